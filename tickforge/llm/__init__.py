"""Operators for training-data pipelines over text tables (documents, pages, benchmark, labels).

Nothing else in the library imports this subpackage.
"""

"""Host-level quality rules: rule failures by host, shrunk by an empirical beta prior, joined back to documents.

DataFrame functions only; no Python runs on the executors.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BLANKS, cut, small_or_plain, words_of

#: What the base rules count.
COUNTS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")
#: Fixed limits of the rules: least words, and percentages of words, characters and lines.
MIN_WORDS, MAX_REPEAT, MAX_SYMBOLS, MAX_DUP_LINES = 50, 50, 10, 50


def rule_counts(docs: DataFrame, text: str = "text", keep: tuple = ()) -> DataFrame:
    """The columns ``keep`` and COUNTS of every row. Null and blank texts have zeros.

    Repeated words: windows of three words are hashed (64 bits, seeded word by word) and sorted with their places;
    words of windows whose hash occurs again are counted once each. Texts whose windows all differ skip the sort.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    df = docs.select(*keep, words_of(t).alias("_w"), t.alias("_t"))
    lines = F.filter(F.split("_t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    df = df.select(
        *keep, "_w",
        F.size("_w").cast("long").alias("n_words"),
        F.length(F.regexp_replace("_t", BLANKS, "")).cast("long").alias("word_chars"),
        (F.length("_t") - F.length(F.regexp_replace("_t", r"[#*$%&|<>]", ""))).cast("long").alias("n_symbols"),
        lines.alias("_lines"),
    )
    at = lambda i: F.get("_w", i)
    windows = F.when(F.size("_w") >= 3, F.transform(F.sequence(F.lit(0), F.size("_w") - 3), lambda i: F.xxhash64(at(i), at(i + 1), at(i + 2)))).otherwise(F.array().cast("array<bigint>"))
    df = df.select(
        *keep, "n_words", "word_chars", "n_symbols",
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        windows.alias("_win"),
    )
    placed = F.when(F.size(F.array_distinct("_win")) == F.size("_win"), F.array().cast("array<struct<h:bigint,i:int>>")).otherwise(
        F.sort_array(F.transform("_win", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    )
    df = df.select(*[c for c in df.columns if c != "_win"], placed.alias("_p"))
    beside = lambda x, i: (F.get("_p", i - 1)["h"] == x["h"]) | (F.get("_p", i + 1)["h"] == x["h"])
    again = F.transform(F.filter("_p", lambda x, i: F.coalesce(beside(x, i), F.get("_p", i - 1)["h"] == x["h"], F.get("_p", i + 1)["h"] == x["h"], F.lit(False))), lambda x: x["i"])
    df = df.select(*[c for c in df.columns if c != "_p"], F.sort_array(again).alias("_a"))
    step = lambda x, i: F.coalesce(F.least(F.lit(3), F.get("_a", i + 1) - x), F.lit(3))
    covered = F.aggregate(F.transform("_a", step), F.lit(0).cast("long"), lambda s, x: s + x)
    return df.select(*[c for c in df.columns if c != "_a"], covered.alias("n_repeat_words"))


def base_failed():
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT * F.col("n_words"))


def rule_failed():
    """The base rules, or too many symbols among the characters, or too many repeated lines."""
    return base_failed() | (100 * F.col("n_symbols") > MAX_SYMBOLS * F.col("word_chars")) | (100 * F.col("n_dup_lines") > MAX_DUP_LINES * F.col("n_lines"))


def host_verdicts(counts: DataFrame, host: str, max_rate: float = 0.5, default_strength: float = 10.0) -> DataFrame:
    """(host, n_docs, n_failed, shrunk_rate, host_rejected).

    The beta prior comes from all hosts' raw rates by the method of moments; where their spread is 0 or too wide for
    a beta distribution, it has the mean rate and ``default_strength`` pseudo-documents. Null is a host of its own.
    """
    return _verdicts_of(counts.groupBy(host).agg(F.count("*").alias("n_docs"), F.sum(F.col("failed").cast("long")).alias("n_failed")), max_rate, default_strength)


def _verdicts_of(hosts: DataFrame, max_rate: float, default_strength: float = 10.0) -> DataFrame:
    hosts = cut(hosts, "hosts")
    rate = F.col("n_failed") / F.col("n_docs")
    row = hosts.agg(F.avg(rate).alias("m"), F.var_pop(rate).alias("v")).first()
    m, v = row["m"] or 0.0, row["v"] or 0.0
    strength = m * (1 - m) / v - 1 if 0 < v < m * (1 - m) else default_strength
    shrunk = (F.col("n_failed") + F.lit(m * strength)) / (F.col("n_docs") + F.lit(strength))
    return hosts.withColumn("shrunk_rate", shrunk).withColumn("host_rejected", F.col("shrunk_rate") > max_rate)


def judge(docs: DataFrame, text: str = "text", host: str = "source", keep: tuple = ("doc_id",), max_rate: float = 0.5, max_broadcast: int = 100_000) -> DataFrame:
    """One row per document: ``keep``, host, COUNTS, base_failed, failed, shrunk_rate, host_rejected, kept.

    A document is kept if it fails no rule and its host's shrunk failure rate is at most max_rate. The texts are
    read once; only the counts are grouped and joined. Null and empty texts fail, very long ones are counted whole;
    repeated rows are judged each; an empty table gives an empty result; columns other than keep, host and text are not read.
    """
    keep = tuple(c for c in keep if c != host)
    counts = rule_counts(docs, text, (*keep, host)).withColumn("base_failed", base_failed()).withColumn("failed", rule_failed())
    counts = cut(counts, "counts")
    verdicts = host_verdicts(counts, host, max_rate).select(F.col(host).alias("_host"), "shrunk_rate", "host_rejected")
    out = counts.join(small_or_plain(verdicts, max_broadcast), F.col(host).eqNullSafe(F.col("_host")), "left").drop("_host")
    return out.withColumn("kept", ~F.col("failed") & ~F.col("host_rejected"))


def keep_good(docs: DataFrame, text: str = "text", host: str = "source", max_rate: float = 0.5, max_broadcast: int = 100_000) -> DataFrame:
    """The rows of docs that judge() keeps, with docs' columns.

    Two passes over the texts instead of a shuffle of them: the first sums failures by host, the second applies the
    rules and the joined host verdicts row by row. Null and empty texts fail and go; a null host is a host of its own;
    repeated rows are judged each; an empty table gives an empty result; extra columns pass through, whatever their names.
    """
    first = cut(rule_counts(docs, text, (host,)).select(host, rule_failed().alias("failed")).groupBy(host, "failed").count(), "hosts")
    counts = first.groupBy(host).agg(F.sum("count").alias("n_docs"), F.sum(F.when(F.col("failed"), F.col("count")).otherwise(0)).alias("n_failed"))
    verdicts = _verdicts_of(counts, max_rate).select(F.col(host).alias("_host"), F.col("host_rejected").alias("_rejected"))
    row = F.struct(*[F.col(c) for c in docs.columns])
    # The verdict passes through a generator: a plain filter would be pushed down and evaluate the counts many times.
    judged = rule_counts(docs.withColumn("_row", row), text, ("_row",)).select(F.explode(F.array(F.struct("_row", rule_failed().alias("failed")))).alias("_x"))
    again = judged.where("not _x.failed").select("_x._row.*")
    good = again.join(small_or_plain(verdicts, max_broadcast), F.col(host).eqNullSafe(F.col("_host")), "left")
    return good.where(~F.col("_rejected")).select(*docs.columns)

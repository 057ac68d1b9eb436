"""Two-level prefixes: running values per symbol that stay parallel when one symbol dominates.

A window over a symbol's whole history is one task. Here the history is cut into time blocks; block totals, a small
table, are accumulated over the blocks, and each row adds its running value inside its own block. Results equal the
plain window's exactly as long as the measure is exact (integers, decimals).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def blocks(ts: str = "ts", unit: str = "day") -> Column:
    return F.date_trunc(unit, F.col(ts))


def _group(key: str, block: Column) -> Column:
    """The key and the block as one struct: its nulls are equal to each other, so rows without either are rows of a
    group like any other, in joins too."""
    return F.struct(F.col(key).alias("k"), block.alias("b"))


def running_total(df: DataFrame, measure: Column, out: str, key: str = "symbol", order: tuple = ("ts", "trade_id"), unit: str = "day") -> DataFrame:
    """Adds the inclusive running sum of measure per key in the total order. Null measures count 0; a null key is a key
    of its own, and rows without a time come first."""
    d = df.withColumn("_m", F.coalesce(measure, F.lit(0))).withColumn("_grp", _group(key, blocks(order[0], unit)))
    inner = W.partitionBy("_grp").orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    before = W.partitionBy("_grp.k").orderBy("_grp.b").rowsBetween(W.unboundedPreceding, -1)
    totals = d.groupBy("_grp").agg(F.sum("_m").alias("_tot")).withColumn("_pre", F.coalesce(F.sum("_tot").over(before), F.lit(0))).drop("_tot")
    d = d.join(totals, "_grp").withColumn(out, F.col("_pre") + F.sum("_m").over(inner))
    return d.drop("_m", "_grp", "_pre")


def row_numbers(df: DataFrame, out: str = "rn", key: str = "symbol", order: tuple = ("ts", "trade_id"), unit: str = "day") -> DataFrame:
    """Adds 1, 2, ... per key in the total order."""
    return running_total(df, F.lit(1).cast("long"), out, key, order, unit)


def previous(df: DataFrame, columns: dict[str, str], key: str = "symbol", order: tuple = ("ts", "trade_id"), unit: str = "day") -> DataFrame:
    """Adds lag(column) under the given names; the first row of a block looks up the last row of the block before."""
    names = list(columns)
    d = df.withColumn("_grp", _group(key, blocks(order[0], unit)))
    inner = W.partitionBy("_grp").orderBy(*order)
    last = d.groupBy("_grp").agg(F.max_by(F.struct(*names), F.struct(*order)).alias("_last"))
    last = last.withColumn("_last", F.lag("_last").over(W.partitionBy("_grp.k").orderBy("_grp.b")))
    d = d.join(last, "_grp").withColumn("_rn", F.row_number().over(inner))
    for c, out in columns.items():
        d = d.withColumn(out, F.when(F.col("_rn") == 1, F.col(f"_last.{c}")).otherwise(F.lag(c).over(inner)))
    return d.drop("_grp", "_last", "_rn")


def decayed_sum(df: DataFrame, measure: Column, decay: float, out: str, key: str = "symbol", order: tuple = ("ts", "trade_id"), unit: str = "day") -> DataFrame:
    """Adds y_t = decay * y_{t-1} + measure_t per key, for 0 < decay < 1.

    Rows are numbered by two-level prefixes and cut into runs of equal length, short enough for decay ** length to
    stay a double however dense a symbol is. Inside a run y is a running sum of measure / decay ** i, scaled back. The
    runs before are folded as far back as they still count in a double: a bounded halo of one row a run.
    """
    digits = -math.log10(decay)
    size = max(1, min(512, int(200 / digits)))
    halo = math.ceil(18 / (digits * size)) + 1
    d = row_numbers(df.withColumn("_x", F.coalesce(measure.cast("double"), F.lit(0.0))), "_g", key, order, unit)
    d = d.withColumn("_i", (F.col("_g") - 1) % size + 1).withColumn("_c", _group(key, F.floor((F.col("_g") - 1) / size)))
    scaled = F.col("_x") * F.pow(F.lit(decay), size - F.col("_i"))
    ends = d.groupBy("_c").agg(F.sum(scaled).alias("_b"))
    before = F.collect_list("_b").over(W.partitionBy("_c.k").orderBy("_c.b").rowsBetween(-halo, -1))
    carry = ends.select("_c", F.aggregate(before, F.lit(0.0), lambda s, x: s * F.lit(decay**size) + x).alias("_carry"))
    inner = W.partitionBy("_c").orderBy("_g").rowsBetween(W.unboundedPreceding, 0)
    d = d.join(carry, "_c").withColumn("_y", F.sum(scaled).over(inner))
    value = F.col("_carry") * F.pow(F.lit(decay), "_i") + F.col("_y") / F.pow(F.lit(decay), size - F.col("_i"))
    return d.withColumn(out, value).drop("_x", "_g", "_c", "_i", "_y", "_carry")

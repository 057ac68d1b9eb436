"""Exact quantiles by histogram refinement: no task ever holds the values of a key.

Values are counted by bucket, the bucket that holds a wanted rank is found, and only that bucket is counted again, until
it is a single value or small. Bucket edges are approximate quantiles of what is left, so buckets are about equally full
whatever the values look like, and a value that many rows share is a bucket of its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..sources.files import written

#: Edges of a round's histogram, and the accuracy of their sketch.
EDGES, ACCURACY = 31, 1000
#: A bucket of at most so many rows is sorted.
SMALL = 100_000


def _histogram(d: DataFrame, open_: DataFrame) -> DataFrame:
    """(k, lo, hi, bucket, c, blo, bhi): rows of each bucket of the ranges lo to hi, and its least and largest value."""
    grid = [i / (EDGES + 1) for i in range(1, EDGES + 1)]
    inside = d.join(open_, "k").where(F.col("x").between(F.col("lo"), F.col("hi")))
    edges = inside.groupBy("k", "lo", "hi").agg(F.array_distinct(F.percentile_approx("x", grid, ACCURACY)).alias("e"))
    # Even numbers lie between edges, odd ones are edges.
    bucket = F.size(F.filter("e", lambda v: v < F.col("x"))) + F.size(F.filter("e", lambda v: v <= F.col("x")))
    rows = d.join(edges, "k").where(F.col("x").between(F.col("lo"), F.col("hi"))).withColumn("bucket", bucket)
    return rows.groupBy("k", "lo", "hi", "bucket").agg(F.sum("c").alias("c"), F.min("x").alias("blo"), F.max("x").alias("bhi"))


def exact_quantiles(df: DataFrame, column: str, probabilities: dict[str, float], keys: tuple = ("symbol",), small: int = SMALL, weight: str | None = None) -> DataFrame:
    """One row per key with the quantiles of a column under the given names, interpolated between neighbouring values.

    Equal to sorting all values of a key. Each round shuffles one row a bucket and task, and reads df once for the edges
    and once for the counts; a round leaves about 1 / EDGES of the rows before it. Null values don't count, a null key is
    a key of its own; keys without values have no row. weight: a column of how often each row counts.
    """
    d = df.select(F.struct(*keys).alias("k"), F.col(column).cast("double").alias("x"), (F.lit(1) if weight is None else F.col(weight)).cast("long").alias("c")).where(F.col("x").isNotNull())
    base = d.groupBy("k").agg(F.sum("c").alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi"))
    wanted = F.explode(F.array(*[F.struct(F.lit(name).alias("name"), F.lit(float(p)).alias("p"), F.lit(up).alias("up")) for name, p in probabilities.items() for up in (0, 1)]))
    at = F.col("w.p") * (F.col("n") - 1)
    rank = F.least(F.floor(at) + F.col("w.up"), F.col("n") - 1)
    state = base.withColumn("w", wanted).select("k", "w.name", "w.up", rank.alias("rank"), (at - F.floor(at)).alias("part"), "lo", "hi", F.lit(0).cast("long").alias("below"), F.col("n").alias("inside"))
    state = written(state, "ranks")
    is_open = (F.col("inside") > small) & (F.col("lo") < F.col("hi"))
    while state.where(is_open).limit(1).count():
        h = _histogram(d, state.where(is_open).select("k", "lo", "hi").distinct())
        before = W.partitionBy("k", "lo", "hi").orderBy("bucket").rowsBetween(W.unboundedPreceding, W.currentRow)
        h = h.withColumn("upto", F.sum("c").over(before))
        r = F.col("rank") - F.col("below")
        finer = state.where(is_open).join(h, ["k", "lo", "hi"]).where((r < F.col("upto")) & (r >= F.col("upto") - F.col("c")))
        finer = finer.select("k", "name", "up", "rank", "part", F.col("blo").alias("lo"), F.col("bhi").alias("hi"), (F.col("below") + F.col("upto") - F.col("c")).alias("below"), F.col("c").alias("inside"))
        state = written(state.where(~is_open).unionByName(finer), "ranks")
    left = state.where("lo < hi")
    values = d.join(left.select("k", "lo", "hi").distinct(), "k").where(F.col("x").between(F.col("lo"), F.col("hi"))).groupBy("k", "lo", "hi", "x").agg(F.sum("c").alias("c"))
    values = values.withColumn("upto", F.sum("c").over(W.partitionBy("k", "lo", "hi").orderBy("x").rowsBetween(W.unboundedPreceding, W.currentRow)))
    r = F.col("rank") - F.col("below")
    found = left.join(values, ["k", "lo", "hi"]).where((r < F.col("upto")) & (r >= F.col("upto") - F.col("c"))).select("k", "name", "up", "part", "x")
    found = found.unionByName(state.where("lo = hi").select("k", "name", "up", "part", F.col("lo").alias("x")))
    value = lambda name, up: F.max(F.when((F.col("name") == name) & (F.col("up") == up), F.col("x")))
    part = lambda name: F.max(F.when(F.col("name") == name, F.col("part")))
    out = found.groupBy("k").agg(*[(value(n, 0) + (value(n, 1) - value(n, 0)) * part(n)).alias(n) for n in probabilities])
    return out.select("k.*", *probabilities)

"""Mixing sources to target weights by hash-threshold histograms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import cut, small_or_plain, words_of

#: Relative weights of the sources, taken in turn.
WEIGHTS = (3, 1, 2)
#: Hex digits of a document's hash: 15 digits are 60 bits, and each histogram round settles STEP digits.
DIGITS, STEP = 15, 4


def doc_hash(doc_id: Column) -> Column:
    """60 bits of the MD5 of the id as lower-case hex text; null hashes as the empty string."""
    return F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit(""))), 1, DIGITS)


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = 1.5, repeat: int = 2) -> DataFrame:
    """(source, source_size) to (source, source_size, weight, target).

    Sources in code-point order, null last, weigh ``weights`` in turn. Together they get ``share`` of all sizes, by
    weight; none gets more than ``repeat`` times its size, and what it can't use goes to the others by weight. The
    limits are found in closed form: sources are capped in the order of size per weight while their cap lies below
    the level that the rest would get. One row per source; all-empty sources get 0.
    """
    rank = W.orderBy(F.col("source").isNull(), F.col("source"))
    by_need = W.orderBy(F.col("source_size") / F.col("weight"), F.col("source").isNull(), F.col("source"))
    n = len(weights)
    pick = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (F.col("_rank") % n + 1).cast("int"))
    t = sizes.withColumn("_rank", F.row_number().over(rank) - 1).withColumn("weight", pick)
    whole = W.partitionBy(F.lit(0))
    t = (
        t.withColumn("_total", F.sum("source_size").over(whole))
        .withColumn("_capped", F.coalesce(F.sum("source_size").over(by_need.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
        .withColumn("_open", F.sum("weight").over(by_need.rowsBetween(0, W.unboundedFollowing)))
        .withColumn("_level", (F.col("_total") * F.lit(float(share)) - F.col("_capped") * F.lit(float(repeat))) / F.col("_open"))
        .withColumn("_over", F.col("source_size") * F.lit(float(repeat)) <= F.col("_level") * F.col("weight"))
    )
    # The first source that is not capped has the level of all the rest; later rows would see lower ones.
    level = F.max(F.when(~F.col("_over"), F.col("_level"))).over(whole)
    cap = F.col("source_size") * F.lit(float(repeat))
    return t.withColumn("target", F.when(F.col("_over"), cap).otherwise(F.least(cap, level * F.col("weight")))).select("source", "source_size", "weight", "target")


def thresholds(docs: DataFrame, budgets: DataFrame) -> DataFrame:
    """Per source the number of whole passes and the hash below which a document is taken once more.

    docs: (source, size, h); budgets: (source, source_size, target). Budgets over the source's size start with
    whole passes. For the rest, sizes are summed by source and by the first STEP digits of the hash; the running sum
    finds the bucket that the budget ends in, and only that bucket's documents are summed again by the next digits,
    until one hash is left in it.
    The result (source, passes, below) takes ``h < below``: the run of hashes whose sum is nearest to the budget.
    """
    b = budgets.select(
        "source",
        F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long").alias("passes"),
        "source_size", "target",
    )
    b = b.withColumn("room", F.col("target") - F.col("passes") * F.col("source_size")).select("source", "passes", "room").withColumn("below", F.lit(""))
    b = cut(b, "mix")
    depth, settled = 0, False
    while depth < DIGITS and not settled:
        before, depth = depth, min(depth + STEP, DIGITS)
        inside = docs if not before else docs.join(small_or_plain(b.select(F.col("source").alias("_s"), "below"), 100_000), F.col("source").eqNullSafe(F.col("_s")) & F.substring("h", 1, before).eqNullSafe(F.col("below")))
        sums = inside.groupBy("source", F.substring("h", 1, depth).alias("bucket")).agg(F.sum("size").alias("tokens"), (F.min("h") == F.max("h")).alias("single"))
        order = W.partitionBy("source").orderBy("bucket")
        run = sums.withColumn("upto", F.sum("tokens").over(order)).select(F.col("source").alias("_s"), "bucket", "tokens", "upto", "single")
        over = b.select("source", "room").join(run, F.col("source").eqNullSafe(F.col("_s")) & (F.col("upto") > F.col("room")))
        first = over.groupBy("source").agg(F.min(F.struct("bucket", "tokens", "upto", "single")).alias("x"))
        b = b.select("source", "passes", "room", "below").join(first.select(F.col("source").alias("_s"), "x"), F.col("source").eqNullSafe(F.col("_s")), "left").select(
            "source", "passes",
            F.when(F.col("x").isNull(), F.col("room")).otherwise(F.col("room") - (F.col("x.upto") - F.col("x.tokens"))).alias("room"),
            F.when(F.col("x").isNull(), F.rpad("below", depth, "g")).otherwise(F.col("x.bucket")).alias("below"),
            F.coalesce("x.single", F.lit(True)).alias("single"), F.col("x.tokens").alias("edge"),
        )
        b = cut(b, "mix")
        settled = bool(b.agg(F.min("single")).first()[0] in (True, None))
    return b.select("source", "passes", F.when(F.col("edge") < 2 * F.col("room"), F.concat("below", F.lit("g"))).otherwise(F.col("below")).alias("below"))


def mix(docs: DataFrame, text: str = "text", source: str = "source", doc_id: str = "doc_id", weights=WEIGHTS, share: float = 1.5, repeat: int = 2, max_broadcast: int = 100_000) -> DataFrame:
    """Which documents a weighted mix takes, and how often.

    Adds mix_size (words), source_size, target and copies (0 to ``repeat``) to every row. Deterministic: the choice
    depends on ids and sizes only, so reruns agree. Null texts have size 0; null sources are a source of their own
    (last); columns of these names in docs are replaced; rows with one doc_id share a hash and so their fate; an empty table gives an empty result. A source's
    taken words miss its target by at most half the size of one document, the one at the threshold.
    """
    docs = docs.drop("mix_size", "source_size", "target", "copies")
    sized = docs.withColumn("mix_size", F.size(words_of(F.col(text))).cast("long")).withColumn("_h", doc_hash(F.col(doc_id)))
    slim = cut(sized.select(F.col(source).alias("source"), F.col("mix_size").alias("size"), F.col("_h").alias("h")), "mix")
    sizes = slim.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = cut(source_targets(sizes, weights, share, repeat), "mix")
    cuts = thresholds(slim, targets)
    plan = targets.join(cuts.withColumnRenamed("source", "_c"), F.col("source").eqNullSafe(F.col("_c"))).select(F.col("source").alias("_src"), "source_size", "target", F.col("passes").alias("_passes"), F.col("below").alias("_below"))
    plan = small_or_plain(cut(plan, "mix"), max_broadcast)
    copies = F.col("_passes") + F.when((F.col("_h") < F.col("_below")) & (F.col("_passes") < repeat), 1).otherwise(0)
    return sized.join(plan, sized[source].eqNullSafe(F.col("_src"))).withColumn("copies", copies.cast("long")).drop("_src", "_h", "_passes", "_below")

"""Helpers shared by the text operators: words, lineage cuts, checked broadcasts, components."""

from __future__ import annotations

import contextlib
import functools
import math
import uuid
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words are maximal runs of anything but the six ASCII white-space characters.
BLANKS = r"[\x20\x09-\x0D]+"


def words_of(text: Column) -> Column:
    """Array of the words of a text; null and blank texts give an empty array."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), BLANKS), "")


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z only; other letters stay as they are."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that the driver and all executors see: spark.checkpoint.dir, or else one in the warehouse."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    return folder.rstrip("/") if folder else spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


#: Scratch tables of the scopes that are open, the innermost last.
_scopes: list[list[DataFrame]] = []


#: Whether an action's shuffle files go when it has ended; otherwise they stay until the driver collects its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def cut(df: DataFrame, label: str = "cut") -> DataFrame:
    """Write df to the shared folder and read it back: lineage ends here, and a lost executor loses nothing.

    The shuffle files of the write go with it, as nothing reads them again.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    was = spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, was)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch = path
    if _scopes:
        _scopes[-1].append(out)
    return out


def drop_cut(df: DataFrame) -> None:
    """Delete the files of a cut() result that nothing reads any more."""
    path, df._scratch = getattr(df, "_scratch", None), None
    if path:
        jvm = df.sparkSession._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(p, True)


@contextlib.contextmanager
def scratch() -> Iterator[list]:
    """Deletes the cut() results made inside, but for those appended to the list, which belong to the scope around."""
    _scopes.append([])
    stay: list[DataFrame] = []
    try:
        yield stay
    finally:
        for df in _scopes.pop():
            if not any(df is x for x in stay):
                drop_cut(df)
        if _scopes:
            _scopes[-1].extend(x for x in stay if not any(x is y for y in _scopes[-1]))


def small_or_plain(df: DataFrame, max_rows: int, weight: Column | None = None) -> DataFrame:
    """A broadcast hint on df if its rows, or the sum of their weights, are at most max_rows; otherwise df, for a shuffled join."""
    if weight is None:
        return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df
    return F.broadcast(df) if (df.agg(F.sum(weight)).first()[0] or 0) <= max_rows else df


def spread(pairs: DataFrame, per_task: int, *by: Column | str) -> DataFrame:
    """pairs in a task for each per_task rows, whatever their bytes: what is done with a pair takes far longer than to move it."""
    return pairs.repartition(max(1, -(-pairs.count() // per_task)), *by)


def _is_stars(edges: DataFrame) -> bool:
    """Whether every u has one v, which is not itself a u: then each v is the smallest id of its component."""
    ends = edges.select(F.col("u").alias("id"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(edges.select(F.col("v").alias("id"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    odd = ends.groupBy("id").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up > 1 or (up = 1 and down = 1)")
    return odd.limit(1).count() == 0


def connected_components(edges: DataFrame, a: str, b: str, max_rounds: int = 60) -> DataFrame:
    """(id, component) for every end of an edge; component is the smallest id reachable.

    Distributed union-find by alternating stars: in the large step each node hands its larger neighbours to its
    smallest one, in the small step its smaller ones; stars of depth one remain after O(log^2 n) rounds. Only
    minima are aggregated (combined before each shuffle) and joined back, so no neighbourhood is ever collected.
    Loops and repeated edges are harmless; an empty input gives an empty result.
    """
    e = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    e = cut(e, "edges")
    for _ in range(max_rounds):
        if _is_stars(e):
            break
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
            .unionByName(low.select("u", F.col("m").alias("v"))).distinct()
        )
        done = cut(small, "edges")
        drop_cut(e)
        e = done
    else:
        raise RuntimeError("connected_components did not settle")
    roots = e.select(F.col("v").alias("id")).distinct().withColumn("component", F.col("id"))
    return e.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(roots)


#: In buckets of at most SMALL members all pairs are compared at once; in larger ones each member first meets the
#: weightiest one. What is open then is compared whole in buckets of at most CROWD members; in larger ones each member
#: meets a few representatives of the other components, for ROUNDS rounds, and then every pair that is still open is
#: compared, in blocks of BLOCK by BLOCK members; CHUNK pairs are confirmed at a time.
SMALL, CROWD, ROUNDS, BLOCK, CHUNK = 8, 48, 1, 1024, 2_000_000
#: Blocks of members that a task compares, on average.
BLOCKS = 16
#: Keys of shared buckets that are broadcast to find their members, at most.
MAX_KEYS = 1_000_000
#: Rows of features that are broadcast, at most.
MAX_ROWS = 20_000
#: Hashes of the sets that members of crowded buckets are compared with that are broadcast, at most.
MAX_HASHES = 1_000_000
#: Hashes of the groups that are indexed at a time, about, and pairs that are screened at a time: what both shuffle is
#: deleted before the next ones, so disk holds one part only.
INDEX, SCREENED = 4_000_000, 500_000
#: Members of a group that are of one size, at most, for them to be compared pair by pair, and the pairs of a task then.
FEW, COMPARED = 1000, 100_000


def _star(member: DataFrame, picks: list) -> DataFrame:
    """Pairs (a, b) of every member and those representatives of its buckets that lie in other components.

    picks give (id, comp). What a member meets is gathered over its buckets before it is spread out, so
    a pair that meets in many buckets is one row from then on.
    """
    reps = member.groupBy("key").agg(F.array_compact(F.array_distinct(F.array(*picks))).alias("reps"))
    p = member.join(reps, "key").select("id", F.filter("reps", lambda r: r["comp"] != F.col("comp")).alias("reps")).where(F.size("reps") > 0)
    p = p.groupBy("id").agg(F.array_distinct(F.flatten(F.collect_set("reps"))).alias("reps"))
    p = p.select("id", F.explode("reps.id").alias("rep"))
    return p.select(F.least("id", "rep").alias("a"), F.greatest("id", "rep").alias("b")).distinct()


def _all_pairs(open_: DataFrame, features: DataFrame, may) -> DataFrame:
    """Pairs (a, b) of open_ (key, id, m, comp, main) that share a bucket, lie in different components and may be alike.

    Members outside a bucket's main component meet all its members. Both sides are dealt to blocks by their ids, so
    a crowded bucket is spread over many tasks; a pair comes out of the first bucket that it shares only.
    """
    keys = open_.groupBy("id").agg(F.sort_array(F.collect_set("key")).alias("keys"))
    d = open_.join(keys, "id").join(features, "id").withColumn("n", F.ceil(F.col("m") / BLOCK).cast("int"))
    d = d.withColumn("blk", F.pmod(F.xxhash64("id"), F.col("n")).cast("int")).withColumn("away", F.col("comp") != F.col("main"))
    span = F.sequence(F.lit(0), F.col("n") - 1)
    one = d.where("away").select("key", F.col("blk").alias("p"), F.explode(span).alias("q"), F.col("id").alias("i1"), F.col("comp").alias("c1"), F.col("keys").alias("k1"), F.col("f").alias("f1"))
    two = d.select("key", F.explode(span).alias("p"), F.col("blk").alias("q"), F.col("id").alias("i2"), F.col("comp").alias("c2"), F.col("keys").alias("k2"), F.col("f").alias("f2"), "away")
    first = F.col("key") == F.array_min(F.array_intersect("k1", "k2"))
    once = ~F.col("away") | (F.col("i1") < F.col("i2"))
    # Blocks are dealt by their number, not by the few bytes of their members.
    n_blocks = open_.select("key", "m").distinct().agg(F.sum(F.pow(F.ceil(F.col("m") / BLOCK), F.lit(2)))).first()[0] or 0
    tasks = int(n_blocks // BLOCKS) + 1
    one, two = (x.repartition(tasks, "key", "p", "q") for x in (one, two))
    pairs = one.join(two, ["key", "p", "q"]).where((F.col("c1") != F.col("c2")) & once & may(F.col("f1"), F.col("f2")) & first)
    return pairs.select(F.least("i1", "i2").alias("a"), F.greatest("i1", "i2").alias("b")).distinct()


def _overlap_pairs(open_: DataFrame, sets, percent: int, features: DataFrame | None = None, may=None, shared=None) -> DataFrame:
    """Pairs (a, b) of open_ (key, id, w, comp) that share a bucket, lie in different components and may be alike,
    by an index of what members differ in. No pair whose sets reach percent % is left out.

    Buckets with one weightiest member form a group. A member counts by its difference D to that member's set, or by
    its own set where differences are no smaller: two sets differ by |D1| + |D2| - 2 * |D1 & D2|, so they are alike if
    |D1 & D2| is at least the sum of (|D| - (100 - percent) / (100 + percent) * n) / 2 over both. Then they share one
    of the rarest of their hashes, of those that are left when all but so many are taken away. As a member outside
    the main component differs much from the weightiest one, one that differs little must share over half of its few
    differences with it; most of these are in no other set and never joined. Where the sum is not positive, pairs are
    alike for certain, and both are linked with the member of the smallest share. Groups are taken in parts of about
    INDEX hashes.

    With shared(f1, f2), the share of the second's features that the first has, groups whose members have less than
    half of their weightiest one's on average are no copies of one template. Their members differ in size, mostly, and
    are compared by size (_size_pairs) unless more than FEW are of one size; an index would move every hash of theirs.
    """
    reps = open_.groupBy("key").agg(F.max_by("id", F.struct("w", -F.col("id"))).alias("rep"))
    group = cut(open_.join(reps, "key").groupBy("rep", "id").agg(F.min("comp").alias("comp")), "groups")
    main = group.groupBy("rep", "comp").agg(F.count("*").alias("c")).groupBy("rep").agg(F.max(F.struct("c", "comp")).alias("top"), F.count("*").alias("k"))
    main = main.where("k > 1").select("rep", F.col("top.comp").alias("main"))
    group = cut(group.join(small_or_plain(cut(main, "groups"), MAX_KEYS), "rep").select("rep", "id", "comp", (F.col("comp") != F.col("main")).alias("away")), "groups")
    v = cut(sets(group.select("id").distinct()), "sets")
    found = []
    if shared is not None:
        features = cut(features.join(small_or_plain(v.select("id"), MAX_KEYS), "id", "left_semi"), "features")
        reps = small_or_plain(cut(group.select(F.col("rep").alias("id")).distinct(), "ids"), MAX_KEYS)
        f = small_or_plain(cut(features.join(reps, "id", "left_semi").select(F.col("id").alias("rep"), F.col("f").alias("fr")), "sets"), MAX_ROWS)
        size = F.floor(F.log("n") / F.lit(math.log(100 / percent) + 1e-9)).cast("int")
        sized = cut(group.join(v.select("id", F.size("v").alias("n")), "id").select("rep", "id", "comp", "away", size.alias("size")), "groups")
        one_size = sized.groupBy("rep", "size").agg(F.count("*").alias("m")).groupBy("rep").agg(F.max("m").alias("m"))
        apart = sized.join(features, "id").join(f, "rep").groupBy("rep").agg(F.avg(shared(F.col("f"), F.col("fr"))).alias("s"))
        few = small_or_plain(cut(apart.where("s < 0.5").join(one_size.where(F.col("m") <= FEW), "rep").select("rep"), "groups"), MAX_KEYS)
        with scratch() as stay:
            found.append(cut(_size_pairs(sized.join(few, "rep"), features, may), "pairs"))
            stay.append(found[-1])
        group = cut(group.join(few, "rep", "left_anti"), "groups")
    hashes = group.join(v.select("id", F.size("v").alias("n")), "id").agg(F.sum("n")).first()[0] or 0
    parts = -(-hashes // INDEX) if found else max(1, -(-hashes // INDEX))
    for part in range(parts):
        with scratch() as stay:
            found.append(cut(_index_pairs(group.where(F.pmod(F.xxhash64("rep"), F.lit(parts)) == part), v, percent), "pairs"))
            stay.append(found[-1])
    return functools.reduce(DataFrame.unionByName, found).distinct()


def _size_pairs(sized: DataFrame, features: DataFrame, may) -> DataFrame:
    """Pairs (a, b) of _overlap_pairs for some of its groups (rep, id, comp, away, size), where sets that are alike are of
    one size or of neighbouring ones: members meet those of their own size and of the next smaller one."""
    sized = cut(sized, "groups")
    cells = sized.groupBy("rep", "size").agg(F.count("*").alias("m"))
    tasks = int((cells.agg(F.sum(F.col("m") * F.col("m"))).first()[0] or 0) // COMPARED) + 1
    d = sized.join(features, "id")
    one = d.select("rep", "size", F.col("id").alias("i1"), F.col("comp").alias("c1"), F.col("away").alias("a1"), F.col("f").alias("f1"))
    two = d.select("rep", F.explode(F.array(F.col("size"), F.col("size") + 1)).alias("at"), F.col("size").alias("own"), F.col("id").alias("i2"), F.col("comp").alias("c2"), F.col("away").alias("a2"), F.col("f").alias("f2")).withColumnRenamed("at", "size")
    one, two = (x.repartition(tasks, "rep", "size") for x in (one, two))
    pairs = one.join(two, ["rep", "size"]).where((F.col("c1") != F.col("c2")) & (F.col("a1") | F.col("a2")) & ((F.col("own") < F.col("size")) | (F.col("i1") < F.col("i2"))) & may(F.col("f1"), F.col("f2")))
    return pairs.select(F.least("i1", "i2").alias("a"), F.greatest("i1", "i2").alias("b")).distinct()


def _index_pairs(group: DataFrame, v: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of _overlap_pairs for some of its groups (rep, id, comp, away), with the sets v (id, v)."""
    scale, less = 2 * (100 + percent), 100 - percent
    r = small_or_plain(cut(v.join(group.select(F.col("rep").alias("id")).distinct(), "id").select(F.col("id").alias("rep"), F.col("v").alias("r")), "sets"), MAX_HASHES, F.size("r"))
    d = v.join(small_or_plain(group, MAX_KEYS), "id").join(r, "rep")
    d = d.select("rep", "id", "comp", "away", F.size("v").cast("long").alias("n"), "v", F.concat(F.array_except("v", "r"), F.array_except("r", "v")).alias("delta"))
    by_delta = cut(d.groupBy("rep").agg((F.sum(F.size("delta")) < F.sum("n")).alias("by_delta")), "groups")
    d = d.join(small_or_plain(by_delta, MAX_KEYS), "rep").withColumn("x", F.when(F.col("by_delta"), F.col("delta")).otherwise(F.col("v")))
    d = cut(d.select("rep", "id", "comp", "away", "x", F.size("x").alias("nx"), (F.size("x") * F.lit(100 + percent) - F.col("n") * less).alias("share")), "differences")
    low = d.groupBy("rep").agg(F.min("share").alias("low"), F.min_by(F.struct("id", "comp"), F.struct("share", "id")).alias("z"), F.min(F.when(F.col("away"), F.col("share"))).alias("away_low"))
    low = small_or_plain(cut(low, "groups"), MAX_KEYS)
    sure = d.join(low, "rep").where((F.col("share") + F.col("low") <= 0) & (F.col("comp") != F.col("z.comp"))).select("id", F.col("z.id").alias("i2"))

    def prefix(other: str | Column) -> Column:
        """How many of the rarest shared hashes count, if the other member's share is at least so large."""
        need = F.greatest(F.lit(1), F.ceil((F.col("share") + (F.col(other) if isinstance(other, str) else other)) / scale))
        return F.greatest(F.lit(0), F.col("left") - need + 1).cast("int")

    # Hashes that no member outside the main component has are in no pair that is looked for.
    hashes = d.select("rep", "id", "away", F.explode("x").alias("t"))
    shared = hashes.groupBy("rep", "t").agg(F.count("*").alias("c"), F.max("away").alias("any")).where("c > 1 and any").drop("any")
    shared = hashes.drop("away").join(shared, ["rep", "t"]).groupBy("rep", "id").agg(F.sort_array(F.collect_list(F.struct("c", "t"))).alias("s"))
    e = d.drop("x", "nx").join(shared, ["rep", "id"]).join(low, "rep").drop("z").withColumn("left", F.size("s"))
    most = prefix(F.when(F.col("away"), F.col("low")).otherwise(F.col("away_low")))
    e = cut(e.withColumn("s", F.slice("s", F.lit(1), most)), "differences")

    def rarest(e: DataFrame, other: str, k: int) -> DataFrame:
        some = F.slice("s", F.lit(1), prefix(other))
        x = e.select("rep", F.col("id").alias(f"i{k}"), F.col("comp").alias(f"c{k}"), F.col("share").alias(f"s{k}"), F.col("left").alias(f"left{k}"), "away", F.posexplode(some).alias("at", "h"))
        return x.select("rep", F.col("h.t").alias("t"), f"i{k}", f"c{k}", f"s{k}", (F.col(f"left{k}") - F.col("at")).alias(f"left{k}"), *(["away"] if k == 2 else []))

    one, two = rarest(e.where("away"), "low", 1), rarest(e, "away_low", 2)
    # The first hash that both have leaves as many to share as follow in either; of later ones it says too little, but only the first must pass.
    fits = F.least("left1", "left2") * F.lit(scale) >= F.col("s1") + F.col("s2")
    pairs = one.join(two, ["rep", "t"]).where((F.col("c1") != F.col("c2")) & (~F.col("away") | (F.col("i1") < F.col("i2"))) & fits).select("i1", "i2")
    pairs = pairs.unionByName(sure.select(F.col("id").alias("i1"), "i2"))
    return pairs.select(F.least("i1", "i2").alias("a"), F.greatest("i1", "i2").alias("b")).distinct()


def _cross(one: DataFrame, two: DataFrame, apart: Column) -> DataFrame:
    """Pairs (a, b) of rows of one (key, i1, ..) and two (key, id, ..) with one key for which ``apart`` holds."""
    return one.join(two, "key").where(apart).select(F.least("i1", "id").alias("a"), F.greatest("i1", "id").alias("b"))


def bucket_links(buckets: DataFrame, features, may, confirm, sets=None, percent: int = 80, shared=None) -> tuple[DataFrame, DataFrame]:
    """(links, components) of ids that share a bucket; buckets: distinct (key, id); features: (id, f), or a function
    that makes them of the ids that share a bucket.

    may(f1, f2) is false for pairs that can't be alike, confirm(pairs) keeps those of pairs (a, b) that are.
    First the pairs of small buckets are compared, and each member of a larger one with its weightiest member. The
    weight of an id is the sum of the sizes of its buckets, so the text that a group of near copies was made from,
    which is in the fullest bucket of every band, is found without comparing copies with each other. Then only buckets
    whose members still lie in several components go on: see CROWD. No pair that shares a bucket stays open, so
    components are those of comparing all of them; work is linear in the members that representatives link. Those that
    they don't are met through an index of rare hashes, if sets(ids) gives (id, v), the ids' whole sets of hashes, and
    are alike from percent % on (_overlap_pairs, also for shared); otherwise all pairs of a crowded bucket's open members are screened.
    """
    sizes = cut(buckets.groupBy("key").agg(F.count("*").alias("m")).where("m > 1"), "sizes")
    member = cut(buckets.join(small_or_plain(sizes, MAX_KEYS), "key"), "members")
    drop_cut(sizes)
    if callable(features):
        features = features(member)

    def screen(pairs: DataFrame) -> DataFrame:
        def keep(p: DataFrame) -> DataFrame:
            # Only the features of the pairs' ends are shuffled.
            ends = small_or_plain(cut(p.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "ids"), MAX_KEYS)
            some = features.join(ends, "id", "left_semi")
            x, y = some.select(F.col("id").alias("a"), F.col("f").alias("fa")), some.select(F.col("id").alias("b"), F.col("f").alias("fb"))
            return p.join(x, "a").join(y, "b").where(may(F.col("fa"), F.col("fb"))).select("a", "b")

        pairs = cut(pairs, "unscreened")
        parts = -(-pairs.count() // SCREENED)
        if parts <= 1:
            return keep(pairs)
        return functools.reduce(DataFrame.unionByName, [cut(keep(pairs.where(F.pmod(F.xxhash64("a", "b"), F.lit(parts)) == part)), "pairs") for part in range(parts)])

    weight = member.groupBy("id").agg(F.sum("m").alias("w"))
    full = cut(member.where(F.col("m") > SMALL).join(weight, "id"), "members")
    reps = full.groupBy("key").agg(F.max_by("id", F.struct("w", -F.col("id"))).alias("rep"))
    star = full.join(reps, "key").where("id <> rep").select(F.least("id", "rep").alias("a"), F.greatest("id", "rep").alias("b"))
    few = member.where(F.col("m") <= SMALL).select("key", "id")
    with scratch() as stay:
        pairs = star.unionByName(_cross(few.withColumnRenamed("id", "i1"), few, F.col("i1") < F.col("id"))).distinct()
        pairs = cut(screen(pairs), "pairs")
        stay.append(pairs)
    drop_cut(member)
    links, tried = confirm(pairs), pairs
    comps = cut(connected_components(links, "a", "b"), "components")
    one = F.struct("id", "comp")
    for turn in range(ROUNDS + 1):
        d = full.join(comps.withColumnRenamed("id", "_c"), F.col("id") == F.col("_c"), "left").select("key", "id", "m", "w", F.coalesce("component", "id").alias("comp"))
        main = d.groupBy("key", "comp").agg(F.count("*").alias("c")).groupBy("key").agg(F.max(F.struct("c", "comp")).alias("top"), F.count("*").alias("k"))
        d = cut(d.join(main.where("k > 1").select("key", F.col("top.comp").alias("main")), "key"), "open")
        big = d.where(F.col("m") > CROWD)
        if not (big if turn else d).limit(1).count():
            break
        whole = turn == ROUNDS
        away = F.col("comp") != F.col("main")
        with scratch() as stay:
            if whole:
                new = _all_pairs(big, features, may) if sets is None else screen(_overlap_pairs(big, sets, percent, features, may, shared))
            else:
                toss = lambda k: F.xxhash64("id", F.lit(8 * turn + k))
                picks = [F.max_by(one, F.when(away, F.struct("w", -F.col("id")))), *[F.min_by(one, F.when(away, toss(k))) for k in range(2)], *[F.min_by(one, F.when(~away, toss(k))) for k in range(2, 7)]]
                new = _star(big, picks)
                if turn == 0:
                    # In a bucket of two open members or more, those outside the main component meet all the others.
                    some = d.where(F.col("m") <= CROWD).withColumn("away", away)
                    x = some.where("away").select("key", F.col("id").alias("i1"), F.col("comp").alias("c1"))
                    new = new.unionByName(_cross(x, some, (F.col("c1") != F.col("comp")) & (~F.col("away") | (F.col("i1") < F.col("id"))))).distinct()
                new = screen(new)
            new = cut(new.join(tried, ["a", "b"], "left_anti"), "pairs")
            stay.append(new)
        drop_cut(d)
        parts = -(-new.count() // CHUNK)
        for part in range(parts):
            todo = new
            if parts > 1:
                # Pairs that the parts before have linked are left out.
                of = lambda end: comps.select(F.col("id").alias(end), F.col("component").alias("_" + end))
                todo = new.where(F.pmod(F.xxhash64("a", "b"), F.lit(parts)) == part).join(of("a"), "a", "left").join(of("b"), "b", "left")
                todo = cut(todo.where(F.coalesce("_a", "a") != F.coalesce("_b", "b")).select("a", "b"), "pairs")
            extra = confirm(todo)
            if not extra.limit(1).count():
                continue
            links = links.unionByName(extra)
            # Stars of the components so far stand for the links behind them.
            stars = comps.select(F.col("id").alias("a"), F.col("component").alias("b"))
            comps = cut(connected_components(stars.unionByName(extra), "a", "b"), "components")
        tried = tried.unionByName(new)
    return links, comps

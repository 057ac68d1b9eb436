"""Scans and sinks over files: hive-partitioned ticks, exports, keyed appends and merges, backups, reports."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ticks import deduplicate
from ..schema import TICKS


def shared_path(spark: SparkSession, label: str) -> str:
    """A new path in the folder that driver and executors share: spark.checkpoint.dir, or else one in the warehouse."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
    return f"{folder.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """df written to the shared folder and read back: lineage ends here, whatever executors are lost later."""
    path = shared_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_ticks(spark: SparkSession, path: str, symbol: str | None = None, start_date: str | None = None, end_date: str | None = None, columns: list[str] | None = None) -> DataFrame:
    """Ticks under symbol=/date= folders. Symbol and dates prune folders, columns prune the scan; a missing path is an error."""
    df = spark.read.schema(TICKS).parquet(path)
    if symbol is not None:
        df = df.where(F.col("symbol") == symbol)
    if start_date is not None:
        df = df.where(F.col("date") >= F.lit(start_date).cast("date"))
    if end_date is not None:
        df = df.where(F.col("date") <= F.lit(end_date).cast("date"))
    return df.select(*columns) if columns else df


def read_nested(spark: SparkSession, path: str) -> DataFrame:
    """date/symbol/*.parquet folders that are not hive-style; both come from the columns."""
    return spark.read.parquet(f"{path}/*/*/*.parquet")


def read_csv_ticks(spark: SparkSession, path: str, schema: str = "symbol string, trade_id long, ts timestamp, price decimal(18,8), quantity decimal(18,8), is_buyer_maker boolean, date date") -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)


def read_lake(spark: SparkSession, path: str, version: int | None = None, as_of: str | None = None, fmt: str = "delta") -> DataFrame:
    """A table version of a lake format, where its connector is on the class path."""
    r = spark.read.format(fmt)
    if version is not None:
        r = r.option("versionAsOf", version)
    if as_of is not None:
        r = r.option("timestampAsOf", as_of)
    return r.load(path)


def _commits(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("version long, first_version long, committed_at timestamp").parquet(f"{path}/commits")


def commit_version(df: DataFrame, path: str, replace: bool = False) -> int:
    """Write df as the next version of a Parquet table that keeps its older ones; the version's number comes back.

    A version adds its rows to those before, or stands for all of them (``replace``). Its commit is written after its
    rows, so rows of a writer that failed are never read, and the next writer overwrites them. One writer at a time;
    all versions have the same columns. An empty df makes a version too.
    """
    spark = df.sparkSession
    try:
        last = _commits(spark, path).orderBy(F.desc("version")).first()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        last = None
    version = last["version"] + 1 if last else 1
    first = last["first_version"] if last and not replace else version
    df.write.mode("overwrite").parquet(f"{path}/rows/{version}")
    commit = spark.range(1).select(F.lit(version).cast("long").alias("version"), F.lit(first).cast("long").alias("first_version"), F.current_timestamp().alias("committed_at"))
    commit.write.mode("append").parquet(f"{path}/commits")
    return version


def read_version(spark: SparkSession, path: str, version: int | None = None, as_of: str | datetime | None = None) -> DataFrame:
    """The table as it was at a version, or at a time; as it is now without either. Only folders that count are read.

    A version or time before which nothing was committed is an error, and so is a missing path.
    """
    commits = _commits(spark, path)
    if version is not None:
        commits = commits.where(F.col("version") == version)
    if as_of is not None:
        commits = commits.where(F.col("committed_at") <= F.lit(as_of).cast("timestamp"))
    at = commits.orderBy(F.desc("version")).first()
    if at is None:
        raise ValueError(f"{path} has no version {version if version is not None else ''} as of {as_of or 'now'}")
    folders = [f"{path}/rows/{v}" for v in range(at["first_version"], at["version"] + 1)]
    return spark.read.parquet(*folders)


def write_ticks(ticks: DataFrame, path: str, mode: str = "append", salt: int = 8) -> None:
    """zstd Parquet under symbol=/date=. A day of a symbol is dealt over ``salt`` tasks, so a dominant one stays parallel."""
    d = ticks if "date" in ticks.columns else ticks.withColumn("date", F.to_date("ts"))
    d = d.withColumn("_s", F.pmod(F.xxhash64("trade_id"), F.lit(salt))).repartition("symbol", "date", "_s").drop("_s")
    d.write.mode(mode).partitionBy("symbol", "date").option("compression", "zstd").parquet(path)


def export_parquet(ticks: DataFrame, path: str, predicate: str = "true") -> None:
    ticks.where(F.expr(predicate)).repartitionByRange("ts").sortWithinPartitions("ts", "trade_id").write.option("compression", "zstd").parquet(path)


def export_csv(ticks: DataFrame, path: str, predicate: str = "true") -> None:
    ticks.where(F.expr(predicate)).repartitionByRange("ts").sortWithinPartitions("ts", "trade_id").write.option("header", True).csv(path)


def append_new(ticks: DataFrame, path: str) -> None:
    """Append rows whose (symbol, trade_id) the table doesn't hold, so reloading is harmless.

    Only the dates that the new rows have are read from the table: their partitions are found by a join on the date,
    which prunes folders at run time, so one late row doesn't open all that lies between.
    """
    spark = ticks.sparkSession
    fresh = deduplicate(ticks)
    if not fresh.limit(1).count():
        return
    # At most a row a day.
    dates = fresh.select("date").distinct()
    old = spark.read.schema(TICKS).parquet(path).join(F.broadcast(dates), "date", "left_semi")
    write_ticks(fresh.join(old.select("symbol", "trade_id"), ["symbol", "trade_id"], "left_anti"), path)


def merge_latest(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Upsert: new rows replace old ones of the same key."""
    both = old.withColumn("_v", F.lit(0)).unionByName(new.withColumn("_v", F.lit(1)))
    return deduplicate(both, tuple(keys), ("_v",), keep="last").drop("_v")


def backup(df: DataFrame, path: str) -> int:
    """Copy df to path and compare the counts; the number of rows comes back."""
    df.write.mode("overwrite").parquet(path)
    n, m = df.count(), df.sparkSession.read.parquet(path).count()
    if n != m:
        raise RuntimeError(f"the backup has {m} of {n} rows")
    return n


def write_report(report: DataFrame, path: str) -> None:
    report.write.mode("overwrite").json(path)


def create_view(df: DataFrame, name: str) -> None:
    df.createOrReplaceTempView(name)


def partition_listing(ticks: DataFrame) -> DataFrame:
    return ticks.groupBy("symbol").agg(F.count_distinct("date").alias("dates"), F.min("date").alias("first_date"), F.max("date").alias("last_date"), F.count("*").alias("records"))


def storage_stats(df: DataFrame, key: str = "symbol") -> DataFrame:
    """Per key: files, megabytes and rows of what df reads; files are counted once, whatever their rows."""
    f = df.groupBy(key, F.col("_metadata.file_path").alias("_f")).agg(F.count("*").alias("_n"), F.max("_metadata.file_size").alias("_b"))
    return f.groupBy(key).agg(F.count("*").alias("files"), F.round(F.sum("_b") / F.lit(1e6), 6).alias("megabytes"), F.sum("_n").alias("records"))


def reorganise_staging(spark: SparkSession, staging: str, path: str) -> None:
    """Staged files without dates become symbol=/date= folders; what the table already holds is not written again."""
    staged = spark.read.parquet(staging).withColumn("date", F.to_date("ts"))
    try:
        append_new(staged, path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        write_ticks(deduplicate(staged), path)


def materialise(df: DataFrame, name: str, mode: str = "overwrite") -> DataFrame:
    """Save a derived table in the catalogue and read it from there."""
    df.write.mode(mode).format("parquet").saveAsTable(name)
    return df.sparkSession.table(name)


def ingest_new(ticks: DataFrame, path: str, cursors: str) -> int:
    """Append the rows beyond each symbol's last stored id, and store the new ids; the number of new rows comes back.

    Cursors are one row per symbol and version; the newest version counts, so a run that fails before its cursors are
    written is simply done again: append_new leaves out what is there already.
    """
    spark = ticks.sparkSession
    held = spark.createDataFrame([], "symbol string, last_id long, version long")
    try:
        held = spark.read.parquet(cursors)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
    now = held.groupBy("symbol").agg(F.max_by("last_id", "version").alias("_last"))
    version = (held.agg(F.max("version")).first()[0] or 0) + 1
    fresh = ticks.join(now, "symbol", "left").where(F.col("_last").isNull() | (F.col("trade_id") > F.col("_last"))).drop("_last")
    n = fresh.count()
    if n:
        if version == 1:
            write_ticks(deduplicate(fresh), path)
        else:
            append_new(fresh, path)
        last = fresh.groupBy("symbol").agg(F.max("trade_id").alias("last_id"), F.lit(version).cast("long").alias("version"))
        last.write.mode("append").parquet(cursors)
    return n

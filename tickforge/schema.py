"""The canonical tick table and the tables it is made from."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PRICE = "decimal(18,8)"

#: One row per trade; (symbol, ts, trade_id) is the total order that every operator uses.
TICKS = T.StructType([
    T.StructField("symbol", T.StringType()), T.StructField("trade_id", T.LongType()), T.StructField("ts", T.TimestampType()),
    T.StructField("price", T.DecimalType(18, 8)), T.StructField("quantity", T.DecimalType(18, 8)),
    T.StructField("is_buyer_maker", T.BooleanType()), T.StructField("date", T.DateType()),
])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ticks_from_events(events: DataFrame) -> DataFrame:
    """Ticks of an event table: type as symbol, value as price, props.k + 1 as quantity. Prices must be positive."""
    return events.where("value > 0").select(
        F.col("event_type").alias("symbol"), F.col("event_id").alias("trade_id"), F.col("ts").cast("timestamp").alias("ts"),
        F.col("value").cast(PRICE).alias("price"), (F.get_json_object("props", "$.k").cast("long") + 1).cast(PRICE).alias("quantity"),
        (F.col("user_id") % 2 == 1).alias("is_buyer_maker"), F.to_date(F.col("ts")).alias("date"),
    )


def ticks_from_lineitem(lineitem: DataFrame) -> DataFrame:
    """Ticks with few symbols and heavy ties: return flag as symbol; the id orders rows of one day.

    notional_cents is the exact measure of dollar bars.
    """
    key = F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return lineitem.select(
        F.col("l_returnflag").alias("symbol"), key.alias("trade_id"), F.col("l_shipdate").cast("timestamp").alias("ts"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("price"), F.col("l_quantity").alias("quantity"),
        (F.col("l_linestatus") == "F").alias("is_buyer_maker"), F.round(F.col("l_extendedprice") * 100).cast("long").alias("notional_cents"),
    )


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ticks_from_events(table(spark, sf_dir, "events"))

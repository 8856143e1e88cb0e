"""RAW measurements derived from the ``events`` table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kpiloom.functions.timegrid import naive_as_utc

EVENTS = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)


def as_raw(events: DataFrame) -> DataFrame:
    """Read each event as one measurement of one of five cells."""
    ts = naive_as_utc("ts")
    cell = F.concat(F.lit("cell_"), F.lpad((F.col("user_id") % 5 + 1).cast("string"), 3, "0"))
    return events.select(
        ts.alias("ts"),
        cell.alias("cell_id"),
        (F.col("value") - 5).alias("throughput"),
        F.regexp_extract("props", "([0-9]+)", 1).cast("double").alias("latency"),
        ((F.col("user_id") % 13) / F.lit(2.0)).alias("jitter"),
        (F.col("value") / 100.0).alias("packet_loss"),
        F.col("value").alias("cell_load"),
        ((F.col("event_type") == "error") & (F.col("value") > 100)).alias("is_anomaly"),
        F.when(F.col("event_type") == "view", "stream").otherwise("batch").alias("source"),
        ts.alias("ingested_at"),
    )


def load_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_raw(spark.read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet"))


def with_late_copies(raw: DataFrame) -> DataFrame:
    """Every measurement twice; the copy arrives a minute later with another value."""
    late = raw.withColumns(
        {
            "throughput": F.col("throughput") + 1,
            "ingested_at": F.col("ingested_at") + F.expr("INTERVAL 1 MINUTE"),
        }
    )
    return raw.unionByName(late)

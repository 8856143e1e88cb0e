"""What an operator screen shows: current state, alerts, freshness."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kpiloom.functions import qos
from kpiloom.functions.timegrid import age_seconds, is_live, whole_div
from kpiloom.operators.blocks import BLOCK, over_blocks
from kpiloom.operators.select import latest_per_cell
from kpiloom.schema import KPIS, STREAM_CADENCE_SECONDS


def current_state(df: DataFrame, suffix: str = "") -> DataFrame:
    """State and dominant cause of each cell's newest row."""
    newest = latest_per_cell(df.select("cell_id", "ts", *[f"{k}{suffix}" for k in KPIS]))
    return qos.with_cause(qos.classify(newest, suffix=suffix), suffix=suffix)


def alerts_by_cell(alerts: DataFrame) -> DataFrame:
    """Number, strongest score and last instant of each cell's alerts."""
    return (
        alerts.groupBy("cell_id")
        .agg(
            F.count(F.lit(1)).alias("alertes"),
            F.max(F.round("score", 4)).alias("score_max"),
            F.max("ts").alias("derniere"),
        )
        .orderBy(F.col("alertes").desc(), "cell_id")
    )


def freshness(stream: DataFrame, now: Column, cadence_seconds: float = STREAM_CADENCE_SECONDS) -> DataFrame:
    """Age of each cell's newest measurement and whether its feed is live."""
    newest = stream.groupBy("cell_id").agg(F.max("ts").alias("derniere"))
    aged = newest.withColumn("age_s", age_seconds(F.col("derniere"), now))
    return aged.withColumn("actif", is_live(F.col("age_s"), cadence_seconds))


def point_delta(stream: DataFrame, block_seconds: int = 3600) -> DataFrame:
    """Change of each KPI against the previous point of the cell; 0 for the first.

    Raw rows are irregular, so blocks are spans of time.  The last row of the
    preceding non-empty block is carried over.
    """
    tie = [c for c in ("source", *KPIS) if c in stream.columns]
    blocked = stream.withColumn("_block", whole_div(F.unix_micros("ts"), block_seconds * 1_000_000))
    newest = Window.partitionBy(*BLOCK).orderBy(F.col("ts").desc(), *[F.col(c).desc() for c in tie])
    ends = (
        blocked.select(*BLOCK, "ts", *tie)
        .withColumn("_rn", F.row_number().over(newest))
        .where("_rn = 1")
        .select(*BLOCK, F.struct(*KPIS).alias("_end"))
    )
    carry = ends.select(*BLOCK, F.lag("_end").over(over_blocks()).alias("_before"))
    here = Window.partitionBy(*BLOCK).orderBy("ts", *tie)
    ranked = blocked.join(carry, BLOCK).withColumns(
        {"_rn": F.row_number().over(here)} | {f"_prev_{k}": F.lag(k).over(here) for k in KPIS}
    )
    previous = {k: F.when(F.col("_rn") == 1, F.col("_before")[k]).otherwise(F.col(f"_prev_{k}")) for k in KPIS}
    first = (F.col("_rn") == 1) & F.col("_before").isNull()
    changes = {f"{k}_delta": F.when(first, F.lit(0.0)).otherwise(F.col(k) - previous[k]) for k in KPIS}
    return ranked.withColumns(changes).select(*stream.columns, *changes)

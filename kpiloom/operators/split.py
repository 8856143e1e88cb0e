"""Chronological train, validation and test segments."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiloom.functions.timegrid import grid_us, shift
from kpiloom.operators.blocks import with_position
from kpiloom.operators.select import join_params
from kpiloom.schema import GRID, PURGE, TRAIN_RATIO, VAL_RATIO

SEGMENTS = ["train", "val", "test"]


class ChronologyError(ValueError):
    """A later segment starts before an earlier one ends."""


def temporal_split(
    df: DataFrame,
    grid: str = GRID,
    train_ratio: float = TRAIN_RATIO,
    val_ratio: float = VAL_RATIO,
    purge: int = PURGE,
) -> DataFrame:
    """Add ``segment`` per cell by row share; purged rows are dropped.

    The first ``purge`` rows of a later segment summarise the earlier one.
    """
    if not 0 < train_ratio < 1 or not 0 < val_ratio < 1:
        raise ValueError("ratios must lie between 0 and 1")
    if train_ratio + val_ratio >= 1:
        raise ValueError("the ratios leave no rows for the test segment")
    placed = with_position(df.select("cell_id", "ts"), grid, totals=True)
    train_end = F.floor(F.col("_rows") * F.lit(float(train_ratio)))
    val_end = F.floor(F.col("_rows") * F.lit(float(train_ratio + val_ratio)))
    pos, ts = F.col("_pos"), F.col("ts")
    # Only keys are shuffled to find the instants where segments begin and end.
    bounds = placed.groupBy("cell_id").agg(
        F.max(F.when(pos < train_end, ts)).alias("_train_to"),
        F.min(F.when(pos >= train_end + purge, ts)).alias("_val_from"),
        F.max(F.when(pos < val_end, ts)).alias("_val_to"),
        F.min(F.when(pos >= val_end + purge, ts)).alias("_test_from"),
    )
    segment = (
        F.when(ts <= F.col("_train_to"), "train")
        .when((ts >= F.col("_val_from")) & (ts <= F.col("_val_to")), "val")
        .when(ts >= F.col("_test_from"), "test")
    )
    return (
        join_params(df, bounds)
        .withColumn("segment", segment)
        .where("segment IS NOT NULL")
        .select(*df.columns, "segment")
    )


def split_by_timestamp(df: DataFrame, train_end, val_end, purge: int = PURGE, grid: str = "1 minute") -> DataFrame:
    """Segments at fixed instants; ``purge`` counts grid steps."""
    gap = purge * grid_us(grid)
    first, second = F.lit(train_end).cast("timestamp"), F.lit(val_end).cast("timestamp")
    ts = F.col("ts")
    segment = (
        F.when(ts <= first, "train")
        .when((ts > shift(first, gap)) & (ts <= second), "val")
        .when(ts > shift(second, gap), "test")
    )
    return df.withColumn("segment", segment).where("segment IS NOT NULL")


def split_summary(df: DataFrame) -> DataFrame:
    """Size, period and number of cells of each segment."""
    per_cell = df.groupBy("segment", "cell_id").agg(
        F.count(F.lit(1)).alias("n"), F.min("ts").alias("debut"), F.max("ts").alias("fin")
    )
    return per_cell.groupBy("segment").agg(
        F.sum("n").alias("n"),
        F.min("debut").alias("debut"),
        F.max("fin").alias("fin"),
        F.count(F.lit(1)).alias("cellules"),
    )


def chronology(df: DataFrame) -> DataFrame:
    """Period of each segment per cell and whether they follow each other."""
    bounds = []
    for s in SEGMENTS:
        inside = F.when(F.col("segment") == s, F.col("ts"))
        bounds += [F.min(inside).alias(f"{s}_start"), F.max(inside).alias(f"{s}_end")]
    val_late = F.coalesce(F.col("train_end") < F.col("val_start"), F.lit(True))
    test_late = F.coalesce(F.col("val_end") < F.col("test_start"), F.lit(True))
    return df.groupBy("cell_id").agg(*bounds).withColumn("in_order", val_late & test_late)


def assert_chronological(df: DataFrame) -> None:
    broken = chronology(df).where(~F.col("in_order")).first()
    if broken is not None:
        raise ChronologyError(f"segments of {broken['cell_id']} overlap")

"""Joins between series: labels, future and past values, alerts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiloom.functions.numeric import all_present
from kpiloom.functions.timegrid import floor_to_grid, grid_us, shift
from kpiloom.schema import GRID, HORIZONS, KEY, KPIS, MIN_MATCH_RATE, target_name


class LabelAlignmentError(ValueError):
    """Labels and rows do not share their timestamps."""


def with_labels(df: DataFrame, labels: DataFrame) -> DataFrame:
    """Left join of the truth; rows without a label are normal."""
    truth = labels.select(*KEY, "is_anomaly")
    return df.join(truth, KEY, "left").withColumn(
        "is_anomaly", F.coalesce("is_anomaly", F.lit(False))
    )


def match_rate(df: DataFrame, labels: DataFrame) -> DataFrame:
    """One row: ``labels``, ``rows``, ``matched`` and ``rate``."""
    truth = labels.select(*KEY, F.col("is_anomaly").isNotNull().alias("_known"))
    found = F.coalesce("_known", F.lit(False))
    total = labels.agg(F.count(F.lit(1)).alias("n")).scalar()
    return (
        df.select(*KEY)
        .join(truth, KEY, "left")
        .agg(F.count(F.lit(1)).alias("rows"), F.count_if(found).alias("matched"))
        .select(
            total.alias("labels"),
            "rows",
            "matched",
            F.try_divide(F.col("matched"), F.col("rows")).alias("rate"),
        )
    )


def align_labels(df: DataFrame, labels: DataFrame, min_match_rate: float = MIN_MATCH_RATE) -> DataFrame:
    """``with_labels`` after a check that the two tables belong together."""
    check = match_rate(df, labels).first()
    if check["labels"] == 0:
        raise LabelAlignmentError("there are no labels")
    if check["rate"] is None or check["rate"] < min_match_rate:
        raise LabelAlignmentError(
            f"only {check['matched']} of {check['rows']} rows have a label; are both on one grid?"
        )
    return with_labels(df, labels)


def values_at(history: DataFrame, shifts: dict[str, int], kpis: list[str] = KPIS) -> DataFrame:
    """KPI values some time away, keyed by the moment that looks for them.

    ``shifts`` maps a column pattern such as ``"{kpi}_target_5m"`` to microseconds.
    All distances share one shuffle on ``(cell_id, ts)``; holes give NULL.
    """
    names = list(shifts)
    moved = F.array(
        *[F.struct(shift(F.col("ts"), -us).alias("at"), F.lit(n).alias("n")) for n, us in enumerate(shifts.values())]
    )
    long = history.select("cell_id", *kpis, F.explode(moved).alias("m"))
    return long.groupBy("cell_id", F.col("m.at").alias("ts")).agg(
        *[
            F.max(F.when(F.col("m.n") == n, F.col(k))).alias(name.format(kpi=k))
            for n, name in enumerate(names)
            for k in kpis
        ]
    )


def build_targets(
    features: DataFrame,
    history: DataFrame,
    horizons: list[int] = HORIZONS,
    kpis: list[str] = KPIS,
    grid: str = GRID,
) -> DataFrame:
    """Add ``{kpi}_target_{h}m``, the value ``h`` grid steps later by time."""
    shifts = {target_name("{kpi}", h): h * grid_us(grid) for h in horizons}
    return features.join(values_at(history, shifts, kpis), KEY, "left")


def supervised(
    features: DataFrame, history: DataFrame, horizons: list[int] = HORIZONS, grid: str = GRID
) -> DataFrame:
    """Rows for which every target exists."""
    wanted = [target_name(k, h) for k in KPIS for h in horizons]
    return build_targets(features, history, horizons, grid=grid).where(all_present(wanted))


def at_alerts(df: DataFrame, alerts: DataFrame) -> DataFrame:
    """KPI rows at the instants of alerts in the same cell."""
    return df.join(alerts.select(*KEY), KEY, "left_semi")


def announced_at(df: DataFrame, horizon: int, grid: str = GRID) -> DataFrame:
    """Move forecasts to the instant they speak about."""
    return df.withColumn("ts", shift(F.col("ts"), horizon * grid_us(grid)))


def align_label_minutes(labels: DataFrame, grid: str = GRID) -> DataFrame:
    """Labels of irregular instants on the grid, holes left out."""
    return labels.groupBy("cell_id", floor_to_grid(F.col("ts"), grid).alias("ts")).agg(
        F.bool_or("is_anomaly").alias("is_anomaly")
    )

"""QoS state of a row and the KPI to blame for it."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpiloom.schema import NO_CAUSE, STATES, THRESHOLDS, Bounds


def _measured(value: Column) -> Column:
    return value.isNotNull() & ~F.isnan(value)


def state_rank(value: Column, bounds: Bounds) -> Column:
    """0 good, 1 degraded, 2 critical; a missing value never degrades."""
    if bounds.higher_is_worse:
        critical, degraded = value > bounds.degraded, value > bounds.good
    else:
        critical, degraded = value < bounds.degraded, value < bounds.good
    return F.when(~_measured(value), 0).when(critical, 2).when(degraded, 1).otherwise(0)


def state_label(rank: Column) -> Column:
    return F.element_at(F.array(*[F.lit(s) for s in STATES]), rank + 1)


def excess(value: Column, bounds: Bounds) -> Column:
    """Relative distance beyond the good bound, in the direction that hurts."""
    if not bounds.good:
        return F.lit(0.0)
    away = value - bounds.good if bounds.higher_is_worse else bounds.good - value
    return away / F.lit(abs(bounds.good))


def _present(df: DataFrame, thresholds: Mapping[str, Bounds], suffix: str) -> list[str]:
    return [k for k in thresholds if f"{k}{suffix}" in df.columns]


def worst_rank(df: DataFrame, thresholds: Mapping[str, Bounds] = THRESHOLDS, suffix: str = "") -> Column:
    ranks = [state_rank(F.col(f"{k}{suffix}"), thresholds[k]) for k in _present(df, thresholds, suffix)]
    return F.greatest(F.lit(0), F.lit(0), *ranks)


def classify(
    df: DataFrame,
    thresholds: Mapping[str, Bounds] = THRESHOLDS,
    suffix: str = "",
    out: str = "qos_state",
) -> DataFrame:
    """Add ``out`` (worst state), ``{out}_rank`` and one state per KPI column.

    ``suffix`` selects derived columns, for example ``_mean_5m`` or forecasts.
    """
    rank = worst_rank(df, thresholds, suffix)
    per_kpi = {
        f"{k}_state{suffix}": state_label(state_rank(F.col(f"{k}{suffix}"), thresholds[k]))
        for k in _present(df, thresholds, suffix)
    }
    return df.withColumns({f"{out}_rank": rank, out: state_label(rank), **per_kpi})


def with_cause(
    df: DataFrame, thresholds: Mapping[str, Bounds] = THRESHOLDS, suffix: str = ""
) -> DataFrame:
    """Add ``cause_kpi``, ``cause_excess`` and the readable ``cause``.

    The worst state wins, then the larger excess, then the contract's KPI order.
    """
    candidates = [
        F.struct(
            state_rank(F.col(f"{k}{suffix}"), thresholds[k]).alias("rank"),
            F.when(_measured(F.col(f"{k}{suffix}")), excess(F.col(f"{k}{suffix}"), thresholds[k])).alias("excess"),
            F.lit(-place).alias("place"),
            F.lit(k).alias("kpi"),
        )
        for place, k in enumerate(_present(df, thresholds, suffix))
    ]
    top = F.array_max(F.array(*candidates))
    named = df.withColumn("_top", top).withColumns(
        {
            "cause_kpi": F.when(F.col("_top.rank") > 0, F.col("_top.kpi")).otherwise(NO_CAUSE),
            "cause_excess": F.when(F.col("_top.rank") > 0, F.col("_top.excess")),
        }
    )
    text = F.format_string("%s (%+.0f%% vs seuil bon)", F.col("cause_kpi"), F.col("cause_excess") * 100)
    return named.withColumn(
        "cause", F.when(F.col("_top.rank") > 0, text).otherwise(NO_CAUSE)
    ).drop("_top")

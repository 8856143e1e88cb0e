"""Forecast study: error tables, gains and announced states."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kpiloom.functions import qos
from kpiloom.functions.timegrid import shift_steps
from kpiloom.models.forecasters import Forecaster, Persistence, long_forecasts
from kpiloom.operators.metrics import regression_metrics, with_skill
from kpiloom.operators.select import latest_per_cell
from kpiloom.schema import GRID, HORIZONS, KPI_UNITS, KPIS, STATES, target_name

_CASE = ["scope", "kpi", "horizon_min"]


def forecast_table(forecasts: DataFrame) -> DataFrame:
    """Errors per scope, model, KPI and horizon, with the gain over persistence."""
    errors = regression_metrics(forecasts, ["scope", "model", "kpi", "horizon_min"])
    unit = F.element_at(F.create_map(*[F.lit(x) for k in KPIS for x in (k, KPI_UNITS[k])]), F.col("kpi"))
    return with_skill(errors, _CASE).withColumn("unite", unit)


def both_scopes(full: DataFrame, common: DataFrame) -> DataFrame:
    """Stack the whole test segment and the common origins."""
    return common.unionByName(full)


def gain_pivot(table: DataFrame, horizons: list[int] = HORIZONS) -> DataFrame:
    """Mean gain by model, one column per horizon."""
    gain = F.col("gain_mae_vs_persistance_pct")
    return table.groupBy("scope", "model").agg(
        *[F.round(F.avg(F.when(F.col("horizon_min") == h, gain)), 2).alias(f"gain_{h}") for h in horizons]
    )


def mae_pivot(table: DataFrame, models: list[str]) -> DataFrame:
    """MAE by KPI and horizon, one column per model."""
    return table.groupBy("scope", "kpi", "horizon_min").agg(
        *[F.max(F.when(F.col("model") == m, F.round("mae", 4))).alias(m) for m in models]
    )


def best_model(table: DataFrame) -> DataFrame:
    """The model with the highest mean gain per horizon, persistence left out."""
    mean = (
        table.where(F.col("model") != Persistence.name)
        .groupBy("scope", "horizon_min", "model")
        .agg(F.avg("gain_mae_vs_persistance_pct").alias("gain"))
    )
    first = Window.partitionBy("scope", "horizon_min").orderBy(F.col("gain").desc_nulls_last(), "model")
    return mean.withColumn("_rn", F.row_number().over(first)).where("_rn = 1").drop("_rn")


def retained_objectives(selection: DataFrame) -> DataFrame:
    """Number of models per retained loss."""
    return selection.where("retenu").groupBy("objectif").agg(F.count(F.lit(1)).alias("nb_modeles"))


def predicted_states(model: Forecaster, df: DataFrame, horizons: list[int] = HORIZONS) -> DataFrame:
    """State announced and state observed per row and horizon, as ranks."""
    prepared = model.prepare(df)
    pairs = []
    for h in horizons:
        told = [qos.state_rank(model.forecast(k, h), qos.THRESHOLDS[k]) for k in KPIS]
        seen = [qos.state_rank(F.col(target_name(k, h)), qos.THRESHOLDS[k]) for k in KPIS]
        pairs.append(
            F.struct(
                F.lit(h).alias("horizon_min"),
                F.greatest(*told).alias("predicted"),
                F.greatest(*seen).alias("actual"),
            )
        )
    return prepared.select("cell_id", "ts", F.explode(F.array(*pairs)).alias("s")).select("cell_id", "ts", "s.*")


def state_accuracy(states: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Share of right states and of critical states that were missed, per horizon and ``by``."""
    critical = F.col("actual") == 2
    missed = F.count_if(critical & (F.col("predicted") != 2))
    return states.groupBy(*by, "horizon_min").agg(
        F.round(F.avg((F.col("predicted") == F.col("actual")).cast("int")), 4).alias("exactitude_etat"),
        F.round(missed / F.greatest(F.count_if(critical), F.lit(1)), 4).alias("part_critiques_manques"),
        F.count(F.lit(1)).alias("n"),
    )


def state_confusion(states: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """All nine pairs of actual and predicted state per horizon and ``by``."""
    pairs = [(a, p) for a in range(3) for p in range(3)]
    counted = states.groupBy(*by, "horizon_min").agg(
        *[F.count_if((F.col("actual") == a) & (F.col("predicted") == p)).alias(f"n{a}{p}") for a, p in pairs]
    )
    cells = F.array(
        *[
            F.struct(F.lit(STATES[a]).alias("actual"), F.lit(STATES[p]).alias("predicted"), F.col(f"n{a}{p}").alias("n"))
            for a, p in pairs
        ]
    )
    return counted.select(*by, "horizon_min", F.explode(cells).alias("c")).select(*by, "horizon_min", "c.*")


def announced_state(
    model: Forecaster, df: DataFrame, grid: str = GRID, horizons: list[int] = HORIZONS
) -> DataFrame:
    """State and cause announced for each cell's newest row, at the instant it speaks about."""
    newest = model.prepare(latest_per_cell(df))
    told = F.array(
        *[
            F.struct(F.lit(h).alias("horizon_min"), *[model.forecast(k, h).alias(k) for k in KPIS])
            for h in horizons
        ]
    )
    rows = newest.select("cell_id", "ts", F.explode(told).alias("f")).select("cell_id", "ts", "f.*")
    at = F.element_at(
        F.create_map(*[x for h in horizons for x in (F.lit(h), shift_steps(F.col("ts"), h, grid))]), F.col("horizon_min")
    )
    return qos.with_cause(qos.classify(rows)).withColumn("announced_for", at)


def forecast_study(models: list[Forecaster], test: DataFrame, origins: DataFrame | None = None) -> DataFrame:
    """The error table on the whole test segment and, if given, on common origins.

    The origins are chosen once, by the caller: every model forecasts from all
    of them.  ARIMA takes part there alone, a fit per row being its cost.
    """
    full = forecast_table(long_forecasts([m for m in models if m.name != "arima"], test))
    if origins is None:
        return full
    return both_scopes(full, forecast_table(long_forecasts(models, origins, scope="origines_communes")))

"""Rolling, lagged, seasonal and derived features."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kpiloom.functions.numeric import all_finite, all_present, ratio
from kpiloom.functions.timegrid import cyclic, day_of_week, hour_of_day, step_index
from kpiloom.operators.blocks import BLOCK, BLOCK_STEPS, in_block, over_blocks, with_block, with_halo
from kpiloom.schema import (
    DETECTOR_COLUMNS,
    FORBIDDEN_FEATURES,
    GRID,
    HOUR_STEPS,
    KPIS,
    LAGS,
    MEAN_WINDOWS,
    SEASON_INTS,
    STD_WINDOWS,
    feature_names,
)


class LeakageError(ValueError):
    """A column that must not reach a model was asked for."""


class MissingFeaturesError(ValueError):
    """Columns a model needs are not there."""


def _frame(steps: int) -> Window:
    """The last ``steps`` grid steps, the current one included."""
    return in_block().rangeBetween(-(steps - 1), 0)


def _blocks_with_past(df: DataFrame, grid: str, steps: int, block_steps: int) -> DataFrame:
    stepped = df.withColumn("_i", step_index(F.col("ts"), grid))
    return with_halo(stepped, "_i", before=steps - 1, block_steps=block_steps)


def _own_rows(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.where("_own").select(*columns)


def rolling(
    df: DataFrame, columns: dict[str, tuple], grid: str = GRID, block_steps: int = BLOCK_STEPS
) -> DataFrame:
    """Add time-window aggregates: ``{name: (function, column, steps)}``.

    A frame spans ``steps`` grid steps and ends at the current row.
    """
    longest = max(steps for _, _, steps in columns.values())
    blocked = _blocks_with_past(df, grid, longest, block_steps)
    added = {name: fn(c).over(_frame(steps)) for name, (fn, c, steps) in columns.items()}
    return _own_rows(blocked.withColumns(added), [*df.columns, *columns])


def rolling_means(df: DataFrame, grid: str = GRID, windows: dict[str, int] = MEAN_WINDOWS, **kw) -> DataFrame:
    return rolling(
        df, {f"{k}_mean_{w}": (F.avg, k, n) for k in KPIS for w, n in windows.items()}, grid, **kw
    )


def rolling_stds(df: DataFrame, grid: str = GRID, windows: dict[str, int] = STD_WINDOWS, **kw) -> DataFrame:
    return rolling(
        df, {f"{k}_std_{w}": (F.stddev_samp, k, n) for k in KPIS for w, n in windows.items()}, grid, **kw
    )


def hour_stats(df: DataFrame, grid: str = GRID, steps: int = HOUR_STEPS, **kw) -> DataFrame:
    wanted = {f"{k}_hour_mean": (F.avg, k, steps) for k in KPIS}
    wanted["cell_load_hour_max"] = (F.max, "cell_load", steps)
    return rolling(df, wanted, grid, **kw)


def _rows_before_blocks(df: DataFrame, grid: str, n: int, beyond: int, block_steps: int, values: list[str] = KPIS) -> DataFrame:
    """Up to ``n`` rows before each block that lie more than ``beyond`` steps ahead of it.

    Lags count rows, so across a hole they reach farther than any halo of time.
    Every block has a row, so the ``n`` blocks before hold enough of them.
    """
    blocked = with_block(df.select("cell_id", "ts", *values), grid, block_steps)
    newest = Window.partitionBy(*BLOCK).orderBy(F.col("_i").desc())
    tails = (
        blocked.withColumn("_rn", F.row_number().over(newest))
        .where(F.col("_rn") <= n)
        .groupBy(*BLOCK)
        .agg(F.sort_array(F.collect_list(F.struct("_i", "ts", *values))).alias("_tail"))
    )
    joined = F.flatten(F.collect_list("_tail").over(over_blocks().rowsBetween(-n, -1)))
    kept = tails.select(*BLOCK, joined.alias("_all"))
    last = F.slice("_all", F.greatest(F.size("_all") - (n - 1), F.lit(1)), n)
    edge = F.col("_block") * block_steps - beyond
    far = F.filter(last, lambda r: r["_i"] < edge)
    return kept.select(*BLOCK, F.explode(far).alias("_r")).select(
        "cell_id", "_r.ts", *[f"_r.{k}" for k in values], "_r._i", "_block", F.lit(False).alias("_own")
    )


def _blocks_for_lags(df: DataFrame, grid: str, n: int, beyond: int, block_steps: int, values: list[str] = KPIS) -> DataFrame:
    """Blocks with ``beyond`` steps of past and at least ``n`` earlier rows, where they exist."""
    blocked = _blocks_with_past(df.select("cell_id", "ts", *values), grid, beyond + 1, block_steps)
    earlier = _rows_before_blocks(df, grid, n, beyond, block_steps, values)
    return blocked.unionByName(earlier)


def _lag_columns(steps: Iterable[int]) -> dict[str, Column]:
    return {f"{k}_lag_{n}": F.lag(k, n).over(in_block()) for k in KPIS for n in steps}


def lags(
    df: DataFrame, grid: str = GRID, steps: Iterable[int] = LAGS, block_steps: int = BLOCK_STEPS
) -> DataFrame:
    """KPIs and their values some rows earlier; the shift counts rows, so it crosses holes."""
    wanted = _lag_columns(list(steps))
    blocked = _blocks_for_lags(df, grid, max(steps), 0, block_steps)
    return _own_rows(blocked.withColumns(wanted), ["cell_id", "ts", *KPIS, *wanted])


def lagged_rows(df: DataFrame, grid: str, deepest: int, column: str = "y", block_steps: int = BLOCK_STEPS) -> DataFrame:
    """One column with its values 1 to ``deepest`` rows earlier, as ``column_1``, ``column_2``, …"""
    wanted = {f"{column}_{n}": F.lag(column, n).over(in_block()) for n in range(1, deepest + 1)}
    blocked = _blocks_for_lags(df, grid, deepest, 0, block_steps, [column])
    return _own_rows(blocked.withColumns(wanted), ["cell_id", "ts", column, *wanted])


def build_features(
    clean: DataFrame, grid: str = GRID, drop_incomplete: bool = True, block_steps: int = BLOCK_STEPS
) -> DataFrame:
    """CLEAN to FEATURES with one shuffle of the series.

    All frames and lags share the window ``(cell_id, block)``.
    """
    blocked = _blocks_for_lags(clean, grid, max(LAGS), HOUR_STEPS - 1, block_steps)
    wanted: dict[str, Column] = {}
    for k in KPIS:
        wanted |= {f"{k}_mean_{w}": F.avg(k).over(_frame(n)) for w, n in MEAN_WINDOWS.items()}
        wanted |= {f"{k}_std_{w}": F.stddev_samp(k).over(_frame(n)) for w, n in STD_WINDOWS.items()}
        wanted[f"{k}_hour_mean"] = F.avg(k).over(_frame(HOUR_STEPS))
    wanted["cell_load_hour_max"] = F.max("cell_load").over(_frame(HOUR_STEPS))
    wanted |= _lag_columns(LAGS)
    rows = _own_rows(blocked.withColumns(wanted), ["ts", "cell_id", *wanted])
    if drop_incomplete:
        rows = rows.where(all_present(list(wanted)))
    season = {"hour_of_day": hour_of_day(F.col("ts")), "day_of_week": day_of_week(F.col("ts"))}
    return rows.withColumns(season).select("ts", "cell_id", *feature_names())


def add_cyclic(df: DataFrame) -> DataFrame:
    """Hour and weekday as points on a circle."""
    has_ints = all(c in df.columns for c in SEASON_INTS)
    hour = F.col("hour_of_day") if has_ints else hour_of_day(F.col("ts"))
    dow = F.col("day_of_week") if has_ints else day_of_week(F.col("ts"))
    (hour_sin, hour_cos), (dow_sin, dow_cos) = cyclic(hour, 24), cyclic(dow, 7)
    return df.withColumns(
        {"hour_sin": hour_sin, "hour_cos": hour_cos, "dow_sin": dow_sin, "dow_cos": dow_cos}
    )


def add_derived(df: DataFrame) -> DataFrame:
    """Trend and ratio to the hour's level; a zero level gives ratio 1."""
    added = {}
    for k in KPIS:
        short = f"{k}_mean_5m"
        if short in df.columns and f"{k}_mean_30m" in df.columns:
            added[f"{k}_trend_5m_30m"] = F.col(short) - F.col(f"{k}_mean_30m")
        if short in df.columns and f"{k}_hour_mean" in df.columns:
            level = ratio(F.col(short), F.col(f"{k}_hour_mean"))
            added[f"{k}_ratio_to_hour"] = F.coalesce(level, F.lit(1.0))
    return df.withColumns(added)


def prepare_features(features: DataFrame, drop_season_ints: bool = True) -> DataFrame:
    """FEATURES to PREPARED: encodings, derived columns, finite rows only."""
    wide = add_derived(add_cyclic(features))
    if drop_season_ints:
        wide = wide.drop(*SEASON_INTS)
    doubles = [f.name for f in wide.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    others = [c for c in wide.columns if c not in doubles]
    return wide.where(all_present(others) & all_finite(doubles))


def _numeric(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def feature_columns(df: DataFrame) -> list[str]:
    """Numeric columns a model may see."""
    columns = [c for c in _numeric(df) if c not in FORBIDDEN_FEATURES]
    if not columns:
        raise LeakageError("no usable feature column")
    return columns


def assert_no_leakage(columns: Iterable[str]) -> None:
    leaked = sorted(FORBIDDEN_FEATURES.intersection(columns))
    if leaked:
        raise LeakageError(f"not allowed as features: {leaked}")


def select_features(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """Key and features; fails before any job if a forbidden column is named."""
    chosen = list(columns) if columns is not None else feature_columns(df)
    assert_no_leakage(chosen)
    return df.select("ts", "cell_id", *chosen)


def forecast_features(df: DataFrame) -> list[str]:
    """Predictors of a forecaster: features that are no target."""
    targets = tuple(f"{k}_target_" for k in KPIS)
    return [
        c for c in _numeric(df) if not c.startswith(targets) and c not in FORBIDDEN_FEATURES
    ]


def anomaly_features(df: DataFrame) -> list[str]:
    """The detector columns; raises if ``df`` lacks any, so no model trains on fewer."""
    held = set(df.columns)
    absent = sorted(set(DETECTOR_COLUMNS) - held)
    if absent:
        raise MissingFeaturesError(f"detector columns not computed: {', '.join(absent)}")
    return list(DETECTOR_COLUMNS)

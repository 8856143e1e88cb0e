"""Robust and standard scaling, per cell or for the whole table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpiloom.operators.features import assert_no_leakage
from kpiloom.operators.quantiles import exact_quantiles, quantile_scalar
from kpiloom.operators.select import join_params

_QUARTILES = [0.25, 0.5, 0.75]


def _by_column(measured: DataFrame, columns: list[str], keys: list[str]) -> DataFrame:
    """Rows ``(keys, name, center, scale)`` to one array ``_p`` in column order."""
    entry = F.struct("name", F.struct("center", "scale"))
    gathered = measured.groupBy(*keys).agg(F.map_from_entries(F.collect_list(entry)).alias("_m"))
    ordered = F.transform(F.array(*[F.lit(c) for c in columns]), lambda c: F.try_element_at("_m", c))
    return gathered.select(*keys, ordered.alias("_p"))


def _robust(train: DataFrame, columns: list[str], by: str | None) -> DataFrame:
    """Median and interquartile range; a zero spread scales by 1."""
    keys = [by] if by else []

    def at(p: float) -> Column:
        return F.max(F.when(F.col("prob") == p, F.col("value")))

    spread = at(0.75) - at(0.25)
    measured = (
        exact_quantiles(train, columns, _QUARTILES, by=by)
        .groupBy(*keys, "name")
        .agg(at(0.5).alias("center"), F.when(spread == 0, 1.0).otherwise(spread).alias("scale"))
    )
    return _by_column(measured, columns, keys)


def _standard(train: DataFrame, columns: list[str]) -> DataFrame:
    """Mean and population deviation; a zero spread scales by 1."""
    spread = F.stddev_pop("value")
    measured = (
        train.select(*columns)
        .unpivot([], columns, "name", "value")
        .groupBy("name")
        .agg(F.avg("value").alias("center"), F.when(spread == 0, 1.0).otherwise(spread).alias("scale"))
    )
    return _by_column(measured, columns, [])


def _expand(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.withColumns({c: F.get("_x", F.lit(i)) for i, c in enumerate(columns)}).drop("_x")


class RobustCellScaler:
    """Median and interquartile range of each cell, with the whole table as fallback."""

    def __init__(self, columns: list[str]):
        assert_no_leakage(columns)
        self.columns = list(columns)
        self.per_cell: DataFrame | None = None
        self.overall: DataFrame | None = None

    def fit(self, train: DataFrame) -> "RobustCellScaler":
        self.per_cell = _robust(train, self.columns, "cell_id")
        self.overall = _robust(train, self.columns, None)
        return self

    def vectors(self, df: DataFrame) -> DataFrame:
        """``df`` with the scaled columns as the array ``_x``.

        Unseen cells use the overall parameters.
        """
        fallback = self.overall.select("_p").scalar()
        joined = join_params(df, self.per_cell).withColumn("_q", F.coalesce("_p", fallback))
        scaled = F.transform(
            F.array(*[F.col(c).cast("double") for c in self.columns]),
            lambda v, i: (v - F.get("_q", i)["center"]) / F.get("_q", i)["scale"],
        )
        return joined.withColumn("_x", scaled).drop("_p", "_q")

    def transform(self, df: DataFrame) -> DataFrame:
        """Scale the columns in place."""
        return _expand(self.vectors(df), self.columns).select(*df.columns)

    def parameters(self) -> DataFrame:
        """Long form ``(cell_id, name, center, scale)``; the fallback has a NULL cell."""
        both = self.per_cell.unionByName(self.overall.withColumn("cell_id", F.lit(None).cast("string")))
        name = F.get(F.array(*[F.lit(c) for c in self.columns]), F.col("at"))
        return both.select("cell_id", F.posexplode("_p").alias("at", "p")).select(
            "cell_id", name.alias("name"), "p.center", "p.scale"
        )


def scale_all(df: DataFrame, train: DataFrame, columns: list[str], kind: str = "robust") -> DataFrame:
    """Scale with parameters of the whole training table: ``robust`` or ``standard``."""
    assert_no_leakage(columns)
    if kind not in ("robust", "standard"):
        raise ValueError(f"unknown scaler {kind!r}")
    params = _robust(train, columns, None) if kind == "robust" else _standard(train, columns)
    scaled = F.transform(
        F.array(*[F.col(c).cast("double") for c in columns]),
        lambda v, i: (v - F.get("_p", i)["center"]) / F.get("_p", i)["scale"],
    )
    return _expand(df.withColumn("_p", params.select("_p").scalar()).withColumn("_x", scaled), columns).select(
        *df.columns
    )


def extremity(vector: str = "_x") -> Column:
    """Sum of absolute scaled values."""
    return F.aggregate(vector, F.lit(0.0), lambda s, v: s + F.abs(v))


def trim_extremes(scaled: DataFrame, share: float, vector: str = "_x") -> DataFrame:
    """Drop the ``share`` of rows farthest from the centre."""
    if share <= 0:
        return scaled
    measured = scaled.withColumn("_far", extremity(vector))
    return measured.where(F.col("_far") <= quantile_scalar(measured, "_far", 1 - share)).drop("_far")

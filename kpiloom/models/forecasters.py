"""Short-term forecasts: ``predict(df, kpi, horizon)`` adds ``y_hat``."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kpiloom.functions.timegrid import grid_us, whole_div
from kpiloom.models import boosting
from kpiloom.operators.blocks import BEFORE_HERE, BLOCK, BLOCK_STEPS, UP_TO_HERE, in_block, over_blocks, with_block, with_position
from kpiloom.operators.features import forecast_features, lagged_rows
from kpiloom.operators.joins import values_at
from kpiloom.operators.select import join_params
from kpiloom.schema import GRID, HORIZONS, KEY, KPIS, target_name
from kpiloom.session import cut

DAY_US = 86_400_000_000


class Forecaster:
    """Common interface.

    ``prepare`` brings whatever a forecast needs to the rows once; ``forecast`` is
    then a column expression, so many KPIs and horizons cost one pass.
    """

    name = "forecaster"

    def fit(self, train: DataFrame, val: DataFrame | None = None) -> "Forecaster":
        return self

    def prepare(self, df: DataFrame) -> DataFrame:
        return df

    def forecast(self, kpi: str, horizon: int) -> Column:
        raise NotImplementedError

    def predict(self, df: DataFrame, kpi: str, horizon: int) -> DataFrame:
        return self.prepare(df).select(*df.columns, self.forecast(kpi, horizon).alias("y_hat"))


class Persistence(Forecaster):
    """The current level, read from the five-step mean."""

    name = "persistance"

    def forecast(self, kpi: str, horizon: int) -> Column:
        return F.col(f"{kpi}_mean_5m")


class MovingAverage(Forecaster):
    """The level of the last fifteen steps."""

    name = "moyenne_mobile_15m"

    def forecast(self, kpi: str, horizon: int) -> Column:
        return F.col(f"{kpi}_mean_15m")


class SeasonalNaive(Forecaster):
    """The value a day before the forecast instant, else the current level."""

    name = "naif_saisonnier_24h"

    def __init__(self, history: DataFrame, grid: str = GRID, horizons: list[int] = HORIZONS):
        self.history, self.grid, self.horizons = history, grid, list(horizons)

    def prepare(self, df: DataFrame) -> DataFrame:
        shifts = {f"{{kpi}}_day_before_{h}": h * grid_us(self.grid) - DAY_US for h in self.horizons}
        return df.join(values_at(self.history, shifts), KEY, "left")

    def forecast(self, kpi: str, horizon: int) -> Column:
        return F.coalesce(F.col(f"{kpi}_day_before_{horizon}"), F.col(f"{kpi}_mean_5m"))


# --------------------------------------------------------------------------
# Autoregression with differences and moving-average terms

# The candidate orders (p, d, q) and the one used where none was chosen.
CANDIDATE_ORDERS = [(1, 0, 0), (2, 0, 0), (2, 0, 1), (1, 1, 1), (2, 1, 1)]
DEFAULT_ORDER = (2, 0, 1)


# Orders are chosen, and models fitted, from sums of products of a series' lags: every candidate is a regression
# among linear combinations of y[t], …, y[t - DEEPEST], so all are fitted on the same points and their criteria compare.
LONG_LAG = 10
DEEPEST = LONG_LAG + 2


def _lag_vector(lag: int, difference: int) -> np.ndarray:
    """The (differenced) value ``lag`` points back as weights of [1, y[t], y[t - 1], …]."""
    out = np.zeros(DEEPEST + 2)
    out[1 + lag] = 1.0
    if difference:
        out[2 + lag] = -1.0
    return out


def _solve(moments: np.ndarray, target: np.ndarray, inputs: list[np.ndarray]) -> tuple[np.ndarray, float]:
    """Coefficients and residual sum of squares of a regression between linear combinations."""
    x = np.array(inputs)
    beta = np.linalg.lstsq(x @ moments @ x.T, x @ moments @ target, rcond=None)[0]
    rest = target - beta @ x
    return beta, float(rest @ moments @ rest)


def choose_order(moments: np.ndarray) -> tuple[int, int, int]:
    """The candidate with the least AIC; ``moments`` are sums of products of [1, y[t], …, y[t - DEEPEST]]."""
    n = moments[0, 0]
    spread = moments[1, 1] / max(n, 1) - (moments[0, 1] / max(n, 1)) ** 2
    if n < 2 * DEEPEST or not np.isfinite(moments).all() or spread <= 0:
        return CANDIDATE_ORDERS[0]
    best = []
    for order in CANDIDATE_ORDERS:
        beta, target, inputs, _ = _regression(moments, order)
        rest = target - beta @ inputs
        aic = n * np.log(max(float(rest @ moments @ rest) / n / spread, 1e-12)) + 2 * (len(beta) + 1)
        best.append((aic, len(best), order))
    return min(best)[2]


def series_moments(series: np.ndarray) -> np.ndarray:
    """The sums of one series held in memory, centred as in ``lag_moments``."""
    y = series - series.mean()
    design = np.column_stack([np.ones(len(y) - DEEPEST), *[y[DEEPEST - k : len(y) - k] for k in range(DEEPEST + 1)]])
    return design.T @ design


def _regression(moments: np.ndarray, order: tuple[int, int, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]:
    """Coefficients of an order, the target and the inputs as combinations of lags, and the errors at t, t - 1, …

    Errors, for moving-average terms, are what a regression on ``LONG_LAG`` lags leaves.
    """
    p, d, q = order
    z = [_lag_vector(k, d) for k in range(LONG_LAG + 2)]
    level = [] if d else [np.eye(DEEPEST + 2)[0]]
    inputs, errors = [*level, *z[1 : p + 1]], []
    if q:
        long_beta, _ = _solve(moments, z[0], [*level, *z[1 : LONG_LAG + 1]])
        errors = [z[k] - long_beta @ np.array([*level, *z[k + 1 : k + LONG_LAG + 1]]) for k in range(q + 1)]
        inputs += errors[1:]
    beta, _ = _solve(moments, z[0], inputs)
    return beta, z[0], np.array(inputs), errors


def project_from(moments: np.ndarray, last: np.ndarray, order: tuple[int, int, int], steps: int) -> np.ndarray:
    """Forecast path from sums of lag products and the last ``DEEPEST + 1`` values, the newest first.

    Where there are too few points, or the path runs away, the last value stays.
    """
    p, d, q = order
    stay = np.full(steps, last[0])
    if not np.isfinite(last).all() or moments[0, 0] < p + q + 5 + (LONG_LAG if q else 0) or not np.isfinite(moments).all():
        return stay
    with np.errstate(all="ignore"):
        beta, _, _, errors = _regression(moments, order)
        seen = np.concatenate([[1.0], last])
        past = list((last[:-1] - last[1:] if d else last)[:p])
        constant, beta = (0.0, beta) if d else (beta[0], beta[1:])
        left = [e @ seen for e in errors[:q]]
        path = []
        for _ in range(steps):
            value = constant + sum(b * y for b, y in zip(beta, past)) + sum(t * e for t, e in zip(beta[p:], left))
            path.append(value)
            past, left = [value, *past[: p - 1]], [0.0, *left[: q - 1]] if q else left
        path = last[0] + np.cumsum(path) if d else np.array(path)
    return path if np.isfinite(path).all() else stay


def project(series: np.ndarray, order: tuple[int, int, int], steps: int) -> np.ndarray:
    """Forecast path of one series held in memory."""
    if len(series) <= DEEPEST:
        return np.full(steps, series[-1])
    mean = series.mean()
    return mean + project_from(series_moments(series), (series - mean)[::-1][: DEEPEST + 1], order, steps)


def _series(history: DataFrame, grid: str) -> tuple[DataFrame, DataFrame]:
    """One series per cell and KPI, nulls left out, centred and with ``DEEPEST`` lags; and its mean.

    A series takes the place of a cell, so that positions and blocks are its own.
    """
    long = history.select("cell_id", "ts", F.explode(F.array(*[F.struct(F.lit(k).alias("kpi"), F.col(k).alias("y")) for k in KPIS])).alias("v"))
    long = long.where("v.y IS NOT NULL").select(_series_name(F.col("cell_id"), F.col("v.kpi")).alias("cell_id"), "ts", F.col("v.y").alias("y"))
    centre = long.groupBy("cell_id").agg(F.avg("y").alias("_mean"))
    centred = join_params(long, centre).select("cell_id", "ts", (F.col("y") - F.col("_mean")).alias("y"))
    return lagged_rows(centred, grid, DEEPEST), centre


def _series_name(cell: Column, kpi: Column) -> Column:
    return F.to_json(F.struct(cell.alias("cell_id"), kpi.alias("kpi")))


def _named(rows: DataFrame, *columns: str) -> DataFrame:
    return rows.withColumn("_k", F.from_json("cell_id", "cell_id string, kpi string")).select("_k.cell_id", "_k.kpi", *columns)


def _products() -> list[Column]:
    """The products whose sums are the moments: upper triangle of [1, y, y_1, …] times itself."""
    terms = [F.lit(1.0), F.col("y"), *[F.col(f"y_{k}") for k in range(1, DEEPEST + 1)]]
    return [terms[i] * terms[j] for i in range(len(terms)) for j in range(i, len(terms))]


def _square(row) -> np.ndarray:
    moments = np.zeros((DEEPEST + 2, DEEPEST + 2))
    at = np.triu_indices(DEEPEST + 2)
    moments[at] = row
    moments.T[at] = row
    return moments


def lag_moments(history: DataFrame, grid: str) -> DataFrame:
    """``cell_id, kpi, moments``: the sums of products over all rows, with every KPI's nulls left out.

    One row per series leaves the aggregation, whatever its length; blocks are
    combined before the shuffle.
    """
    lagged, _ = _series(history, grid)
    whole = lagged.where(F.col(f"y_{DEEPEST}").isNotNull())
    sums = whole.groupBy("cell_id").agg(F.array(*[F.sum(p) for p in _products()]).alias("moments"))
    return _named(sums, "moments")


def rolling_moments(history: DataFrame, origins: DataFrame, grid: str, context: int) -> DataFrame:
    """``cell_id, kpi, ts, points, mean, last, moments`` of the last ``context`` points up to each origin.

    Rows are summed once, between the positions at which some origin's context
    begins or ends.  Running sums over these few rows then give every origin's
    moments as a difference of two, however many contexts a row belongs to.
    """
    lagged, centre = _series(history, grid)
    lagged = cut(lagged)
    placed = cut(with_position(lagged, grid))

    # The last point up to each origin: by window within a block, from earlier blocks by one row per block.
    wanted = origins.select(F.explode(F.array(*[_series_name(F.col("cell_id"), F.lit(k)) for k in KPIS])).alias("cell_id"), "ts").distinct()
    both = placed.select("cell_id", "ts", "_pos").withColumn("_asked", F.lit(False)).unionByName(
        wanted.withColumn("_pos", F.lit(None).cast("long")).withColumn("_asked", F.lit(True))
    )
    blocked = with_block(both, grid)
    carry = blocked.groupBy(*BLOCK).agg(F.max("_pos").alias("_most"))
    carry = carry.select(*BLOCK, F.max("_most").over(over_blocks().rowsBetween(*BEFORE_HERE)).alias("_far"))
    near = F.max("_pos").over(in_block().rangeBetween(Window.unboundedPreceding, 0))
    found = blocked.withColumn("_near", near).where("_asked").join(carry, BLOCK)
    asked = cut(found.select("cell_id", "ts", F.greatest("_near", "_far").alias("_hi")).where("_hi IS NOT NULL").withColumn("_lo", F.col("_hi") - (context - DEEPEST)))

    # Every row belongs to the next position where a context begins or ends.
    edges = asked.select("cell_id", F.explode(F.array("_hi", "_lo")).alias("_pos")).where("_pos >= 0").distinct()
    terms = ["y", *[f"y_{k}" for k in range(1, DEEPEST + 1)]]
    rows = placed.where(F.col(f"y_{DEEPEST}").isNotNull()).select("cell_id", "_pos", *terms)
    empty = [F.lit(None).cast("double").alias(c) for c in terms]
    marked = rows.withColumn("_edge", F.lit(None).cast("long")).unionByName(edges.select("cell_id", "_pos", *empty, F.col("_pos").alias("_edge")))
    marked = marked.withColumn("_block", whole_div(F.col("_pos"), BLOCK_STEPS))
    later = marked.groupBy(*BLOCK).agg(F.min("_edge").alias("_least"))
    later = later.select(*BLOCK, F.min("_least").over(over_blocks(descending=True).rowsBetween(*BEFORE_HERE)).alias("_after"))
    ahead = F.min("_edge").over(in_block("_pos").rangeBetween(0, Window.unboundedFollowing))
    owned = marked.withColumn("_ahead", ahead).join(later, BLOCK).withColumn("_until", F.coalesce("_ahead", "_after")).where("_until IS NOT NULL")
    n = (DEEPEST + 2) * (DEEPEST + 3) // 2
    parts = owned.groupBy("cell_id", F.col("_until").alias("_pos")).agg(*[F.coalesce(F.sum(p * 1.0 if i else F.when(F.col("y").isNotNull(), 1.0)), F.lit(0.0)).alias(f"m{i}") for i, p in enumerate(_products())])
    parts = cut(parts.withColumn("_block", whole_div(F.col("_pos"), BLOCK_STEPS)))
    per = parts.groupBy(*BLOCK).agg(*[F.sum(f"m{i}").alias(f"b{i}") for i in range(n)])
    before = over_blocks().rowsBetween(*BEFORE_HERE)
    per = per.select(*BLOCK, *[F.coalesce(F.sum(f"b{i}").over(before), F.lit(0.0)).alias(f"b{i}") for i in range(n)])
    here = in_block("_pos").rowsBetween(*UP_TO_HERE)
    sums = parts.join(per, BLOCK).select("cell_id", "_pos", F.array(*[F.col(f"b{i}") + F.sum(f"m{i}").over(here) for i in range(n)]).alias("sums"))
    sums = cut(sums)

    up_to = sums.select("cell_id", F.col("_pos").alias("_hi"), F.col("sums").alias("_upto"))
    from_ = sums.select("cell_id", F.col("_pos").alias("_lo"), F.col("sums").alias("_from"))
    newest = placed.select("cell_id", F.col("_pos").alias("_hi"), F.array(*terms).alias("last"))
    out = asked.join(up_to, ["cell_id", "_hi"]).join(from_, ["cell_id", "_lo"], "left").join(newest, ["cell_id", "_hi"])
    moments = F.when(F.col("_from").isNull(), F.col("_upto")).otherwise(F.zip_with("_upto", "_from", lambda a, b: a - b))
    out = join_params(out, centre).withColumn("points", F.least(F.col("_hi") + 1, F.lit(context))).withColumn("moments", moments)
    return _named(out, "ts", "points", F.col("_mean").alias("mean"), "last", "moments")


class AutoRegression(Forecaster):
    """ARIMA orders by AIC per cell and KPI from all training rows; forecasts from every row given.

    An origin is fitted on its last ``context`` points, which is the model's
    memory, by sums that all origins share: nothing is copied per origin.
    """

    name = "arima"

    def __init__(
        self,
        history: DataFrame,
        grid: str = GRID,
        horizons: list[int] = HORIZONS,
        context: int = 1440,
        least: int = 60,
    ):
        self.history, self.grid, self.horizons = history, grid, list(horizons)
        self.context, self.least = context, least
        self.orders: DataFrame | None = None

    def fit(self, train: DataFrame, val: DataFrame | None = None) -> "AutoRegression":
        """Orders ``(cell_id, kpi, p, d, q)`` from the history up to the last training row."""
        ends = train.groupBy("cell_id").agg(F.max("ts").alias("_end"))
        known = join_params(self.history.select("cell_id", "ts", *KPIS), ends, how="inner").where(
            F.col("ts") <= F.col("_end")
        )

        @F.pandas_udf("struct<p:int,d:int,q:int>")
        def order(sums: pd.Series) -> pd.DataFrame:
            found = [choose_order(_square(row)) for row in sums]
            return pd.DataFrame(found, columns=["p", "d", "q"])

        self.orders = cut(lag_moments(known, self.grid).select("cell_id", "kpi", order("moments").alias("o")).select("cell_id", "kpi", "o.*"))
        return self

    def contexts(self, origins: DataFrame) -> DataFrame:
        """The last ``context`` history rows up to each origin.

        The range join is an equi-join on pieces of ``context`` positions; an origin
        touches at most two of them.
        """
        placed = with_position(self.history.select("cell_id", "ts", *KPIS), self.grid)
        starts = (
            origins.select("cell_id", F.col("ts").alias("origin"))
            .join(placed.select("cell_id", F.col("ts").alias("origin"), F.col("_pos").alias("_at")), ["cell_id", "origin"])
            .withColumn("_last", whole_div(F.col("_at"), self.context))
            .withColumn("_piece", F.explode(F.array("_last", F.col("_last") - 1)))
            .drop("_last")
        )
        pieces = placed.withColumn("_piece", whole_div(F.col("_pos"), self.context))
        return (
            starts.join(pieces, ["cell_id", "_piece"])
            .where((F.col("_pos") <= F.col("_at")) & (F.col("_pos") > F.col("_at") - self.context))
            .drop("_piece", "_at")
        )

    def forecasts(self, df: DataFrame) -> DataFrame:
        """Long forecasts ``cell_id, ts, kpi, horizon_min, y_hat`` from every row of ``df``."""
        sums = rolling_moments(self.history.select("cell_id", "ts", *KPIS), df.select(*KEY), self.grid, self.context)
        horizons, least, longest = self.horizons, self.least, max(self.horizons)
        chosen = self.orders.select("cell_id", "kpi", F.array("p", "d", "q").alias("order"))
        salted = sums.join(chosen, ["cell_id", "kpi"], "left")

        @F.pandas_udf("array<double>")
        def ahead(points: pd.Series, mean: pd.Series, last: pd.Series, moments: pd.Series, order: pd.Series) -> pd.Series:
            out = []
            for n, centre, values, sums, o in zip(points, mean, last, moments, order):
                if n < least:
                    out.append([None] * len(horizons))
                    continue
                path = project_from(_square(sums), np.array(values, dtype=float), DEFAULT_ORDER if o is None else tuple(int(v) for v in o), longest)
                out.append([float(centre + path[h - 1]) for h in horizons])
            return pd.Series(out, dtype=object)

        told = salted.withColumn("_told", ahead("points", "mean", "last", "moments", "order"))
        at = F.array(*[F.struct(F.lit(h).alias("horizon_min"), F.get("_told", F.lit(i)).alias("y_hat")) for i, h in enumerate(horizons)])
        return told.select("cell_id", "ts", "kpi", F.explode(at).alias("f")).select("cell_id", "ts", "kpi", "f.*")

    def prepare(self, df: DataFrame) -> DataFrame:
        wide = self.forecasts(df).groupBy(*KEY).agg(
            *[
                F.max(F.when((F.col("kpi") == k) & (F.col("horizon_min") == h), F.col("y_hat"))).alias(f"_ar_{k}_{h}")
                for k in KPIS
                for h in self.horizons
            ]
        )
        return df.join(wide, KEY, "left")

    def forecast(self, kpi: str, horizon: int) -> Column:
        return F.col(f"_ar_{kpi}_{horizon}")


# --------------------------------------------------------------------------
# Boosted trees

LOSSES = [boosting.SQUARED, boosting.ABSOLUTE]


class BoostedTrees(Forecaster):
    """Boosted trees for every KPI and horizon, fitted together; the loss is chosen on validation MAE."""

    name = "arbres_gradient"

    def __init__(
        self,
        kpis: list[str] = KPIS,
        horizons: list[int] = HORIZONS,
        trees: int = 400,
        depth: int = 6,
        rate: float = 0.05,
        rows: float = 0.8,
        columns: float = 0.8,
        loss: str | None = None,
        seed: int = 42,
    ):
        self.kpis, self.horizons, self.loss = list(kpis), list(horizons), loss
        self.settings = boosting.Settings(trees=trees, depth=depth, rate=rate, rows=rows, columns=columns, seed=seed)
        self.inputs: list[str] = []
        self.cells: DataFrame | None = None
        self.booster: boosting.Booster | None = None
        self.log: list[tuple] = []

    def _cases(self) -> list[tuple[str, int]]:
        return [(k, h) for k in self.kpis for h in self.horizons]

    def _design(self, df: DataFrame) -> DataFrame:
        """Adds the cell's number in name order, -1 when unseen."""
        return join_params(df, self.cells).withColumn("cell_id_code", F.coalesce(F.col("_code"), F.lit(-1.0))).drop("_code")

    def fit(self, train: DataFrame, val: DataFrame | None = None) -> "BoostedTrees":
        self.inputs = forecast_features(train)
        self.cells = cut(numbered_cells(train))
        targets = [target_name(k, h) for k, h in self._cases()]
        losses = [self.loss] if self.loss else LOSSES if val is not None else LOSSES[:1]
        rows = cut(self._design(train).select(*KEY, *self.inputs, "cell_id_code", *targets))
        fitted = boosting.Booster([*self.inputs, "cell_id_code"], targets, losses, self.settings).fit(rows, KEY)
        errors = [None] * len(fitted.pairs)
        if val is not None:
            told = fitted.predict(self._design(val), "_told")
            errors = told.agg(*[F.avg(F.abs(F.get("_told", F.lit(m)) - F.col(t))).alias(f"e{m}") for m, (t, _) in enumerate(fitted.pairs)]).first()
        chosen = []
        for k, h in self._cases():
            mine = [(m, loss) for m, (t, loss) in enumerate(fitted.pairs) if t == target_name(k, h)]
            best = min(mine, key=lambda x: (errors[x[0]] is None, errors[x[0]] or 0.0, x[0]))
            chosen.append(fitted.pairs[best[0]])
            self.log += [(k, h, loss, errors[m], m == best[0]) for m, loss in mine]
        self.booster = fitted.keep(chosen)
        return self

    def selection_table(self, spark) -> DataFrame:
        return spark.createDataFrame(
            [(k, h, loss, mae, bool(kept)) for k, h, loss, mae, kept in self.log],
            "kpi string, horizon_min int, objectif string, mae_validation double, retenu boolean",
        )

    def prepare(self, df: DataFrame) -> DataFrame:
        return self.booster.predict(self._design(df), "_boosted").drop("cell_id_code")

    def _number(self, kpi: str, horizon: int) -> int:
        if (kpi, horizon) not in self._cases():
            raise KeyError(f"no model for {kpi} at {horizon}")
        return self._cases().index((kpi, horizon))

    def forecast(self, kpi: str, horizon: int) -> Column:
        return F.get("_boosted", F.lit(self._number(kpi, horizon)))

    def feature_importance(self, spark, kpi: str, horizon: int, top_k: int = 15) -> DataFrame:
        pair = self.booster.pairs[self._number(kpi, horizon)]
        table = spark.createDataFrame(self.booster.importance(pair), "feature string, importance double")
        return table.orderBy(F.col("importance").desc(), "feature").limit(top_k)

    def save(self, path: str) -> None:
        """Everything that ``load`` needs, predictors and settings included."""
        spark = self.cells.sparkSession
        self.cells.write.mode("overwrite").parquet(f"{path}/cells")
        cases = [(i, k, h) for i, (k, h) in enumerate(self._cases())]
        spark.createDataFrame(cases, "at int, kpi string, horizon int").write.mode("overwrite").parquet(f"{path}/cases")
        for name, table in self.booster.tables(spark).items():
            table.write.mode("overwrite").parquet(f"{path}/{name}")

    @staticmethod
    def load(spark, path: str) -> "BoostedTrees":
        cases = spark.read.parquet(f"{path}/cases").orderBy("at").collect()
        out = BoostedTrees(list(dict.fromkeys(r["kpi"] for r in cases)), list(dict.fromkeys(r["horizon"] for r in cases)))
        out.cells = spark.read.parquet(f"{path}/cells")
        out.booster = boosting.Booster.of_tables({n: spark.read.parquet(f"{path}/{n}") for n in ("nodes", "models", "columns", "settings")})
        out.settings, out.inputs = out.booster.settings, out.booster.columns[:-1]
        return out


def numbered_cells(rows: DataFrame) -> DataFrame:
    """``cell_id, _code``: each cell's number in name order, without ordering all cells in one task."""
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cells = cut(rows.select("cell_id").where("cell_id IS NOT NULL").distinct().repartitionByRange(parts, "cell_id").withColumn("_part", F.spark_partition_id()))
    sizes = cells.groupBy("_part").count().orderBy("_part").collect()  # one row per partition
    ahead = spark.createDataFrame([(r["_part"], sum(x["count"] for x in sizes[:i])) for i, r in enumerate(sizes)], "_part int, _ahead long")
    place = F.row_number().over(Window.partitionBy("_part").orderBy("cell_id"))
    return cells.join(F.broadcast(ahead), "_part").select("cell_id", (F.col("_ahead") + place - 1).cast("double").alias("_code"))


def long_forecasts(
    models: list[Forecaster],
    df: DataFrame,
    kpis: list[str] = KPIS,
    horizons: list[int] = HORIZONS,
    scope: str = "test_complet",
) -> DataFrame:
    """``scope, model, kpi, horizon_min, ts, cell_id, y, y_hat`` for rows with targets."""
    parts = []
    for model in models:
        cells = F.array(
            *[
                F.struct(
                    F.lit(k).alias("kpi"),
                    F.lit(h).alias("horizon_min"),
                    F.col(target_name(k, h)).alias("y"),
                    model.forecast(k, h).cast("double").alias("y_hat"),
                )
                for k in kpis
                for h in horizons
            ]
        )
        parts.append(
            model.prepare(df).select(
                F.lit(scope).alias("scope"), F.lit(model.name).alias("model"), *KEY, F.explode(cells).alias("f")
            ).select("scope", "model", "f.kpi", "f.horizon_min", *KEY, "f.y", "f.y_hat")
        )
    return reduce(DataFrame.unionByName, parts)

"""Anomaly detectors: ``fit(train)``, ``score(df)`` adding ``score``, and a threshold.

A higher score is always odder.  Truth never reaches ``fit``.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kpiloom.functions import qos
from kpiloom.operators import neighbours
from kpiloom.operators.features import assert_no_leakage
from kpiloom.operators.quantiles import exact_quantiles, quantile_scalar
from kpiloom.operators.scaling import RobustCellScaler, extremity
from kpiloom.operators.select import systematic_sample
from kpiloom.schema import CONTAMINATION, GRID, KEY, THRESHOLDS
from kpiloom.session import cut

SEED = 42


def uniform(*parts: Column) -> Column:
    """A repeatable number in [0, 1) for a row, derived from its key."""
    return F.shiftrightunsigned(F.xxhash64(*parts), 11) / F.lit(float(1 << 53))


class Detector:
    """Common interface."""

    name = "detector"

    def fit(self, train: DataFrame) -> "Detector":
        return self

    def score(self, df: DataFrame) -> DataFrame:
        raise NotImplementedError

    def default_threshold(self, scored: DataFrame, contamination: float = CONTAMINATION) -> Column:
        """The quantile of scored rows above which ``contamination`` lies; no truth needed."""
        return quantile_scalar(scored, "score", 1 - contamination)

    def predict(self, df: DataFrame, threshold: Column) -> DataFrame:
        return self.score(df).withColumn("is_anomaly_pred", F.col("score") >= threshold)


class ThresholdDetector(Detector):
    """Contract rules on the five-step means: the score is the worst state's rank."""

    name = "seuils_contrat"

    def __init__(self, thresholds=THRESHOLDS, suffix: str = "_mean_5m"):
        self.thresholds, self.suffix = thresholds, suffix

    def score(self, df: DataFrame) -> DataFrame:
        return df.withColumn("score", qos.worst_rank(df, self.thresholds, self.suffix).cast("double"))

    def default_threshold(self, scored: DataFrame, contamination: float = CONTAMINATION) -> Column:
        return F.lit(2.0)


def stored_scaler(train: DataFrame, columns: list[str]) -> RobustCellScaler:
    """A fitted scaler whose parameters are written once."""
    scaler = RobustCellScaler(columns).fit(train)
    scaler.per_cell, scaler.overall = cut(scaler.per_cell), cut(scaler.overall)
    return scaler


class _Scaled(Detector):
    """A detector that works on robustly scaled columns."""

    def __init__(self, columns: list[str]):
        assert_no_leakage(columns)
        self.columns = list(columns)
        self.scaler = RobustCellScaler(self.columns)
        self._given = False

    def share_scaler(self, scaler: RobustCellScaler) -> "_Scaled":
        """Use a scaler already fitted on the same training rows and columns."""
        if scaler.columns != self.columns:
            raise ValueError("the scaler was fitted on other columns")
        self.scaler, self._given = scaler, True
        return self

    def _fit_scaler(self, train: DataFrame) -> DataFrame:
        """Fit the scaler, unless one was shared; return key and scaled vector of the training rows."""
        if not self._given:
            self.scaler = stored_scaler(train, self.columns)
        return self.scaler.vectors(train.select(*KEY, *self.columns)).select(*KEY, "_x")

    def _vectors(self, df: DataFrame) -> DataFrame:
        return self.scaler.vectors(df)


def _stack(vectors: pd.Series, width: int) -> np.ndarray:
    return np.stack(vectors.to_numpy()) if len(vectors) else np.empty((0, width))


# --------------------------------------------------------------------------
# Isolation forest


def _average_path(n: np.ndarray | float) -> np.ndarray:
    """Mean depth of an unsuccessful search among ``n`` points."""
    n = np.asarray(n, dtype=float)
    big = np.maximum(n, 3.0)
    harmonic = np.log(big - 1.0) + np.euler_gamma
    return np.where(n <= 1, 0.0, np.where(n <= 2, 1.0, 2.0 * harmonic - 2.0 * (big - 1.0) / big))


def _grow_tree(points: np.ndarray, rng: np.random.Generator, max_depth: int) -> list[tuple]:
    """Nodes ``(node, feature, threshold, left, right, path)``; leaves have feature -1."""
    nodes: list[tuple] = []
    waiting = [(0, np.arange(len(points)), 0)]
    used = 1
    while waiting:
        node, rows, depth = waiting.pop()
        low, high = points[rows].min(axis=0), points[rows].max(axis=0)
        varied = np.flatnonzero(high > low)
        if depth >= max_depth or len(rows) <= 1 or not len(varied):
            nodes.append((node, -1, 0.0, -1, -1, depth + float(_average_path(len(rows)))))
            continue
        feature = int(rng.choice(varied))
        # Below the highest value, so that both sides keep a row.
        cut_at = float(min(rng.uniform(low[feature], high[feature]), np.nextafter(high[feature], low[feature])))
        goes_left = points[rows, feature] <= cut_at
        left, right = used, used + 1
        used += 2
        nodes.append((node, feature, cut_at, left, right, 0.0))
        waiting += [(left, rows[goes_left], depth + 1), (right, rows[~goes_left], depth + 1)]
    return nodes


class IsolationForest(_Scaled):
    """Trees of random cuts, grown in parallel, one small sample each.

    ``trees * (2 * sample - 1)`` bounds the node table, whatever the data size.
    """

    name = "isolation_forest"
    NODES = "tree int, node int, feature int, threshold double, left int, right int, path double"

    def __init__(self, columns: list[str], trees: int = 300, sample: int = 256, seed: int = SEED):
        super().__init__(columns)
        self.trees, self.sample, self.seed = trees, sample, seed
        self.nodes: DataFrame | None = None
        self.points = sample
        self._shared = None

    def fit(self, train: DataFrame) -> "IsolationForest":
        scaled = self._fit_scaler(train)
        total = train.count()
        # A few more candidates than needed per tree, then exactly `sample` of them.
        rate = min(1.0, (self.sample + 10 * math.sqrt(self.sample)) / max(total, 1))
        drawn = self._draw(scaled, rate)
        chosen = (
            drawn.withColumn("_rn", F.row_number().over(Window.partitionBy("tree").orderBy("_u", *KEY)))
            .where(F.col("_rn") <= self.sample)
            .select("tree", "_rn", "_x")
        )
        self.points = max(min(self.sample, total), 2)
        depth, width, seed = max(1, math.ceil(math.log2(self.points))), len(self.columns), self.seed

        def grow(pdf: pd.DataFrame) -> pd.DataFrame:
            tree = int(pdf["tree"].iloc[0])
            rows = pdf.sort_values("_rn")
            nodes = _grow_tree(_stack(rows["_x"], width), np.random.default_rng([seed, tree]), depth)
            out = pd.DataFrame(nodes, columns=["node", "feature", "threshold", "left", "right", "path"])
            out.insert(0, "tree", tree)
            return out

        self.nodes = cut(chosen.groupBy("tree").applyInPandas(grow, self.NODES))
        self._shared = None
        return self

    def _draw(self, rows: DataFrame, rate: float) -> DataFrame:
        """Every tree draws each row with probability ``rate``, all rows of the table taking part.

        A row's first tree comes from one number by a geometric skip, so rows
        that no tree draws, nearly all of a large table, cost one hash.  Only the
        others decide about their later trees one by one.
        """
        trees, key = self.trees, KEY
        if rate < 1.0:
            skip = F.floor(F.log1p(-uniform(F.lit(self.seed), *key)) / F.lit(math.log1p(-rate)))
            rows = rows.withColumn("_first", skip).where(F.col("_first") < trees)
        else:
            rows = rows.withColumn("_first", F.lit(0).cast("long"))
        chance = lambda t: uniform(F.lit(self.seed + 1), t, *[F.col(k) for k in key])
        later = F.filter(
            F.sequence(F.lit(0).cast("long"), F.lit(trees - 1).cast("long")),
            lambda t: (t == F.col("_first")) | ((t > F.col("_first")) & (chance(t) < rate)),
        )
        drawn = rows.withColumn("tree", F.explode(F.transform(later, lambda t: t.cast("int")))).drop("_first")
        return drawn.withColumn("_u", uniform(F.lit(self.seed + 2), "tree", *key))

    def _forest(self, spark) -> object:
        """The node table as arrays for the executors; its size is fixed by the parameters."""
        if self._shared is None:
            limit = self.trees * (2 * self.sample - 1)
            rows = self.nodes.limit(limit + 1).toPandas()
            if len(rows) > limit:
                raise RuntimeError("the node table is larger than its parameters allow")
            slots = int(rows["node"].max()) + 1
            shape = (int(rows["tree"].max()) + 1, slots)
            packed = {}
            for name, kind in (("feature", int), ("threshold", float), ("left", int), ("right", int), ("path", float)):
                table = np.zeros(shape, dtype=kind)
                table[rows["tree"], rows["node"]] = rows[name]
                packed[name] = table
            self._shared = spark.sparkContext.broadcast(packed)
        return self._shared

    def score(self, df: DataFrame) -> DataFrame:
        shared, width = self._forest(df.sparkSession), len(self.columns)
        norm = float(_average_path(self.points))

        @F.pandas_udf("double")
        def isolate(vectors: pd.Series) -> pd.Series:
            forest, x = shared.value, _stack(vectors, width)
            rows, depth = np.arange(len(x)), np.zeros(len(x))
            for t in range(len(forest["feature"])):
                at = np.zeros(len(x), dtype=int)
                while True:
                    feature = forest["feature"][t, at]
                    inner = feature >= 0
                    if not inner.any():
                        break
                    left = x[rows, np.maximum(feature, 0)] <= forest["threshold"][t, at]
                    step = np.where(left, forest["left"][t, at], forest["right"][t, at])
                    at = np.where(inner, step, at)
                depth += forest["path"][t, at]
            return pd.Series(np.exp2(-depth / len(forest["feature"]) / norm))

        return self._vectors(df).withColumn("score", isolate("_x")).drop("_x")


# --------------------------------------------------------------------------
# DBSCAN


def _numbered(points: DataFrame) -> DataFrame:
    """Points written with a row number."""
    return cut(points.withColumn("_row", F.monotonically_increasing_id()))


class DensityDetector(_Scaled):
    """DBSCAN on all training rows; the score is the distance to the nearest kept point.

    Every step is a neighbour join on cells of projections: the distances to
    the ``min_samples``-th neighbour, of which a high quantile is eps, the points near a core,
    and the scores.  A row is a core if its ``min_samples``-th neighbour, itself counted, lies within eps.
    Given ``max_points``, a systematic sample of at most so many rows is fitted instead.
    """

    name = "dbscan"

    def __init__(
        self,
        columns: list[str],
        eps: float | None = None,
        min_samples: int = 20,
        max_points: int | None = None,
        eps_quantile: float = 0.98,
        grid: str = GRID,
        few: int | None = None,
    ):
        super().__init__(columns)
        self.eps, self.min_samples, self.max_points = eps, min_samples, max_points
        self.eps_quantile, self.grid, self.few = eps_quantile, grid, few
        self.noise_ratio: float | None = None
        self.kept: DataFrame | None = None

    def _nearest(self, rows: DataFrame, points: DataFrame, k: int, **limits) -> DataFrame:
        queries = rows.select(F.col("_row").alias("_q"), "_x")
        found = neighbours.nearest(queries, points, k, len(self.columns), few=self.few, **limits)
        return found.select(F.col("_q").alias("_row"), F.element_at("d", -1).alias("_far"), F.size("d").alias("_n"))

    def kth_distances(self, points: DataFrame, share: float = 1.0) -> DataFrame:
        """``_row, k_distance`` to the ``min_samples``-th neighbour, itself counted, of at least ``share`` of the points."""
        found = self._nearest(points, points, self.min_samples, share=share)
        return found.select("_row", F.col("_far").alias("k_distance"))

    def _estimate(self, points: DataFrame, n: int) -> DataFrame:
        """Set eps to the quantile of the distances; returns those of all points that can matter for it."""
        distances = cut(self.kth_distances(points, self.eps_quantile))
        # The points left out are farther than all others, so ranks count as in the whole table.
        known = distances.count()
        rank = self.eps_quantile * (n - 1)
        prob = min(1.0, rank / (known - 1)) if known > 1 else 0.0
        self.eps = float(exact_quantiles(distances, ["k_distance"], [prob]).first()["value"])
        return distances.where(F.col("k_distance") <= self.eps)

    def label(self, points: DataFrame) -> DataFrame:
        """Add ``is_core`` and ``is_noise`` to numbered points; estimates eps if it is not given."""
        n = points.count()
        if self.eps is None:
            cores = self._estimate(points, n)
        else:
            needed = min(self.min_samples, n)
            cores = self._nearest(points, points, needed, within=self.eps).where(F.col("_n") >= needed) if n >= self.min_samples else points.limit(0)
        marked = cut(points.join(cores.select("_row", F.lit(True).alias("is_core")), "_row", "left").withColumn("is_core", F.coalesce("is_core", F.lit(False))))
        near = self._nearest(marked.where("NOT is_core"), marked.where("is_core").select("_x"), 1, within=self.eps)
        near = near.select("_row", F.lit(True).alias("_near"))
        return marked.join(near, "_row", "left").withColumn("is_noise", ~F.col("is_core") & F.col("_near").isNull()).drop("_near")

    def fit(self, train: DataFrame) -> "DensityDetector":
        scaled = self._fit_scaler(train)
        if self.max_points is not None:
            scaled = systematic_sample(scaled, self.grid, self.max_points)
        labelled = cut(self.label(_numbered(scaled)))
        self.noise_ratio = labelled.agg(F.avg(F.col("is_noise").cast("int"))).first()[0]
        kept = labelled.where(~F.col("is_noise"))
        self.kept = cut((labelled if kept.isEmpty() else kept).select(*KEY, "_x"))
        return self

    def score(self, df: DataFrame) -> DataFrame:
        rows = _numbered(self._vectors(df))
        found = self._nearest(rows, self.kept, 1).select("_row", F.col("_far").alias("score"))
        return rows.join(found, "_row", "left").drop("_row", "_x")

    def default_threshold(self, scored: DataFrame, contamination: float = CONTAMINATION) -> Column:
        return F.lit(float(self.eps))


# --------------------------------------------------------------------------
# Autoencoder


class _Net:
    """A dense ReLU network over one flat parameter vector."""

    def __init__(self, sizes: tuple[int, ...]):
        self.sizes = sizes
        self.shapes = [((a, b), (b,)) for a, b in zip(sizes, sizes[1:])]
        self.length = sum(a * b + b for a, b in zip(sizes, sizes[1:]))

    def start(self, seed: int) -> np.ndarray:
        rng, parts = np.random.default_rng(seed), []
        for a, b in zip(self.sizes, self.sizes[1:]):
            bound = math.sqrt(6.0 / (a + b))
            parts += [rng.uniform(-bound, bound, a * b), rng.uniform(-bound, bound, b)]
        return np.concatenate(parts)

    def layers(self, flat: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        out, at = [], 0
        for weight, bias in self.shapes:
            size = weight[0] * weight[1]
            out.append((flat[at : at + size].reshape(weight), flat[at + size : at + size + bias[0]]))
            at += size + bias[0]
        return out

    def forward(self, flat: np.ndarray, x: np.ndarray) -> list[np.ndarray]:
        layers, seen = self.layers(flat), [x]
        for depth, (w, b) in enumerate(layers):
            z = seen[-1] @ w + b
            seen.append(np.maximum(z, 0.0) if depth < len(layers) - 1 else z)
        return seen

    def gradient(self, flat: np.ndarray, x: np.ndarray, decay: float) -> np.ndarray:
        layers, seen = self.layers(flat), self.forward(flat, x)
        delta, parts = (seen[-1] - x) / len(x), []
        for depth in range(len(layers) - 1, -1, -1):
            w, _ = layers[depth]
            parts = [(seen[depth].T @ delta + decay * w / len(x)).ravel(), delta.sum(axis=0)] + parts
            if depth:
                delta = (delta @ w.T) * (seen[depth] > 0)
        return np.concatenate(parts)


def _direction(gradient: np.ndarray, past: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The quasi-Newton step from the last changes of parameters and gradient (two-loop recursion)."""
    q, weights = gradient.copy(), []
    for moved, turned in reversed(past):
        weights.append((moved @ q) / (turned @ moved))
        q -= weights[-1] * turned
    if past:
        moved, turned = past[-1]
        q *= (moved @ turned) / (turned @ turned)
    for (moved, turned), a in zip(past, reversed(weights)):
        q += (a - (turned @ q) / (turned @ moved)) * moved
    return -q


LOCAL_ROWS = 65_536  # so many training rows fit one task


class Autoencoder(_Scaled):
    """A bottleneck network; the score is the mean squared reconstruction error.

    Fitted by L-BFGS on the whole training set, alone or with other shapes at
    once (``fit_autoencoders``).
    """

    name = "autoencodeur"

    def __init__(
        self,
        columns: list[str],
        hidden: tuple[int, ...] = (16, 8, 16),
        max_iter: int = 300,
        trim: float = 0.02,
        patience: int = 12,
        memory: int = 10,
        decay: float = 1e-4,
        seed: int = SEED,
    ):
        super().__init__(columns)
        self.hidden, self.max_iter, self.trim = tuple(hidden), max_iter, trim
        self.patience, self.memory, self.decay, self.seed = patience, memory, decay, seed
        self.net = _Net((len(self.columns), *self.hidden, len(self.columns)))
        self.weights: np.ndarray | None = None
        self.rows_kept = 0
        self.epochs = 0

    def _settings(self) -> dict:
        return dict(max_iter=self.max_iter, patience=self.patience, memory=self.memory, decay=self.decay, seed=self.seed)

    def fit(self, train: DataFrame) -> "Autoencoder":
        return fit_autoencoders([self], train)[0]

    def errors(self, df: DataFrame) -> DataFrame:
        """Add ``_errors``, the squared reconstruction error of each column."""
        net, weights = self.net, self.weights

        @F.pandas_udf("array<double>")
        def reconstruct(vectors: pd.Series) -> pd.Series:
            x = _stack(vectors, net.sizes[0])
            return pd.Series(list((x - net.forward(weights, x)[-1]) ** 2))

        return self._vectors(df).withColumn("_errors", reconstruct("_x")).drop("_x")

    def score(self, df: DataFrame) -> DataFrame:
        return self.errors(df).withColumn("score", mean_of("_errors")).drop("_errors")

    def explain(self, df: DataFrame, top_k: int = 3) -> DataFrame:
        """Add ``score`` and ``causes``, the columns reconstructed worst."""
        scored = self.errors(df).withColumn("score", mean_of("_errors"))
        return scored.withColumn("causes", top_contributors("_errors", self.columns, top_k)).drop("_errors")


def _net_sums(net: _Net, w: np.ndarray, x: np.ndarray, aside: np.ndarray) -> np.ndarray:
    """Sums over rows: gradient, loss, rows, and of the rows set aside error and number."""
    total = np.zeros(net.length + 4)
    if aside.any():
        total[-2] = ((net.forward(w, x[aside])[-1] - x[aside]) ** 2).mean(axis=1).sum()
        total[-1] = aside.sum()
    if (~aside).any():
        x = x[~aside]
        total[: net.length] = net.gradient(w, x, 0.0) * len(x)
        total[-4] = 0.5 * ((net.forward(w, x)[-1] - x) ** 2).sum()
        total[-3] = len(x)
    return total


def _net_loss(net: _Net, w: np.ndarray, summed: np.ndarray, decay: float) -> tuple[float, np.ndarray, float]:
    """Mean loss and gradient over the training rows, and the mean error of those set aside."""
    n = max(summed[-3], 1.0)
    inner = np.zeros(net.length)
    at = 0
    for (a, b), _ in net.shapes:  # decay holds for weights, not for biases
        inner[at : at + a * b] = w[at : at + a * b]
        at += a * b + b
    held = summed[-2] / summed[-1] if summed[-1] else math.inf
    return summed[-4] / n + 0.5 * decay * inner @ inner, summed[: net.length] / n + decay * inner, held


def _descent(net: _Net, max_iter: int, patience: int, memory: int, decay: float, seed: int):
    """L-BFGS as a generator: yields parameters, is sent their sums, and returns the best parameters and the steps taken."""
    w = net.start(seed)
    loss, gradient, error = _net_loss(net, w, (yield w), decay)
    best, kept, stale, past, steps = error, w, 0, [], 0
    for step in range(1, max_iter + 1):
        if not np.abs(gradient).max() > 1e-9:
            break
        way = _direction(gradient, past)
        slope = way @ gradient
        if slope >= 0:  # the curvature held is of no use; start again downhill
            past, way = [], -gradient
            slope = way @ gradient
        length = 1.0 if past else min(1.0, 1.0 / np.abs(gradient).sum())
        for _ in range(12):
            tried = w + length * way
            new_loss, new_gradient, new_error = _net_loss(net, tried, (yield tried), decay)
            if new_loss <= loss + 1e-4 * length * slope:
                break
            length *= 0.3
        else:
            break
        moved, turned = tried - w, new_gradient - gradient
        if moved @ turned > 1e-10 * (turned @ turned):
            past = [*past, (moved, turned)][-memory:]
        w, loss, gradient, error, steps = tried, new_loss, new_gradient, new_error, step
        if not math.isfinite(error) or error < best - 1e-4 * abs(best if math.isfinite(best) else 0.0):
            best, kept, stale = error, w, 0
        else:
            stale += 1
            if stale >= patience:
                break
    return kept, steps


def fit_autoencoders(models: list[Autoencoder], train: DataFrame) -> list[Autoencoder]:
    """Fit several shapes on the same columns together.

    Every pass over the rows sums the gradients of all shapes that still move,
    each at its own parameters, with its own line search and its own stop.  Only parameters and
    their gradients pass through the driver.  Up to ``LOCAL_ROWS`` rows, one task per shape
    makes the same steps on them without a pass each.
    """
    lead = models[0]
    if any(m.columns != lead.columns or m.seed != lead.seed for m in models):
        raise ValueError("models fitted together share columns and seed")
    scaled = cut(lead._fit_scaler(train))
    for m in models[1:]:
        m.share_scaler(lead.scaler)
    measured = cut(scaled.select("_x", extremity("_x").alias("far"), (uniform(F.lit(lead.seed), *KEY) < 0.1).alias("held")))
    shares = sorted({m.trim for m in models if m.trim > 0})
    found = exact_quantiles(measured, ["far"], [1 - s for s in shares]).collect() if shares else []
    by_prob = {r["prob"]: r["value"] for r in found}
    limits = [by_prob.get(1 - m.trim, math.inf) if m.trim > 0 else math.inf for m in models]
    counted = measured.agg(F.count("*").alias("n"), *[F.count_if(F.col("far") <= F.lit(v)).alias(f"n{i}") for i, v in enumerate(limits)]).first()
    for i, m in enumerate(models):
        m.rows_kept = counted[f"n{i}"]
    nets, settings = [m.net for m in models], [m._settings() for m in models]

    if 0 < counted["n"] <= LOCAL_ROWS:

        def alone(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
            i = key[0]
            rows = rows[rows["far"] <= limits[i]]
            x, aside = _stack(rows["_x"], nets[i].sizes[0]), rows["held"].to_numpy(bool)
            run = _descent(nets[i], **settings[i])
            w = next(run)
            while True:
                try:
                    w = run.send(_net_sums(nets[i], w, x, aside))
                except StopIteration as end:
                    kept, steps = end.value
                    return pd.DataFrame({"i": [i], "w": [kept.tobytes()], "steps": [steps]})

        each = measured.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(len(models) - 1)))).repartition(len(models), "i")
        for r in each.groupBy("i").applyInPandas(alone, "i int, w binary, steps int").collect():
            models[r["i"]].weights, models[r["i"]].epochs = np.frombuffer(r["w"]), r["steps"]
        return models

    runs = {i: _descent(nets[i], **settings[i]) for i in range(len(models))}
    at = {i: next(run) for i, run in runs.items()}
    while at:
        sums = _pass(measured, [(i, nets[i], limits[i], w) for i, w in at.items()])
        for i in list(at):
            try:
                at[i] = runs[i].send(sums[i])
            except StopIteration as end:
                models[i].weights, models[i].epochs = end.value
                del at[i]
    return models


def _pass(rows: DataFrame, asked: list[tuple[int, _Net, float, np.ndarray]]) -> dict[int, np.ndarray]:
    """The sums of all asked networks in one pass over the rows."""

    def sums(batches):
        totals = {i: np.zeros(net.length + 4) for i, net, _, _ in asked}
        for pdf in batches:
            if len(pdf):
                x, far, aside = _stack(pdf["_x"], asked[0][1].sizes[0]), pdf["far"].to_numpy(), pdf["held"].to_numpy(bool)
                for i, net, limit, w in asked:
                    mine = far <= limit
                    totals[i] += _net_sums(net, w, x[mine], aside[mine])
        yield pd.DataFrame({"i": list(totals), "total": [t.tolist() for t in totals.values()]})

    parts = rows.mapInPandas(sums, "i int, total array<double>").select("i", F.posexplode("total").alias("at", "v"))
    summed = parts.groupBy("i", "at").agg(F.sum("v").alias("v")).toPandas()
    out = {i: np.zeros(net.length + 4) for i, net, _, _ in asked}
    for i, part in summed.groupby("i"):
        out[i][part["at"]] = part["v"]
    return out


def mean_of(errors: str) -> Column:
    return F.aggregate(errors, F.lit(0.0), lambda s, v: s + v) / F.size(errors)


def top_contributors(errors: str, columns: list[str], top_k: int) -> Column:
    """Names of the ``top_k`` largest entries, the earlier column first on ties."""
    named = F.transform(
        errors,
        lambda e, i: F.struct(e.alias("e"), (-i).alias("i"), F.get(F.array(*[F.lit(c) for c in columns]), i).alias("c")),
    )
    return F.array_join(F.transform(F.slice(F.sort_array(named, asc=False), 1, top_k), lambda s: s["c"]), ", ")


class LinearReconstruction(_Scaled):
    """Reconstruction error from the leading principal components, fitted by MLlib."""

    name = "acp"

    def __init__(self, columns: list[str], components: int = 8):
        super().__init__(columns)
        self.components = components
        self.basis: np.ndarray | None = None

    def fit(self, train: DataFrame) -> "LinearReconstruction":
        from pyspark.ml.feature import PCA
        from pyspark.ml.functions import array_to_vector

        scaled = self._fit_scaler(train).select(array_to_vector("_x").alias("v"))
        model = PCA(k=self.components, inputCol="v", outputCol="p").fit(scaled)
        self.basis = model.pc.toArray()
        return self

    def score(self, df: DataFrame) -> DataFrame:
        basis = self.basis

        @F.pandas_udf("double")
        def residual(vectors: pd.Series) -> pd.Series:
            x = _stack(vectors, len(basis))
            return pd.Series(((x - x @ basis @ basis.T) ** 2).mean(axis=1))

        return self._vectors(df).withColumn("score", residual("_x")).drop("_x")


def build_detectors(columns: list[str], grid: str = GRID, thresholds=THRESHOLDS) -> dict[str, Detector]:
    """The four compared detectors."""
    found = [ThresholdDetector(thresholds), IsolationForest(columns), DensityDetector(columns, grid=grid), Autoencoder(columns)]
    return {d.name: d for d in found}


# Fixed grid of compared network shapes and trim shares.
AUTOENCODER_GRID = [
    {"hidden": (16, 8, 16), "trim": 0.0},
    {"hidden": (16, 8, 16), "trim": 0.02},
    {"hidden": (16, 6, 16), "trim": 0.05},
    {"hidden": (12, 4, 12), "trim": 0.02},
    {"hidden": (20, 10, 20), "trim": 0.02},
]

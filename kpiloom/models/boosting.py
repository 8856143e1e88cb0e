"""Boosted regression trees for many targets and losses at once.

Predictors are cut into at most ``BINS`` ranges and stored as one matrix of
bytes, in blocks of bounded size.  A level of a tree is grown for every model in
one pass: each block adds gradients and curvatures per node, predictor and
range for all models, partial sums are combined under a key of one model, and a
model's best splits are found where its sums meet.  Only splits reach the
driver; their number is fixed by the settings.  Up to ``LOCAL_ROWS`` rows, a
bounded amount, one task per model runs the same steps without a pass per level.

The squared error has curvature 1.  The absolute error is replaced, at each
residual r, by the parabola that touches it there, whose curvature is 1/|r|.
"""

from __future__ import annotations

import dataclasses
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiloom.operators.quantiles import exact_quantiles
from kpiloom.session import cut

BINS = 64
BLOCK = 8_192  # rows of a block
LOCAL_ROWS = 65_536  # so many rows fit one task
KEPT_TREES = 5  # trees applied in memory before the predictions of all rows are written again
SQUARED, ABSOLUTE = "squared", "absolute"
_BLOCK = "block long, n int, bins binary, y binary, mark binary, margin binary"


@dataclasses.dataclass(frozen=True)
class Settings:
    trees: int = 400
    depth: int = 6
    rate: float = 0.05
    rows: float = 0.8
    columns: float = 0.8
    ridge: float = 1.0
    least_rows: int = 1
    seed: int = 42


class Trees:
    """Complete binary trees of several models as arrays ``(model, tree, node)``; an unsplit node has feature -1."""

    def __init__(self, models: int, trees: int, depth: int) -> None:
        nodes = 2 ** (depth + 1) - 1
        self.depth = depth
        self.feature = np.full((models, trees, nodes), -1, np.int16)
        self.bin = np.zeros((models, trees, nodes), np.uint8)
        self.value = np.zeros((models, trees, nodes))

    def leaves(self, bins: np.ndarray, tree: int, levels: int | None = None) -> np.ndarray:
        """The node that every row reaches in one tree of every model: ``(row, model)``."""
        feature, at_bin = self.feature[:, tree], self.bin[:, tree]
        models = np.arange(len(feature))[None, :]
        rows = np.arange(len(bins))[:, None]
        node = np.zeros((len(bins), len(feature)), np.int64)
        for _ in range(self.depth if levels is None else levels):
            f = feature[models, node]
            right = bins[rows, np.maximum(f, 0)] > at_bin[models, node]
            node = np.where(f >= 0, 2 * node + 1 + right, node)
        return node

    def add(self, margin: np.ndarray, bins: np.ndarray, trees: range) -> None:
        models = np.arange(self.feature.shape[0])[None, :]
        for t in trees:
            margin += self.value[:, t][models, self.leaves(bins, t)]


def bin_edges(rows: DataFrame, columns: list[str], bins: int = BINS) -> list[np.ndarray]:
    """Upper edges of the ranges of each predictor: quantiles from one mergeable sketch, at most ``bins - 1`` each."""
    probs = F.array(*[F.lit(k / bins) for k in range(1, bins)])
    found = rows.agg(*[F.percentile_approx(F.col(f"`{c}`").cast("double"), probs, F.lit(50 * bins)).alias(f"q{i}") for i, c in enumerate(columns)]).first()
    return [np.unique(np.array([v for v in (found[i] or []) if v is not None and not math.isnan(v)])) for i in range(len(columns))]


def binned(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    """Range numbers; a missing value goes to the first."""
    out = np.zeros(x.shape, np.uint8)
    for i, e in enumerate(edges):
        out[:, i] = np.where(np.isnan(x[:, i]), 0, np.searchsorted(e, x[:, i], side="left"))
    return out


def _matrix(batch: pd.DataFrame, columns: list[str]) -> np.ndarray:
    return np.column_stack([pd.to_numeric(batch[c]).to_numpy(dtype=float, na_value=np.nan) for c in columns]) if columns else np.zeros((len(batch), 0))


def blocks(rows: DataFrame, columns: list[str], targets: list[str], edges: list[np.ndarray], base: np.ndarray, key: list[str]) -> DataFrame:
    """The binned matrix with targets, a number per row that decides on samples, and the first predictions."""
    chosen = rows.select(
        *[F.col(f"`{c}`").cast("double").alias(f"x{i}") for i, c in enumerate(columns)],
        *[F.col(f"`{c}`").cast("double").alias(f"y{i}") for i, c in enumerate(targets)],
        F.xxhash64(*key).alias("mark"),
    )
    xs, ys = [f"x{i}" for i in range(len(columns))], [f"y{i}" for i in range(len(targets))]

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), BLOCK):
                part = batch.iloc[at : at + BLOCK]
                margin = np.tile(base, (len(part), 1))
                yield pd.DataFrame(
                    {
                        "block": [0],
                        "n": np.array([len(part)], np.int32),
                        "bins": [binned(_matrix(part, xs), edges).tobytes()],
                        "y": [_matrix(part, ys).tobytes()],
                        "mark": [part["mark"].to_numpy(np.int64).tobytes()],
                        "margin": [margin.tobytes()],
                    }
                )

    return chosen.mapInPandas(pack, _BLOCK)


def _read(rows: list[dict], width: int, targets: int, models: int) -> Iterator[tuple]:
    for r in rows:
        n = r["n"]
        yield (
            r,
            np.frombuffer(r["bins"], np.uint8).reshape(n, width),
            np.frombuffer(r["y"]).reshape(n, targets),
            np.frombuffer(r["mark"], np.int64),
            np.frombuffer(r["margin"]).reshape(n, models).copy(),
        )


def _drawn(mark: np.ndarray, tree: int, share: float, seed: int) -> np.ndarray:
    """The rows that a tree sees, by a hash of the row and the tree."""
    x = mark.astype(np.uint64) + np.uint64(((tree + 1) * 0x9E3779B97F4A7C15 + seed) % (1 << 64))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((x ^ (x >> np.uint64(31))) >> np.uint64(11)).astype(float) / float(1 << 53) < share


def columns_of(settings: Settings, tree: int, model: int, width: int) -> np.ndarray:
    """The predictors that a tree of a model may use."""
    out = np.zeros(width, bool)
    kept = max(1, round(settings.columns * width))
    out[np.random.default_rng([settings.seed, tree, model]).permutation(width)[:kept]] = True
    return out


def level_sums(bins: np.ndarray, residual: np.ndarray, node: np.ndarray, nodes: int, n_bins: int, floor: float | None) -> np.ndarray:
    """Gradients, curvatures and rows per node, predictor and range; ``floor`` is given for the absolute error."""
    width = bins.shape[1]
    size = nodes * width * n_bins
    here = (node >= 0) & ~np.isnan(residual)
    r = residual[here]
    at = (np.arange(width) * n_bins + bins[here] + (node[here] * (width * n_bins))[:, None]).ravel()
    out = np.empty((3, size))
    out[2] = np.bincount(at, minlength=size)
    if floor is None:
        out[0], out[1] = np.bincount(at, np.repeat(r, width), size), out[2]
    else:
        h = 1.0 / np.maximum(np.abs(r), floor)
        out[0], out[1] = np.bincount(at, np.repeat(r * h, width), size), np.bincount(at, np.repeat(h, width), size)
    return out


def best_splits(total: np.ndarray, nodes: int, allowed: np.ndarray, settings: Settings) -> list[tuple]:
    """``(node, feature, bin, gain, low, high)`` of the nodes of a level that are split; a root's own value has feature -1."""
    width = len(allowed)
    g, h, n = total.reshape(3, nodes, width, -1)
    n_bins = g.shape[2]
    left_g, left_h, left_n = (v.cumsum(axis=2) for v in (g, h, n))
    all_g, all_h, all_n = (v[:, :, -1:] for v in (left_g, left_h, left_n))
    # the ridge counts in rows: a row's mean curvature
    extra = settings.ridge * all_h / np.maximum(all_n, 1)

    def worth(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return a * a / np.maximum(b + extra, 1e-300)

    gain = worth(left_g, left_h) + worth(all_g - left_g, all_h - left_h) - worth(all_g, all_h)
    fits = (left_n >= settings.least_rows) & (all_n - left_n >= settings.least_rows) & allowed[None, :, None]
    gain = np.where(fits, gain, -np.inf).reshape(nodes, -1)
    best = gain.argmax(axis=1)
    out, rate = [], settings.rate
    for k in range(nodes):
        f, b = divmod(int(best[k]), n_bins)
        e = extra[k, f, 0]
        if nodes == 1 and all_n[k, 0, 0] > 0:
            out.append((0, -1, 0, 0.0, 0.0, rate * all_g[k, f, 0] / max(all_h[k, f, 0] + e, 1e-300)))
        if gain[k, best[k]] > 1e-12:
            lg, lh = left_g[k, f, b], left_h[k, f, b]
            rg, rh = all_g[k, f, 0] - lg, all_h[k, f, 0] - lh
            out.append((nodes - 1 + k, f, b, float(gain[k, best[k]]), rate * lg / (lh + e), rate * rg / (rh + e)))
    return out


def _note(trees: Trees, gain: np.ndarray, model: int, tree: int, splits: list[tuple]) -> bool:
    for node, feature, at_bin, worth, low, high in splits:
        if feature < 0:
            trees.value[model, tree, 0] = high
            continue
        trees.feature[model, tree, node], trees.bin[model, tree, node] = feature, at_bin
        trees.value[model, tree, 2 * node + 1], trees.value[model, tree, 2 * node + 2] = low, high
        gain[model, feature] += worth
    return any(s[1] >= 0 for s in splits)


class Booster:
    """Models of ``(target, loss)`` fitted together."""

    def __init__(self, columns: list[str], targets: list[str], losses: list[str], settings: Settings = Settings(), bins: int = BINS) -> None:
        self.columns, self.targets, self.losses = list(columns), list(targets), list(losses)
        self.settings, self.bins = settings, bins
        self.pairs = [(t, loss) for t in self.targets for loss in self.losses]
        self.edges: list[np.ndarray] = []
        self.base = np.zeros(len(self.pairs))
        self.floor = np.ones(len(self.pairs))
        self.trees: Trees | None = None
        self.gain = np.zeros((len(self.pairs), len(self.columns)))

    def start(self, rows: DataFrame) -> None:
        """First predictions: the mean, or the median for the absolute error; and the scale below which residuals count as zero."""
        means = rows.agg(*[F.avg(F.col(f"`{t}`").cast("double")).alias(f"m{i}") for i, t in enumerate(self.targets)]).first()
        quantiles = exact_quantiles(rows, self.targets, [0.25, 0.5, 0.75]).collect()
        at = {(r["name"], r["prob"]): r["value"] for r in quantiles}
        for m, (t, loss) in enumerate(self.pairs):
            mean, median = means[self.targets.index(t)], at.get((t, 0.5))
            self.base[m] = (mean if loss == SQUARED else median) or 0.0
            spread = (at.get((t, 0.75)) or 0.0) - (at.get((t, 0.25)) or 0.0)
            self.floor[m] = 1e-3 * spread if spread > 0 else 1e-6

    def fit(self, rows: DataFrame, key: list[str]) -> "Booster":
        s, models = self.settings, len(self.pairs)
        self.edges = bin_edges(rows, self.columns, self.bins)
        self.start(rows)
        self.trees = Trees(models, s.trees, s.depth)
        n = rows.count()
        # Partitions of whole blocks, so that partial sums are few where rows are few.
        rows = rows.repartition(max(1, math.ceil(n / BLOCK)), *key)
        state = cut(blocks(rows, self.columns, self.targets, self.edges, self.base, key))
        if n <= LOCAL_ROWS:
            self._fit_apart(state)
            return self
        state = state.persist()
        written = 0
        for tree in range(s.trees):
            for level in range(s.depth):
                if not self._grow(state, written, tree, level):
                    break
            if tree + 1 - written >= KEPT_TREES and tree + 1 < s.trees:
                newer = cut(self._applied(state, written, tree + 1)).persist()
                state.unpersist()
                state, written = newer, tree + 1
        state.unpersist()
        return self

    def _fit_apart(self, state: DataFrame) -> None:
        """Every model in a task of its own, from all rows, of which there are at most ``LOCAL_ROWS``."""
        s, width, targets, models, n_bins = self.settings, len(self.columns), len(self.targets), len(self.pairs), self.bins
        base, floors = self.base, self._floors()
        target_of = [self.targets.index(t) for t, _ in self.pairs]

        def grow(key: tuple, parts: pd.DataFrame) -> pd.DataFrame:
            model = key[0]
            read = list(_read(parts.to_dict("records"), width, targets, models))
            bins, y, mark = (np.concatenate([r[k] for r in read]) for k in (1, 2, 3))
            y, margin = y[:, target_of[model]], np.full(len(bins), base[model])
            trees, gain = Trees(1, s.trees, s.depth), np.zeros((1, width))
            for tree in range(s.trees):
                seen, allowed = _drawn(mark, tree, s.rows, s.seed), columns_of(s, tree, model, width)
                some, residual = bins[seen], (y - margin)[seen]
                for level in range(s.depth):
                    node = trees.leaves(some, tree, level)[:, 0] - (2**level - 1)
                    total = level_sums(some, residual, node, 2**level, n_bins, floors[model])
                    if not _note(trees, gain, 0, tree, best_splits(total, 2**level, allowed, s)):
                        break
                margin += trees.value[0, tree][trees.leaves(bins, tree)[:, 0]]
            packed = [getattr(trees, name).tobytes() for name in ("feature", "bin", "value")]
            return pd.DataFrame([(model, *packed, gain.tobytes())], columns=["model", "feature", "bin", "value", "gain"])

        apart = state.withColumn("model", F.explode(F.sequence(F.lit(0), F.lit(models - 1)))).repartition(models, "model")
        for r in apart.groupBy("model").applyInPandas(grow, "model int, feature binary, bin binary, value binary, gain binary").collect():
            m = r["model"]
            for name in ("feature", "bin", "value"):
                table = getattr(self.trees, name)
                table[m] = np.frombuffer(r[name], table.dtype).reshape(table.shape[1:])
            self.gain[m] = np.frombuffer(r["gain"])

    def _floors(self) -> list[float | None]:
        return [float(f) if loss == ABSOLUTE else None for f, (_, loss) in zip(self.floor, self.pairs)]

    def _applied(self, state: DataFrame, first: int, last: int) -> DataFrame:
        width, targets, models = len(self.columns), len(self.targets), len(self.pairs)
        part = self._some(first, last)

        def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for r, bins, _, _, margin in _read(batch.to_pylist(), width, targets, models):
                    part.add(margin, bins, range(last - first))
                    yield pa.RecordBatch.from_pylist([{**r, "margin": margin.tobytes()}], batch.schema)

        return state.mapInArrow(apply, _BLOCK)

    def _some(self, first: int, last: int) -> Trees:
        """A copy of the trees from ``first`` up to ``last``, which is all a task needs."""
        out = Trees(0, 0, self.settings.depth)
        for name in ("feature", "bin", "value"):
            setattr(out, name, getattr(self.trees, name)[:, first:last].copy())
        return out

    def _grow(self, state: DataFrame, written: int, tree: int, level: int) -> bool:
        """Splits the nodes of one level of all models in one pass; whether any was split."""
        s, width, targets, models, n_bins = self.settings, len(self.columns), len(self.targets), len(self.pairs), self.bins
        part, since, floors = self._some(written, tree + 1), tree - written, self._floors()
        target_of = [self.targets.index(t) for t, _ in self.pairs]
        nodes = 2**level

        def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((models, 3, nodes * width * n_bins))
            for batch in batches:
                for _, bins, y, mark, margin in _read(batch.to_pylist(), width, targets, models):
                    part.add(margin, bins, range(since))
                    seen = _drawn(mark, tree, s.rows, s.seed)
                    bins = bins[seen]
                    node = part.leaves(bins, since, level) - (nodes - 1)
                    residual = (y[:, target_of] - margin)[seen]
                    for m in range(models):
                        total[m] += level_sums(bins, residual[:, m], node[:, m], nodes, n_bins, floors[m])
            held = [np.flatnonzero(total[m, 2]) for m in range(models)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(range(models), pa.int32()),
                    pa.array([at.astype(np.int32).tobytes() for at in held], pa.binary()),
                    pa.array([total[m][:, at].tobytes() for m, at in enumerate(held)], pa.binary()),
                ],
                names=["model", "at", "sums"],
            )

        def split(key: tuple, parts: pd.DataFrame) -> pd.DataFrame:
            total = np.zeros((3, nodes * width * n_bins))
            for at, values in zip(parts["at"], parts["sums"]):
                at = np.frombuffer(at, np.int32)
                total[:, at] += np.frombuffer(values).reshape(3, len(at))
            found = best_splits(total, nodes, columns_of(s, tree, key[0], width), s)
            return pd.DataFrame([(key[0], *f) for f in found], columns=["model", "node", "feature", "bin", "gain", "low", "high"])

        schema = "model int, node int, feature int, bin int, gain double, low double, high double"
        found = state.mapInArrow(sums, "model int, at binary, sums binary").groupBy("model").applyInPandas(split, schema).collect()
        by_model: dict[int, list[tuple]] = {}
        for r in found:  # at most one row per model and node
            by_model.setdefault(r["model"], []).append(tuple(r)[1:])
        return any([_note(self.trees, self.gain, m, tree, splits) for m, splits in by_model.items()])

    def keep(self, pairs: list[tuple[str, str]]) -> "Booster":
        """The same predictors with some of the models only."""
        at = [self.pairs.index(p) for p in pairs]
        out = Booster(self.columns, [t for t, _ in pairs], self.losses, self.settings, self.bins)
        out.pairs, out.edges = list(pairs), self.edges
        out.base, out.floor, out.gain = self.base[at], self.floor[at], self.gain[at]
        out.trees = Trees(0, 0, self.settings.depth)
        for name in ("feature", "bin", "value"):
            setattr(out.trees, name, getattr(self.trees, name)[at])
        return out

    def predict(self, df: DataFrame, column: str) -> DataFrame:
        """Adds an array with the prediction of every model, in the order of ``pairs``."""
        shared = df.sparkSession.sparkContext.broadcast((self.edges, self.base, self.trees))
        n_trees = self.trees.feature.shape[1]

        @F.pandas_udf("array<double>")
        def told(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            edges, base, trees = shared.value
            for x in batches:
                out = []
                for at in range(0, len(x), BLOCK):
                    bins = binned(np.stack(x.iloc[at : at + BLOCK].to_numpy()).astype(float), edges)
                    margin = np.tile(base, (len(bins), 1))
                    trees.add(margin, bins, range(n_trees))
                    out.extend(margin)
                yield pd.Series(out, dtype=object)

        return df.withColumn(column, told(F.array(*[F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(float("nan"))) for c in self.columns])))

    def importance(self, pair: tuple[str, str]) -> list[tuple[str, float]]:
        """Each predictor's share of the gain of all splits."""
        gain = self.gain[self.pairs.index(pair)]
        return [(c, float(g / gain.sum()) if gain.sum() > 0 else 0.0) for c, g in zip(self.columns, gain)]

    def tables(self, spark) -> dict[str, DataFrame]:
        """The fitted state as tables whose size the settings fix."""
        m, t, n = np.nonzero((self.trees.feature >= 0) | (self.trees.value != 0))
        nodes = pd.DataFrame(
            {"model": m, "tree": t, "node": n, "feature": self.trees.feature[m, t, n].astype(int), "bin": self.trees.bin[m, t, n].astype(int), "value": self.trees.value[m, t, n]}
        )
        models = [(i, t, loss, float(self.base[i]), self.gain[i].tolist()) for i, (t, loss) in enumerate(self.pairs)]
        edges = [(i, c, [float(v) for v in e]) for i, (c, e) in enumerate(zip(self.columns, self.edges))]
        return {
            "nodes": spark.createDataFrame(nodes, "model long, tree long, node long, feature long, bin long, value double"),
            "models": spark.createDataFrame(models, "model int, target string, loss string, base double, gain array<double>"),
            "columns": spark.createDataFrame(edges, "at int, name string, edges array<double>"),
            "settings": spark.createDataFrame([(k, float(v)) for k, v in {**dataclasses.asdict(self.settings), "bins": self.bins}.items()], "name string, value double"),
        }

    @staticmethod
    def of_tables(tables: dict[str, DataFrame]) -> "Booster":
        values = {r["name"]: r["value"] for r in tables["settings"].collect()}
        kinds = {f.name: type(f.default) for f in dataclasses.fields(Settings)}
        settings = Settings(**{k: kinds[k](values[k]) for k in kinds})
        columns = tables["columns"].orderBy("at").collect()
        models = tables["models"].orderBy("model").collect()
        out = Booster([r["name"] for r in columns], [r["target"] for r in models], [], settings, int(values["bins"]))
        out.pairs = [(r["target"], r["loss"]) for r in models]
        out.edges = [np.array(r["edges"]) for r in columns]
        out.base = np.array([r["base"] for r in models])
        out.gain = np.array([r["gain"] for r in models])
        out.trees = Trees(len(models), settings.trees, settings.depth)
        nodes = tables["nodes"].toPandas()
        at = (nodes["model"].to_numpy(), nodes["tree"].to_numpy(), nodes["node"].to_numpy())
        for name in ("feature", "bin", "value"):
            getattr(out.trees, name)[at] = nodes[name].to_numpy()
        return out

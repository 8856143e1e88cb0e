"""Exact nearest neighbours as an equi-join on cells of orthonormal projections.

A projection on orthonormal axes never lengthens a distance.  Points whose
projections lie in cells of width r that do not touch are therefore farther
apart than r, and the cells around a query hold every neighbour within r.  Rings of doubled width
serve the queries that the ring before left without ``k`` neighbours, so dense places are searched
in narrow cells and only what lies far out in wide ones.

A cell with many points is cut into chunks of bounded size, and its queries
are dealt over blocks; a task reads one chunk and streams one block past it.
Each task sends on the ``k`` smallest distances of a query.
"""

from __future__ import annotations

import functools
import itertools
import math
import operator
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpiloom.session import cut

AXES = 3
CHUNK = 32_768  # points of a cell that one task holds
BATCH = 256  # queries measured at once
FEW = 4_096  # so few queries are sent to all points instead
SAMPLE = 1_024  # points that suggest the first width
SALTS = 16


def principal_axes(points: DataFrame, width: int, column: str = "_x", axes: int = AXES, clip: float = 10.0) -> np.ndarray:
    """Orthonormal axes (``width`` x at most ``axes``) along which most points spread.

    Any orthonormal axes give the same neighbours; these divide the points
    best.  Values are clipped, so that a few far points do not turn the axes.
    """
    length = 1 + width + width * width

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(length)
        for batch in batches:
            if len(batch):
                x = np.clip(np.stack(batch["_x"].to_numpy()), -clip, clip)
                total += np.concatenate([[len(x)], x.sum(0), (x.T @ x).ravel()])
        yield pd.DataFrame({"at": np.arange(length), "v": total})

    rows = points.select(F.col(column).alias("_x")).mapInPandas(sums, "at int, v double").groupBy("at").agg(F.sum("v").alias("v")).collect()
    total = np.zeros(length)
    for r in rows:
        total[r["at"]] = r["v"]
    n = max(total[0], 1.0)
    mean = total[1 : 1 + width] / n
    spread = total[1 + width :].reshape(width, width) / n - np.outer(mean, mean)
    return np.linalg.eigh(spread)[1][:, ::-1][:, : min(axes, width)]


def projected(rows: DataFrame, axes: np.ndarray, column: str = "_x") -> DataFrame:
    """Adds ``_c``, the coordinates of a vector along the axes."""
    def along(weights: np.ndarray) -> Column:
        terms = F.zip_with(column, F.array(*[F.lit(float(w)) for w in weights]), lambda a, b: a * b)
        return F.aggregate(terms, F.lit(0.0), lambda s, v: s + v)

    return rows.withColumn("_c", F.array(*[along(axes[:, a]) for a in range(axes.shape[1])]))


def _smallest(x: np.ndarray, points: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` smallest distances of each row of ``x``, ascending.

    Candidates come from squared norms and a matrix product; their distances
    are then measured by differences, free of cancellation.
    """
    rough = (x * x).sum(1)[:, None] + (points * points).sum(1)[None, :] - 2.0 * x @ points.T
    some = min(k + 8, len(points))
    near = np.argpartition(rough, some - 1, axis=1)[:, :some] if some < len(points) else np.tile(np.arange(len(points)), (len(x), 1))
    exact = np.sqrt(((x[:, None, :] - points[near]) ** 2).sum(-1))
    exact.sort(axis=1)
    return exact[:, :k]


def _measured(queries: np.ndarray, points: np.ndarray, k: int) -> Iterator[tuple[slice, np.ndarray]]:
    for at in range(0, len(queries), BATCH):
        span = slice(at, at + BATCH)
        yield span, _smallest(queries[span], points, k)


def _merged(found: DataFrame, k: int) -> DataFrame:
    """One row per query: its ``k`` smallest distances, ascending."""
    lists = found.groupBy("_q").agg(F.slice(F.array_sort(F.flatten(F.collect_list("d"))), 1, k).alias("d"))
    return lists


def _against_all(queries: DataFrame, points: DataFrame, k: int, column: str) -> DataFrame:
    """The nearest points of at most ``FEW`` queries: every task measures its own points."""
    rows = queries.select("_q", F.col(column).alias("_x")).toPandas()
    if not len(rows):
        return queries.sparkSession.createDataFrame([], "_q long, d array<double>")
    shared = queries.sparkSession.sparkContext.broadcast((rows["_q"].to_numpy(), np.stack(rows["_x"].to_numpy())))

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids, x = shared.value
        best = np.zeros((len(x), 0))
        for batch in batches:
            if len(batch):
                mine = np.stack(batch["_x"].to_numpy())
                for span in (slice(a, a + CHUNK) for a in range(0, len(mine), CHUNK)):
                    found = np.concatenate([d for _, d in _measured(x, mine[span], k)])
                    best = np.sort(np.hstack([best, found]), axis=1)[:, :k]
        if best.shape[1]:
            yield pd.DataFrame({"_q": ids, "d": list(best)})

    return _merged(points.select(F.col(column).alias("_x")).mapInPandas(measure, "_q long, d array<double>"), k)


def _cell(radius: float, n: int) -> Column:
    return F.array(*[F.floor(F.get("_c", F.lit(a)) / radius) for a in range(n)])


def _around(radius: float, n: int) -> Column:
    """The cells that a ball of this radius around a row reaches."""
    sides = []
    for a in range(n):
        c = F.get("_c", F.lit(a))
        cell = F.floor(c / radius)
        below, above = c - cell * radius, (cell + 1) * radius - c
        sides.append([(cell - 1, below * below), (cell, F.lit(0.0)), (cell + 1, above * above)])
    reached = [
        F.struct(F.array(*[cell for cell, _ in one]).alias("cell"), functools.reduce(operator.add, [far for _, far in one]).alias("far"))
        for one in itertools.product(*sides)
    ]
    # rounding may push a far value just beyond the radius
    inside = F.filter(F.array(*reached), lambda x: x["far"] <= radius * radius * (1 + 1e-9))
    return F.transform(inside, lambda x: x["cell"])


def _ring(queries: DataFrame, points: DataFrame, k: int, radius: float, axes: int, column: str) -> DataFrame:
    """``_q, d``: up to ``k`` distances within the radius, for every query that has any."""
    chunk, few = CHUNK, k
    mine = points.select(_cell(radius, axes).alias("cell"), F.col(column).alias("_x"), F.monotonically_increasing_id().alias("nth"))
    sizes = mine.groupBy("cell").agg(F.ceil(F.count("*") / chunk).cast("int").alias("chunks"))
    # Queries of a crowded cell look up its size under a salt; the sizes are one row per cell.
    salted = sizes.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    blocks = F.greatest(F.lit(1), F.floor(F.col("chunks") / 2)).cast("int")
    asked = queries.select("_q", F.col(column).alias("_x"), F.explode(_around(radius, axes)).alias("cell"), F.pmod("_q", F.lit(SALTS)).cast("int").alias("salt"))
    asked = asked.join(salted, ["cell", "salt"]).withColumn("block", F.pmod(F.xxhash64("_q"), blocks).cast("int"))
    asked = asked.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    held = mine.withColumn("salt", F.pmod("nth", F.lit(SALTS)).cast("int")).join(salted, ["cell", "salt"])
    held = held.withColumn("chunk", F.pmod(F.xxhash64("nth"), F.col("chunks")).cast("int"))
    held = held.withColumn("block", F.explode(F.sequence(F.lit(0), blocks - 1)))
    place = ["cell", "chunk", "block"]
    both = held.select(*place, F.lit(-1).cast("long").alias("_q"), "_x").union(asked.select(*place, "_q", "_x"))

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, points_here = None, []
        for batch in batches:
            if not len(batch):
                continue
            keys = np.column_stack([np.stack(batch["cell"].to_numpy()), batch["chunk"], batch["block"]])
            ids, x = batch["_q"].to_numpy(), np.stack(batch["_x"].to_numpy())
            edges = np.flatnonzero(np.concatenate([[True], (keys[1:] != keys[:-1]).any(axis=1)]))
            for a, b in zip(edges, [*edges[1:], len(keys)]):
                key = tuple(keys[a])
                if key != now:
                    now, points_here = key, []
                split = a + int((ids[a:b] < 0).sum())  # points sort before queries
                if split > a:
                    points_here.append(x[a:split])
                if split < b and points_here:
                    points_here = [np.concatenate(points_here)]
                    out_ids, out = [], []
                    for span, found in _measured(x[split:b], points_here[0], few):
                        for q, d in zip(ids[split:b][span], found):
                            d = d[d <= radius]
                            if len(d):
                                out_ids.append(q)
                                out.append(d)
                    if out_ids:
                        yield pd.DataFrame({"_q": out_ids, "d": out})

    dealt = both.repartition(*place).sortWithinPartitions(*place, "_q")
    return _merged(dealt.mapInPandas(measure, "_q long, d array<double>"), k)


def first_width(points: DataFrame, k: int, n: int, column: str) -> float:
    """A guess at the usual distance of the ``k``-th neighbour, from a bounded sample; the result does not depend on it."""
    share = min(1.0, SAMPLE / max(n, 1))
    nth = F.shiftrightunsigned(F.xxhash64(F.col(column)), 11) / float(1 << 53)
    rows = points.where(nth < share).select(F.col(column).alias("_x")).limit(2 * SAMPLE).toPandas()
    if len(rows) < 2:
        return 1.0
    x = np.stack(rows["_x"].to_numpy())
    near = max(1, round(k * len(x) / max(n, 1)))
    kth = np.concatenate([d for _, d in _measured(x, x, near + 1)])[:, -1]
    usual = float(np.median(kth))
    return usual if usual > 0 else float(kth.max()) or 1.0


def nearest(
    queries: DataFrame,
    points: DataFrame,
    k: int,
    width: int,
    column: str = "_x",
    radius: float | None = None,
    within: float | None = None,
    share: float = 1.0,
    few: int | None = None,
) -> DataFrame:
    """``_q, d``: the ``k`` smallest distances from each query to the points, ascending (all, if there are fewer).

    ``queries`` has ``_q`` (a number that names the row, not negative) and a vector without nulls, ``points`` a
    vector.  Given ``within``, one ring finds the distances up to it, and queries without any
    are left out.  Otherwise rings widen from ``radius`` until at least ``share`` of the
    queries have their ``k`` neighbours; the others, whose ``k``-th neighbour is farther
    than anyone's here, are left out.  Both tables should be written ones, as they are read several times.
    Without points there are no rows.
    """
    spark, few = queries.sparkSession, FEW if few is None else few
    n, total = points.count(), queries.count()
    if not n or not total:
        return spark.createDataFrame([], "_q long, d array<double>")
    k = min(k, n)
    if total <= few:
        found = _against_all(queries, points, k, column)
        if within is None:
            return found
        near = found.select("_q", F.filter("d", lambda v: v <= within).alias("d"))
        return near.where(F.size("d") > 0)
    axes = principal_axes(points, width, column)
    count = axes.shape[1]
    points = cut(projected(points.select(column), axes, column))
    queries = cut(projected(queries.select("_q", column), axes, column))
    if within is not None:
        return cut(_ring(queries, points, k, within, count, column))
    radius = radius or first_width(points, k, n, column)
    needed = min(total, math.ceil(share * (total - 1)) + 1)
    done: DataFrame | None = None
    resolved = 0
    while resolved < needed:
        if total - resolved <= few and share >= 1.0:
            new = cut(_against_all(queries, points, k, column))
        else:
            new = cut(_ring(queries, points, k, radius, count, column).where(F.size("d") >= k))
        found = new.count()
        resolved += found
        done = new if done is None else done.union(new)
        if resolved < needed:
            queries = cut(queries.join(new.select("_q"), "_q", "left_anti")) if found else queries
            # Few found: these are far out, so widen faster.
            radius *= 2.0 if found > 0.05 * total or resolved > total / 2 else 4.0
    return done

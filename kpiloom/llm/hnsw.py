"""Embedding near-dedup: small-world graphs per shard, audited searches, verified cosines, components.

Vectors of one label are dealt into shards of bounded size.  Each shard gets a
hierarchical navigable small-world graph; every vector then searches every
shard of its label by a beam.  A shard's searches are audited against an exact
scan for part of the queries, and the beam is doubled until the audit passes; a
beam that is full of links is widened to the whole shard, which is an exact
scan in blocks.  All steps handle a block of queries at once in array form.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiloom.llm.common import components
from kpiloom.session import cut

THRESHOLD = 0.98
SHARD_ROWS = 4096
BLOCK_ROWS = 4096
DEGREE = 12  # links per node above the base layer, twice as many on it
BUILD_BEAM = 40
BEAM = 24
AUDIT_EVERY = 10  # vectors whose id is divisible by this audit the search
AUDIT_RECALL = 0.99
_AT_ONCE = 256
_EXPAND = 4


def beam_search(vectors: np.ndarray, links: np.ndarray, queries: np.ndarray, entry: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``beam`` best nodes met for each query, best first, and their similarities (-1 and -inf beyond the end)."""
    n_q = len(queries)
    rows = np.arange(n_q)[:, None]
    seen = np.zeros((n_q, len(vectors) + 1), bool)
    seen[:, -1] = True  # stands for "no neighbour"
    ids = np.full((n_q, beam), -1, np.int32)
    sims = np.full((n_q, beam), -np.inf, np.float32)
    done = np.ones((n_q, beam), bool)
    ids[:, 0] = entry
    sims[:, 0] = np.einsum("qd,qd->q", queries, vectors[entry])
    done[:, 0] = False
    seen[rows[:, 0], entry] = True
    while True:
        alive = np.flatnonzero(~done.all(axis=1))
        if not len(alive):
            return ids, sims
        at = rows[: len(alive)]
        open_sims = np.where(done[alive], -np.inf, sims[alive])
        width = min(_EXPAND, beam)
        pick = np.argpartition(-open_sims, width - 1, axis=1)[:, :width]
        nodes = np.where(np.isfinite(open_sims[at, pick]), ids[alive][at, pick], -1)
        done[alive[:, None], pick] = True
        near = links[nodes].reshape(len(alive), -1)
        near[np.repeat(nodes < 0, links.shape[1], axis=1)] = -1
        # Each new neighbour once: of equal ids in a row only the first counts.
        order = np.argsort(near, axis=1, kind="stable")
        ranked = near[at, order]
        twice = np.zeros_like(near, bool)
        twice[at, order] = np.concatenate([np.zeros((len(alive), 1), bool), ranked[:, 1:] == ranked[:, :-1]], axis=1)
        fresh = ~seen[alive[:, None], near] & ~twice
        seen[alive[:, None], near] = True
        found = np.einsum("qd,qkd->qk", queries[alive], vectors[near])
        found[~fresh] = -np.inf
        all_sims = np.concatenate([sims[alive], found], axis=1)
        all_ids = np.concatenate([ids[alive], near], axis=1)
        all_done = np.concatenate([done[alive], ~fresh], axis=1)
        best = np.argsort(-all_sims, axis=1, kind="stable")[:, :beam]
        sims[alive], ids[alive], done[alive] = all_sims[at, best], all_ids[at, best], all_done[at, best]


def diverse(vectors: np.ndarray, centre: np.ndarray, ids: np.ndarray, sims: np.ndarray, most: int) -> np.ndarray:
    """Up to ``most`` neighbours per row: nearest first, skipping those nearer to a chosen one than to the centre.

    Free places are then filled with the nearest skipped ones, so that a dense
    group stays connected.
    """
    order = np.argsort(-sims, axis=1, kind="stable")
    rows = np.arange(len(ids))[:, None]
    ids, sims = ids[rows, order], sims[rows, order]
    valid = np.isfinite(sims) & (ids >= 0) & (ids != centre[:, None])
    valid[:, 1:] &= ids[:, 1:] != ids[:, :-1]
    points = vectors[ids]
    between = np.einsum("qad,qbd->qab", points, points)
    chosen = np.zeros_like(valid)
    count = np.zeros(len(ids), int)
    for k in range(ids.shape[1]):
        crowded = (chosen & (between[:, k] > sims[:, k, None])).any(axis=1)
        take = valid[:, k] & ~crowded & (count < most)
        chosen[:, k] = take
        count += take
    rank = np.where(chosen, 0, np.where(valid, 1, 2)) * ids.shape[1] + np.arange(ids.shape[1])
    best = np.argsort(rank, axis=1)[:, :most]
    out = np.where(valid[rows, best], ids[rows, best], -1)
    if out.shape[1] < most:
        out = np.pad(out, ((0, 0), (0, most - out.shape[1])), constant_values=-1)
    return out.astype(np.int32)


class Graph:
    """Layers over prefixes of the nodes: layer k holds the first ``sizes[k]``, layer 0 all of them."""

    def __init__(self, vectors: np.ndarray, seed: int = 3, degree: int = DEGREE, beam: int = BUILD_BEAM) -> None:
        self.vectors = np.ascontiguousarray(vectors, np.float32)
        n = len(vectors)
        level = np.floor(-np.log(np.random.default_rng(seed).random(n)) / np.log(degree)).astype(int)
        self.sizes = [n, *[int(s) for k in range(1, level.max(initial=0) + 1) if (s := (level >= k).sum()) > 1]]
        self.layers: list[np.ndarray] = [np.zeros((0, 0), np.int32)] * len(self.sizes)
        for k in range(len(self.sizes) - 1, -1, -1):
            self._build(k, degree * (2 if k == 0 else 1), beam)

    def plain(self) -> dict:
        return {"sizes": self.sizes, "layers": self.layers}

    @classmethod
    def restored(cls, vectors: np.ndarray, sizes: list[int], layers: list[np.ndarray]) -> Graph:
        graph = cls.__new__(cls)
        graph.vectors, graph.sizes, graph.layers = np.ascontiguousarray(vectors, np.float32), sizes, layers
        return graph

    def entry(self, queries: np.ndarray, above: int) -> np.ndarray:
        """The node at which to start in layer ``above - 1``."""
        at = np.zeros(len(queries), np.int64)
        for k in range(len(self.sizes) - 1, above - 1, -1):
            at = beam_search(self.vectors, self.layers[k], queries, at, 4)[0][:, 0].astype(np.int64)
        return at

    def _build(self, k: int, most: int, beam: int) -> None:
        n, vectors = self.sizes[k], self.vectors
        links = np.full((n + 1, most), -1, np.int32)
        self.layers[k] = links
        at = 1
        while at < n:
            to = min(n, at + min(at, _AT_ONCE))
            new = np.arange(at, to)
            queries = vectors[new]
            start = np.minimum(self.entry(queries, k + 1), at - 1)
            ids, sims = beam_search(vectors, links, queries, start, min(beam, at))
            own = queries @ queries.T
            np.fill_diagonal(own, -np.inf)
            peers = np.argsort(-own, axis=1)[:, :most]
            ids = np.concatenate([ids, new[peers]], axis=1)
            sims = np.concatenate([sims, np.take_along_axis(own, peers, axis=1)], axis=1)
            links[new] = diverse(vectors, new, ids, sims, most)
            self._reverse(links, new, most)
            at = to

    def _reverse(self, links: np.ndarray, new: np.ndarray, most: int) -> None:
        """Links back to the new nodes, each list pruned to ``most``."""
        source = np.repeat(new, most)
        target = links[new].ravel()
        source, target = source[target >= 0], target[target >= 0]
        sims = np.einsum("ad,ad->a", self.vectors[source], self.vectors[target])
        order = np.lexsort((-sims, target))
        source, target = source[order], target[order]
        first = np.flatnonzero(np.concatenate([[True], target[1:] != target[:-1]]))
        rank = np.arange(len(target)) - np.repeat(first, np.diff(np.append(first, len(target))))
        source, target = source[rank < most], target[rank < most]
        nodes, row = np.unique(target, return_inverse=True)
        added = np.full((len(nodes), most), -1, np.int32)
        added[row, rank[rank < most]] = source
        for lo in range(0, len(nodes), _AT_ONCE):
            part = nodes[lo : lo + _AT_ONCE]
            ids = np.concatenate([links[part], added[lo : lo + _AT_ONCE]], axis=1)
            near = np.einsum("qd,qkd->qk", self.vectors[part], self.vectors[ids])
            near[ids < 0] = -np.inf
            links[part] = diverse(self.vectors, part, ids, near, most)

    def search(self, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        queries = np.ascontiguousarray(queries, np.float32)
        return beam_search(self.vectors, self.layers[0], queries, self.entry(queries, 1), beam)


def _normal(rows) -> np.ndarray:
    x = np.stack([np.asarray(v, np.float64) for v in rows])
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _packed(part: pd.DataFrame, **more) -> bytes:
    """Arrays alone, in a form that every Python worker reads without this module."""
    part = part.sort_values("node")
    vectors = _normal(part["vector"])
    return pickle.dumps({"node": part["node"].to_numpy(np.int64), "copies": part["copies"].to_numpy(np.int64), "vectors": vectors, **{k: f(vectors) for k, f in more.items()}})


def linked(queries: dict, shard: dict, threshold: float, beam: int = BEAM, audit_every: int = AUDIT_EVERY) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (query row, shard row) with cosine >= threshold, a bounded number of queries at a time."""
    exact, points = shard["vectors"], queries["vectors"]
    graph = Graph.restored(exact, **shard["graph"])
    audit = np.flatnonzero(queries["node"] % audit_every == 0)
    want = [np.flatnonzero(exact @ points[q] >= threshold) for q in audit]
    total = sum(map(len, want))
    width = beam
    while total and width < len(exact):
        found = 0
        for lo in range(0, len(audit), _AT_ONCE):
            ids, sims = graph.search(points[audit[lo : lo + _AT_ONCE]], width)
            for row, values, true in zip(ids, sims, want[lo : lo + _AT_ONCE]):
                full = values[-1] >= threshold - 1e-4  # such a beam is widened to the whole shard below
                found += len(true) if full else np.isin(true, row).sum()
        if found >= AUDIT_RECALL * total:
            break
        width *= 2
    for lo in range(0, len(points), _AT_ONCE):
        part = np.arange(lo, min(lo + _AT_ONCE, len(points)))
        if width >= len(exact):
            scan = part
        else:
            ids, sims = graph.search(points[part], width)
            full = sims[:, -1] >= threshold - 1e-4
            scan = part[full]
            q, k = np.nonzero((sims >= threshold - 1e-4) & ~full[:, None])
            rows = ids[q, k]
            sure = np.einsum("ad,ad->a", points[part[q]], exact[rows]) >= threshold
            yield part[q][sure], rows[sure]
        if len(scan):
            q, rows = np.nonzero(points[scan] @ exact.T >= threshold)
            yield scan[q], rows


def _spanning(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A star per component of the given links: no more rows than nodes."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[x], label[y])
        step = label.copy()
        np.minimum.at(step, x, low)
        np.minimum.at(step, y, low)
        step = step[step]
        if (step == label).all():
            break
        label = step
    own = label != np.arange(len(nodes))
    return nodes[own], nodes[label[own]]


def _search(threshold: float):
    """For every (block of queries, shard): links per query, and a spanning forest of the links."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for block, index in zip(batch["block"], batch["shard"]):
                queries, shard = pickle.loads(block), pickle.loads(index)
                count = np.zeros(len(queries["node"]), np.int64)
                for q, s in linked(queries, shard, threshold):
                    other = queries["node"][q] != shard["node"][s]
                    q, s = q[other], s[other]
                    np.add.at(count, q, shard["copies"][s])
                    if len(q):
                        node, root = _spanning(queries["node"][q], shard["node"][s])
                        yield pd.DataFrame({"node": node, "root": root, "links": 0})
                some = count > 0
                yield pd.DataFrame({"node": queries["node"][some], "root": queries["node"][some], "links": count[some]})

    return run


def near_duplicates(
    table: DataFrame,
    ident: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    threshold: float = THRESHOLD,
    shard_rows: int = SHARD_ROWS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """One row per vector: ``ident``, ``n_links``, ``component_id``, ``kept``.

    Vectors link within one non-null label and one dimension at cosine >=
    ``threshold`` in double precision.  Vectors that are null, zero, or hold a
    null or non-finite component link with nothing, nor do rows without an id
    (their component_id and kept are null).  Equal vectors are indexed once and
    counted as often as they occur; rows that repeat an id with another vector
    share its component.
    """
    rows = table.select(F.col(f"`{ident}`").cast("long").alias("id"), F.col(f"`{vector}`").alias("vector"), F.col(f"`{label}`").alias("label"))
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    usable = F.col("id").isNotNull() & F.col("label").isNotNull() & F.forall("vector", finite) & F.exists("vector", lambda x: x != 0)
    rows = rows.withColumn("usable", F.coalesce(usable, F.lit(False)))
    points = rows.where("usable").groupBy("label", "vector").agg(F.min("id").alias("node"), F.count("*").alias("copies"))
    points = cut(points.withColumn("dim", F.size("vector")))
    sizes = points.groupBy("label", "dim").agg(F.count("*").alias("n"))
    dealt = points.join(sizes, ["label", "dim"]).select(
        "label",
        "dim",
        "vector",
        "node",
        "copies",
        F.pmod(F.xxhash64("node"), F.ceil(F.col("n") / shard_rows)).alias("shard_no"),
        F.pmod(F.xxhash64("node", F.lit(1)), F.ceil(F.col("n") / block_rows)).alias("block_no"),
    )
    kind = table.schema[label].dataType.simpleString()

    def index(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"label": [key[0]], "dim": [key[1]], "shard_no": [key[2]], "shard": [_packed(part, graph=lambda x: Graph(x).plain())]})

    def block(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"label": [key[0]], "dim": [key[1]], "block_no": [key[2]], "block": [_packed(part)]})

    shards = cut(dealt.groupBy("label", "dim", "shard_no").applyInPandas(index, f"label {kind}, dim int, shard_no long, shard binary"))
    blocks = cut(dealt.groupBy("label", "dim", "block_no").applyInPandas(block, f"label {kind}, dim int, block_no long, block binary"))
    tasks = blocks.join(shards, ["label", "dim"]).repartition("label", "dim", "block_no", "shard_no")
    found = cut(tasks.select("block", "shard").mapInPandas(_search(threshold), "node long, root long, links long"))

    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    parts = components(found.where("node != root").select("node", "root"), "node", "root").select(F.col("node").alias("_node"), "component")
    reps = points.select("label", "vector", "node", "copies").join(counts, "node", "left").join(parts, F.col("node") == F.col("_node"), "left")
    reps = reps.select("label", "vector", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "node").alias("component_id"))
    known = rows.where("usable").join(reps, ["label", "vector"]).select("id", "n_links", "component_id")
    alone = rows.where("not usable").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    out = known.union(alone)
    return out.select(F.col("id").alias(ident), "n_links", "component_id", (F.col("id") == F.col("component_id")).alias("kept"))

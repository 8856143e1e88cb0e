"""Ranked lexical search by K2-treaps over the term-document grid.

Documents are dealt into shards of some thousand; a shard's postings are
written once.  For a search every shard becomes a square grid, rows its terms
from rare to common, columns its documents by id, cut into quadrants again and
again.  Only cells that hold a posting exist, as four bits in their parent, and
every cell knows the largest impact below it.

An item enters at the root with all its terms.  A document range is halved,
each term follows its row into that half, and the weighted maxima of the cells
reached bound every score in it.  Ranges are expanded best first, in waves that
serve all items together, until no range left can beat an item's tenth score;
at single documents the bound is the score.  All scores are 64-bit integers.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kpiloom.llm.common import word_blocks
from kpiloom.session import cut

TOP = 10
SHARD_DOCS = 4096
SHARD_BYTES = 8 << 20  # text of a shard, unless one document is longer
ITEM_BLOCK = 20_000  # items that one pass over the shards serves
PATHS = 8000  # term paths that descend together
WAVES = (32, 256, None)  # ranges of an item expanded per level and wave; the last wave takes all
SALTS = 32
NO_ID = np.iinfo(np.int64).max  # stands for a null id, after all others
# Everything but digits, letters and bytes beyond ASCII separates; A-Z become a-z.
_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))
_ONES = np.array([bin(x).count("1") for x in range(16)], np.int64)


def terms_of(raw: bytes) -> Iterator[list[bytes]]:
    """The terms of a text in lists from about a megabyte each."""
    return word_blocks(raw.translate(_TABLE), 0)


class _Shard:
    """Documents and their term counts, while a shard is filled."""

    def __init__(self) -> None:
        self.ids: list[int] = []
        self.size = 0
        self.terms: dict[bytes, int] = {}
        self.keys: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []
        self._words: list[bytes] = []
        self._docs: list[int] = []
        self._lengths: list[int] = []

    def add(self, ident: int | None, raw: bytes) -> None:
        for words in terms_of(raw):
            self._words += words
            self._docs.append(len(self.ids))
            self._lengths.append(len(words))
            if len(self._words) > 1 << 19:
                self._count()
        self.ids.append(NO_ID if ident is None else ident)
        self.size += len(raw)

    def _count(self) -> None:
        if not self._words:
            return
        words = pa.array(self._words, pa.binary()).dictionary_encode()
        number = np.array([self.terms.setdefault(w, len(self.terms)) for w in words.dictionary.to_pylist()], np.int64)
        docs = np.repeat(np.array(self._docs, np.int64), self._lengths)
        keys, counts = np.unique(number[words.indices.to_numpy()] << 32 | docs, return_counts=True)
        self.keys.append(keys)
        self.counts.append(counts)
        self._words, self._docs, self._lengths = [], [], []

    def row(self) -> dict:
        self._count()
        ids = np.array(self.ids, np.int64)
        order = np.argsort(ids, kind="stable")
        place = np.empty(len(ids), np.int64)
        place[order] = np.arange(len(ids))
        key = np.concatenate([np.zeros(0, np.int64), *self.keys])
        term, doc = key >> 32, place[key & 0xFFFFFFFF]
        tf = np.concatenate([np.zeros(0, np.int64), *self.counts])
        # a document counted in several lists has several rows of one term
        pair, back = np.unique(term * len(ids) + doc, return_inverse=True) if len(key) else (key, key)
        tf = np.bincount(back, tf, len(pair)).astype(np.int64) if len(key) else tf
        term, doc = (pair // len(ids), pair % len(ids)) if len(key) else (key, key)
        lengths = np.bincount(doc, tf, len(ids)).astype(np.int64)
        df = np.bincount(term, minlength=len(self.terms))
        # rows from rare to common: rare rows leave most cells empty
        rows = np.argsort(df, kind="stable")
        at = np.empty(len(rows), np.int64)
        at[rows] = np.arange(len(rows))
        names = pa.array(list(self.terms), pa.binary()).take(pa.array(rows))
        return {
            "n": int((lengths > 0).sum()),
            "words": int(lengths.sum()),
            "terms": names.to_pylist(),
            "df": df[rows].tolist(),
            "ids": _packed(ids[order]),
            "lengths": _packed(lengths),
            "rows": _packed(at[term].astype(np.int32)),
            "docs": _packed(doc.astype(np.int32)),
            "tfs": _packed(tf.astype(np.int32)),
        }


def _packed(x: np.ndarray) -> bytes:
    return zstandard.compress(x.tobytes(), 1)


def _read(blob: bytes, kind: type) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(blob), kind)


_SHARD = "n long, words long, terms array<binary>, df array<int>, ids binary, lengths binary, rows binary, docs binary, tfs binary"
_SHARD_ARROW = pa.schema(
    [("n", pa.int64()), ("words", pa.int64()), ("terms", pa.list_(pa.binary())), ("df", pa.list_(pa.int32()))]
    + [(c, pa.binary()) for c in ("ids", "lengths", "rows", "docs", "tfs")]
)


def index(docs: DataFrame, ident: str = "doc_id", text: str = "text", shard_docs: int = SHARD_DOCS, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """The postings of all documents, one row per shard, written to the shared folder.

    Null, empty and termless texts are documents without postings; a null id
    sorts after all others; rows that repeat are documents of their own.
    """

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = _Shard()
        for batch in batches:
            for doc, body in zip(batch.column(0).to_pylist(), batch.column(1)):
                shard.add(doc, body.as_buffer().to_pybytes() if body.is_valid else b"")
                if len(shard.ids) >= shard_docs or shard.size >= shard_bytes:
                    yield pa.RecordBatch.from_pylist([shard.row()], _SHARD_ARROW)
                    shard = _Shard()
        if shard.ids:
            yield pa.RecordBatch.from_pylist([shard.row()], _SHARD_ARROW)

    rows = docs.select(F.col(f"`{ident}`").cast("long").alias("doc"), F.col(f"`{text}`").cast("binary").alias("text"))
    return cut(rows.mapInArrow(build, _SHARD))


class Treap:
    """The quadrant tree of one shard; ``masks[l]``, ``first[l]``, ``most[l]`` describe the cells of level ``l`` in Morton order."""

    def __init__(self, rows: np.ndarray, cols: np.ndarray, impacts: np.ndarray, side: int) -> None:
        self.levels = max(1, (max(side, 2) - 1).bit_length())
        code = np.zeros(len(rows), np.int64)
        for bit in range(self.levels):
            code |= ((cols >> bit) & 1) << (2 * bit) | ((rows >> bit) & 1) << (2 * bit + 1)
        order = np.argsort(code)
        code, most = code[order], impacts[order]
        self.masks: list[np.ndarray] = []
        self.first: list[np.ndarray] = []
        self.most = [most]
        for _ in range(self.levels):
            up = code >> 2
            starts = np.flatnonzero(np.concatenate([[True], up[1:] != up[:-1]]))
            self.masks.append(np.bitwise_or.reduceat(np.left_shift(1, code & 3), starts).astype(np.uint8))
            self.first.append(starts.astype(np.int64))
            most = np.maximum.reduceat(most, starts)
            self.most.append(most)
            code = up[starts]
        for level in (self.masks, self.first, self.most):
            level.reverse()

    def children(self, level: int, node: np.ndarray, quadrant: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether each cell has the quadrant, and that quadrant's cell on the next level."""
        mask = self.masks[level][node]
        before = mask & ((1 << quadrant) - 1).astype(np.uint8)
        return (mask >> quadrant.astype(np.uint8)) & 1 == 1, self.first[level][node] + _ONES[before]


class Ranges:
    """Document ranges of one level: ``item``, ``col``, ``bound``, and the cells of the terms that go on there."""

    def __init__(self, item, col, bound, count, path, node) -> None:
        self.item, self.col, self.bound, self.count, self.path, self.node = item, col, bound, count, path, node

    def where(self, keep: np.ndarray) -> "Ranges":
        wide = np.repeat(keep, self.count)
        return Ranges(self.item[keep], self.col[keep], self.bound[keep], self.count[keep], self.path[wide], self.node[wide])

    @staticmethod
    def joined(parts: list["Ranges"]) -> "Ranges":
        return Ranges(*[np.concatenate([getattr(p, name) for p in parts]) for name in ("item", "col", "bound", "count", "path", "node")])


def _halves(treap: Treap, level: int, ranges: Ranges, row: np.ndarray, weight: np.ndarray) -> Ranges:
    """Both halves of every range, without those that hold no posting of the item."""
    out = []
    bit = (row[ranges.path] >> (treap.levels - 1 - level)) & 1
    starts = np.cumsum(ranges.count) - ranges.count
    for half in (0, 1):
        has, child = treap.children(level, ranges.node, bit * 2 + half)
        child = np.where(has, child, 0)
        worth = np.where(has, weight[ranges.path] * treap.most[level + 1][child], 0)
        bound = np.add.reduceat(worth, starts)
        count = np.add.reduceat(has.astype(np.int64), starts)
        stay = count > 0
        out.append(Ranges(ranges.item[stay], ranges.col[stay] * 2 + half, bound[stay], count[stay], ranges.path[has], child[has]))
    return Ranges.joined(out)


class Best:
    """The best documents of every item so far: score descending, then id."""

    def __init__(self, items: int, top: int) -> None:
        self.top = top
        self.item, self.score, self.ident = (np.zeros(0, np.int64) for _ in range(3))
        self.floor, self.floor_id = np.zeros(items, np.int64), np.full(items, -1, np.int64)

    def add(self, item: np.ndarray, score: np.ndarray, ident: np.ndarray) -> None:
        item, score, ident = (np.concatenate(x) for x in ((self.item, item), (self.score, score), (self.ident, ident)))
        order = np.lexsort((ident, -score, item))
        item, score, ident = item[order], score[order], ident[order]
        starts = np.flatnonzero(np.concatenate([[True], item[1:] != item[:-1]])) if len(item) else np.zeros(0, np.int64)
        rank = np.arange(len(item)) - np.repeat(starts, np.diff(starts, append=len(item)))
        last = rank == self.top - 1
        self.floor[item[last]], self.floor_id[item[last]] = score[last], ident[last]
        stay = rank < self.top
        self.item, self.score, self.ident = item[stay], score[stay], ident[stay]

    def open(self, item: np.ndarray, bound: np.ndarray, first_id: np.ndarray) -> np.ndarray:
        """Ranges that may still hold one of the best: above the last of them, or equal with a lower id."""
        floor = self.floor[item]
        return (bound > floor) | ((bound == floor) & (floor > 0) & (first_id <= self.floor_id[item]))


def search_shard(treap: Treap, ids: np.ndarray, item: np.ndarray, row: np.ndarray, weight: np.ndarray, best: Best, waves: tuple = WAVES) -> None:
    """Adds a shard's documents to the best; ``item``, ``row``, ``weight`` describe the items' terms, in item order."""
    names, count = np.unique(item, return_counts=True)
    root = Ranges(names, np.zeros(len(names), np.int64), np.full(len(names), np.iinfo(np.int64).max), count, np.arange(len(item)), np.zeros(len(item), np.int64))
    waiting: list[list[Ranges]] = [[root], *[[] for _ in range(treap.levels)]]
    for wave in waves:
        for level in range(treap.levels):
            if not waiting[level]:
                continue
            ranges = Ranges.joined(waiting[level])
            waiting[level] = []
            first = ids[np.minimum(ranges.col << (treap.levels - level), len(ids) - 1)]
            ranges = ranges.where(best.open(ranges.item, ranges.bound, first))
            if wave and len(ranges.item):
                order = np.lexsort((ranges.col, -ranges.bound, ranges.item))
                sorted_items = ranges.item[order]
                starts = np.flatnonzero(np.concatenate([[True], sorted_items[1:] != sorted_items[:-1]]))
                rank = np.empty(len(order), np.int64)
                rank[order] = np.arange(len(order)) - np.repeat(starts, np.diff(starts, append=len(order)))
                if (rank >= wave).any():
                    waiting[level] = [ranges.where(rank >= wave)]
                    ranges = ranges.where(rank < wave)
            if len(ranges.item):
                waiting[level + 1].append(_halves(treap, level, ranges, row, weight))
        if waiting[treap.levels]:
            found = Ranges.joined(waiting[treap.levels])
            waiting[treap.levels] = []
            best.add(found.item, found.bound, ids[found.col])


def _queries(block: list, total: int, dfs: dict[bytes, int], terms: list[list[bytes]]) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray]:
    """Distinct terms of the items with their weights, and the pairs (item, term) in item order."""
    names = sorted({t for one in terms for t in one if dfs.get(t)})
    at = {t: k for k, t in enumerate(names)}
    weights = np.array([math.floor(1000 * math.log((2 * total + 2) / (2 * dfs[t] + 1))) for t in names], np.int64)
    pairs = [(k, at[t]) for k, one in enumerate(terms) for t in one if t in at]
    both = np.array(pairs, np.int64).reshape(-1, 2)
    return names, weights, both[:, 0], both[:, 1]


def search(
    shards: DataFrame,
    items: DataFrame,
    item_ident: str = "item_id",
    item_text: str = "text",
    ident: str = "doc_id",
    top: int = TOP,
    item_block: int = ITEM_BLOCK,
    waves: tuple = WAVES,
) -> DataFrame:
    """The ``top`` documents of every item: ``item_ident, rank, ident, score``, from an ``index``.

    Items are served in blocks of ``item_block``, one pass over the shards each.
    An item without terms, or whose terms no document holds with a positive
    weight, has no rows.  Rows of ``items`` that repeat repeat their results.
    Empty items or documents give no rows.
    """
    spark = shards.sparkSession
    total, words = shards.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("words"), F.lit(0))).first()
    kind = items.schema[item_ident].dataType
    chosen = items.select(F.col(f"`{item_ident}`").alias("item"), F.col(f"`{item_text}`").cast("binary").alias("text"))
    out = []
    rows = chosen.toLocalIterator()
    while block := list(itertools.islice(rows, item_block)):
        out.append(_search_block(shards, block, total, words, top, waves))
    schema = f"item {kind.simpleString()}, rank int, doc long, score long"
    if not out:
        return spark.createDataFrame([], schema).toDF(item_ident, "rank", ident, "score")
    found = out[0]
    for more in out[1:]:
        found = found.union(more)
    return found.select(F.col("item").cast(kind).alias(item_ident), "rank", F.col("doc").alias(ident), "score")


def _search_block(shards: DataFrame, block: list, total: int, words: int, top: int, waves: tuple) -> DataFrame:
    spark = shards.sparkSession
    terms = [list(dict.fromkeys(w for words_ in terms_of(bytes(r["text"] or b"")) for w in words_)) for r in block]
    wanted = spark.sparkContext.broadcast(sorted({t for one in terms for t in one}))

    def local_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ask = pa.array(wanted.value, pa.binary())
        df = np.zeros(len(ask), np.int64)
        for batch in batches:
            for names, counts in zip(batch.column(0), batch.column(1)):
                at = pc.index_in(ask, value_set=names.values)
                has = at.is_valid().to_numpy(zero_copy_only=False)
                df[has] += counts.values.to_numpy()[at.drop_null().to_numpy()]
        held = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(df[held])], names=["term", "df"])

    per = shards.select("terms", "df").mapInArrow(local_counts, "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))
    dfs = {wanted.value[r["term"]]: r["df"] for r in per.collect()}  # one row per term of the items at most
    query = spark.sparkContext.broadcast(_queries(block, total, dfs, terms))
    n_items = len(block)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, weights, item, term = query.value
        asked = pa.array(names, pa.binary())
        best = Best(n_items, top)
        for batch in batches:
            for r in range(batch.num_rows):
                get = {name: batch.column(k)[r] for k, name in enumerate(batch.schema.names)}
                held = pc.index_in(asked, value_set=get["terms"].values) if len(asked) else None
                blobs = {c: _read(get[c].as_py(), np.int32) for c in ("rows", "docs", "tfs")}
                if held is None or held.null_count == len(held) or not len(blobs["rows"]):
                    continue
                ids = _read(get["ids"].as_py(), np.int64)
                norm = np.array([10 + 90 * n * total // words for n in _read(get["lengths"].as_py(), np.int64).tolist()], np.int64)
                tf = blobs["tfs"].astype(np.int64)
                impacts = 1_000_000_000 * tf // (1000 * tf + 8 * norm[blobs["docs"]])
                treap = Treap(blobs["rows"].astype(np.int64), blobs["docs"].astype(np.int64), impacts, max(len(get["terms"].values), len(ids)))
                row = held.fill_null(-1).to_numpy().astype(np.int64)[term]
                use = (row >= 0) & (weights[term] > 0)
                its, path_rows, path_weights = item[use], row[use], weights[term[use]]
                # whole items, about PATHS terms at a time
                edges = np.flatnonzero(np.concatenate([[True], its[1:] != its[:-1]])) if len(its) else np.zeros(0, np.int64)
                at = 0
                while at < len(its):
                    later = edges[edges >= at + PATHS]
                    end = int(later[0]) if len(later) else len(its)
                    search_shard(treap, ids, its[at:end], path_rows[at:end], path_weights[at:end], best, waves)
                    at = end
        ident = pa.array(best.ident, mask=best.ident == NO_ID)
        yield pa.RecordBatch.from_arrays([pa.array(best.item), ident, pa.array(best.score)], names=["number", "doc", "score"])

    found = shards.select("terms", "ids", "lengths", "rows", "docs", "tfs").mapInArrow(run, "number long, doc long, score long")
    order = [F.desc("score"), F.col("doc").asc_nulls_last()]
    some = Window.partitionBy("number", F.spark_partition_id() % SALTS).orderBy(*order)
    near = found.withColumn("rank", F.row_number().over(some)).where(F.col("rank") <= top)
    best = near.withColumn("rank", F.row_number().over(Window.partitionBy("number").orderBy(*order))).where(F.col("rank") <= top)
    named = spark.createDataFrame([(k, None if r["item"] is None else str(r["item"])) for k, r in enumerate(block)], "number long, item string")
    return best.join(named, "number").select("item", F.col("rank").cast("int").alias("rank"), "doc", "score")

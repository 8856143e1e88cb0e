"""Suffix-array dedup by bucket-pointer refinement: bytes in strings of 400 that start more than once.

Bucket-pointer refinement sorts suffixes by their first q bytes into buckets
and refines a bucket by the bucket identifiers of later offsets, reusing refined
identifiers recursively.  Here an identifier is a hash, so that a bucket has the
same name in every task and nothing needs to be ranked globally:

* depth q: the q-gram at a position; depth 2q: the identifiers at p and p + q;
* depth 400: the depth-2q identifiers at p and p + 400 - 2q.

A corpus has too many suffixes to shuffle, so buckets are opened where needed:

1. Each 400-byte window names the position of its least q-gram, its anchor
   (leftmost on ties).  Equal windows have equal anchors, about one per 140
   bytes.  Anchors in buckets of one are finished: their windows occur once.
2. The other anchors are refined to the string that holds all windows up to the
   next anchor.  If that occurs again, all its windows repeat.
3. What is left are windows near the ends of repeated passages.  Their bytes
   go to their anchor's bucket once, with one example of each string of step 2,
   and are refined to depth 400 there.  In a crowded bucket windows are first told
   apart by how far ahead of the anchor they start, in classes; all windows of a class
   share a stretch of some 300 bytes around the anchor, whose hash refines the bucket.  What is
   still too large is split by the depth-400 identifiers instead of being gathered.

Texts that occur more than once take part once; all their windows repeat.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiloom.llm.common import with_text
from kpiloom.session import cut

LENGTH = 400
CROWDED = 256  # anchors of a bucket beyond which it is refined by classes
HOT = 4096  # windows' stretches of a refined bucket beyond which it is split by window
CLASSES = 5  # of the distances between a window's start and its anchor

_PLACE = 20
_CHUNK = 1 << (_PLACE - 1)
_LOW = np.uint64((1 << _PLACE) - 1)
_BASE = 0xD6E8FEB86659FD93
_FOLD = np.uint64(0xA24BAED4963EE407)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    return np.cumprod(np.full(n, base, np.uint64))


class Refiner:
    """Bucket identifiers of one stretch of bytes."""

    _byte = _mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    _up: np.ndarray | None = None
    _down: np.ndarray | None = None

    def __init__(self, length: int = LENGTH) -> None:
        self.length = length
        self.q = max(1, length * 8 // 25)  # 128 of 400
        self.width = length - self.q + 1  # q-grams in a window

    def grams(self, data: np.ndarray) -> np.ndarray:
        """Identifiers of depth q at every position that has one."""
        n, q = len(data), self.q
        if n < q:
            return np.zeros(0, np.uint64)
        if Refiner._up is None or len(Refiner._up) < n:
            room = max(n, _CHUNK + 4 * self.length)
            Refiner._up, Refiner._down = _powers(_BASE, room), _powers(pow(_BASE, -1, 1 << 64), room)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(self._byte[data] * self._up[:n], out=sums[1:])
        return _mixed((sums[q:] - sums[:-q]) * self._down[: n - q + 1])

    def doubled(self, grams: np.ndarray) -> np.ndarray:
        """Identifiers of depth 2q, from those of depth q at p and p + q."""
        return _mixed(grams[: -self.q] * _FOLD + grams[self.q :]) if len(grams) > self.q else np.zeros(0, np.uint64)

    def windows(self, double: np.ndarray) -> np.ndarray:
        """Identifiers of depth ``length``, from those of depth 2q at p and p + length - 2q."""
        later = self.length - 2 * self.q
        return _mixed(double[: len(double) - later] * _FOLD + double[later:]) if len(double) > later else np.zeros(0, np.uint64)

    def strings(self, double: np.ndarray, at: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """Identifiers of longer strings, up to 6q, from three of depth 2q that cover them."""
        two = 2 * self.q
        parts = double[at] * _FOLD + double[at + np.minimum(two, depth - two)]
        return _mixed(_mixed(parts) * _FOLD + double[at + depth - two] + depth.astype(np.uint64))

    def anchors(self, grams: np.ndarray) -> np.ndarray:
        """The anchor of every window: the leftmost least q-gram (by its upper bits)."""
        low = (grams & ~_LOW) | np.arange(len(grams), dtype=np.uint64)
        n, size = len(grams) - self.width + 1, 1
        if n <= 0:
            return np.zeros(0, np.int64)
        while size * 2 <= self.width:
            low = np.minimum(low[:-size], low[size:])
            size *= 2
        return (np.minimum(low[:n], low[self.width - size : self.width - size + n]) & _LOW).astype(np.int64)

    def chunks(self, raw: bytes) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """``(start, bytes, grams, anchors of the windows that start in the chunk)`` with bounded arrays."""
        n_windows = len(raw) - self.length + 1
        for start in range(0, max(n_windows, 0), _CHUNK):
            data = np.frombuffer(raw, np.uint8, min(_CHUNK + 3 * self.length, len(raw) - start), start)
            grams = self.grams(data)
            held = min(_CHUNK, n_windows - start)
            yield start, data, grams, self.anchors(grams[: held + self.width - 1])

    def listing(self, raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Anchors of a text: position, bucket of depth q, and the string up to the next anchor with its length.

        Anchors without a string have length 0; those on the seam of two chunks
        may be listed twice and are merged.
        """
        found = [np.zeros((0, 4), np.int64)]
        for start, data, grams, anchors in self.chunks(raw):
            at = np.unique(anchors)
            double = self.doubled(grams)
            depth = np.append(np.diff(at), 0) - 1 + self.length
            fits = (depth >= self.length) & (at + depth <= len(data)) & (depth <= 6 * self.q)
            depth = np.where(fits, depth, 0)
            ids = np.zeros(len(at), np.uint64)
            ids[fits] = self.strings(double, at[fits], depth[fits])
            found.append(np.column_stack([start + at, grams[at].view(np.int64), ids.view(np.int64), depth]))
        rows = np.concatenate(found)
        rows = rows[np.lexsort((-rows[:, 3], rows[:, 0]))]
        rows = rows[np.concatenate([[True], rows[1:, 0] != rows[:-1, 0]])] if len(rows) else rows
        return rows[:, 0], rows[:, 1], rows[:, 2], rows[:, 3]


def _runs(flags: np.ndarray) -> list[tuple[int, int]]:
    """Half-open runs of set flags."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return list(zip(edge[::2].tolist(), edge[1::2].tolist()))


def _repeated(ids: np.ndarray) -> np.ndarray:
    values, at, n = np.unique(ids, return_inverse=True, return_counts=True)
    return n[at] > 1


def _list_anchors(length: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        refiner = Refiner(length)
        for batch in batches:
            rows = [refiner.listing(raw) for raw in batch["raw"]]
            out = batch[["k1", "k2", "doc"]].copy()
            for k, name in enumerate(("pos", "bucket", "string", "depth")):
                out[name] = [r[k] for r in rows]
            yield out

    return run


def _open_windows(length: int):
    """The bytes of the windows still open, one row per anchor."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        refiner = Refiner(length)
        step = -(-refiner.width // CLASSES)
        for batch in batches:
            rows, held = [], 0
            for k1, k2, raw, known in zip(batch["k1"], batch["k2"], batch["raw"], batch["known"]):
                pos = np.array([a["pos"] for a in known], np.int64)
                order = np.argsort(pos)
                pos = pos[order]
                covered = np.array([a["covered"] for a in known], np.int64)[order]
                example = np.array([a["example"] for a in known], bool)[order]
                crowded = np.array([a["crowded"] for a in known], bool)[order]
                for start, _, grams, anchors in refiner.chunks(raw):
                    at = np.minimum(np.searchsorted(pos, start + anchors), len(pos) - 1)
                    shared = pos[at] == start + anchors
                    change = np.zeros(len(anchors) + 1, np.int64)  # windows inside repeated strings
                    lo = np.clip(pos - start, 0, len(anchors))
                    hi = np.clip(pos - start + np.maximum(covered - length + 1, 0), 0, len(anchors))
                    np.add.at(change, lo, 1)
                    np.add.at(change, hi, -1)
                    inside = np.cumsum(change[:-1]) > 0
                    kept = np.zeros(len(anchors) + 1, np.int64)  # those of the one string kept as an example
                    np.add.at(kept, lo[example], 1)
                    np.add.at(kept, hi[example], -1)
                    wanted = shared & (~inside | (np.cumsum(kept[:-1]) > 0))
                    crowd = crowded[at] & wanted
                    ahead = anchors - np.arange(len(anchors))  # from the window's start to its anchor
                    group = np.where(wanted, np.where(crowd, at * CLASSES + ahead // step, at * CLASSES), -1)
                    edge = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1], [True]]))
                    for a, b in zip(edge[:-1].tolist(), edge[1:].tolist()):
                        if group[a] >= 0:
                            piece = raw[start + a : start + b - 1 + length]
                            bucket = int(grams[anchors[a]].view(np.int64))
                            if crowd[a]:
                                # Every window of the class holds this stretch, so equal windows agree in it.
                                first = int(ahead[a]) // step * step
                                shared_at = start + int(anchors[a]) - first
                                shared_bytes = raw[shared_at : shared_at + length - step + 1]
                                bucket = xxhash.xxh64_intdigest(shared_bytes, (bucket + first) & 0xFFFFFFFF) - (1 << 63)
                            rows.append((bucket, k1, k2, start + a, bool(crowd[a]), piece))
                            held += len(piece)
                    if held > 4 << 20:
                        yield pd.DataFrame(rows, columns=["bucket", "k1", "k2", "pos", "crowded", "piece"])
                        rows, held = [], 0
            if rows:
                yield pd.DataFrame(rows, columns=["bucket", "k1", "k2", "pos", "crowded", "piece"])

    return run


def _window_ids(refiner: Refiner, pieces) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Depth-``length`` identifiers of all pieces, with the piece and the offset of each."""
    data = np.frombuffer(b"".join(pieces), np.uint8)
    ids = refiner.windows(refiner.doubled(refiner.grams(data)))
    size = np.array([len(p) for p in pieces], np.int64)
    n = size - refiner.length + 1
    piece = np.repeat(np.arange(len(size)), n)
    offset = np.arange(len(piece)) - np.repeat(np.cumsum(n) - n, n)
    return ids[np.repeat(np.cumsum(size) - size, n) + offset], piece, offset


def _refine_buckets(length: int):
    """Spans of repeated windows in buckets that lie whole in a partition, sorted by bucket."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        refiner = Refiner(length)

        def spans(part: pd.DataFrame) -> pd.DataFrame:
            out = []
            buckets = part["bucket"].to_numpy()
            edge = np.append(np.flatnonzero(np.concatenate([[True], buckets[1:] != buckets[:-1]])), len(part))
            at = 0
            while at < len(edge) - 1:  # whole buckets, some thousand pieces at a time
                to = max(at + 1, int(np.searchsorted(edge, edge[at] + 1000, "right")) - 1)
                rows = part.iloc[edge[at] : edge[to]]
                ids, piece, offset = _window_ids(refiner, rows["piece"].tolist())
                again = _repeated(ids)
                for p in np.unique(piece[again]).tolist():
                    flags = again[slice(*np.searchsorted(piece, [p, p + 1]))]
                    row = rows.iloc[p]
                    out += [(row["k1"], row["k2"], row["pos"] + a, row["pos"] + b - 1 + length) for a, b in _runs(flags)]
                at = to
            return pd.DataFrame(out, columns=["k1", "k2", "lo", "hi"])

        rest = None
        for batch in batches:
            batch = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
            last = batch["bucket"].to_numpy() == batch["bucket"].iloc[-1]  # may go on in the next batch
            rest = batch[last]
            if not last.all():
                yield spans(batch[~last])
        if rest is not None and len(rest):
            yield spans(rest)

    return run


def _hot_windows(length: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        refiner = Refiner(length)
        for batch in batches:
            for at in range(0, len(batch), 500):
                part = batch.iloc[at : at + 500]
                ids, piece, offset = _window_ids(refiner, part["piece"].tolist())
                yield pd.DataFrame(
                    {
                        "window": ids.view(np.int64),
                        "k1": part["k1"].to_numpy()[piece],
                        "k2": part["k2"].to_numpy()[piece],
                        "lo": part["pos"].to_numpy()[piece] + offset,
                    }
                )

    return run


def repeated_spans(docs: DataFrame, text: str, ident: str, length: int = LENGTH, hot: int = HOT, crowded: int = CROWDED) -> DataFrame:
    """Byte spans ``(k1, k2, lo, hi)`` covered by repeated windows, by the 128-bit hash of the text."""
    raw = _keyed(docs, ident, text)
    schema = "k1 long, k2 long, doc long, pos array<long>, bucket array<long>, string array<long>, depth array<long>"
    listed = cut(raw.where(F.length("raw") >= length).select("k1", "k2", "doc", "raw").mapInPandas(_list_anchors(length), schema))
    copies = listed.groupBy("k1", "k2").agg(F.count("*").alias("copies"), F.min("doc").alias("first"))
    each = listed.dropDuplicates(["k1", "k2"]).select("k1", "k2", F.explode(F.arrays_zip("pos", "bucket", "string", "depth")).alias("a"))
    each = each.select("k1", "k2", "a.*")
    # Written first: joined as a table of its own, a very large bucket can be split by Spark.
    many = cut(each.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1"))
    shared = cut(each.join(many, "bucket"))
    strings = shared.where("depth > 0").groupBy("string", "depth").agg(F.count("*").alias("times"), F.min(F.struct("k1", "k2", "pos")).alias("example"))
    refined = shared.join(cut(strings.where("times > 1")), ["string", "depth"], "left")
    known = refined.select(
        "k1",
        "k2",
        F.struct(
            "pos",
            F.when(F.col("times") > 1, F.col("depth")).otherwise(0).alias("covered"),
            F.coalesce(F.struct("k1", "k2", "pos") == F.col("example"), F.lit(False)).alias("example"),
            (F.col("n") > crowded).alias("crowded"),
        ).alias("a"),
    )
    # A document's own anchors: as many as its length allows.
    known = cut(known.groupBy("k1", "k2").agg(F.collect_list("a").alias("known")).join(copies, ["k1", "k2"]))
    once = known.select("k1", "k2", "known", "first")
    texts = raw.join(once, ["k1", "k2"]).where(F.col("doc").eqNullSafe(F.col("first")))
    opened = cut(texts.select("k1", "k2", "raw", "known").mapInPandas(_open_windows(length), "bucket long, k1 long, k2 long, pos long, crowded boolean, piece binary"))

    spans = "k1 long, k2 long, lo long, hi long"
    large = cut(opened.where("crowded").groupBy("bucket").agg(F.count("*").alias("n")).where(F.col("n") > hot).select("bucket"))
    cold = opened.join(large, "bucket", "left_anti").repartition("bucket").sortWithinPartitions("bucket")
    near = cold.select("bucket", "k1", "k2", "pos", "piece").mapInPandas(_refine_buckets(length), spans)
    windows = opened.join(large, "bucket", "left_semi").select("k1", "k2", "pos", "piece").mapInPandas(_hot_windows(length), "window long, k1 long, k2 long, lo long")
    again = cut(windows.groupBy("window").agg(F.count("*").alias("n")).where("n > 1").select("window"))
    far = windows.join(again, "window").select("k1", "k2", "lo", (F.col("lo") + length).alias("hi"))
    inner = known.select("k1", "k2", F.explode("known").alias("a")).where("a.covered > 0")
    inner = inner.select("k1", "k2", F.col("a.pos").alias("lo"), (F.col("a.pos") + F.col("a.covered")).alias("hi"))
    whole = copies.where("copies > 1").select("k1", "k2", F.lit(0).cast("long").alias("lo"), F.lit((1 << 62)).alias("hi"))
    return near.union(far).union(inner).union(whole)


def _keyed(docs: DataFrame, ident: str, text: str) -> DataFrame:
    """Texts as bytes with two independent 64-bit hashes; null is empty."""
    kept = with_text(docs, ident, text)
    body = F.coalesce(F.col(text), F.lit(""))
    return kept.select(F.col(ident).cast("long").alias("doc"), F.xxhash64(body).alias("k1"), F.xxhash64(F.lit(1), body).alias("k2"), body.cast("binary").alias("raw"))


def merged(spans, size: int) -> list[tuple[int, int]]:
    """Disjoint ascending runs of the bytes in any span; spans that touch are one run."""
    out: list[list[int]] = []
    for lo, hi in sorted(spans):
        hi = min(hi, size)
        if out and lo <= out[-1][1]:
            out[-1][1] = max(out[-1][1], hi)
        else:
            out.append([lo, hi])
    return [(a, b) for a, b in out]


def _removed(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
    for raws, lists in batches:
        out = []
        for raw, spans in zip(raws, lists):
            runs = merged([(s["lo"], s["hi"]) for s in (spans if spans is not None else ())], len(raw))
            digest, at = hashlib.sha256(), 0
            for lo, hi in runs:
                digest.update(raw[at:lo])
                at = hi
            digest.update(raw[at:])
            out.append((sum(b - a for a, b in runs), len(runs), digest.hexdigest()))
        yield pd.DataFrame(out, columns=["n_removed", "n_spans", "kept_sha256"])


def remove_repeats(docs: DataFrame, ident: str = "doc_id", text: str = "text", length: int = LENGTH, hot: int = HOT, crowded: int = CROWDED) -> DataFrame:
    """One row per document: ``ident``, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256``.

    Every byte in a ``length``-byte string that starts anywhere else too is
    removed.  Null texts are empty, shorter texts keep everything, repeated
    rows are copies of each other.  Other columns are not read, whatever their
    names; an empty table gives no rows.
    """
    spans = repeated_spans(docs, text, ident, length, hot, crowded)
    spans = spans.groupBy("k1", "k2").agg(F.collect_set(F.struct("lo", "hi")).alias("spans"))
    raw = _keyed(docs, ident, text).withColumn("n_bytes", F.length("raw").cast("long"))
    joined = raw.join(spans, ["k1", "k2"], "left").select("doc", "n_bytes", F.pandas_udf(_removed, "n_removed long, n_spans long, kept_sha256 string")("raw", "spans").alias("r"))
    return joined.select(F.col("doc").alias(ident), "n_bytes", "r.n_removed", "r.n_spans", "r.kept_sha256")

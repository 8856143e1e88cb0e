"""Phrase collocations by mergeable Misra-Gries summaries.

First pass: phrases of one to three words are hashed with their language; the
hash names a partition and, within it, a 32-bit key.  Every task counts its own
phrases and sends each partition a packed summary.  A partition merges the
summaries under a capacity of its mass divided by the threshold, so what it
subtracts in all stays below the threshold and every frequent phrase survives.

Second pass: the phrases themselves are counted wherever their key survived.
A filter of fixed size stands for the survivors; what it lets through beyond
them is counted exactly too and fails the threshold.  Counts, cuts, containment and ranks
then are joins and aggregates over the frequent phrases alone.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kpiloom.llm.common import word_blocks
from kpiloom.session import cut

LEAST = 10  # a phrase's occurrences
LONGEST = 3  # words of a phrase
MOST = 2000  # phrases returned of a language
COVERED = 50  # percent of a phrase's occurrences that a longer one must hold to replace it
CHUNK = 4 << 20  # bytes of text counted at once; a task needs some forty times as much memory
PART_MASS = 8 << 20  # occurrences of phrases in one hash partition, on average at most
FAN = 1024  # hash partitions that one exchange deals to
FILTER_BITS = 1 << 27
SALTS = 16
_BREAK = b"A"  # lower-cased texts hold no capital, so this can stand between pieces
_TABLE = bytes(0x0A if c in b".,;:!?\n\x0b\x0c\r" else c + 32 if 65 <= c <= 90 else c for c in range(256))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


class Chunk:
    """Words of several texts in a row, with the hashes of all phrases that end in a word not seen before."""

    def __init__(self, langs: list[str], lists: list[list[bytes]], seen: list[int]) -> None:
        lengths = np.array([len(w) for w in lists])
        flat = list(itertools.chain.from_iterable(lists))
        lists.clear()
        words = pa.array(flat, pa.binary()).dictionary_encode()
        del flat
        self.ids = words.indices.to_numpy()
        self.words = words.dictionary
        vocabulary = self.words.to_pylist()
        self.names = sorted(set(langs))
        code = {name: k for k, name in enumerate(self.names)}
        self.lang = np.repeat(np.array([code[x] for x in langs], np.int32), lengths)
        plain = np.array([w != _BREAK for w in vocabulary], bool)[self.ids]
        starts = np.cumsum(lengths) - lengths
        new = np.arange(len(self.ids)) - np.repeat(starts, lengths) >= np.repeat(np.array(seen), lengths)
        hashes = np.array([xxhash.xxh64_intdigest(w) for w in vocabulary], np.uint64)[self.ids]
        salts = np.array([xxhash.xxh64_intdigest(name.encode(), 1) for name in self.names], np.uint64)[self.lang]
        self.counted = plain & new
        # first[n-1], keys[n-1]: where phrases of n words start, and their hashes
        self.first, self.keys = [], []
        inside = np.arange(len(self.ids)) - np.repeat(starts, lengths)
        key, whole = salts, np.ones(len(self.ids), bool)
        for n in range(1, LONGEST + 1):
            # a phrase is kept by its last word
            if n == 1:
                key, whole = _mixed(salts ^ hashes), plain
            else:
                key = np.concatenate([key[:1], _mixed(key[:-1] + hashes[1:])])
                whole = plain & np.concatenate([[False], whole[:-1]])
            last = np.flatnonzero(whole & new & (inside >= n - 1))
            self.first.append(last - (n - 1))
            self.keys.append(key[last])


def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[Chunk]:
    """Chunks of about ``CHUNK`` bytes; a longer text is cut between words, sharing two with the next chunk."""
    langs, lists, seen, size = [], [], [], 0
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            raw = text.as_buffer().to_pybytes() if text.is_valid else b""
            if not raw:
                continue
            marked = raw.translate(_TABLE).replace(b"\n", b" A ")
            for k, words in enumerate(word_blocks(marked, LONGEST - 1, CHUNK)):
                if not words:
                    continue
                langs.append(lang)
                lists.append(words)
                seen.append(min(LONGEST - 1, len(words)) if k else 0)
                size += min(len(marked), CHUNK)
                if size >= CHUNK:
                    yield Chunk(langs, lists, seen)
                    langs, lists, seen, size = [], [], [], 0
    if lists:
        yield Chunk(langs, lists, seen)


def pack(keys: np.ndarray, counts: np.ndarray) -> bytes:
    """Ascending keys as packed differences, byte by byte, then the counts."""
    gaps = np.diff(keys.astype("<u8"), prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8)
    width = 8 if (gaps[:, 4:] != 0).any() else 4
    many = np.minimum(counts, 255).astype(np.uint8)
    large = counts[counts >= 255].astype("<i8")
    head = np.array([len(keys), width], "<i8").tobytes()
    return zstandard.compress(head + np.ascontiguousarray(gaps[:, :width].T).tobytes() + many.tobytes() + large.tobytes(), 1)


def unpack(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    raw = zstandard.decompress(blob)
    n, width = (int(x) for x in np.frombuffer(raw, "<i8", 2))
    gaps = np.ascontiguousarray(np.frombuffer(raw, np.uint8, width * n, 16).reshape(width, n).T).view(f"<u{width}").reshape(-1)
    at = 16 + width * n
    counts = np.frombuffer(raw, np.uint8, n, at).astype(np.int64)
    counts[counts == 255] = np.frombuffer(raw, "<i8", -1, at + n)
    return np.cumsum(gaps, dtype=np.uint64), counts


def merged(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Sums the counts of equal keys."""
    key, count = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(key, kind="stable")
    key, count = key[order], count[order]
    starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    return key[starts], np.add.reduceat(count, starts) if len(key) else count


class Summary:
    """A Misra-Gries summary: at most ``capacity`` counters, each too low by at most ``error``."""

    def __init__(self, capacity: int) -> None:
        self.capacity, self.error = max(1, capacity), 0
        self.keys, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self._keys: list[np.ndarray] = []
        self._counts: list[np.ndarray] = []
        self._waiting = 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self._keys.append(keys)
        self._counts.append(counts)
        self._waiting += len(keys)
        if self._waiting > self.capacity + (1 << 16):
            self.settle()

    def settle(self) -> None:
        if self._waiting:
            self.keys, self.counts = merged([self.keys, *self._keys], [self.counts, *self._counts])
            self._keys, self._counts, self._waiting = [], [], 0
        if len(self.keys) > self.capacity:
            at = len(self.counts) - self.capacity - 1
            less = int(np.partition(self.counts, at)[at])
            stay = self.counts > less
            self.keys, self.counts, self.error = self.keys[stay], self.counts[stay] - less, self.error + less

    def frequent(self, least: int) -> np.ndarray:
        """All keys whose true count may reach ``least``."""
        self.settle()
        return self.keys[self.counts + self.error >= least]


def _dealt(keys: np.ndarray, counts: np.ndarray, shift: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Ascending keys by their bits above ``shift``: these bits, and the rows of each."""
    part = keys >> np.uint64(shift) if shift < 64 else np.zeros(len(keys), np.uint64)
    starts = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]])) if len(keys) else []
    for a, b in zip(starts, [*starts[1:], len(keys)]):
        yield int(part[a]), keys[a:b], counts[a:b]


def _short(keys: np.ndarray, bits: int) -> np.ndarray:
    """The partition's bits and 32 more of each hash."""
    low = keys & np.uint64(0xFFFFFFFF)
    return (keys >> np.uint64(64 - bits)) << np.uint64(32) | low if bits else low


_SUMMARY = "part long, mass long, summary binary"


def _summaries(rows: Iterator[tuple[int, np.ndarray, np.ndarray]], keep: int) -> pa.RecordBatch:
    """One packed summary per partition; keys keep their lowest ``keep`` bits."""
    mask = np.uint64((1 << keep) - 1)
    made = [{"part": p, "mass": int(c.sum()), "summary": pack(k & mask, c)} for p, k, c in rows]
    return pa.RecordBatch.from_pylist(made, _arrow(_SUMMARY))


def survivors(texts: DataFrame, bits: int, least: int, fan: int = FAN) -> DataFrame:
    """Per hash partition the part of the filter that holds its survivors: ``part, bits, n``.

    There are ``2**bits`` partitions, reached by one exchange, or by a second one
    inside the partitions of the first where they are more than ``fan``.
    """
    segment = max(64, FILTER_BITS >> bits)
    first = min(bits, fan.bit_length() - 1)
    rest = bits - first

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks(batches):
            keys = np.sort(_short(np.concatenate(chunk.keys), bits))
            starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
            yield _summaries(_dealt(keys[starts], np.diff(starts, append=len(keys)), 32 + rest), 32 + rest)

    def deal_again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def out() -> pa.RecordBatch:
            keys, counts = merged([k for k, _ in held], [c for _, c in held])
            return _summaries(_dealt(keys, counts, 32), 32)

        size = 0
        for batch in batches:
            for part, blob in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                keys, counts = unpack(blob)
                held.append((keys | np.uint64(part << (32 + rest)), counts))
                size += len(keys)
                if size > CHUNK:
                    yield out()
                    held, size = [], 0
        if held:
            yield out()

    def merge(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        summary = Summary(int(rows["mass"].sum()) // least)
        for blob in rows["summary"]:
            summary.add(*unpack(blob))
        found = summary.frequent(least)
        return pd.DataFrame({"part": [key[0]], "bits": [_marks(found, segment).tobytes()], "n": [len(found)]})

    summaries = texts.mapInArrow(count, _SUMMARY)
    if rest:
        summaries = summaries.repartition("part").mapInArrow(deal_again, _SUMMARY)
    return summaries.groupBy("part").applyInPandas(merge, "part long, bits binary, n long")


def _arrow(schema: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "binary": pa.binary(), "string": pa.string(), "int": pa.int32()}
    return pa.schema([(name, kinds[kind]) for name, kind in (f.split() for f in schema.split(", "))])


def _slots(low: np.ndarray, segment: int) -> tuple[np.ndarray, np.ndarray]:
    """The two places of a key in its part of the filter."""
    x = _mixed(low.astype(np.uint64) + np.uint64(1))
    return (x % np.uint64(segment)).astype(np.int64), ((x >> np.uint64(32)) % np.uint64(segment)).astype(np.int64)


def _marks(low: np.ndarray, segment: int) -> np.ndarray:
    table = np.zeros(segment, bool)
    for at in _slots(low, segment):
        table[at] = True
    return np.packbits(table)


def _held(keys: np.ndarray, table: np.ndarray, bits: int, segment: int) -> np.ndarray:
    """Whether the filter holds each 64-bit key."""
    part = (keys >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(keys), np.int64)
    out = np.ones(len(keys), bool)
    for at in _slots(keys & np.uint64(0xFFFFFFFF), segment):
        at = part * segment + at
        out &= (table[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1
    return out


_COUNTED = "lang string, phrase string, words int, a long"


def frequent_phrases(
    docs: DataFrame, lang: str = "lang", text: str = "text", least: int = LEAST, part_mass: int = PART_MASS, fan: int = FAN
) -> DataFrame:
    """Exact counts: ``lang, phrase, words, a`` for every phrase with ``a >= least``; ``words = 0`` and no phrase: all words of a language."""
    spark = docs.sparkSession
    texts = docs.select(F.coalesce(F.col(f"`{lang}`"), F.lit("und")).alias("lang"), F.col(f"`{text}`").cast("binary").alias("text"))
    # A word takes two bytes with what follows it, so this bounds the mass; two more bytes per row for the last word.
    size = texts.agg(F.sum(F.octet_length("text") + 2)).first()[0] or 0
    mass = LONGEST * size // 2
    bits = (mass // part_mass).bit_length()
    segment = max(64, FILTER_BITS >> bits)
    table = np.zeros((segment << bits) // 8, np.uint8)
    # The filter has a fixed size whatever the input: FILTER_BITS / 8 bytes on the driver and in every task.
    for r in survivors(texts, bits, least, fan).collect():
        table[r["part"] * segment // 8 : (r["part"] + 1) * segment // 8] = np.frombuffer(r["bits"], np.uint8)
    shared = spark.sparkContext.broadcast(table)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = _arrow(_COUNTED)
        for chunk in chunks(batches):
            names = pa.array(chunk.names, pa.string())
            per = np.bincount(chunk.lang[chunk.counted], minlength=len(chunk.names))
            none = pa.nulls(len(names), pa.string())
            yield pa.RecordBatch.from_arrays([names, none, pa.array(np.zeros(len(names), np.int32)), pa.array(per.astype(np.int64))], schema=schema)
            for n in range(1, LONGEST + 1):
                keys, first = chunk.keys[n - 1], chunk.first[n - 1]
                held = _held(keys, shared.value, bits, segment)
                keys, first = keys[held], first[held]
                _, where_, counts = np.unique(keys, return_index=True, return_counts=True)
                first = first[where_]
                for at in range(0, len(first), 1 << 16):
                    here = first[at : at + (1 << 16)]
                    parts = [chunk.words.take(pa.array(chunk.ids[here + k])) for k in range(n)]
                    phrase = pc.binary_join_element_wise(*parts, b" ") if n > 1 else parts[0]
                    yield pa.RecordBatch.from_arrays(
                        [
                            names.take(pa.array(chunk.lang[here])),
                            phrase.cast(pa.string()),
                            pa.array(np.full(len(here), n, np.int32)),
                            pa.array(counts[at : at + (1 << 16)].astype(np.int64)),
                        ],
                        schema=schema,
                    )

    counted = texts.mapInArrow(count, _COUNTED).groupBy("lang", "phrase", "words").agg(F.sum("a").alias("a"))
    return cut(counted.where((F.col("a") >= least) | (F.col("words") == 0)))


def collocations(
    docs: DataFrame,
    lang: str = "lang",
    text: str = "text",
    least: int = LEAST,
    covered: int = COVERED,
    most: int = MOST,
    part_mass: int = PART_MASS,
    fan: int = FAN,
) -> DataFrame:
    """The strongest phrases of two or three words of each language: ``lang, rank, phrase, a, l, r, n, score``.

    ``a``, ``l``, ``r`` count the phrase and the two parts of its weakest cut,
    ``n`` all words of the language.  Equal scores are ordered by ``a``, then by the
    phrase's UTF-8 bytes.  Null languages count as ``und``; null and empty texts
    hold no words; repeated rows count each; other columns are not read.  An empty
    table, or one without a phrase that occurs ``least`` times, gives no rows.
    """
    counted = frequent_phrases(docs, lang, text, least, part_mass, fan)
    totals = counted.where("words = 0").select("lang", F.col("a").alias("n"))
    phrases = counted.where(f"words between 2 and {LONGEST}").withColumn("w", F.split("phrase", " "))

    # One row per cut.  A part of a frequent phrase is frequent, so its count is there.
    cuts = phrases.select("*", F.explode(F.expr("sequence(1, words - 1)")).alias("k"))
    joined = lambda first, n: F.array_join(F.slice("w", first, n), " ")
    cuts = cuts.select(
        "lang", "phrase", "words", "a", "k",
        joined(F.lit(1), F.col("k")).alias("head"),
        joined(F.col("k") + 1, F.col("words") - F.col("k")).alias("tail"),
        F.pmod(F.xxhash64("phrase"), F.lit(SALTS)).cast("int").alias("salt"),
    )
    # A common word heads very many phrases: single words are joined under a salt, with one copy of each per salt.
    sides = counted.where(f"words between 1 and {LONGEST - 1}")
    salts = F.when(F.col("words") == 1, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(-1)))
    sides = sides.select(F.col("lang").alias("_lang"), F.col("phrase").alias("_part"), F.explode(salts).alias("_salt"), F.col("a").alias("_a"))
    for part, name in (("head", "l"), ("tail", "r")):
        salt = F.when(F.instr(part, " ") == 0, F.col("salt")).otherwise(F.lit(-1))
        met = (F.col("lang") == F.col("_lang")) & (F.col(part) == F.col("_part")) & (salt == F.col("_salt"))
        cuts = cuts.join(sides, met).withColumnRenamed("_a", name).drop("_lang", "_part", "_salt")
    wide = lambda c: F.col(c).cast("decimal(19,0)")
    cuts = cuts.withColumn("num", wide("a") * wide("a") * F.lit(1_000_000).cast("decimal(7,0)")).withColumn("den", wide("l") * wide("r"))
    cuts = cuts.withColumn("score", F.expr("num div den"))
    weakest = F.min(F.struct("score", "k", "l", "r")).alias("cut")
    scored = cuts.groupBy("lang", "phrase", "words", "a").agg(weakest).select("lang", "phrase", "words", "a", "cut.l", "cut.r", "cut.score")

    # Phrases inside a longer candidate that holds half of their occurrences go, whether or not that one stays.
    longer = phrases.where("words > 2").select("lang", "a", "words", "w")
    inner = longer.select("lang", "a", "w", "words", F.explode(F.expr("sequence(2, words - 1)")).alias("size"))
    inner = inner.select("lang", "a", "w", "size", F.explode(F.expr("sequence(1, words - size + 1)")).alias("at"))
    inner = inner.groupBy("lang", joined(F.col("at"), F.col("size")).alias("phrase")).agg(F.max("a").alias("held"))
    kept = scored.join(inner, ["lang", "phrase"], "left").where(F.coalesce(100 * F.col("held") < covered * F.col("a"), F.lit(True)))

    # First per salt, then per language, so that a language's phrases are never ordered in one task.
    best = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    some = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(SALTS * 4))).orderBy(*best)
    near = kept.withColumn("rank", F.row_number().over(some)).where(F.col("rank") <= most)
    ranked = near.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best))).where(F.col("rank") <= most)
    out = ranked.join(totals, "lang")
    return out.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")

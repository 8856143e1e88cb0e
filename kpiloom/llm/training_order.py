"""Token ids in training order: a keyed permutation gives every sequence its slot in fixed-stride shards.

Documents are tokenised and cut into sequences of ``length`` tokens, the last
one padded.  Sequences are numbered by document id, text and part, whatever
the splits of the input.  Sequence number ``i`` of ``N`` goes to slot ``P(i)``, where P is a
Feistel network on the smallest even-width domain that holds N, walked along
its cycle until it falls below N.  P is a bijection of 0..N-1 that needs no
table and no shuffle of numbers; the same key gives the same order.

The result's partitions have exact bounds: a partition holds whole shards, a
shard the slots from ``shard * per_shard`` on, in order, every record of
``stride`` bytes.  Writing the result writes the shards, one file each, so nothing is stored
twice; with ``path`` the operator writes them itself.  ``write_shards`` makes
flat files, where slot s begins at byte ``(s % per_shard) * stride``.
"""

from __future__ import annotations

import array
import base64
import os
from collections.abc import Iterator

import numpy as np
import pandas as pd
import tiktoken
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiloom.llm.common import with_text
from kpiloom.session import cut

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
END = 50256  # free id of that vocabulary: marks the end of a document and pads its last record
LENGTH = 512
PER_SHARD = 8192
MOST_PARTITIONS = 20_000  # beyond so many shards, a partition holds several
ROUNDS = 6
CACHE_ENTRIES = 300_000
# Fixed value: the pattern that belongs to the vocabulary file.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


class Encoder:
    """Token ids as packed unsigned integers, with a bounded cache of words.

    The pattern always separates before a single space that follows a
    non-space, so a text without double spaces encodes word by word.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str, code: str) -> None:
        self.encoding = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.code = code
        self.words: dict[str, bytes] = {}

    def _word(self, word: str) -> bytes:
        packed = array.array(self.code, self.encoding.encode_ordinary(word)).tobytes()
        if len(self.words) < CACHE_ENTRIES and len(word) < 40:
            self.words[word] = packed
        return packed

    def encode(self, text: str) -> bytes:
        if "  " in text:
            return array.array(self.code, self.encoding.encode_ordinary(text)).tobytes()
        get, make = self.words.get, self._word
        head, *rest = text.split(" ")
        return b"".join([get(w) or make(w) for w in [head, *[" " + w for w in rest]] if w])


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


def _ranges(docs: DataFrame, ident: str) -> tuple[np.ndarray, int]:
    """Ascending ids between which documents are dealt, and the number of ranges; a frequent id may bound several."""
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    probs = F.array(*[F.lit(k / n) for k in range(1, n)]) if n > 1 else F.array(F.lit(0.5))
    found = docs.agg(F.percentile_approx(F.col(f"`{ident}`").cast("long"), probs, F.lit(max(10_000, 10 * n)))).first()[0]
    return np.array(found if n > 1 and found else [], np.int64), n


def sequences(docs: DataFrame, ident: str, text: str, tokenizer: str, end: int, length: int) -> tuple[DataFrame, list[tuple[int, int]]]:
    """One row per sequence, written in the order of document id (null last), text and part; and the rows of each range.

    Columns: document, part, tokens (compressed), range and place in it.  An id
    that fills several ranges is dealt over them by its texts' hashes, as are null ids, so order
    and balance both hold.
    """
    ranks = load_ranks(tokenizer)
    code = "H" if max(end, max(ranks.values())) < 1 << 16 else "I"
    shared = docs.sparkSession.sparkContext.broadcast(ranks)
    width = array.array(code).itemsize
    mark = array.array(code, [end]).tobytes()
    bounds, n = _ranges(docs, ident)

    def cut_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = Encoder(shared.value, PATTERN, code)
        packer = zstandard.ZstdCompressor(level=1)
        row, rows, size = TaskContext.get().partitionId() << 33, [], 0
        for batch in batches:
            ids = batch["doc"].to_numpy(dtype=object, na_value=None)
            share = ((batch["key"].to_numpy(np.int64) >> 11) + (1 << 52)) / float(1 << 53)
            for doc, key, along, body in zip(ids, batch["key"], share, batch["text"]):
                if doc is None:
                    at = n + int(along * n)
                else:
                    low, high = (int(np.searchsorted(bounds, doc, side)) for side in ("left", "right"))
                    at = low + int(along * (high - low + 1)) if high > low else low
                data = (encoder.encode(body) if body else b"") + mark
                for k in range(-(-len(data) // (length * width))):
                    piece = data[k * length * width : (k + 1) * length * width]
                    rows.append((doc, key, row, k, at, len(piece) // width, packer.compress(piece)))
                row += 1
                size += len(data)
                if size > 8 << 20:
                    yield _rows(rows)
                    rows, size = [], 0
        if rows:
            yield _rows(rows)

    rows = with_text(docs, ident, text).select(F.col(ident).cast("long").alias("doc"), F.xxhash64(text).alias("key"), F.col(text).alias("text"))
    schema = "doc long, key long, row long, part int, at int, n_tokens int, tokens binary"
    dealt = rows.mapInPandas(cut_up, schema).repartitionById(2 * n, "at")
    ordered = dealt.sortWithinPartitions(F.col("doc").asc_nulls_last(), "key", "row", "part")
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    table = cut(ordered.select("doc", "part", "n_tokens", "tokens", "at", place.alias("place")))
    per = table.groupBy("at").agg(F.count("*").alias("n")).collect()  # one row per range
    return table, sorted((r["at"], r["n"]) for r in per)


def _rows(rows: list[tuple]) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=["doc", "key", "row", "part", "at", "n_tokens", "tokens"])
    out["doc"] = pd.array(out["doc"].tolist(), dtype="Int64") if out["doc"].notna().any() else pd.array([None] * len(out), dtype="Int64")
    return out


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def permute(index: np.ndarray, total: int, key: int) -> np.ndarray:
    """The slots of sequence numbers below ``total``."""
    half = max(1, -(-max(total - 1, 1).bit_length() // 2))
    low = np.uint64((1 << half) - 1)
    shift = np.uint64(half)
    keys = _mixed(np.arange(1, ROUNDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(key))

    def once(x: np.ndarray) -> np.ndarray:
        left, right = x >> shift, x & low
        for k in keys:
            left, right = right, left ^ (_mixed(right ^ k) & low)
        return (left << shift) | right

    out = once(index.astype(np.uint64))
    while (outside := out >= total).any():
        out[outside] = once(out[outside])
    return out.astype(np.int64)


def training_order(
    docs: DataFrame,
    ident: str = "doc_id",
    text: str = "text",
    tokenizer: str = TOKENIZER,
    end: int = END,
    length: int = LENGTH,
    per_shard: int = PER_SHARD,
    key: int = 20240,
    path: str | None = None,
) -> DataFrame:
    """One record per sequence; a partition holds whole shards, ordered by slot.

    Columns: ``slot``, ``shard``, ``shard_byte`` (offset of the record in its shard), ``ident``,
    ``part`` (number of the sequence in its document), ``n_tokens``, ``tokens``
    (``length`` little-endian ids, padded with ``end``).  Every document ends
    with ``end``; null and empty texts consist of it alone.  Repeated rows
    repeat their sequences; null ids come last in the numbering.  The order depends on the rows and the key alone.
    Other columns are not read.  An empty table gives no record.  With ``path`` the
    shards are written there, one folder per shard, and read back.
    """
    table, per = sequences(docs, ident, text, tokenizer, end, length)
    total = sum(n for _, n in per)
    ahead = np.cumsum([0, *[n for _, n in per]])
    offsets = docs.sparkSession.createDataFrame([(at, int(a)) for (at, _), a in zip(per, ahead)], "at int, ahead long")
    shards = max(1, -(-total // per_shard))
    each = -(-shards // MOST_PARTITIONS)  # shards of a partition
    unit = 2 if max(end, 0) < 1 << 16 else 4
    stride = length * unit
    fill = end.to_bytes(unit, "little") * length

    @F.pandas_udf("long")
    def slot_of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for index in batches:
            yield pd.Series(permute(index.to_numpy(), total, key))

    @F.pandas_udf("binary")
    def unpacked(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        opener = zstandard.ZstdDecompressor()
        for batch in batches:
            yield pd.Series([(opener.decompress(x) + fill)[:stride] for x in batch], dtype=object)

    placed = table.join(F.broadcast(offsets), "at").withColumn("slot", slot_of(F.col("ahead") + F.col("place")))
    placed = placed.withColumn("shard", F.floor(F.col("slot") / per_shard).cast("long"))
    # The partition is the shard itself, not a sampled range.
    dealt = placed.select("slot", "shard", "doc", "part", "n_tokens", "tokens").repartitionById(-(-shards // each), F.floor(F.col("shard") / each).cast("int"))
    records = dealt.sortWithinPartitions("shard", "slot").select("slot", "doc", "part", "n_tokens", unpacked("tokens").alias("tokens"), "shard")
    if path is not None:
        records.write.partitionBy("shard").parquet(path)
        records = docs.sparkSession.read.schema(records.schema).parquet(path)
    return records.select(
        "slot",
        "shard",
        ((F.col("slot") - F.col("shard") * per_shard) * stride).cast("long").alias("shard_byte"),
        F.col("doc").alias(ident),
        "part",
        "n_tokens",
        "tokens",
    )


def write_shards(records: DataFrame, folder: str) -> DataFrame:
    """Copy the records to flat files ``shard-00000.bin`` below a folder that all executors share.

    Every task writes whole shards: records are dealt by shard and ordered by
    slot.  A file appears under its name only when complete, so a lost executor
    or a second attempt leaves no torn shard.  Returns one row per shard.
    """

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, out, name, n = None, None, "", 0
        attempt = TaskContext.get().taskAttemptId()

        def close() -> pd.DataFrame:
            out.close()
            os.replace(f"{name}.{attempt}", name)
            return pd.DataFrame({"shard": [current], "records": [n], "file": [os.path.basename(name)]})

        for batch in batches:
            for shard, tokens in zip(batch["shard"], batch["tokens"]):
                if shard != current:
                    if out:
                        yield close()
                    current, n, name = shard, 0, os.path.join(folder, f"shard-{shard:05d}.bin")
                    out = open(f"{name}.{attempt}", "wb")  # noqa: SIM115
                out.write(tokens)
                n += 1
        if out:
            yield close()

    os.makedirs(folder, exist_ok=True)
    dealt = records.select("shard", "slot", "tokens").repartition("shard").sortWithinPartitions("shard", "slot")
    return dealt.mapInPandas(write, "shard long, records long, file string")


def read_slots(folder: str, first: int, n: int, length: int = LENGTH, per_shard: int = PER_SHARD, unit: int = 2) -> np.ndarray:
    """``n`` records from slot ``first`` on: seeks, without reading what comes before."""
    out = []
    while n > 0:
        shard, at = divmod(first, per_shard)
        take = min(n, per_shard - at)
        with open(os.path.join(folder, f"shard-{shard:05d}.bin"), "rb") as data:
            data.seek(at * length * unit)
            raw = data.read(take * length * unit)
        out.append(np.frombuffer(raw, f"<u{unit}").reshape(-1, length))
        first, n = first + take, n - take
    return np.concatenate(out) if out else np.zeros((0, length), f"<u{unit}")

"""SimHash near-dedup: generalised pigeonhole search over 64-bit fingerprints.

Fingerprints link at ``max_bits`` or fewer differing bits.  The bits are
grouped into partitions by correlation; a dynamic program gives each partition
a threshold ``t`` from estimated candidate counts, so that the thresholds sum
to ``max_bits - partitions + 1``.  By the generalised pigeonhole principle a
linked pair then differs in at most ``t`` bits in at least one partition with
``t >= 0``.  It is probed by masks that leave out ``t`` of the partition's bits,
and every probed pair is verified on all 64 bits.

A bucket with more than ``bucket`` fingerprints is not compared at once: its
members agree on the mask, so all their differences lie in the other bits, and
the same principle splits those again until buckets are small.  No pair is lost
and no bucket is ever compared whole beyond that size.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiloom.llm.common import components, with_text, word_blocks
from kpiloom.session import cut

BITS = 64
_BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def fingerprint(raw: bytes | None, shingle: int, seed: int) -> int:
    """The signed 64-bit SimHash of a text's word shingles; a text without words has 0."""
    if not raw:
        return 0
    ones, total = np.zeros(BITS, np.int64), 0
    for words in word_blocks(raw.lower(), shingle - 1):
        if not words:
            continue
        if len(words) <= shingle:
            grams = [b" ".join(words)]
        else:
            grams = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, grams, itertools.repeat(seed)), np.uint64)
        octets = hashes.view(np.uint8).reshape(-1, 8)
        if len(hashes) < 200:
            ones += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        else:
            for k in range(8):
                ones[8 * k : 8 * k + 8] += np.bincount(octets[:, k], minlength=256) @ _BYTE_BITS
        total += len(hashes)
    bits = np.packbits((2 * ones > total).astype(np.uint8), bitorder="little")
    return int(bits.view(np.int64)[0])


def with_fingerprint(docs: DataFrame, ident: str = "doc_id", text: str = "text", shingle: int = 3, seed: int = 42) -> DataFrame:
    """``(ident, text_key, fp)`` for every row; a null text counts as empty."""

    @F.pandas_udf("long")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([fingerprint(t, shingle, seed) for t in texts], dtype="int64")

    kept = with_text(docs, ident, text)
    return kept.select(F.col(ident).alias("doc"), F.xxhash64(text).alias("text_key"), of(F.col(text).cast("binary")).alias("fp"))


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >= 1 << (BITS - 1) else mask


def _mask(bits) -> int:
    return sum(1 << int(b) for b in bits)


def bit_statistics(fps: DataFrame) -> tuple[int, np.ndarray]:
    """Number of fingerprints, and how many have bits i and j both set; 4 096 sums whatever the input's size."""

    def sums(batches):
        total, both = 0, np.zeros((BITS, BITS), np.int64)
        for batch in batches:
            fp = np.ascontiguousarray(batch["fp"].to_numpy(np.int64))
            x = np.unpackbits(fp.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float32)
            both += np.rint(x.T @ x).astype(np.int64)
            total += len(fp)
        yield pd.DataFrame({"cell": np.arange(BITS * BITS + 1), "n": np.append(both.ravel(), total)})

    cells = fps.select("fp").mapInPandas(sums, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect()
    values = np.zeros(BITS * BITS + 1, np.int64)
    for cell, n in cells:
        values[cell] = n
    return int(values[-1]), values[:-1].reshape(BITS, BITS)


def group_bits(n: int, both: np.ndarray, partitions: int) -> list[list[int]]:
    """Partitions of nearly equal width, each grown from one bit by the bits most correlated with it."""
    p = np.diag(both) / max(n, 1)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    strength = np.abs((both / max(n, 1) - np.outer(p, p)) / np.outer(spread, spread))
    np.fill_diagonal(strength, 0)
    left, groups = list(range(BITS)), []
    for k in range(partitions):
        size = BITS // partitions + (k < BITS % partitions)
        group = [max(left, key=lambda b: strength[b, left].sum())]
        left.remove(group[0])
        while len(group) < size:
            best = max(left, key=lambda b: strength[b, group].sum())
            group.append(best)
            left.remove(best)
        groups.append(sorted(group))
    return groups


def allocate(costs: list[list[float]], max_bits: int) -> list[int]:
    """Thresholds from -1 to ``max_bits`` that sum to ``max_bits - partitions + 1`` at the least total cost.

    ``costs[i][t + 1]`` is the cost of threshold ``t`` in partition ``i``.
    """
    goal = max_bits + 1  # in steps above -1
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for row in costs:
        step: dict[int, tuple[float, list[int]]] = {}
        for used, (cost, chosen) in best.items():
            for t, more in enumerate(row):
                if used + t <= goal and (used + t not in step or cost + more < step[used + t][0]):
                    step[used + t] = (cost + more, [*chosen, t - 1])
        best = step
    return best[goal][1]


def _choose(n: int, k: int) -> int:
    return len(list(itertools.combinations(range(n), k)))


def plan(fps: DataFrame, max_bits: int, partitions: int) -> list[int]:
    """The masks to probe: bits that must agree."""
    n, both = bit_statistics(fps)
    groups = group_bits(n, both, partitions)
    masks = F.array(*[F.lit(_signed(_mask(g))) for g in groups])
    values = fps.select(F.posexplode(masks).alias("part", "mask"), "fp").select("part", F.col("fp").bitwiseAND(F.col("mask")).alias("value"))
    same = values.groupBy("part", "value").count().groupBy("part").agg(F.sum(F.col("count").cast("double") * F.col("count")).alias("pairs"))
    equal = {r["part"]: r["pairs"] for r in same.collect()}
    p = np.diag(both) / max(n, 1)
    apart = 2 * p * (1 - p)
    costs = []
    for i, group in enumerate(groups):
        # Pairs at distance exactly d, from those at distance 0: elementary symmetric sums of the bits' odds to differ.
        odds = np.array([1.0] + [0.0] * max_bits)
        for b in group:
            odds[1:] += odds[:-1] * apart[b] / (1 - apart[b])
        row = [0.0]
        for t in range(max_bits + 1):
            row.append(n * _choose(len(group), t) + equal.get(i, 0.0) * odds[: t + 1].sum())
        costs.append(row)
    thresholds = allocate(costs, max_bits)
    found = []
    for group, t in zip(groups, thresholds):
        if t >= 0:
            found += [_mask(set(group) - set(out)) for out in itertools.combinations(group, t)]
    return found


def _split(mask: int, parts: int) -> list[int]:
    """The masks that fix one more part of the bits a mask leaves open."""
    open_bits = [b for b in range(BITS) if not mask >> b & 1]
    return [mask | _mask(open_bits[k::parts]) for k in range(parts)]


def _verified(max_bits: int):
    """Links within each small bucket, as a spanning star per component: never more rows than members."""

    def run(batches):
        for batch in batches:
            nodes, roots = [], []
            for members in batch["fps"]:
                fp = np.unique(np.asarray(members, np.int64))
                near = np.bitwise_count((fp[:, None] ^ fp[None, :]).view(np.uint64)) <= max_bits
                label = np.arange(len(fp))
                while True:
                    lower = np.where(near, label[None, :], len(fp)).min(axis=1)
                    lower = lower[lower]
                    if (lower == label).all():
                        break
                    label = lower
                linked = label != np.arange(len(fp))
                nodes.append(fp[linked])
                roots.append(fp[label[linked]])
            if nodes:
                yield pd.DataFrame({"a": np.concatenate(nodes), "b": np.concatenate(roots)})

    return run


def links(fps: DataFrame, max_bits: int = 2, partitions: int | None = None, bucket: int = 256) -> DataFrame:
    """Edges ``(a, b)`` that connect exactly the fingerprints within ``max_bits`` of each other, chains included.

    ``fps`` holds distinct fingerprints.
    """
    masks = plan(fps, max_bits, partitions or max_bits + 1)
    spark = fps.sparkSession
    rows = fps.select("fp", F.explode(F.array(*[F.lit(_signed(m)) for m in masks])).alias("mask"))
    found = []
    while True:
        rows = rows.select("fp", "mask", F.col("fp").bitwiseAND(F.col("mask")).alias("value"))
        sizes = cut(rows.groupBy("mask", "value").agg(F.count("fp").alias("n")).where("n > 1"))
        shared = cut(rows.join(sizes, ["mask", "value"]))
        small = shared.where(F.col("n") <= bucket).groupBy("mask", "value").agg(F.collect_list("fp").alias("fps"))
        found.append(cut(small.select("fps").mapInPandas(_verified(max_bits), "a long, b long").distinct()))
        large = shared.where(F.col("n") > bucket)
        again = [r["mask"] for r in large.select("mask").distinct().collect()]  # a few fixed masks, not data
        if not again:
            break
        parts = [(m, [_signed(c) for c in _split(m % (1 << BITS), max_bits + 1)]) for m in again]
        finer = spark.createDataFrame(parts, "mask long, finer array<long>")
        rows = large.join(F.broadcast(finer), "mask").select("fp", F.explode("finer").alias("mask")).distinct()
    out = found[0]
    for more in found[1:]:
        out = out.union(more)
    return out


def simhash_groups(
    docs: DataFrame,
    ident: str = "doc_id",
    text: str = "text",
    shingle: int = 3,
    seed: int = 42,
    max_bits: int = 2,
    partitions: int | None = None,
    bucket: int = 256,
    text_key: bool = False,
) -> DataFrame:
    """One row per document: ``ident``, ``fingerprint`` (16 hex digits), ``component_id`` (least id reachable).

    Null and wordless texts have fingerprint zero and link like any other.
    Rows that repeat an id stay rows; a component whose ids are all null has a
    null component_id.  Other columns of ``docs`` are ignored.  ``text_key`` adds a
    hash of the text, for joining back to rows whose ids repeat.
    """
    prints = cut(with_fingerprint(docs, ident, text, shingle, seed))
    classes = cut(prints.groupBy("fp").agg(F.min("doc").alias("least")))
    joined = components(links(classes.select("fp"), max_bits, partitions, bucket), "a", "b")
    of = classes.join(joined, F.col("fp") == F.col("node"), "left").select("fp", "least", F.coalesce("component", "fp").alias("root"))
    roots = of.groupBy("root").agg(F.min("least").alias("component_id"))
    of = of.join(roots, "root").select("fp", "component_id")
    out = prints.join(of, "fp")
    return out.select(F.col("doc").alias(ident), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", *["text_key"] * text_key)

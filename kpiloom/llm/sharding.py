"""Sharding by histogram sort: equal bytes in every shard, equal texts side by side.

Rows are ordered by a hash of their text.  The bounds between shards are found
by probing: every round counts the exact bytes between candidate keys over all
partitions, and the bracket around each bound is probed again until a
candidate lies within tolerance of the byte count wanted below it.  Only then
do the rows move, once.

A text whose copies hold more than the tolerance would make its key too coarse
a probe.  There are at most ``shards / tolerance`` of these; they are counted
exactly and placed first, each whole in the emptiest shard if it fits, or in
pieces, whose bounds are probed on a hash of the id.  The other rows fill what
is left, so that no text that fits a shard is divided.
"""

from __future__ import annotations

import math
from collections import defaultdict

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kpiloom.session import cut, new_path

LAW = "bytes"
SHARDS = 24
TOLERANCE = 0.005  # of one shard's bytes
PART_BYTES = 64 << 20  # rows of a shard are ordered in parts of about this size,
MOST_PARTS = 20_000  # or larger ones where that would make more parts than this in all
ROW_BYTES = 8
LOWEST, WIDTH = -(1 << 63), 1 << 64
PROBES = 1 << 10  # candidates per bracket and round


def size_of(text: Column) -> Column:
    """UTF-8 bytes of a text plus eight for its row; null has no bytes of its own."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + ROW_BYTES).cast("long")


def _shifted(x: Column, bits: int) -> Column:
    """Distance shifted right by ``bits``; distances up to 2^64 wrap, so the shift is unsigned."""
    return F.shiftrightunsigned(x, bits) if bits else x


def _minus(x: Column, low: int) -> Column:
    """``x - low`` modulo 2^64, without overflow checks."""
    return x.bitwiseXOR(F.lit(LOWEST)) if low == LOWEST else (x - F.lit(low))


def splitters(rows: DataFrame, targets: dict[int, list[float]], tolerance: float) -> dict[int, list[int]]:
    """For every space, the least keys such that the bytes below them meet the targets.

    ``rows`` has ``space int, pos long, size long``; ``targets`` names for each
    space ascending byte counts.  A round collects at most ``PROBES`` counts for
    every bracket, and there is one bracket per bound at most.  A bound may be
    2^63: everything lies below it.
    """
    found: dict[tuple[int, int], int] = {}
    # Brackets: (space, low) -> bytes below low and the bounds still sought inside; all have one width.
    width = WIDTH
    brackets = {(space, LOWEST): (0, list(range(len(goals)))) for space, goals in targets.items() if goals}
    while brackets:
        step = max(1, width // PROBES)
        bits = step.bit_length() - 1
        chosen = F.lit(None).cast("int")
        inside = F.lit(None).cast("long")
        order = sorted(brackets)
        for k, (space, low) in enumerate(order):
            here = F.col("space") == space
            if width < WIDTH:
                here = here & F.col("pos").between(low, low + width - 1)
            chosen = F.when(here, F.lit(k)).otherwise(chosen)
            inside = F.when(here, _shifted(_minus(F.col("pos"), low), bits)).otherwise(inside)
        binned = rows.select(chosen.alias("b"), inside.alias("bin"), "size").where("b is not null")
        counts: dict[int, dict[int, int]] = defaultdict(dict)
        for r in binned.groupBy("b", "bin").agg(F.sum("size").alias("bytes")).collect():
            counts[r["b"]][r["bin"]] = r["bytes"]
        narrower: dict[tuple[int, int], tuple[int, list[int]]] = {}
        for k, bracket in enumerate(order):
            space, low = bracket
            below, sought = brackets[bracket]
            goals = sorted(sought, key=lambda j: targets[space][j])
            edge, at = below, 0
            for b in sorted(counts[k]):
                after = edge + counts[k][b]
                while at < len(goals) and targets[space][goals[at]] <= after:
                    j = goals[at]
                    want = targets[space][j]
                    left = want - edge <= after - want
                    if step == 1 or min(want - edge, after - want) <= tolerance:
                        found[space, j] = low + b * step + (0 if left else step)
                    else:
                        narrower.setdefault((space, low + b * step), (edge, []))[1].append(j)
                    at += 1
                edge = after
            for j in goals[at:]:  # rounding may leave a last target just above all bytes
                found[space, j] = low + width
        brackets, width = narrower, step
    return {space: [found[space, j] for j in range(len(goals))] for space, goals in targets.items()}


def place(groups: list[tuple[int, int, int]], shards: int, ideal: float, slack: float) -> tuple[list[float], dict[int, list[tuple[int, float]]]]:
    """Shards of the heavy texts ``(key, bytes, rows)``: loads, and per key its pieces ``(shard, bytes up to its end)``.

    Largest first, a text goes whole to the emptiest shard if it fits there or is
    a single row; otherwise it fills that shard and goes on with the next.
    """
    loads = [0.0] * shards
    pieces: dict[int, list[tuple[int, float]]] = {}
    for key, size, rows in sorted(groups, key=lambda g: (-g[1], g[0])):
        done = 0.0
        pieces[key] = []
        while done < size:
            s = min(range(shards), key=lambda k: (loads[k], k))
            room, rest = ideal - loads[s], size - done
            take = rest if rows == 1 or rest <= room + slack or room <= slack else room
            loads[s] += take
            done += take
            pieces[key].append((s, done))
    return loads, pieces


def shard(
    docs: DataFrame,
    ident: str = "doc_id",
    text: str = "text",
    shards: int = SHARDS,
    tolerance: float = TOLERANCE,
    part_bytes: int = PART_BYTES,
    path: str | None = None,
) -> DataFrame:
    """Every row with its shard and its place there: ``row`` (a struct of all columns), ``size``, ``shard``, ``slot``.

    The rows are written to ``path`` (in the shared folder if not given) in one
    exchange, one folder per shard, and read back from there.  Shards differ by
    ``tolerance`` of a shard and by what single rows larger than that force.
    Slots run from 0 without gaps, ordered by part, text and id.

    A null text has the size of its row alone and forms a text of its own; so
    does the empty text.  Rows that repeat, ids included, are dealt like other
    copies; null ids come first.  Any column names are allowed, since the
    columns stay inside ``row``.  An empty table gives no rows.
    """
    spark = docs.sparkSession
    ident_, text_ = F.col(f"`{ident}`"), F.col(f"`{text}`")
    keys = cut(docs.select(size_of(text_).alias("size"), F.xxhash64(text_).alias("key"), F.xxhash64(ident_).alias("sub"), F.monotonically_increasing_id().alias("nth")))
    total = keys.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    ideal = total / shards
    limit = tolerance * ideal

    # Heavy texts: exact counts of the texts in the few bins that hold more than the limit.
    bits = 64 - max(1, math.ceil(math.log2(4 * shards / tolerance)))
    bins = keys.groupBy(F.shiftright("key", bits).alias("bin")).agg(F.sum("size").alias("bytes"))
    full = bins.where(F.col("bytes") > limit).select("bin")  # at most shards / tolerance rows, as their bytes add up to the total
    counted = keys.join(F.broadcast(full), F.shiftright("key", bits) == F.col("bin")).groupBy("key")
    heavy = counted.agg(F.sum("size").alias("bytes"), F.count("*").alias("n")).where(F.col("bytes") > limit).collect()
    loads, pieces = place([(r["key"], r["bytes"], r["n"]) for r in heavy], shards, ideal, limit / 2)

    # What is left of every shard goes to the light rows, in the order of their keys.
    light = total - sum(r["bytes"] for r in heavy)
    room = [max(0.0, ideal - x) for x in loads]
    share = light / sum(room) if sum(room) > 0 else 0.0
    goals = {0: [share * sum(room[: s + 1]) for s in range(shards - 1)] if light else []}
    split = [key for key, cuts in pieces.items() if len(cuts) > 1]
    goals |= {g + 1: [end for _, end in pieces[key][:-1]] for g, key in enumerate(split)}
    spaces = {key: g + 1 for g, key in enumerate(split)}

    # Copies of one text under one id cannot be told apart by hashes: where they are many, their row number helps.
    alike: list = []
    if split:
        pairs = keys.where(F.col("key").isin(split)).groupBy("key", "sub").agg(F.sum("size").alias("bytes"))
        alike = [(r["key"], r["sub"]) for r in pairs.where(F.col("bytes") > limit).collect()]  # bounded like the heavy texts
    hot_pairs = F.broadcast(spark.createDataFrame(alike, "key long, sub long").withColumn("alike", F.lit(True)))
    known = F.broadcast(spark.createDataFrame([(r["key"], spaces.get(r["key"], -1)) for r in heavy], "key long, space int"))

    def positioned(table: DataFrame) -> DataFrame:
        """Adds ``space`` (0 light, -1 whole heavy, else a divided text) and ``pos``, the key within it."""
        table = table.join(known, "key", "left").join(hot_pairs, ["key", "sub"], "left")
        by_id = F.when(F.col("alike"), F.xxhash64("sub", "nth")).otherwise(F.col("sub"))
        space = F.coalesce("space", F.lit(0))
        return table.withColumns({"space": space, "pos": F.when(space > 0, by_id).otherwise(F.col("key"))})

    bounds = splitters(positioned(keys).select("space", "pos", "size"), goals, limit / 2)

    # Shard by comparing with at most `shards` bounds; a text in pieces has its own.
    def above(cuts: list[int], shard_of: list[int]) -> Column:
        out = F.lit(shard_of[0])
        for c, s in zip(cuts, shard_of[1:]):
            if c < LOWEST + WIDTH:
                out = F.when(F.col("pos") >= F.lit(c), F.lit(s)).otherwise(out)
        return out

    whole = [(key, cuts[0][0]) for key, cuts in pieces.items() if len(cuts) == 1]
    home = F.broadcast(spark.createDataFrame(whole, "key long, home int"))
    where_ = F.when(F.col("space") == 0, above(bounds[0], list(range(shards))) if bounds[0] else F.lit(0))
    for key in split:
        where_ = where_.when(F.col("space") == spaces[key], above(bounds[spaces[key]], [s for s, _ in pieces[key]]))
    where_ = where_.otherwise(F.col("home"))

    # Parts divide the key range of a shard evenly, so that no task orders a whole shard.
    parts = max(1, min(math.ceil(ideal / part_bytes), MOST_PARTS // shards))
    lows = [LOWEST, *bounds[0]] if bounds[0] else [LOWEST] * shards
    highs = [*bounds[0], LOWEST + WIDTH] if bounds[0] else [LOWEST + WIDTH] * shards
    low = F.element_at(F.array(*[F.lit(float(x)) for x in lows]), F.col("shard") + 1)
    wide = F.element_at(F.array(*[F.lit(float(max(1, h - x))) for x, h in zip(lows, highs)]), F.col("shard") + 1)
    along = F.floor((F.col("pos").cast("double") - low) / wide * parts).cast("int")
    part = F.when(F.col("space") == 0, F.greatest(F.lit(0), F.least(F.lit(parts - 1), along))).otherwise(F.pmod(F.xxhash64("pos", "sub"), F.lit(parts)).cast("int"))

    read = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        size_of(text_).alias("size"),
        F.xxhash64(text_).alias("key"),
        F.xxhash64(ident_).alias("sub"),
        F.monotonically_increasing_id().alias("nth"),
    )
    dealt = positioned(read).join(home, "key", "left").withColumn("shard", where_).withColumn("part", part)
    dealt = dealt.select("row", "size", "shard", "part", "key", "sub").withColumn("box", F.col("shard") * parts + F.col("part"))
    order = Window.partitionBy("box").orderBy("key", F.col("row").getField(ident), "sub")
    moved = dealt.repartition(shards * parts, "box").withColumn("place", F.row_number().over(order))
    path = path or new_path(spark, "shards")
    stored = moved.select("row", "size", "part", "place", "shard")
    stored.write.partitionBy("shard").parquet(path)
    written = spark.read.schema(stored.schema).parquet(path)

    # One count per part, numbered within each shard: at most MOST_PARTS rows, so the rows themselves stay where they are.
    per = written.groupBy("shard", "part").agg(F.max("place").alias("n"))
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ahead = per.select("shard", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("ahead"))
    return written.join(F.broadcast(ahead), ["shard", "part"]).select("row", "size", "shard", (F.col("ahead") + F.col("place") - 1).cast("long").alias("slot"))


def shard_digest(sharded: DataFrame, ident: str = "doc_id", text: str = "text") -> DataFrame:
    """The contract's view of sharded rows: ids, sizes, checksums of the texts and places."""
    body = F.col("row").getField(text)
    return sharded.select(
        F.col("row").getField(ident).alias(ident),
        "size",
        F.crc32(F.coalesce(body, F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit(LAW).alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )

"""Histogram-sort sharding against its own rules."""

import random
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from kpiloom.llm import sharding


def size(text):
    return len((text or "").encode()) + 8


def checked(got, rows, shards):
    """Every row once, sizes and checksums right, slots gapless; returns bytes per shard."""
    want = Counter((i, size(t), zlib.crc32((t or "").encode())) for i, t, _, _ in rows)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == want
    slots, loads = defaultdict(list), Counter({s: 0 for s in range(shards)})
    for r in got:
        assert 0 <= r["shard"] < shards and r["law"] == "bytes" and r["grown_shard"] is None
        slots[r["shard"]].append(r["slot"])
        loads[r["shard"]] += r["size"]
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    return loads


def test_splitters_meet_their_targets(spark):
    rng = random.Random(4)
    rows = [(s, rng.getrandbits(64) - (1 << 63), rng.randint(1, 90)) for s in (0, 1) for _ in range(3000)]
    rows += [(0, 77, 5)] * 400 + [(0, -(1 << 63), 3), (0, (1 << 63) - 1, 3)]
    df = spark.createDataFrame(rows, "space int, pos long, size long")
    totals = {s: sum(r[2] for r in rows if r[0] == s) for s in (0, 1)}
    goals = {s: [totals[s] * k / 7 for k in range(1, 7)] for s in (0, 1)} | {2: []}
    got = sharding.splitters(df, goals, 20)
    assert got[2] == []
    for s in (0, 1):
        assert got[s] == sorted(got[s])
        for bound, want in zip(got[s], goals[s]):
            below = sum(z for space, pos, z in rows if space == s and pos < bound)
            repeated = sum(z for space, pos, z in rows if space == s and pos == 77)
            assert abs(below - want) <= max(90, repeated)


def test_shards_of_equal_bytes_keep_texts_together(spark, docs_of):
    rng = random.Random(5)
    texts = ["".join(rng.choice("abcdef ") for _ in range(rng.randint(0, 400))) for _ in range(1500)]
    rows = [(k, rng.choice(texts) if k % 3 else texts[k % 1500], "a", "en") for k in range(3000)]
    df = docs_of(rows)
    got = sharding.shard_digest(sharding.shard(df, shards=8, part_bytes=9000)).collect()
    loads = checked(got, rows, 8)
    assert max(loads.values()) - min(loads.values()) <= 0.01 * sum(loads.values()) / 8
    homes = defaultdict(set)
    for r in got:
        homes[r["text_crc32"], r["size"]].add(r["shard"])
    assert max(map(len, homes.values())) == 1
    again = sharding.shard_digest(sharding.shard(df.repartition(5), shards=8, part_bytes=9000)).collect()
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, again), key=str)


def test_a_hot_text_is_divided_and_the_rest_is_not(spark, docs_of):
    rows = [(k, "copy of a text " * 9, "a", "en") for k in range(900)] + [(1000 + k, f"text {k} " * 7, "a", "en") for k in range(2000)]
    rows += [(5, "one id, one text " * 8, "a", "en")] * 700  # rows that only their number tells apart
    got = sharding.shard_digest(sharding.shard(docs_of(rows), shards=6)).collect()
    loads = checked(got, rows, 6)
    assert max(loads.values()) - min(loads.values()) <= 0.06 * sum(loads.values()) / 6
    homes = defaultdict(set)
    for r in got:
        homes[r["text_crc32"]].add(r["shard"])
    assert sum(len(s) > 1 for s in homes.values()) <= 2


def test_one_row_larger_than_a_shard(spark, docs_of):
    rows = [(0, "x" * 100_000, "a", "en")] + [(k, f"t{k}", "a", "en") for k in range(1, 600)]
    loads = checked(sharding.shard_digest(sharding.shard(docs_of(rows), shards=5)).collect(), rows, 5)
    assert sorted(loads.values())[-1] == 100_008  # alone; the others share the rest
    assert max(sorted(loads.values())[:-1]) - min(loads.values()) <= 60


@pytest.mark.parametrize("shards", [1, 24])
def test_odd_rows(spark, docs_of, odd_rows, shards):
    df = docs_of(odd_rows, extra=True).withColumn("shard", F.lit("x")).withColumn("part", F.lit("y"))
    checked(sharding.shard_digest(sharding.shard(df, shards=shards)).collect(), odd_rows, shards)
    assert sharding.shard_digest(sharding.shard(docs_of([]), shards=shards)).collect() == []


def test_stored_rows_hold_every_column(spark, docs_of, odd_rows, tmp_path):
    df = docs_of(odd_rows)
    out = sharding.shard(df, shards=3, path=f"file://{tmp_path}/shards")
    assert sorted(map(str, out.select("row.*").collect())) == sorted(map(str, df.collect()))
    assert {p.name for p in (tmp_path / "shards").iterdir() if p.name.startswith("shard=")} <= {"shard=0", "shard=1", "shard=2"}

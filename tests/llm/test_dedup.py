"""SimHash, vector and suffix near-dedup against brute force."""

import hashlib
import itertools
import random

import numpy as np
import pytest
import xxhash

from kpiloom.llm import hnsw, simhash, suffix_dedup
from kpiloom.llm.common import components, word_blocks

SMALL = "/root/testdata/sf0.001"


def plain_fingerprint(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in __import__("re").split("[\x20\x09-\x0d]+", words) if w]
    grams = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def linked_components(ids, near):
    """Least id reachable, by repeated minimum over the full matrix."""
    label = np.array(ids)
    while True:
        low = np.where(near, label[None, :], np.iinfo(np.int64).max).min(axis=1)
        if (low == label).all():
            return label
        label = low


def test_word_blocks_cover_every_gram():
    raw = b" ".join(b"w%d" % i for i in range(5000))
    whole = raw.split()
    for block in (7, 50, 1000, 1 << 20):
        grams = [g for words in word_blocks(raw, 2, block) for g in zip(words, words[1:], words[2:])]
        assert grams == list(zip(whole, whole[1:], whole[2:]))
    assert list(word_blocks(b"   ", 2, 1)) == [] or all(not w for w in word_blocks(b"   ", 2, 1))


@pytest.mark.parametrize("n", range(4))
def test_word_blocks_keep_few_words_of_a_long_text(n):
    raw = (b" " * 40).join([b""] + [b"w%d" % i for i in range(n)] + [b""])
    lists = [words for words in word_blocks(raw, 2, 8) if words]
    assert lists == ([raw.split()] if n else [])
    text = raw.decode() + " " * (1 << 20)
    assert simhash.fingerprint(text.encode(), 3, 42) & (1 << 64) - 1 == plain_fingerprint(text)


@pytest.mark.parametrize("bucket", [256, 2])
def test_simhash_equals_brute_force(spark, docs_of, odd_rows, bucket):
    rng = random.Random(1)
    base = [" ".join(rng.choice("abcdefgh") * 2 for _ in range(40)) for _ in range(12)]
    rows = list(odd_rows)
    for k in range(120):
        words = base[k % 12].split()
        words[rng.randrange(40)] = rng.choice(["x", "Y", "bb"])
        rows.append((100 + k, " ".join(words), "s", "en"))
    got = simhash.simhash_groups(docs_of(rows, extra=True), bucket=bucket).collect()
    assert len(got) == len(rows)
    prints = {}
    for i, text, *_ in rows:
        prints.setdefault(i, plain_fingerprint(text))
    assert all(int(r["fingerprint"], 16) == prints[r["doc_id"]] for r in got)
    ids = [i for i in prints if i is not None]
    fp = np.array([prints[i] for i in ids], np.uint64)
    want = dict(zip(ids, linked_components(ids, np.bitwise_count(fp[:, None] ^ fp[None, :]) <= 2)))
    # The row without an id links others but has no name of its own.
    assert all(r["component_id"] == want[r["doc_id"]] for r in got if r["doc_id"] is not None)


def test_simhash_hot_group_of_near_fingerprints(spark):
    rng = np.random.default_rng(0)
    centre = int(rng.integers(0, 1 << 62))
    fps = {centre}
    while len(fps) < 1500:
        flips = rng.choice(64, rng.integers(1, 4), replace=False)
        fps.add(centre ^ sum(1 << int(b) for b in flips))
    fps = [f - (1 << 64) if f >= 1 << 63 else f for f in fps]
    edges = simhash.links(spark.createDataFrame([(f,) for f in fps], "fp long"), bucket=32)
    assert edges.count() < 60 * len(fps)
    found = {r["node"]: r["component"] for r in components(edges, "a", "b").collect()}
    x = np.array(fps, np.int64)
    want = linked_components(fps, np.bitwise_count((x[:, None] ^ x[None, :]).view(np.uint64)) <= 2)
    assert all(found.get(f, f) == w for f, w in zip(fps, want))


def test_thresholds_are_the_cheapest_allocation():
    rng = random.Random(3)
    for _ in range(30):
        m, most = rng.randint(1, 4), rng.randint(0, 3)
        costs = [[0.0, *sorted(rng.random() * 10 for _ in range(most + 1))] for _ in range(m)]
        best = min(
            (sum(costs[i][t + 1] for i, t in enumerate(ts)), ts)
            for ts in itertools.product(range(-1, most + 1), repeat=m)
            if sum(ts) == most - m + 1
        )
        got = simhash.allocate(costs, most)
        assert sum(got) == most - m + 1
        assert abs(sum(costs[i][t + 1] for i, t in enumerate(got)) - best[0]) < 1e-9


def test_simhash_of_nothing(spark, docs_of):
    assert simhash.simhash_groups(docs_of([])).count() == 0


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(1000, 1000 + k) for k in range(1, 50)] + [(7, 7), (500, 501), (501, 500)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    assert all(got[i] == 0 for i in range(61))
    assert all(got[1000 + k] == 1000 for k in range(50))
    assert got[501] == got[500] == 500


def test_vectors_equal_brute_force(spark):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(40, 16))
    rows = []
    for k in range(400):
        v = base[k % 40] + rng.normal(size=16) * (0.02 if k % 3 else 0.3)
        rows.append((k, [float(x) for x in v], int(k % 40 % 3)))
    rows += [(1000, rows[4][1], rows[4][2]), (1001, rows[4][1], None), (1002, None, 0), (1003, [0.0] * 16, 0)]
    rows += [(1004, [float("nan")] * 16, 0), (1005, [None] * 16, 0), (1006, [float("inf")] * 16, 1), (1007, [1.0, 2.0], 1), (None, rows[4][1], rows[4][2])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = hnsw.near_duplicates(df, threshold=0.98, shard_rows=64, block_rows=100).collect()
    assert len(got) == len(rows)
    live = [r for r in rows if r[0] is not None and (r[0] < 1000 or r[0] == 1000)]
    x = np.array([r[1] for r in live])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    label = np.array([r[2] for r in live])
    near = (x @ x.T >= 0.98) & (label[:, None] == label[None, :])
    part = linked_components([r[0] for r in live], near)
    want = {r[0]: (int(n) - 1, int(c)) for r, n, c in zip(live, near.sum(axis=1), part)}
    for r in got:
        n, c = want.get(r["vec_id"], (0, r["vec_id"]))
        assert (r["n_links"], r["component_id"]) == (n, c), r
        assert r["kept"] == (None if r["vec_id"] is None else r["vec_id"] == c)


def test_graph_finds_most_neighbours():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(1500, 24))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    graph = hnsw.Graph(x)
    ids, _ = graph.search(x[:200], 64)
    exact = np.argsort(-(x[:200] @ x.T), axis=1)[:, :10]
    assert np.mean([len(set(a) & set(b)) / 10 for a, b in zip(ids, exact)]) > 0.9


def test_vectors_of_nothing(spark):
    assert hnsw.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0


def brute_removed(texts, length):
    raws = [(t or "").encode() for t in texts]
    seen = {}
    for raw in raws:
        for i in range(len(raw) - length + 1):
            seen[raw[i : i + length]] = seen.get(raw[i : i + length], 0) + 1
    out = []
    for raw in raws:
        gone = np.zeros(len(raw), bool)
        for i in range(len(raw) - length + 1):
            if seen[raw[i : i + length]] > 1:
                gone[i : i + length] = True
        edge = np.diff(np.concatenate([[0], gone.astype(int), [0]]))
        kept = np.frombuffer(raw, np.uint8)[~gone].tobytes()
        out.append((len(raw), int(gone.sum()), int((edge == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize(("hot", "crowded"), [(4096, 256), (2, 1), (4096, 1)])
def test_suffix_dedup_equals_brute_force(spark, docs_of, hot, crowded):
    rng = random.Random(hot)
    word = lambda: "".join(rng.choice("abcé ") for _ in range(rng.randint(1, 9)))
    fresh = lambda n: "".join(word() for _ in range(n))
    passages = [fresh(40) for _ in range(4)]
    texts = [None, "", "short", "z" * 700, "ab" * 300]
    for k in range(60):
        parts = [fresh(rng.randint(1, 60))]
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(passages)
            a = rng.randint(0, 60)
            parts += [p[a : a + rng.randint(40, 200)], fresh(rng.randint(0, 20))]
        texts.append("".join(parts))
    texts += [texts[10], texts[11], texts[11] + "!"]
    rows = [(i, t, "s", "en") for i, t in enumerate(texts)] + [(12, texts[12], "s", "en")]
    want = sorted(zip([r[0] for r in rows], brute_removed([r[1] for r in rows], 100)))
    got = suffix_dedup.remove_repeats(docs_of(rows, extra=True), length=100, hot=hot, crowded=crowded).collect()
    assert sorted((r["doc_id"], (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"])) for r in got) == want


def test_suffix_chunks_do_not_change_the_anchors(monkeypatch):
    rng = random.Random(4)
    raw = bytes(rng.choice(b"abcd") for _ in range(20_000))
    refiner = suffix_dedup.Refiner(400)
    whole = np.concatenate([a + s for s, _, _, a in refiner.chunks(raw)])
    monkeypatch.setattr(suffix_dedup, "_CHUNK", 3000)
    pieces = np.concatenate([a + s for s, _, _, a in refiner.chunks(raw)])
    assert len(whole) == len(raw) - 399 and (whole == pieces).all()


def test_suffix_dedup_of_nothing(spark, docs_of):
    assert suffix_dedup.remove_repeats(docs_of([])).count() == 0


def test_suffix_dedup_at_full_length(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = docs.select("doc_id", "text").toPandas()
    got = suffix_dedup.remove_repeats(docs).toPandas().set_index("doc_id")
    for i, want in zip(rows["doc_id"], brute_removed(rows["text"], 400)):
        r = got.loc[i]
        assert (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) == want

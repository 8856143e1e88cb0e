"""Ranked search against scoring every document."""

import math
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest

from kpiloom.llm import lexical_search as ls
from kpiloom.llm.oracles import LEXICAL_SEARCH

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def plain(docs, items, top=10):
    bags = [(i, Counter(TERM.findall((t or "").translate(LOWER)))) for i, t in docs]
    n_docs, words = sum(bool(b) for _, b in bags), sum(b.total() for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item, text in items:
        terms = set(TERM.findall((text or "").translate(LOWER)))
        found = []
        for i, bag in bags:
            m = 10 + (90 * bag.total() * n_docs) // words if words else 0
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1_000_000_000 * bag[t] // (1000 * bag[t] + 8 * m)) for t in terms if t in bag
            )
            if score > 0:
                found.append((-score, i is None, i))
        out += [(item, rank, i, -s) for rank, (s, _, i) in enumerate(sorted(found, key=lambda x: (x[0], x[1], x[2] or 0))[:top], 1)]
    return sorted(out, key=str)


def made(rng, n, words):
    weights = [1 / (k + 1) for k in range(len(words))]
    return [(k, " ".join(rng.choices(words, weights, k=rng.choice([0, 1, 5, 40, 200])))) for k in range(n)]


WORDS = ["The", "été", "a1", "Zz", "x", "naïve", "über", "42"] + [f"w{k}" for k in range(300)]


@pytest.mark.parametrize("waves", [(2, None), ls.WAVES])
def test_equals_scoring_everything(spark, waves):
    rng = random.Random(11)
    docs = made(rng, 900, WORDS)
    docs += [(2000 + k, docs[7][1]) for k in range(60)] + [(3000 + k, docs[11][1]) for k in range(40)]  # ties
    rng.shuffle(docs)
    items = made(rng, 40, WORDS) + [(100, "no such-term_here unknownword"), (101, None), (102, ""), (103, docs[3][1])]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    shards = ls.index(df, shard_docs=128)
    assert shards.count() >= 7
    got = ls.search(shards, spark.createDataFrame(items, "item_id long, text string"), item_block=17, waves=waves)
    assert sorted(map(tuple, got.collect()), key=str) == plain(docs, items)


def test_odd_rows_and_oracle(spark, docs_of, odd_rows):
    df = docs_of(odd_rows, extra=True)
    items = [(1, "the same TEXT, über"), (2, "word7 next3 word7 one"), (3, "")]
    bench = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "'x' as doc", "'y' as rank")
    got = sorted(map(tuple, ls.search(ls.index(df), bench).collect()), key=str)
    assert got == plain([(i, t) for i, t, _, _ in odd_rows], items)
    some = [(k, t, "a", "en") for k, (_, t, _, _) in enumerate(odd_rows)]
    documents, benchmark = docs_of(some).toPandas(), bench.toPandas()  # noqa: F841
    want = sorted(duckdb.connect().sql(LEXICAL_SEARCH).fetchall(), key=str)
    assert want == plain([(i, t) for i, t, _, _ in some], items)
    assert ls.search(ls.index(docs_of([])), bench).collect() == []
    assert ls.search(ls.index(df), bench.limit(0)).collect() == []


def test_very_long_document_counts_once(spark):
    long = " ".join(f"t{k % 700}" for k in range(600_000)) + " rare"
    docs = [(1, long), (2, "rare t1"), (3, "t1 t2")]
    items = [(0, "rare t1 t2")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = ls.search(ls.index(df), spark.createDataFrame(items, "item_id long, text string"))
    assert sorted(map(tuple, got.collect()), key=str) == plain(docs, items)


def test_tree_holds_every_posting_and_maximum():
    rng = np.random.default_rng(2)
    cells = rng.choice(60 * 300, 700, replace=False)
    rows, cols, impacts = cells // 60, cells % 60, rng.integers(1, 99, 700)
    tree = ls.Treap(rows, cols, impacts, 300)
    for r, c, v in zip(rows, cols, impacts):
        node = np.array([0])
        for level in range(tree.levels):
            shift = tree.levels - 1 - level
            assert tree.most[level][node[0]] >= v
            has, node = tree.children(level, node, np.array([((r >> shift) & 1) * 2 + ((c >> shift) & 1)]))
            assert has[0]
        assert tree.most[-1][node[0]] == v
    assert len(tree.most[-1]) == 700 and tree.most[0][0] == impacts.max()

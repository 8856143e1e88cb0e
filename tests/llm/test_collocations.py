"""Collocations against a brute-force count, and the summaries against their guarantee."""

import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from kpiloom.llm import collocations as co
from kpiloom.llm.oracles import COLLOCATIONS

LOWER = {c: c + 32 for c in range(65, 91)}


def plain(rows, least=10, covered=50, most=2000):
    counts, totals = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for n in (1, 2, 3):
                for k in range(len(words) - n + 1):
                    counts[lang][" ".join(words[k : k + n])] += 1
    out = []
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if " " in p and a >= least}
        held = defaultdict(int)
        for p, a in candidates.items():
            w = p.split(" ")
            if len(w) == 3:
                for q in (" ".join(w[:2]), " ".join(w[1:])):
                    held[q] = max(held[q], a)
        scored = []
        for p, a in candidates.items():
            w = p.split(" ")
            cuts = []
            for k in range(1, len(w)):
                left, right = f[" ".join(w[:k])], f[" ".join(w[k:])]
                cuts.append((1_000_000 * a * a // (left * right), k, left, right))
            score, _, left, right = min(cuts)
            if len(w) == 3 or 100 * held[p] < covered * a:
                scored.append((-score, -a, p.encode(), left, right))
        for rank, (score, a, p, left, right) in enumerate(sorted(scored)[:most], 1):
            out.append((lang, rank, p.decode(), -a, left, right, totals[lang], -score))
    return sorted(out)


def rows_of(rng, n, vocabulary, langs):
    seps = [" ", " ", " ", "  ", "\t", ", ", ". ", "\n", "\r\n"]
    weights = [1 / (k + 1) for k in range(len(vocabulary))]
    return [(rng.choice(langs), "".join(w + rng.choice(seps) for w in rng.choices(vocabulary, weights, k=rng.randint(0, 60)))) for _ in range(n)]


@pytest.mark.parametrize("settings", [{}, {"part_mass": 400}, {"part_mass": 60, "fan": 4}])
def test_equals_brute_force(spark, settings):
    rng = random.Random(3)
    rows = rows_of(rng, 400, ["The", "a", "Éa", "x-y", "b", "c'd", "ZZ", "\x00\x1c", " ", "q9"], ["en", "fr", None, "", "und"])
    rows += [("en", "same words again, same words again"), (None, None), ("en", "")] * 30
    df = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    got = sorted(tuple(r) for r in co.collocations(df, **settings).collect())
    assert got == plain(rows) and len(got) > 100


def test_long_texts_are_cut_between_words(spark, monkeypatch):
    rng = random.Random(9)
    long = " ".join(rng.choice(["ab", "cd", "ef", "gh, ij", "k"]) for _ in range(3000))
    lists = [b.split() for b in [long.encode().translate(co._TABLE).replace(b"\n", b" A ")]]
    whole = co.Chunk(["en"], lists, [0])  # takes the words out of the lists
    pieces = [w for w in co.word_blocks(long.encode().translate(co._TABLE).replace(b"\n", b" A "), 2, 500)]
    assert len(pieces) > 5
    n = len(pieces)
    cut_up = co.Chunk(["en"] * n, pieces, [0] + [2] * (n - 1))
    for a, b in zip(whole.keys, cut_up.keys):
        assert np.array_equal(np.sort(a), np.sort(b))
    assert whole.counted.sum() == cut_up.counted.sum()


def test_most_and_repeated_ties(spark):
    rows = [("en", f"w{k} v{k}") for k in range(40) for _ in range(10)]
    got = sorted(tuple(r) for r in co.collocations(spark.createDataFrame(rows, "lang string, text string"), most=7).collect())
    assert got == plain(rows, most=7) and len(got) == 7


def test_odd_rows_and_oracle(spark, docs_of, odd_rows):
    df = docs_of(odd_rows * 6, extra=True)
    want = plain([(lang, t) for _, t, _, lang in odd_rows * 6])
    assert sorted(tuple(r) for r in co.collocations(df).collect()) == want
    documents = df.select("lang", "text").toPandas()  # noqa: F841
    con = duckdb.connect()
    assert sorted(con.sql(COLLOCATIONS).fetchall()) == want
    assert co.collocations(docs_of([])).collect() == []


def test_summaries_keep_every_frequent_key():
    rng = np.random.default_rng(1)
    for least in (2, 10, 37):
        stream = np.minimum(rng.zipf(1.3, 20_000), 5000).astype(np.uint64)
        true = Counter(stream.tolist())
        summary = co.Summary(len(stream) // least)
        for piece in np.array_split(stream, 13):
            keys, counts = np.unique(piece, return_counts=True)
            summary._waiting = summary.capacity + (1 << 16)  # settle at every step
            summary.add(*co.unpack(co.pack(keys, counts)))
        kept = set(summary.frequent(least).tolist())
        assert summary.error < least and len(summary.keys) <= summary.capacity
        assert {k for k, n in true.items() if n >= least} <= kept


def test_packing_round_trip():
    for keys in ([], [0], [5, 2**32 - 1], [1, 2**40, 2**63]):
        counts = np.array([300, 1, 2**40][: len(keys)], np.int64)
        got = co.unpack(co.pack(np.array(keys, np.uint64), counts))
        assert got[0].tolist() == keys and got[1].tolist() == counts.tolist()

"""Language, toxicity and quality models against plain re-computation and on held-out rows."""

import itertools
import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest

from kpiloom.llm import line_crf, ppm, toxicity

DATA = "/root/testdata/sf0.01"


def plain_bits(texts, text, least):
    """Code length by the definition: longest context with a node, escapes down to 256 equal symbols."""
    seen = defaultdict(Counter)
    for t in texts:
        data = b"\0\0\0" + t
        for i in range(3, len(data)):
            for k in range(4):
                seen[data[i - k : i]][data[i]] += 1
    total = 0.0
    data = b"\0\0\0" + text
    for i in range(3, len(data)):
        p = 1.0
        for k in (3, 2, 1, 0):
            counts = seen.get(data[i - k : i])
            if not counts or (k and sum(counts.values()) < least):
                continue
            n, d = sum(counts.values()), len(counts)
            if data[i] in counts:
                p *= counts[data[i]] / (n + d)
                break
            p *= d / (n + d)
        else:
            p /= 256
        total -= math.log2(p)
    return total


@pytest.mark.parametrize("least", [1, 4])
def test_code_lengths_are_exact(least):
    rng = np.random.default_rng(0)
    langs = {"x": [bytes(rng.choice(list(b"abcab \xc3\xa9"), 60).tolist()) for _ in range(6)], "y": [bytes(rng.choice(list(b"bcdd "), 50).tolist()) for _ in range(5)]}
    frames = []
    for lang, texts in langs.items():
        grams = Counter()
        for t in texts:
            data = b"\0\0\0" + t
            grams.update(int.from_bytes(data[i : i + 4], "big") for i in range(len(data) - 3))
        frames.append(pd.DataFrame({"lang": lang, "gram": list(grams), "n": list(grams.values())}))
    trees = ppm.build(pd.concat(frames), least)
    probes = [b"abc", b"", b"dddd cab", b"zzz\xff", langs["x"][0], b"a" * 300]
    bits = trees.bits(probes)
    for i, probe in enumerate(probes):
        for j, lang in enumerate(trees.languages):
            assert bits[i, j] == pytest.approx(plain_bits(langs[lang], probe, least), rel=1e-5, abs=1e-4)


def test_long_texts_are_scored_whole(monkeypatch):
    counts = pd.DataFrame({"lang": ["x"] * 3, "gram": [0x00000061, 0x00006162, 0x00616261], "n": [50, 40, 30]})
    trees = ppm.build(counts)
    texts = [b"abab" * 100, b"", b"ba" * 33]
    whole = trees.bits(texts)
    monkeypatch.setattr(ppm, "_PIECE", 7)
    assert np.allclose(trees.bits(texts), whole)


def test_languages_of_held_out_documents(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    got = ppm.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").toPandas()
    assert len(got) == docs.count()
    for row in got.itertuples():
        assert row.held_out == (zlib.crc32(str(row.doc_id).encode()) % 4 == 2)
    held = got[got.held_out]
    assert (held.lang_pred == held.lang).mean() > 0.99
    assert got.score.between(0, 1).all()


def test_texts_in_no_learned_language_go(spark, docs_of):
    rng = np.random.default_rng(4)
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    strange = ["".join(chr(c) for c in rng.integers(0x4E00, 0x9FA0, 200)), "".join(chr(c) for c in rng.integers(0x430, 0x44F, 300)), "".join(rng.choice(list("qxzjkvw0189"), 400))]
    rows = docs_of([(10_000_000 + k, t, "s", None) for k, t in enumerate(strange)])
    kept = {r["doc_id"] for r in ppm.known_language(docs.unionByName(rows)).select("doc_id").collect()}
    lettered = {r["doc_id"] for r in docs.collect() if any(map(str.isalpha, r["text"] or ""))}
    assert kept == lettered


def test_language_of_odd_rows(spark, docs_of, odd_rows):
    got = ppm.identify(docs_of(odd_rows, extra=True)).collect()
    by = {r["doc_id"]: r for r in got}
    assert len(got) == len(odd_rows)
    for i in (0, 1, 2, 8):
        assert (by[i]["lang_pred"], by[i]["score"]) == ("und", 0.0)
    assert by[9]["lang_pred"] in ("en", "fr", "de") and by[None]["held_out"] is False
    assert ppm.identify(docs_of([])).count() == 0
    alone = ppm.identify(docs_of([(1, "some text", "s", None)])).collect()
    assert alone[0]["lang_pred"] == "und"
    kept = ppm.known_language(docs_of(odd_rows, extra=True))
    assert kept.count() == len(odd_rows) - 4 and kept.columns == docs_of([], extra=True).columns


def _insults(n, rng):
    clean = [f"w{k}" .replace("0", "o").replace("1", "l") for k in range(300)]
    clean = ["".join(rng.choice(list("abcdefg"), 5)) for _ in clean]
    rows = []
    for i in range(n):
        sentences = [" ".join(rng.choice(clean, 8)) for _ in range(rng.integers(2, 9))]
        toxic = int(rng.random() < 0.4)
        at = int(rng.integers(0, len(sentences)))
        if toxic:
            sentences[at] += " " + str(rng.choice(["moronic", "scumbag", "zzidiot"]))
        rows.append((i, ". ".join(sentences) + ".", toxic, at if toxic else None))
    return rows


def test_noisy_or_finds_documents_and_sentences(spark):
    rows = _insults(600, np.random.default_rng(1))
    docs = spark.createDataFrame([(i, t) for i, t, *_ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y, _ in rows], "doc_id long, toxic int")
    got = {r["doc_id"]: r for r in toxicity.toxicity(docs, labels).collect()}
    held = [r for r in rows if got[r[0]]["held_out"]]
    assert len(held) > 50
    assert np.mean([got[i]["predicted"] == y for i, _, y, _ in held]) > 0.97
    assert np.mean([got[i]["worst"] == at for i, _, y, at in held if y]) > 0.95
    # Labels of the held-out fold change nothing.
    flipped = spark.createDataFrame([(i, 1 - y if got[i]["held_out"] else y) for i, _, y, _ in rows], "doc_id long, toxic int")
    again = {r["doc_id"]: r["score"] for r in toxicity.toxicity(docs, flipped).collect()}
    assert all(again[i] == got[i]["score"] for i in got)
    model = toxicity.fit(docs, labels)
    found = toxicity.offending(docs, model).toPandas()
    assert found["words"].str.contains("moronic|scumbag|zzidiot").mean() > 0.95


def test_document_score_is_the_noisy_or_of_its_sentences():
    model = toxicity.SentenceModel(-2.0, {"bad": 3.0}, {4: {"wors": 1.5}, 5: {"worse": 0.5}})
    z = toxicity.sentence_scores("Bad worse day. Fine!\n\n... worst bad bad", toxicity.WordScores(model))
    assert np.allclose(z, [-2 + 3 + 2, -2, -2 + 1.5 + 3])
    assert len(toxicity.sentence_scores("?! ...", toxicity.WordScores(model))) == 0


def test_toxicity_of_odd_rows(spark, docs_of, odd_rows):
    labels = spark.createDataFrame([(3, 0), (4, None), (None, 1), (5, 1), (5, 0)], "doc_id long, toxic int")
    got = toxicity.toxicity(docs_of(odd_rows, extra=True), labels).collect()
    assert len(got) == len(odd_rows) and all(0 <= r["score"] <= 1 for r in got)
    assert all(r["score"] == 0 and r["worst"] is None for r in got if r["doc_id"] in (0, 1, 2))
    assert toxicity.toxicity(docs_of([]), labels).count() == 0
    assert toxicity.toxicity(docs_of(odd_rows), labels.where("false")).count() == len(odd_rows)


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(3)
    doc = np.repeat([0, 1, 2], [4, 1, 3])
    score, transition = rng.normal(size=8), rng.normal(size=(2, 2))
    good, pairs = line_crf.marginals(score, doc, transition)
    at = 0
    for n in (4, 1, 3):
        total, per, both = 0.0, np.zeros(n), np.zeros((n - 1, 2, 2))
        for path in itertools.product((0, 1), repeat=n):
            w = math.exp(sum(score[at + t] * y for t, y in enumerate(path)) + sum(transition[a, b] for a, b in zip(path, path[1:])))
            total += w
            per += w * np.array(path)
            for t, (a, b) in enumerate(zip(path, path[1:])):
                both[t, a, b] += w
        assert np.allclose(good[at : at + n], per / total)
        follows = np.flatnonzero(doc[1:] == doc[:-1]) + 1
        mine = pairs[(follows > at) & (follows < at + n)]
        assert np.allclose(mine, both / total)
        at += n


def test_quality_of_held_out_documents(spark):
    docs, labels = spark.read.parquet(f"{DATA}/documents.parquet"), spark.read.parquet(f"{DATA}/labels.parquet")
    got = line_crf.quality(docs, labels).join(labels, "doc_id").toPandas()
    held = got[got.held_out]
    assert (held.predicted == held.quality).mean() > 0.95
    assert got.score.between(0, 1).all()


def test_quality_of_odd_rows(spark, docs_of, odd_rows):
    labels = spark.createDataFrame([(3, 0), (4, None), (None, 1), (5, 1), (6, 0)], "doc_id long, quality int")
    got = line_crf.quality(docs_of(odd_rows, extra=True), labels).collect()
    assert len(got) == len(odd_rows) and all(0 <= r["score"] <= 1 for r in got)
    assert {r["score"] for r in got if r["doc_id"] == 0} == {r["score"] for r in got if r["doc_id"] == 1}
    assert line_crf.quality(docs_of([]), labels).count() == 0
    assert {r["score"] for r in line_crf.quality(docs_of(odd_rows), labels.where("false")).collect()} == {0.5}


def test_a_planted_bad_block_is_found_by_its_lines(spark):
    """Lines of held-out bad documents inside held-out good ones, with a field that never saw a line's label."""
    docs, labels = (spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("documents", "labels"))
    rows = sorted(docs.join(labels, "doc_id").where("quality is not null").select("doc_id", "text", "quality").collect())
    held = [zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0 for r in rows]
    seen = [r for r, h in zip(rows, held) if not h]
    field = line_crf.train([r["text"].encode() for r in seen], np.array([r["quality"] for r in seen]))
    good, bad = ([r["text"].encode().split(b"\n") for r, h in zip(rows, held) if h and r["quality"] == q] for q in (1, 0))
    inside, around = [], []
    for host, other in zip([g for g in good if len(g) >= 6] * 3, [b for b in bad if len(b) >= 3]):
        k = len(host) // 2
        told, _, _ = field.lines([b"\n".join(host[:k] + other[:4] + host[k:])])
        inside += list(told[k : k + len(other[:4])])
        around += [*told[:k], *told[k + len(other[:4]) :]]
    assert len(inside) > 10 and np.mean(np.array(inside) < 0.5) > 0.8 and np.mean(np.array(around) > 0.5) > 0.9


def test_document_quality_weighs_lines_by_length():
    field = line_crf.train([b"Good words in a line.\nMore good words here.", b"!!! ###\n%%% $$$ @@@"], np.array([1, 0]), steps=80)
    texts = [b"Good words in a line.\n!!! ###", b""]
    x, doc, size = line_crf.features(texts)
    good, _ = line_crf.marginals(x @ field.weights, doc, field.transition)
    want = (good[0] * size[0] + good[1] * size[1]) / (size[0] + size[1])
    assert field.quality(texts)[0] == pytest.approx(want)

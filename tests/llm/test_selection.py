"""Mixing, decontamination, quotations, training order and the pipeline."""

import itertools
import random
import re

import duckdb
import numpy as np
import pytest

import corpus_pipeline
from kpiloom.llm import decontam, mixing, quotes, training_order
from kpiloom.llm.oracles import ORACLES
from kpiloom.session import cut

from .test_dedup import linked_components, plain_fingerprint

SMALL = "/root/testdata/sf0.001"


def reshared(sizes, weights, total):
    """Targets by the words of the rule: cut at twice the size, share the excess again until none is above."""
    target, capped = {s: 0.0 for s in sizes}, set()
    left = total
    while True:
        free = [s for s in sizes if s not in capped]
        weight = sum(weights[s] for s in free)
        if not free:
            return target
        over = [s for s in free if left * weights[s] / weight > 2 * sizes[s]]
        if not over:
            return target | {s: left * weights[s] / weight for s in free}
        for s in over:
            capped.add(s)
            target[s] = 2.0 * sizes[s]
            left -= target[s]


def test_targets_are_reshared_until_none_is_above(spark):
    rng = random.Random(2)
    for _ in range(3):
        sizes = {f"s{k}": rng.choice([0, 3, 50, 400, 9000]) for k in range(7)} | {None: 77}
        order = sorted(sizes, key=lambda s: (s is None, s or ""))
        weights = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
        df = spark.createDataFrame([(s, n, 1) for s, n in sizes.items()], "source string, source_size long, n long")
        got = {r["source"]: r["target"] for r in mixing.targets(df).collect()}
        want = reshared(sizes, weights, 1.5 * sum(sizes.values()))
        assert got == pytest.approx(want)


def test_mix_of_odd_rows(spark, docs_of, odd_rows):
    rng = random.Random(7)
    rows = list(odd_rows) + [(100 + k, " ".join("ab" for _ in range(rng.randint(1, 60))), rng.choice(["a", "hot", "hot", None]), "en") for k in range(300)]
    df = docs_of(rows, extra=True)
    got = mixing.mix(df).collect()
    assert len(got) == len(rows)
    assert sorted(got, key=str) == sorted(mixing.mix(df.repartition(7)).collect(), key=str)
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    by_source = {}
    for i, t, s, _ in rows:
        by_source.setdefault(s, []).append(size(t))
    total = {}
    for r in got:
        assert r["taken"] in (0, r["size"], 2 * r["size"]) and r["taken"] == r["size"] * r["epochs"]
        source = next(s for i, t, s, _ in rows if i == r["doc_id"])
        assert r["source_size"] == sum(by_source[source]) and r["target"] <= 2 * r["source_size"]
        total.setdefault(source, [0, r["target"]])[0] += r["taken"]
    for source, (taken, target) in total.items():
        assert abs(taken - target) <= max(by_source[source]) / 2
    assert mixing.mix(docs_of([])).count() == 0


def test_heavier_documents_come_first(spark):
    good = [(i, "lower case letters only in this one", "s") for i in range(400)]
    poor = [(1000 + i, "1234 5678 9999 0000 1111 2222 3333", "s") for i in range(400)]
    df = spark.createDataFrame(good + poor, "doc_id long, text string, source string")
    got = mixing.mix(df, share=0.5).toPandas()
    share = got.groupby(got.doc_id < 1000).taken.sum()
    assert share[True] > 1.5 * share[False]


def test_masks_meet_every_two_substitutions():
    window = range(decontam.WINDOW)
    for gone in itertools.chain.from_iterable(itertools.combinations(window, k) for k in (0, 1, 2)):
        assert any(not {s + o for o in m} & set(gone) for m in decontam.MASKS for s in range(decontam.WINDOW - m[-1]))


@pytest.mark.parametrize("n", range(decontam.SHORTEST, decontam.WINDOW))
def test_masks_of_short_items_meet_every_allowed_substitution(n):
    masks = decontam.short_masks(n)
    for k in range(n + 1):
        if n - k >= decontam.SIMILARITY * n:
            for gone in itertools.combinations(range(n), k):
                assert any(not set(m) & set(gone) for m in masks)


def test_short_items_are_met_with_every_allowed_substitution(spark):
    rows, want, items = [], {}, []
    for n in range(decontam.SHORTEST, decontam.WINDOW + 1):
        item = [f"i{n}w{k}" for k in range(n)]
        items.append((n, " ".join(item)))
        most = max(k for k in range(n) if n - k >= decontam.SIMILARITY * n)
        for k in range(most + 2):
            for gone in itertools.combinations(range(n), k):
                if k > most and sum(gone) % 7:  # one too many: a few are enough
                    continue
                body = " ".join(w if p not in gone else "XX" for p, w in enumerate(item))
                for text in (body, f"pre {body} post"):
                    if k <= most:
                        want[len(rows), n] = (n - k, n)
                    rows.append((len(rows), text))
        rows.append((len(rows), " ".join(item[1:])))  # cut off: not the whole item
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = decontam.overlaps(docs, spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r["doc_id"], r["item_id"]): (r["matched"], r["length"]) for r in found} == want


def test_overlaps_tolerate_substitutions(spark, docs_of, odd_rows):
    item = [f"q{k}" for k in range(30)]
    around = lambda words: " ".join(["pre"] * 9 + words + ["post"] * 9)
    two = [w if k not in (4, 8, 17, 21) else "XX" for k, w in enumerate(item)]
    many = [w if k % 4 else "YY" for k, w in enumerate(item)]
    rows = list(odd_rows) + [
        (200, around(item).upper().replace(" ", ",\n"), "s", "en"),
        (201, around(two), "s", "en"),
        (202, around(many), "s", "en"),
        (203, around(item[5:18]), "s", "en"),
        (204, around(item[5:15]), "s", "en"),
        (205, "six tiny words make one item yes", "s", "en"),
        (206, "six tiny words make two items yes", "s", "en"),
        (206, "six tiny words make one item yes", "s", "en"),
    ]
    bench = spark.createDataFrame([(1, " ".join(item)), (1, " ".join(item)), (2, "six tiny words make one item"), (3, None), (4, "the same"), (5, "")], "item_id long, text string")
    docs = docs_of(rows, extra=True)
    got = {(r["doc_id"], r["item_id"]): (r["matched"], r["length"]) for r in decontam.overlaps(docs, bench).collect()}
    assert got == {(200, 1): (13, 13), (201, 1): (11, 13), (203, 1): (13, 13), (205, 2): (6, 6), (206, 2): (6, 6)}
    kept = decontam.decontaminate(docs, bench)
    assert kept.columns == docs.columns and kept.count() == len(rows) - 6
    flags = decontam.verdicts(docs, bench).collect()
    assert len(flags) == len(rows) and sum(r["contaminated"] for r in flags) == 6
    assert decontam.verdicts(docs_of([]), bench).count() == 0
    assert not any(r["contaminated"] for r in decontam.verdicts(docs, bench.where("false")).collect())


@pytest.mark.parametrize("most", [decontam.BROADCAST_SEEDS, 0])
def test_verdicts_equal_plain_alignment(spark, monkeypatch, most):
    """Items of 3 to 30 tokens, planted whole or in part with substitutions, by SQL that knows no masks; seeds broadcast and shuffled."""
    monkeypatch.setattr(decontam, "BROADCAST_SEEDS", most)
    rng = random.Random(12)
    words = [f"w{k}" for k in range(40)]
    items = [(n, " ".join(rng.choices(words, k=n))) for n in (3, 4, 5, 6, 7, 8, 9, 10, 11, 12, 13, 14, 20, 30)]
    docs = []
    for k in range(260):
        item = rng.choice(items)[1].split()
        a = rng.randint(0, max(0, len(item) - 12)) if rng.random() < 0.5 else 0
        part = [w if rng.random() > 0.12 else "other" for w in item[a : a + rng.randint(5, 30)]]
        docs.append((k, " ".join([*rng.choices(words, k=rng.randint(0, 12)), *part, *rng.choices(words, k=rng.randint(0, 12))])))
    frames = [spark.createDataFrame(x, f"{i} long, text string") for x, i in ((docs, "doc_id"), (items, "item_id"))]
    got = {r["doc_id"]: list(r["item_ids"]) for r in decontam.verdicts(*frames).collect()}
    documents, benchmark = (f.toPandas() for f in frames)  # noqa: F841
    want = {r[0]: [int(x) for x in r[3].split(",") if x] for r in duckdb.connect().sql(ORACLES["op6_decontamination"]).fetchall()}
    assert got == want and 40 < sum(map(bool, want.values())) < 250


@pytest.mark.parametrize("name", ["op3_mixing", "op6_decontamination"])
def test_queries_equal_their_sql(spark, name):
    from kpiloom.llm.queries import QUERIES

    con = duckdb.connect()
    for table in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    want = con.sql(ORACLES[name]).df()
    got = QUERIES[name](spark, SMALL).toPandas()[list(want.columns)]
    want, got = (x.sort_values("doc_id", ignore_index=True) for x in (want, got))
    for c in want.columns:
        assert (got[c].to_numpy() == want[c].to_numpy()).all(), c


TALK = [
    (1, 0, "user", "Hello there my friend.\nHow do I bake a good bread at home?"),
    (1, 1, "assistant", "You need flour, water and some patience.\n\nKnead it well for ten minutes."),
    (1, 2, "user", "On Monday bot wrote:\n> Knead it well for\n> ten minutes.\nIs ten minutes enough?"),
    (1, 3, "assistant", "> > Knead it well for ten minutes.\n> Is ten minutes enough?\nYes it is enough."),
    (1, 4, "user", ">How do I bake a good bread at home?\nI mean this one. >> not a quote"),
    (1, 100, "user", "> You need flour, water and some patience.\n> unrelated words here now\nok"),
    (1, 101, "user", None),
    (2, 0, "user", ""),
    (2, 1, "user", "> Hello there my friend.\nanother conversation"),
    (None, None, "x", "a b c d"),
    (None, 0, "x", "> a b c d\nq"),
]


def test_quotes_are_linked_and_removed(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(TALK, "conv_id long, turn long, role string, text string")
    for name in ("position", "key", "block", "runs", "_conv", "linked", "n"):
        df = df.withColumn(name, F.lit(name))
    got = {(r["conv_id"], r["turn"]): r for r in quotes.link_replies(df).collect()}
    assert len(got) == len(TALK)
    replies = {k: (r["reply_to"], r["quoted"], r["n_quotes"], r["n_linked"]) for k, r in got.items()}
    assert replies == {
        (1, 0): (None, False, 0, 0),
        (1, 1): (0, False, 0, 0),
        (1, 2): (1, True, 1, 1),
        (1, 3): (2, True, 2, 2),
        (1, 4): (0, True, 1, 1),
        (1, 100): (1, True, 1, 1),
        (1, 101): (100, False, 0, 0),
        (2, 0): (None, False, 0, 0),
        (2, 1): (0, False, 1, 0),
        (None, None): (None, False, 0, 0),
        (None, 0): (None, False, 1, 0),
    }
    assert got[(1, 2)]["body"] == "Is ten minutes enough?" and got[(1, 101)]["body"] == ""
    assert got[(1, 4)]["body"] == "I mean this one. >> not a quote"
    # Reply order: turn 4 answers turn 0 as turn 1 does, and so comes before turn 2, which answers turn 1.
    places = {t: got[(1, t)]["position"] for t in (0, 1, 2, 3, 4, 100, 101)}
    assert sorted(places.values()) == list(range(1, 8))
    assert all(got[(1, t)]["reply_to"] is None or places[got[(1, t)]["reply_to"]] < at for t, at in places.items())
    assert quotes.link_replies(df.where("false")).count() == 0


def plain_links(rows):
    """Brute force over ``(turn, text)`` of one conversation in order: reply, quoted passages, linked passages, depth."""
    mark = re.compile(r"^(?:[ \t]*>)+[ \t]?")

    def runs_of(text):
        out = []
        for line in (text or "").split("\n"):
            m = mark.match(line)
            level, body = (m.group(0).count(">"), line[m.end() :]) if m else (0, line)
            if out and out[-1][0] == level:
                out[-1][1].append(body)
            else:
                out.append((level, [body]))
        return [(level, "\n".join(lines)) for level, lines in out]

    def forms(body):
        parts = [body, *re.split(r"\n[ \t]*\n", body), *body.split("\n")]
        return {f for f in (re.sub(r"[\W_]+", " ", p.lower()).strip() for p in parts) if f}

    own, out = [], []
    for k, (turn, text) in enumerate(rows):
        runs = runs_of(text)
        body = "\n".join(b.strip() for level, b in runs if level == 0 and b.strip())
        votes, n_linked = {}, 0
        for level, quoted in runs:
            if level and turn is not None:
                met = [(len(f.split(" ")), max(j for j in range(k) if f in own[j])) for f in forms(quoted) if any(f in o for o in own)]
                if met:
                    words, source = max(met)
                    votes[level, source] = votes.get((level, source), 0) + words
                    n_linked += 1
        linked = None
        if votes:
            near = min(level for level, _ in votes)
            linked = max((w, source) for (level, source), w in votes.items() if level == near)[1]
        at = linked if linked is not None else k - 1
        answers = turn is not None and at >= 0 and rows[at][0] is not None
        out.append((rows[at][0] if answers else None, linked is not None, sum(level > 0 for level, _ in runs), n_linked, body, out[at][5] + 1 if answers else 0))
        own.append(forms(body) if turn is not None else set())
    order = sorted(range(len(rows)), key=lambda k: (out[k][5], k))
    return [(*out[k][:5], order.index(k) + 1) for k in range(len(rows))]


@pytest.mark.parametrize(("seed", "block"), [(1, 64), (2, 4), (3, 3)])
def test_links_and_positions_equal_brute_force(spark, monkeypatch, seed, block):
    """Short, nested, repeated and partial quotes in a hot conversation without an id and in others."""
    monkeypatch.setattr(quotes, "BLOCK", block)
    rng = random.Random(seed)
    talks = {}
    for conv, n in ((None, 120), (1, 30), (2, 1), (3, 25)):
        said, rows = [], [(None, "lost words") for _ in range(2 if conv is None else 0)]
        for t in range(n):
            lines = [" ".join(rng.choice(["yes", "no", "why", "ab", "cd ef"]) for _ in range(rng.randint(1, 3))) for _ in range(rng.randint(1, 3))]
            text = "\n".join(lines)
            if said and rng.random() < 0.6:
                old = rng.choice(said).split("\n")
                part = rng.sample(old, rng.randint(1, len(old))) if rng.random() < 0.5 else old
                text = "\n".join("> " * rng.randint(1, 2) + x for x in part) + "\n" + text
                if rng.random() < 0.3:
                    text += "\n>>" + rng.choice(said).split("\n")[0]
            rows.append((10 * t, text))
            said.append("\n".join(lines))
        talks[conv] = rows
    flat = [(conv, t, "user", text, "x") for conv, rows in talks.items() for t, text in rows]
    rng.shuffle(flat)
    df = spark.createDataFrame(flat, "conv_id long, turn long, role string, text string, seq string")
    got = {}
    for r in quotes.link_replies(df).collect():
        got.setdefault(r["conv_id"], []).append((r["turn"], r["reply_to"], r["quoted"], r["n_quotes"], r["n_linked"], r["body"], r["position"]))
    for conv, rows in talks.items():
        want = [(t, *w) for (t, _), w in zip(rows, plain_links(rows))]
        assert sorted(got[conv], key=str) == sorted(want, key=str)


def test_a_quoted_question_of_two_words_is_answered(spark):
    rows = [(1, 1, "user", "Why not?"), (1, 2, "user", "Because."), (1, 3, "user", "> Why not?\nI see."), (1, 4, "user", "> nowhere said")]
    got = {r["turn"]: r for r in quotes.link_replies(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()}
    assert got[3]["reply_to"] == 1 and got[3]["n_linked"] == 1 and got[3]["body"] == "I see."
    assert got[4]["reply_to"] == 3 and got[4]["n_linked"] == 0
    assert [got[t]["position"] for t in (1, 2, 3, 4)] == [1, 2, 3, 4]


def test_equal_turns_and_repeated_messages(spark):
    rows = [(1, 5, "user", f"m{k % 3}") for k in range(300)] + [(None, None, None, None)] * 200
    got = quotes.link_replies(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    assert sorted(r["position"] for r in got if r["conv_id"] == 1) == list(range(1, 301))
    assert sorted(r["position"] for r in got if r["conv_id"] is None) == list(range(1, 201))


def test_permutation_is_a_bijection():
    for total in (1, 2, 3, 5, 16, 17, 1000, 4097):
        slots = training_order.permute(np.arange(total), total, 9)
        assert sorted(slots) == list(range(total))
    a, b = (training_order.permute(np.arange(500), 500, k) for k in (1, 2))
    assert (a != b).mean() > 0.9 and (a == training_order.permute(np.arange(500), 500, 1)).all()


def test_records_hold_every_document(spark, docs_of, odd_rows, tmp_path):
    ranks = training_order.load_ranks(training_order.TOKENIZER)
    plain = training_order.tiktoken.Encoding("plain", pat_str=training_order.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rows = list(odd_rows) + [(20, "  two  spaces ", "a", "en"), (21, "tab\tand \n new", "a", "en"), (22, " lead and trail ", "a", "en")]
    records = training_order.training_order(docs_of(rows, extra=True), length=16, per_shard=64)
    got = records.toPandas().sort_values("slot", ignore_index=True)
    assert (got["slot"] == np.arange(len(got))).all()
    assert (got["shard"] == got["slot"] // 64).all() and (got["shard_byte"] == got["slot"] % 64 * 32).all()
    for ident, text in {(r[0], r[1]) for r in rows}:
        mine = got[got["doc_id"].isna() if ident is None else got["doc_id"] == ident]
        copies = sum(r[0] == ident for r in rows)
        want = [*(plain.encode_ordinary(text) if text else []), training_order.END]
        for part, group in mine.groupby("part"):
            assert len(group) == copies
            ids = np.frombuffer(group["tokens"].iloc[0], "<u2")
            held = want[part * 16 : part * 16 + 16]
            assert len(ids) == 16 and ids[: len(held)].tolist() == held and (ids[len(held) :] == training_order.END).all()
            assert (group["n_tokens"] == len(held)).all()
        assert mine["part"].max() == (len(want) - 1) // 16
    folder = str(tmp_path / "shards")
    shards = training_order.write_shards(records, folder).toPandas()
    assert shards["records"].sum() == len(got)
    for first, n in ((0, len(got)), (60, 10), (len(got) - 1, 1)):
        read = training_order.read_slots(folder, first, n, length=16, per_shard=64)
        assert (read == np.stack([np.frombuffer(t, "<u2") for t in got["tokens"][first : first + n]])).all()
    assert training_order.training_order(docs_of([])).count() == 0


def test_slots_do_not_depend_on_splits_and_shards_have_exact_bounds(spark, docs_of, odd_rows, tmp_path):
    rows = [r for r in odd_rows if r[0] != 4] + [(100 + k, f"text number {k} " * (k % 9), "a", "en") for k in range(400)]
    found = []
    for n in (1, 7):
        path = f"{tmp_path}/s{n}"
        records = training_order.training_order(docs_of(rows).repartition(n), length=16, per_shard=32, path=path)
        found.append(sorted((r["slot"], r["shard"], -1 if r["doc_id"] is None else r["doc_id"], r["part"], bytes(r["tokens"])) for r in records.collect()))
        for folder in sorted((tmp_path / f"s{n}").glob("shard=*")):
            files = list(folder.glob("*.parquet"))
            slots = [r["slot"] for r in spark.read.parquet(str(files[0])).select("slot").collect()]
            first = int(folder.name.split("=")[1]) * 32
            assert len(files) == 1 and slots == list(range(first, first + len(slots)))
    assert found[0] == found[1] and [f[0] for f in found[0]] == list(range(len(found[0])))
    # The partitions of the result are the shards.
    from pyspark.sql import functions as F

    records = training_order.training_order(docs_of(rows), length=16, per_shard=32)
    parts = records.withColumn("pid", F.spark_partition_id()).groupBy("pid").agg(F.min("shard").alias("a"), F.max("shard").alias("b")).collect()
    assert all(r["pid"] == r["a"] == r["b"] for r in parts)


def test_an_id_that_many_rows_share_is_dealt_in_order(spark, docs_of):
    rows = [(5, f"text {k}", "a", "en") for k in range(300)] + [(None, f"lost {k}", "a", "en") for k in range(200)] + [(k, f"t {k}", "a", "en") for k in range(60)]
    table, per = training_order.sequences(docs_of(rows).repartition(5), "doc_id", "text", training_order.TOKENIZER, training_order.END, 8)
    assert max(n for _, n in per) < 330 and len(per) > 4
    order = [r["doc"] for r in table.orderBy("at", "place").collect()]
    assert order == sorted(order, key=lambda d: (d is None, d or 0))


def test_pipeline_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = docs.toPandas()
    rows = rows[rows["text"].map(lambda t: any(c.isalpha() for c in t or ""))]
    fp = np.array([plain_fingerprint(t) for t in rows["text"]], np.uint64)
    near = np.bitwise_count(fp[:, None] ^ fp[None, :]) <= 2
    rows = rows[linked_components(rows["doc_id"].to_numpy(), near) == rows["doc_id"].to_numpy()]
    con = duckdb.connect()
    con.register("documents", rows)
    con.execute(f"CREATE VIEW benchmark AS SELECT * FROM '{SMALL}/benchmark.parquet'")
    leaks = con.sql(ORACLES["op6_decontamination"]).df()
    rows = rows[~rows["doc_id"].isin(leaks.loc[leaks["contaminated"], "doc_id"])]
    out, at = {}, docs
    for name, stage in corpus_pipeline.STAGES:
        at = cut(stage(spark, at, SMALL))
        out[name] = at
        if name != "token_output":
            assert at.columns == docs.columns and at.dtypes == docs.dtypes
    assert sorted(r["doc_id"] for r in out["decontamination"].collect()) == sorted(rows["doc_id"])
    mixed = {r["doc_id"]: r["count"] for r in out["source_mixing"].groupBy("doc_id").count().collect()}
    epochs = mixing.mix(out["decontamination"], text_key=True).where("epochs > 0").collect()
    assert mixed == {r["doc_id"]: r["epochs"] for r in epochs}
    ends = out["token_output"].groupBy("doc_id").agg({"slot": "count", "part": "max"}).collect()
    assert {r["doc_id"]: r["count(slot)"] for r in ends} == {r["doc_id"]: (r["max(part)"] + 1) * mixed[r["doc_id"]] for r in ends}
    assert {r["doc_id"] for r in ends} == set(mixed)
    assert corpus_pipeline.run(spark, SMALL).count() == out["token_output"].count()


def test_stages_take_odd_rows(spark, docs_of, odd_rows):
    for name, stage in corpus_pipeline.STAGES:
        for rows in (odd_rows, []):
            docs = docs_of(rows, extra=True)
            got = cut(stage(spark, docs, SMALL))
            if name != "token_output":
                assert got.columns == docs.columns
            if not rows:
                assert got.count() == 0
            elif name == "language_id":
                assert sorted(r["doc_id"] or -1 for r in got.select("doc_id").collect()) == [-1, 3, 4, 5, 6, 6, 9]
            elif name == "simhash_neardup":
                # Null, empty and blank texts share fingerprint zero; 5, 6 and 6 share one text.
                assert sorted(-1 if r["doc_id"] is None else r["doc_id"] for r in got.select("doc_id").collect()) == [-1, 0, 3, 4, 5, 8, 9]
            elif name == "decontamination":
                assert got.count() == len(rows)


def test_the_rest_imports_without_this_folder():
    import subprocess
    import sys

    code = """
import sys
class Gone:
    def find_spec(self, name, path=None, target=None):
        if name in ("kpiloom.llm", "corpus_pipeline"):
            raise ModuleNotFoundError(f"No module named {name!r}", name=name)
sys.meta_path.insert(0, Gone())
import __spark_entry__ as e
assert not any(n.startswith("op") and "_" in n and n[2].isdigit() for n in e.queries()) and "pipeline" not in e.queries()
assert len(e.queries()) > 100
"""
    root = corpus_pipeline.__file__.rpartition("/")[0]
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True, timeout=120)

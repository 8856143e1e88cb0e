import datetime as dt
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from kpiloom.functions import qos
from kpiloom.operators import episodes, joins, metrics, scaling, split
from kpiloom.operators.quantiles import exact_quantiles
from kpiloom.schema import KPIS, THRESHOLDS

START = dt.datetime(2024, 1, 1)


def minutes(n):
    return START + dt.timedelta(minutes=int(n))


@pytest.mark.parametrize("accuracy", [20, 200, 10_000])
def test_quantiles_are_exact_with_a_hot_cell_and_hot_value(spark, accuracy):
    rng = np.random.default_rng(1)
    rows = pd.DataFrame({"cell_id": np.where(rng.random(6000) < 0.7, "hot", "cold"), "x": rng.normal(size=6000)})
    rows.loc[rng.random(6000) < 0.33, "x"] = 0.25
    rows["y"] = rng.exponential(size=6000)
    table = spark.createDataFrame([(c, minutes(i), float(x), float(y)) for i, (c, x, y) in enumerate(rows.itertuples(index=False))],
                                  "cell_id string, ts timestamp, x double, y double")
    probs = [0.0, 0.02, 0.25, 0.5, 0.75, 0.98, 1.0]
    for by in ("cell_id", None):
        for r in exact_quantiles(table, ["x", "y"], probs, by=by, accuracy=accuracy).collect():
            chosen = rows[rows["cell_id"] == r["cell_id"]] if by else rows
            assert r["value"] == pytest.approx(np.quantile(chosen[r["name"]], r["prob"]), abs=1e-12)


def test_scaler_falls_back_for_an_unseen_cell(spark):
    rng = np.random.default_rng(2)
    rows = [(c, minutes(i), float(v)) for c, at in (("a", 10), ("b", 50)) for i, v in enumerate(rng.normal(at, 3, 200))]
    train = spark.createDataFrame(rows, "cell_id string, ts timestamp, x double")
    scaler = scaling.RobustCellScaler(["x"]).fit(train)
    got = {r["cell_id"]: r["x"] for r in scaler.transform(spark.createDataFrame([("a", START, 12.0), ("new", START, 12.0)], train.schema)).collect()}
    for cell, values in (("a", [v for c, _, v in rows if c == "a"]), ("new", [v for _, _, v in rows])):
        q1, q2, q3 = np.quantile(values, [0.25, 0.5, 0.75])
        assert got[cell] == pytest.approx((12.0 - q2) / (q3 - q1))


def score_rows(spark, rng, n=400, levels=None):
    truth = rng.random(n) < 0.1
    score = rng.normal(size=n) + truth
    if levels:
        score = np.round(score * levels) / levels
    rows = [("d", bool(t), float(s)) for t, s in zip(truth, score)]
    return spark.createDataFrame(rows, "detector string, is_anomaly boolean, score double"), truth, score


def average_precision(truth, score):
    total, area, before = truth.sum(), 0.0, 0.0
    for t in sorted(set(score), reverse=True):
        hit = score >= t
        recall = truth[hit].sum() / total
        area += (recall - before) * truth[hit].mean()
        before = recall
    return area


@pytest.mark.parametrize("levels", [None, 2])
def test_ranking_and_sweep_against_brute_force(spark, levels):
    table, truth, score = score_rows(spark, np.random.default_rng(3), levels=levels)
    got = metrics.ranking_metrics(table).first()
    pairs = [(p > n) + 0.5 * (p == n) for p in score[truth] for n in score[~truth]]
    assert got["pr_auc"] == pytest.approx(average_precision(truth, score))
    assert got["roc_auc"] == pytest.approx(np.mean(pairs))
    cuts = np.unique(np.quantile(score, np.linspace(0.50, 0.9995, 200)))
    curve = metrics.sweep_threshold(table).orderBy("seuil").toPandas()
    np.testing.assert_allclose(curve["seuil"], cuts)
    for row in curve.itertuples():
        hit = score >= cuts[row.Index]
        assert row.taux_alerte_pct == pytest.approx(hit.mean() * 100)
        assert row.rappel == pytest.approx(truth[hit].sum() / truth.sum())
    best = metrics.best_threshold(table).first()
    assert best["seuil"] == pytest.approx(curve.loc[curve["f1"].idxmax(), "seuil"])


def test_ranking_is_null_with_one_class(spark):
    table = spark.createDataFrame([("d", False, 1.0), ("d", False, 2.0)], "detector string, is_anomaly boolean, score double")
    assert metrics.ranking_metrics(table).first()["pr_auc"] is None


def mask_table(spark, masks):
    rows = [(c, minutes(i), bool(y), bool(p)) for c, pairs in masks.items() for i, (y, p) in enumerate(pairs)]
    return spark.createDataFrame(rows, "cell_id string, ts timestamp, is_anomaly boolean, is_anomaly_pred boolean")


def runs_of(mask):
    found, start = [], None
    for i, v in enumerate([*mask, False]):
        if v and start is None:
            start = i
        if not v and start is not None:
            found.append((start, i - 1))
            start = None
    return found


@pytest.mark.parametrize("block_steps", [7, 8192])
def test_episode_metrics_against_brute_force(spark, block_steps):
    rng = np.random.default_rng(4)
    masks = {c: list(zip(np.repeat(rng.random(60) < 0.4, 5), rng.random(300) < 0.3)) for c in "abc"}
    table = mask_table(spark, masks)
    got = {r["cell_id"]: r for r in episodes.episode_metrics(table, block_steps=block_steps).collect()}
    for c, pairs in masks.items():
        y, p = np.array(pairs).T
        real = runs_of(y)
        delays = [int(np.argmax(p[a : b + 1])) for a, b in real if p[a : b + 1].any()]
        false = sum(not y[a : b + 1].any() for a, b in runs_of(p))
        r = got[c]
        assert (r["episodes_reels"], r["episodes_detectes"], r["episodes_fausse_alerte"]) == (len(real), len(delays), false)
        assert r["delai_median_min"] == np.median(delays) and r["delai_max_min"] == max(delays)
        assert r["fausses_alertes_par_heure"] == pytest.approx(false / 5)
    total = episodes.episode_totals(episodes.episode_metrics(table, block_steps=block_steps)).first()
    assert total["delai_median_min"] == np.median([got[c]["delai_median_min"] for c in "abc"])


def test_episodes_stop_at_cell_borders_and_span_blocks(spark):
    table = mask_table(spark, {"a": [(False, False)] * 3 + [(True, False)] * 30, "b": [(True, False)] * 2})
    found = episodes.episodes(table, "is_anomaly", block_steps=8).orderBy("cell_id").collect()
    assert [(r["cell_id"], r["episode_id"], r["points"]) for r in found] == [("a", 1, 30), ("b", 1, 2)]


def test_no_alert(spark):
    table = mask_table(spark, {"a": [(True, False), (False, False)]})
    flat = metrics.confusion(table, ["cell_id"]).first()
    assert (flat["precision"], flat["rappel"], flat["f1"]) == (0, 0, 0)
    assert flat["vp"] + flat["fp"] + flat["vn"] + flat["fn"] == flat["n"] == 2
    assert episodes.episode_metrics(table).first()["delai_median_min"] is None


def test_regression_metrics_skip_missing_pairs(spark):
    rows = [("m", 1.0, 2.0), ("m", 0.0, 1.0), ("m", None, 1.0), ("m", float("nan"), 1.0), ("e", None, 1.0)]
    table = spark.createDataFrame(rows, "model string, y double, y_hat double")
    got = {r["model"]: r for r in metrics.regression_metrics(table, ["model"]).collect()}
    assert got["m"]["n"] == 2 and got["m"]["mae"] == 1.0 and got["m"]["mape"] == pytest.approx((1 + 1e6) / 2 * 100)
    assert got["e"]["n"] == 0 and got["e"]["mae"] is None


def test_state_bounds_and_missing_values(spark):
    rows = [(20.0,), (50.0,), (50.1,), (None,), (float("nan"),)]
    table = spark.createDataFrame(rows, "latency double")
    assert [r["qos_state"] for r in qos.classify(table).collect()] == ["bon", "dégradé", "critique", "bon", "bon"]
    empty = spark.createDataFrame([tuple([None] * 5)], ", ".join(f"{k} double" for k in KPIS))
    assert qos.with_cause(qos.classify(empty)).first()["cause"] == "aucun"


def test_cause_against_brute_force(spark):
    rng = np.random.default_rng(5)
    data = rng.random((300, 5)) * [200, 80, 7, 1.5, 120]
    rows = [tuple(float(v) for v in r) for r in data]
    got = qos.with_cause(spark.createDataFrame(rows, ", ".join(f"{k} double" for k in KPIS))).collect()
    for r in got:
        best = (0, None, 0.0)
        for k in KPIS:
            b, v = THRESHOLDS[k], r[k]
            over = (lambda limit: v > limit) if b.higher_is_worse else (lambda limit: v < limit)
            rank = 2 if over(b.degraded) else 1 if over(b.good) else 0
            far = (v - b.good) / b.good * (1 if b.higher_is_worse else -1)
            if rank > best[0] or (rank == best[0] and far > best[2]):
                best = (rank, k, far)
        assert r["cause_kpi"] == (best[1] if best[0] else "aucun")
        assert (r["cause_excess"] or 0.0) == pytest.approx(best[2] if best[0] else 0.0)


def test_split_sizes_and_purge(spark):
    table = spark.range(20150).select(F.lit("a").alias("cell_id"), F.timestamp_seconds(F.col("id") * 60).alias("ts"))
    parts = split.temporal_split(table)
    sizes = {r["segment"]: r["n"] for r in split.split_summary(parts).collect()}
    assert sizes == {"train": 12090, "val": 3970, "test": 3970}
    split.assert_chronological(parts)
    mixed = parts.withColumn("segment", F.when(F.minute("ts") < 30, "train").otherwise("val"))
    with pytest.raises(split.ChronologyError):
        split.assert_chronological(mixed)
    with pytest.raises(ValueError):
        split.temporal_split(table, train_ratio=0.8, val_ratio=0.3)


def test_label_alignment_guards(spark):
    rows = spark.createDataFrame([("a", START)], "cell_id string, ts timestamp")
    off = spark.createDataFrame([("a", START + dt.timedelta(seconds=41), True)], "cell_id string, ts timestamp, is_anomaly boolean")
    with pytest.raises(joins.LabelAlignmentError):
        joins.align_labels(rows, off)
    with pytest.raises(joins.LabelAlignmentError):
        joins.align_labels(rows, off.limit(0))
    assert joins.align_labels(rows, joins.align_label_minutes(off)).first()["is_anomaly"] is True


def test_targets_follow_time_not_rows(series):
    table = series({"a": range(40)}, skip=(15,))
    got = {r["ts"]: r for r in joins.build_targets(table, table, [5, 15], grid="1 minute").collect()}
    assert got[START]["latency_target_5m"] == 5.0 and got[START]["latency_target_15m"] is None
    # 39 rows: the last five look past the end, and row 10 looks into the hole.
    assert joins.supervised(table, table, [5], "1 minute").count() == 39 - 5 - 1

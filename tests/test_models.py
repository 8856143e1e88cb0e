import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from kpiloom.models import forecasters as fc
from kpiloom.models import detectors, store
from kpiloom.models.detectors import Autoencoder, DensityDetector, IsolationForest, LinearReconstruction, fit_autoencoders
from kpiloom.operators.select import evaluation_origins
from kpiloom.session import new_path

COLUMNS = ["x", "y", "z"]
START = dt.datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def cloud(spark):
    """Two cells of correlated points; every 40th point lies far off."""
    rng = np.random.default_rng(0)
    rows = []
    for c, level in (("a", 0.0), ("b", 100.0)):
        for i in range(600):
            base = rng.normal()
            far = i % 40 == 39
            point = level + np.array([base, base + 0.1 * rng.normal(), -base + 0.1 * rng.normal()]) + (9.0 * rng.choice([-1, 1], 3) if far else 0)
            rows.append((c, START + dt.timedelta(minutes=i), far, *map(float, point)))
    return spark.createDataFrame(rows, "cell_id string, ts timestamp, far boolean, x double, y double, z double").cache()


def separation(scored):
    rows = scored.select("far", "score").collect()
    far, near = [r["score"] for r in rows if r["far"]], [r["score"] for r in rows if not r["far"]]
    return np.mean([f > n for f in far for n in near])


def test_isolation_forest_ranks_outliers_and_reloads(spark, cloud):
    model = IsolationForest(COLUMNS, trees=60, sample=128).fit(cloud)
    scored = model.score(cloud)
    ends = scored.agg(F.min("score"), F.max("score")).first()
    assert 0 < ends[0] and ends[1] < 1 and separation(scored) > 0.98
    assert model.nodes.groupBy("tree").count().count() == 60
    path = new_path(spark, "forest")
    store.save_forest(model, path)
    again = store.load_forest(spark, path, IsolationForest(COLUMNS, trees=60, sample=128), model.points)
    assert again.score(cloud).agg(F.sum("score")).first()[0] == pytest.approx(scored.agg(F.sum("score")).first()[0])


def test_density_detector_against_brute_force(spark, cloud):
    model = DensityDetector(COLUMNS, min_samples=5, max_points=300).fit(cloud)
    sample = model.scaler.vectors(cloud).orderBy("cell_id", "ts").select("_x").collect()
    x = np.array([r["_x"] for r in sample])
    step = len(x) // 300
    pts = x[::step][:300]
    dist = np.sqrt(((pts[:, None, :] - pts[None, :, :]) ** 2).sum(-1))
    eps = np.quantile(np.sort(dist, axis=1)[:, 4], 0.98)
    assert model.eps == pytest.approx(eps, abs=1e-6)
    core = (dist <= eps + 1e-9).sum(axis=1) >= 5
    kept = core | (dist[:, core] <= eps + 1e-9).any(axis=1)
    assert model.noise_ratio == pytest.approx(1 - kept.mean(), abs=0.005)
    want = np.sqrt(((x[:, None, :] - pts[kept][None, :, :]) ** 2).sum(-1)).min(axis=1)
    got = [r["score"] for r in model.score(cloud).orderBy("cell_id", "ts").collect()]
    np.testing.assert_allclose(got, want, atol=1e-9)


def test_density_detector_keeps_every_point_when_all_are_noise(cloud):
    model = DensityDetector(COLUMNS, eps=1e-9, min_samples=5, max_points=100).fit(cloud)
    assert model.noise_ratio == 1.0 and model.kept.count() == 100


@pytest.mark.parametrize("few", [None, 0])
def test_density_detector_fits_all_rows(spark, cloud, few):
    """By all pairs of few rows and by rings of cells, against brute force over all rows."""
    assert DensityDetector(COLUMNS).max_points is None
    model = DensityDetector(COLUMNS, min_samples=5, few=few).fit(cloud)
    x = np.array([r["_x"] for r in model.scaler.vectors(cloud).orderBy("cell_id", "ts").select("_x").collect()])
    dist = np.sqrt(((x[:, None, :] - x[None, :, :]) ** 2).sum(-1))
    assert model.eps == pytest.approx(np.quantile(np.sort(dist, axis=1)[:, 4], 0.98), abs=1e-9)
    core = (dist <= model.eps).sum(axis=1) >= 5
    kept = core | (dist[:, core] <= model.eps).any(axis=1)
    assert len(x) > 1000 and model.kept.count() == kept.sum()
    scored = model.score(cloud).orderBy("cell_id", "ts")
    np.testing.assert_allclose([r["score"] for r in scored.collect()], dist[:, kept].min(axis=1), atol=1e-9)
    assert scored.columns == [*cloud.columns, "score"]


def test_density_detector_does_not_stop_at_twenty_thousand_rows(spark):
    """The last two cells have a second place of many rows, beyond the first 20 000 rows: it is no anomaly."""
    rows = spark.range(20_200).select(
        F.format_string("c%05d", F.floor(F.col("id") / 101)).alias("cell_id"),
        F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") * 3600).alias("ts"),
        *[(F.when((F.col("id") >= 20_000) & (F.col("id") % 5 == 0), 50.0).otherwise(0.0) + F.rand(k)).alias(c) for k, c in enumerate(COLUMNS)],
    ).cache()
    model = DensityDetector(COLUMNS, eps=4.0, min_samples=5).fit(rows)
    assert model.kept.where("cell_id = 'c00199'").count() == 101
    assert model.score(rows).where("x > 40").agg(F.max("score")).first()[0] < 1e-3


def test_autoencoder_learns_explains_and_reloads(spark, cloud):
    start = Autoencoder(COLUMNS, hidden=(4, 2, 4), max_iter=1).fit(cloud)
    model = Autoencoder(COLUMNS, hidden=(4, 2, 4), max_iter=12).fit(cloud)
    error = lambda m: m.score(cloud.where("NOT far")).agg(F.avg("score")).first()[0]
    assert error(model) < error(start) and model.rows_kept < 1200
    assert separation(model.score(cloud)) > 0.9
    told = model.explain(cloud, 2).select("causes").first()["causes"].split(", ")
    assert len(told) == 2 and set(told) <= set(COLUMNS)
    path = new_path(spark, "net")
    store.save_autoencoder(model, path)
    again = store.load_autoencoder(spark, path, Autoencoder(COLUMNS, hidden=(4, 2, 4)))
    assert error(again) == pytest.approx(error(model))


def test_autoencoder_does_not_depend_on_the_layout(cloud):
    fitted = [Autoencoder(COLUMNS, hidden=(4, 2, 4), max_iter=5).fit(cloud.repartition(n)).weights for n in (1, 7)]
    np.testing.assert_allclose(*fitted, rtol=1e-6, atol=1e-8)


def test_shapes_fitted_together_equal_those_fitted_alone(cloud, monkeypatch):
    """A pass for all shapes, each with its own trim and stop, and a task per shape."""
    shapes = [dict(hidden=(4, 2, 4), trim=0.05, max_iter=4), dict(hidden=(3,), trim=0.0, max_iter=7)]
    alone = [Autoencoder(COLUMNS, **s).fit(cloud) for s in shapes]
    monkeypatch.setattr(detectors, "LOCAL_ROWS", 0)
    together = fit_autoencoders([Autoencoder(COLUMNS, **s) for s in shapes], cloud)
    for a, b, s in zip(alone, together, shapes):
        assert (a.rows_kept, a.epochs) == (b.rows_kept, b.epochs) and a.epochs <= s["max_iter"]
        np.testing.assert_allclose(a.weights, b.weights, rtol=1e-5, atol=1e-7)


def test_forest_draws_from_all_rows(spark):
    """Far more rows than trees times sample: hardly any row is drawn twice, from every part of the table."""
    rows = spark.range(200_000).select(
        F.concat(F.lit("c"), F.col("id") % 4).alias("cell_id"), F.timestamp_seconds("id").alias("ts"), F.array(F.col("id").cast("double")).alias("_x")
    )
    model = IsolationForest(["x"], trees=40, sample=64)
    drawn = model._draw(rows, 64 / 200_000).select("tree", F.col("_x")[0].alias("x")).toPandas()
    assert abs(len(drawn) - 40 * 64) < 250 and drawn["tree"].nunique() == 40
    assert drawn["x"].nunique() > 0.97 * len(drawn)
    assert drawn["x"].mean() == pytest.approx(100_000, rel=0.05) and drawn["tree"].mean() == pytest.approx(19.5, abs=1)


def test_autoencoder_gradient():
    model = Autoencoder(COLUMNS, hidden=(4, 2, 4))
    net, rng = model.net, np.random.default_rng(0)
    w, x = net.start(1), rng.normal(size=(16, 3))
    loss = lambda v: 0.5 * ((net.forward(v, x)[-1] - x) ** 2).sum() / len(x)
    g = net.gradient(w, x, 0.0)
    for i in rng.choice(len(w), 12, replace=False):
        step = np.zeros_like(w)
        step[i] = 1e-6
        assert g[i] == pytest.approx((loss(w + step) - loss(w - step)) / 2e-6, abs=1e-5)


def test_linear_reconstruction(cloud):
    assert separation(LinearReconstruction(COLUMNS, 1).fit(cloud).score(cloud)) > 0.8


def test_autoregression_helpers():
    rng = np.random.default_rng(7)
    y = [0.0]
    for _ in range(3000):
        y.append(1.0 + 0.8 * y[-1] + 0.1 * rng.normal())
    y = np.array(y)
    path = fc.project(y, (1, 0, 0), 30)
    assert path[0] == pytest.approx(1.0 + 0.8 * y[-1], abs=0.05) and path[-1] == pytest.approx(5.0, abs=0.2)
    walk = np.cumsum(rng.normal(size=2000))
    assert np.isfinite(fc.project(walk, (2, 1, 1), 30)).all()
    assert list(fc.project(np.ones(8), (2, 0, 1), 3)) == [1, 1, 1]


def test_the_order_does_not_depend_on_the_unit():
    rng = np.random.default_rng(11)
    for _ in range(10):
        y = [0.0]
        for _ in range(800):
            y.append(0.6 * y[-1] + rng.normal())
        y = np.array(y)
        orders = {fc.choose_order(fc.series_moments(scale * y + level)) for scale, level in ((1e-3, 0), (1, 50), (1e3, -7))}
        assert len(orders) == 1
    walk = np.cumsum(rng.normal(size=4000))
    assert np.isfinite(fc.project(walk, fc.choose_order(fc.series_moments(walk)), 30)).all()


def test_criteria_equal_regressions_on_common_points():
    rng = np.random.default_rng(5)
    y = np.cumsum(rng.normal(size=600)) * 0.1 + rng.normal(size=600)
    centred, start = y - y.mean(), fc.DEEPEST
    best = []
    for p, d, q in fc.CANDIDATE_ORDERS:
        z = np.concatenate([np.full(d, np.nan), np.diff(centred, d)]) if d else centred
        at = lambda k: z[start - k : len(z) - k]
        one = [] if d else [np.ones(len(y) - start)]
        inputs = one + [at(k) for k in range(1, p + 1)]
        if q:
            long = np.linalg.lstsq(np.column_stack(one + [at(k) for k in range(1, 11)]), at(0), rcond=None)[0]
            inputs.append(at(1) - np.column_stack(one + [at(k) for k in range(2, 12)]) @ long)
        x = np.column_stack(inputs)
        beta = np.linalg.lstsq(x, at(0), rcond=None)[0]
        rss = ((at(0) - x @ beta) ** 2).sum()
        best.append((len(at(0)) * np.log(rss / len(at(0))) + 2 * (len(beta) + 1), (p, d, q)))
    assert fc.choose_order(fc.series_moments(y)) == min(best)[1]


def test_orders_use_all_rows_of_a_series(spark, series):
    rng = np.random.default_rng(2)
    y = [0.0]
    for _ in range(900):
        y.append(0.7 * y[-1] + rng.normal())
    history = series({"a": y, "b": np.cumsum(rng.normal(size=500)).tolist()}, skip=range(300, 340))
    sums = {(r["cell_id"], r["kpi"]): r["moments"] for r in fc.lag_moments(history, "1 minute").collect()}
    full = history.toPandas().sort_values("ts")
    for cell in "ab":
        want = fc.series_moments(full.loc[full["cell_id"] == cell, "latency"].to_numpy())
        np.testing.assert_allclose(sums[cell, "latency"], want[np.triu_indices(fc.DEEPEST + 2)], rtol=1e-6, atol=1e-6)
    model = fc.AutoRegression(history, "1 minute").fit(history)
    assert model.orders.count() == 2 * len(fc.KPIS)


def plain_forecast(series, order, steps):
    """The rule of the fit written with matrices: rows with ``DEEPEST`` earlier points, errors of a longer regression."""
    p, d, q = order
    deep, long = fc.DEEPEST, fc.LONG_LAG
    z = np.concatenate([[np.nan], np.diff(series)]) if d else series
    t = np.arange(deep, len(series))
    ones = [] if d else [np.ones(len(t))]
    lag = lambda v, k: v[t - k]
    inputs = [*ones, *[lag(z, k) for k in range(1, p + 1)]]
    if q:
        b = np.linalg.lstsq(np.column_stack([*ones, *[lag(z, k) for k in range(1, long + 1)]]), lag(z, 0), rcond=None)[0]
        error = lambda at: z[at] - np.dot(b, [*([] if d else [1.0]), *[z[at - k] for k in range(1, long + 1)]])
        inputs.append(np.array([error(i - 1) for i in t]))
    beta = np.linalg.lstsq(np.column_stack(inputs), lag(z, 0), rcond=None)[0]
    past, e, path = list(z[::-1][:p]), error(len(z) - 1) if q else 0.0, []
    for _ in range(steps):
        x = [*([] if d else [1.0]), *past, *([e] if q else [])]
        path.append(float(np.dot(beta, x)))
        past, e = [path[-1], *past[: p - 1]], 0.0
    return series[-1] + np.cumsum(path) if d else np.array(path)


@pytest.mark.parametrize("order", fc.CANDIDATE_ORDERS)
def test_a_fit_from_moments_equals_one_from_rows(order):
    rng = np.random.default_rng(4)
    y = [50.0, 51.0]
    for _ in range(200):
        y.append(20 + 0.9 * y[-1] - 0.3 * y[-2] + rng.normal())
    np.testing.assert_allclose(fc.project(np.array(y), order, 30), plain_forecast(np.array(y), order, 30), rtol=1e-6)


def test_rolling_sums_equal_a_fit_per_origin(spark, series, monkeypatch):
    """Every row an origin, contexts that overlap, nulls in one KPI, a hole, and blocks shorter than a context."""
    monkeypatch.setattr(fc, "BLOCK_STEPS", 64)
    rng = np.random.default_rng(5)
    walk = np.cumsum(rng.normal(size=260)).tolist()
    history = series({"a": walk, "b": rng.normal(size=70).tolist()}, skip=range(100, 130))
    history = history.withColumn("jitter", F.when(F.minute("ts") % 7 != 3, F.col("jitter")))
    model = fc.AutoRegression(history, "1 minute", horizons=[1, 5], context=80, least=30).fit(history)
    got = {(r["cell_id"], r["ts"], r["kpi"], r["horizon_min"]): r["y_hat"] for r in model.forecasts(history).collect()}
    orders = {(r["cell_id"], r["kpi"]): (r["p"], r["d"], r["q"]) for r in model.orders.collect()}
    full = history.toPandas().sort_values("ts")
    for cell in "ab":
        mine = full[full["cell_id"] == cell]
        for kpi in ("latency", "jitter"):
            for at in range(5, len(mine), 11):
                known = mine.iloc[: at + 1][kpi].dropna().to_numpy()[-80:]
                value = got[cell, mine["ts"].iloc[at], kpi, 5]
                if len(known) < 30:
                    assert value is None
                else:
                    assert value == pytest.approx(fc.project(known, orders[cell, kpi], 5)[-1], rel=1e-6, abs=1e-6)


def test_contexts_are_the_last_rows(spark, series):
    history = series({"a": range(500), "b": range(80)}, skip=range(100, 130))
    model = fc.AutoRegression(history, "1 minute", context=60)
    origins = evaluation_origins(history, "1 minute", 50)
    assert origins.groupBy("cell_id").count().where("cell_id = 'a'").first()["count"] == 10
    rows = model.contexts(origins).toPandas()
    full = history.toPandas().sort_values("ts")
    for (cell, origin), group in rows.groupby(["cell_id", "origin"]):
        want = full[(full["cell_id"] == cell) & (full["ts"] <= origin)].tail(60)
        assert sorted(group["ts"]) == list(want["ts"])


def test_boosted_trees_choose_a_loss_and_code_unseen_cells(spark):
    rng = np.random.default_rng(3)
    rows = [(c, START + dt.timedelta(minutes=i), float(v), float(3 * v)) for c in "ab" for i, v in enumerate(rng.random(120))]
    table = spark.createDataFrame(rows, "cell_id string, ts timestamp, latency_mean_5m double, latency_target_5m double")
    model = fc.BoostedTrees(["latency"], [5], trees=5, depth=3, columns=1.0).fit(table, table)
    log = model.selection_table(spark).collect()
    assert len(log) == 2 and sum(r["retenu"] for r in log) == 1
    assert min(log, key=lambda r: r["mae_validation"])["retenu"]
    unseen = table.limit(3).withColumn("cell_id", F.lit("z"))
    assert model.predict(unseen, "latency", 5).where("y_hat IS NULL").count() == 0
    assert model.feature_importance(spark, "latency", 5, 1).first()["feature"] == "latency_mean_5m"
    with pytest.raises(KeyError):
        model.forecast("jitter", 5)
    path = new_path(spark, "trees")
    model.save(path)
    again = fc.BoostedTrees.load(spark, path)
    assert again.inputs == model.inputs and again.settings == model.settings
    total = lambda m: m.predict(table, "latency", 5).agg(F.sum("y_hat")).first()[0]
    assert total(again) == pytest.approx(total(model))


def test_every_model_is_stored_with_all_it_needs(spark, cloud, series):
    """Scores of reloaded models equal those of the fitted ones."""
    models = [
        detectors.ThresholdDetector(suffix=""),
        IsolationForest(COLUMNS, trees=20, sample=32),
        DensityDetector(COLUMNS, min_samples=5),
        Autoencoder(COLUMNS, hidden=(3,), max_iter=3),
        LinearReconstruction(COLUMNS, 2),
    ]
    for k in fc.KPIS:
        cloud = cloud.withColumn(k, F.col("x"))
    for model in models:
        path = new_path(spark, "model")
        fitted = model.fit(cloud)
        store.save(spark, fitted, path)
        again = store.load(spark, path)
        assert type(again) is type(model) and getattr(again, "columns", None) == getattr(model, "columns", None)
        want = {(r["cell_id"], r["ts"]): r["score"] for r in fitted.score(cloud).collect()}
        got = {(r["cell_id"], r["ts"]): r["score"] for r in again.score(cloud).collect()}
        assert got == pytest.approx(want)
    history = series({"a": np.sin(np.arange(200)).tolist()})
    arima = fc.AutoRegression(history, "1 minute", horizons=[5], context=100).fit(history)
    for model in (fc.Persistence(), fc.MovingAverage(), fc.SeasonalNaive(history, "1 minute", [5]), arima):
        path = new_path(spark, "model")
        store.save(spark, model, path)
        again = store.load(spark, path, history)
        assert type(again) is type(model)
    want = sorted(map(tuple, arima.forecasts(history.limit(90)).collect()), key=str)
    assert sorted(map(tuple, again.forecasts(history.limit(90)).collect()), key=str) == want
    with pytest.raises(ValueError):
        store.load(spark, path)

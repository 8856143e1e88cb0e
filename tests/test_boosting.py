"""Boosted trees against plain code on the same sums, and their invariants."""

import numpy as np
import pytest

from kpiloom.models import boosting
from kpiloom.models.boosting import ABSOLUTE, SQUARED, Booster, Settings


def rows_of(rng, n):
    x = rng.normal(size=(n, 3))
    x[:, 2] = np.round(x[:, 2])
    a = np.where(x[:, 0] > 0.3, 5.0, -1.0) + x[:, 2]
    b = 3 * x[:, 1] + (rng.random(n) < 0.05) * 80
    return [(i, *map(float, x[i]), float(a[i]), None if i % 17 == 0 else float(b[i])) for i in range(n)]


def table(spark, rows, parts=2):
    return spark.createDataFrame(rows, "id long, x0 double, x1 double, x2 double, a double, b double").repartition(parts)


def plain_model(x, y, edges, loss, settings):
    """The same rule written as loops over one model without samples."""
    seen = ~np.isnan(y)
    bins = boosting.binned(x, edges)
    margin = np.full(len(x), y[seen].mean() if loss == SQUARED else np.median(y[seen]))
    spread = np.subtract(*np.quantile(y[seen], [0.75, 0.25]))
    for _ in range(settings.trees):
        r = np.where(seen, y - margin, 0.0)
        h = seen * (1.0 if loss == SQUARED else 1.0 / np.maximum(np.abs(r), 1e-3 * spread))
        g = r * h
        step = np.zeros(len(x))
        groups = [np.arange(len(x))]
        for _level in range(settings.depth):
            after = []
            for rows in groups:
                rows_seen = rows[seen[rows]]
                ridge = settings.ridge * h[rows].sum() / max(len(rows_seen), 1)
                worth = lambda q: g[q].sum() ** 2 / max(h[q].sum() + ridge, 1e-300)  # noqa: B023, E731
                best = (1e-12, None)
                for f in range(x.shape[1]):
                    for b in range(len(edges[f])):
                        low, high = rows[bins[rows, f] <= b], rows[bins[rows, f] > b]
                        if seen[low].sum() and seen[high].sum():
                            gain = worth(low) + worth(high) - worth(rows)
                            if gain > best[0] * (1 + 1e-9):
                                best = (gain, (low, high))
                if best[1] is not None:
                    for side in best[1]:
                        step[side] = settings.rate * g[side].sum() / (h[side].sum() + ridge)
                        after.append(side)
            groups = after
        margin = margin + step
    return margin


@pytest.mark.parametrize(("block", "local"), [(80, 0), (80, 10_000)])
def test_equals_plain_code(spark, monkeypatch, block, local):
    """A pass per level over several blocks, and a task per model."""
    monkeypatch.setattr(boosting, "BLOCK", block)
    monkeypatch.setattr(boosting, "LOCAL_ROWS", local)
    monkeypatch.setattr(boosting, "KEPT_TREES", 2)
    rows = rows_of(np.random.default_rng(5), 300)
    settings = Settings(trees=4, depth=3, rate=0.3, rows=1.0, columns=1.0)
    df = table(spark, rows)
    model = Booster(["x0", "x1", "x2"], ["a", "b"], [SQUARED, ABSOLUTE], settings, bins=16).fit(df, ["id"])
    got = {r["id"]: r["p"] for r in model.predict(df, "p").select("id", "p").collect()}
    x = np.array([r[1:4] for r in rows])
    for m, (target, loss) in enumerate(model.pairs):
        y = np.array([np.nan if r[4 + "ab".index(target)] is None else r[4 + "ab".index(target)] for r in rows])
        want = plain_model(x, y, model.edges, loss, settings)
        np.testing.assert_allclose([got[r[0]][m] for r in rows], want, atol=1e-9)


def test_samples_do_not_depend_on_partitions_and_learn(spark):
    rows = rows_of(np.random.default_rng(6), 500)
    settings = Settings(trees=30, depth=4, rate=0.2)
    fits = [Booster(["x0", "x1", "x2"], ["a", "b"], [SQUARED, ABSOLUTE], settings).fit(table(spark, rows, p), ["id"]) for p in (1, 5)]
    told, other = ({r["id"]: r["p"] for r in f.predict(table(spark, rows), "p").collect()} for f in fits)
    np.testing.assert_allclose([told[i] for i in told], [other[i] for i in told], atol=1e-6)
    for m, (target, loss) in enumerate(fits[0].pairs):
        at = 4 + "ab".index(target)
        y = np.array([r[at] for r in rows if r[at] is not None])
        p = np.array([told[r[0]][m] for r in rows if r[at] is not None])
        assert np.abs(y - p).mean() < 0.75 * np.abs(y - fits[0].base[m]).mean()
        error = (y - p) ** 2 if loss == SQUARED else np.abs(y - p)
        rival = np.array([told[r[0]][m ^ 1] for r in rows if r[at] is not None])
        assert target == "a" or error.mean() < ((y - rival) ** 2 if loss == SQUARED else np.abs(y - rival)).mean()
    assert sum(v for _, v in fits[0].importance(("a", SQUARED))) == pytest.approx(1)


def test_constant_and_missing_columns(spark):
    df = spark.createDataFrame([(i, 1.0, None, 4.0) for i in range(20)], "id long, x double, z double, y double")
    model = Booster(["x", "z"], ["y"], [SQUARED], Settings(trees=2, depth=2)).fit(df, ["id"])
    assert {r["p"][0] for r in model.predict(df, "p").collect()} == {4.0}

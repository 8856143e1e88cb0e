"""The neighbour join against all pairs."""

import numpy as np
import pytest

from kpiloom.operators import neighbours as nb


def table(spark, x):
    return spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(x)], "_q long, _x array<double>").repartition(3)


def clouds(rng, n, width):
    """A dense place that holds a third of all points, a wide cloud, repeated points and far ones."""
    dense = rng.normal(0, 0.01, (n // 3, width))
    wide = rng.normal(0, 1, (n // 2, width)) * np.linspace(0.2, 3, width)
    far = rng.normal(0, 500, (7, width))
    return np.vstack([dense, wide, far, np.repeat(wide[:2], 15, axis=0)])


def all_pairs(q, p):
    return np.sort(np.sqrt(((q[:, None, :] - p[None, :, :]) ** 2).sum(-1)), axis=1)


@pytest.mark.parametrize(("width", "k", "few"), [(2, 1, 8), (9, 4, 40), (5, 3, None)])
def test_nearest_equals_all_pairs(spark, monkeypatch, width, k, few):
    monkeypatch.setattr(nb, "CHUNK", 64)  # cells of several chunks and blocks
    rng = np.random.default_rng(width)
    p, q = clouds(rng, 420, width), clouds(rng, 130, width)
    got = {r["_q"]: r["d"] for r in nb.nearest(table(spark, q), table(spark, p).drop("_q"), k, width, few=few).collect()}
    want = all_pairs(q, p)[:, :k]
    assert sorted(got) == list(range(len(q)))
    np.testing.assert_allclose([got[i] for i in range(len(q))], want, atol=1e-9)


def test_a_share_leaves_out_only_the_farthest(spark):
    rng = np.random.default_rng(8)
    x = clouds(rng, 600, 4)
    df = table(spark, x)
    got = {r["_q"]: r["d"][-1] for r in nb.nearest(df, df, 6, 4, share=0.9, few=8).collect()}
    kth = all_pairs(x, x)[:, 5]
    assert len(got) >= 0.9 * len(x)
    np.testing.assert_allclose([got[i] for i in got], [kth[i] for i in got], atol=1e-9)
    assert max(got.values()) <= min([kth[i] for i in range(len(x)) if i not in got], default=np.inf)


@pytest.mark.parametrize("few", [0, None])
def test_within_a_radius(spark, few):
    rng = np.random.default_rng(9)
    p, q = rng.normal(0, 1, (300, 3)), rng.normal(0, 2, (200, 3))
    got = {r["_q"]: r["d"] for r in nb.nearest(table(spark, q), table(spark, p), 3, 3, within=0.4, few=few).collect()}
    want = {i: [v for v in row[:3] if v <= 0.4] for i, row in enumerate(all_pairs(q, p))}
    assert {i: len(v) for i, v in got.items()} == {i: len(v) for i, v in want.items() if v}
    for i, v in got.items():
        np.testing.assert_allclose(v, want[i], atol=1e-9)


def test_few_points_and_none(spark):
    x = np.array([[0.0, 1.0], [2.0, 3.0]])
    got = {r["_q"]: r["d"] for r in nb.nearest(table(spark, x), table(spark, x), 20, 2).collect()}
    assert all(len(v) == 2 for v in got.values())
    none = table(spark, x).limit(0)
    assert nb.nearest(none, table(spark, x), 2, 2).collect() == nb.nearest(table(spark, x), none, 2, 2).collect() == []

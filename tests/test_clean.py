import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from kpiloom.functions.timegrid import grid_us
from kpiloom.operators import clean
from kpiloom.schema import KPIS


def values(df, column="throughput"):
    rows = df.orderBy("cell_id", "ts").select(column).collect()
    return [None if r[0] is None else round(r[0], 9) for r in rows]


@pytest.mark.parametrize(
    "given, expected",
    [
        ([0, *[None] * 6, 7], [0, 1, 2, 3, 4, 5, 6, 7]),
        ([0, *[None] * 7, 8], [0, 1, 2, 3, None, 5, 6, 7, 8]),
        ([*[None] * 5, 1, 2, *[None] * 5], [None, None, 1, 1, 1, 1, 2, 2, 2, 2, None, None]),
        ([None, None], [None, None]),
    ],
)
@pytest.mark.parametrize("block_steps", [4, 8192])
def test_fill_reaches_three_steps_from_each_side(series, given, expected, block_steps):
    filled = clean.fill_gaps(series({"a": given}), whole_grid=True, block_steps=block_steps)
    assert values(filled) == expected


@pytest.mark.parametrize("seed", range(3))
def test_fill_matches_pandas_on_missing_rows(spark, seed):
    rng = np.random.default_rng(seed)
    start = pd.Timestamp("2024-01-01")
    frames = []
    for cell in "ab":
        keep = np.flatnonzero(rng.random(300) < 0.25)
        frame = pd.DataFrame({"cell_id": cell, "ts": start + pd.to_timedelta(keep, "min")})
        for k in KPIS:
            frame[k] = np.where(rng.random(len(keep)) < 0.7, rng.random(len(keep)) * 100, np.nan)
        frames.append(frame)
    rows = pd.concat(frames, ignore_index=True)
    plain = [
        (c, t.to_pydatetime(), *[None if np.isnan(v) else float(v) for v in vs])
        for c, t, *vs in rows.itertuples(index=False)
    ]
    table = spark.createDataFrame(plain, "cell_id string, ts timestamp, " + ", ".join(f"{k} double" for k in KPIS))
    want = []
    for cell, group in rows.groupby("cell_id"):
        grid = group.set_index("ts")[KPIS].resample("1min").mean()
        flags = grid["throughput"].isna()
        grid = grid.interpolate(method="linear", limit=3, limit_direction="both")
        want.append(grid.assign(is_missing=flags, cell_id=cell).reset_index())
    want = pd.concat(want).dropna(subset=["throughput", "latency"]).sort_values(["cell_id", "ts"], ignore_index=True)
    for block in (16, 8192):
        got = clean.drop_long_gaps(clean.fill_gaps(table, block_steps=block)).toPandas()
        got = got.sort_values(["cell_id", "ts"], ignore_index=True)
        assert list(got["ts"]) == list(want["ts"]) and list(got["is_missing"]) == list(want["is_missing"])
        np.testing.assert_allclose(got[KPIS].astype(float), want[KPIS], atol=1e-9)


def test_clip_keeps_null_and_bounds(series):
    table = series({"a": [-3, None, 250]})
    assert values(clean.clip_bounds(table)) == [0.0, None, 250.0]
    assert values(clean.clip_bounds(table), "packet_loss") == [0.0, None, 100.0]


def test_first_arrival_wins(spark):
    now = dt.datetime(2024, 1, 1)
    rows = [("a", now, 5.0, "batch", now + dt.timedelta(minutes=1)), ("a", now, 3.0, "stream", now)]
    table = spark.createDataFrame(rows, "cell_id string, ts timestamp, throughput double, source string, ingested_at timestamp")
    assert clean.dedupe_first(table).select("throughput").collect()[0][0] == 3.0


def test_label_hole(spark):
    start = dt.datetime(2024, 1, 1)
    rows = [("a", start + dt.timedelta(minutes=m, seconds=41), True) for m in (0, 1, 3)]
    table = spark.createDataFrame(rows, "cell_id string, ts timestamp, is_anomaly boolean")
    on_grid = clean.labels_on_grid(table).orderBy("ts").collect()
    assert [r["is_anomaly"] for r in on_grid] == [True, True, False, True]
    assert clean.labels_by_floor(table).count() == 3


def test_long_gap_on_the_grid_crosses_blocks(spark):
    start = dt.datetime(2024, 1, 1)
    rows = [("a", start, 1.0), ("a", start + dt.timedelta(minutes=1000), 2.0)]
    table = spark.createDataFrame(rows, "cell_id string, ts timestamp, throughput double")
    grid = clean.regular_grid(table, block_steps=64)
    assert grid.count() == 1001 and grid.where(F.col("throughput").isNotNull()).count() == 2
    assert grid.select("ts").distinct().count() == 1001


def test_grid_names():
    assert grid_us("10 minutes") == 600_000_000
    with pytest.raises(ValueError):
        grid_us("a while")

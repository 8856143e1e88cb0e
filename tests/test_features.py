import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from kpiloom.operators import clean, explore, features, monitor, select
from kpiloom.operators.blocks import with_position
from kpiloom.schema import KPIS, feature_names
from kpiloom.sources.events import load_raw
from conftest import SMALL


@pytest.fixture(scope="module")
def holed(spark):
    """Series with long holes: ten-minute steps of the smallest table."""
    from kpiloom.session import cut

    return cut(clean.clean_series(load_raw(spark, SMALL), "10 minutes"))


def frame(df):
    return df.toPandas().sort_values(["cell_id", "ts"], ignore_index=True)


def pandas_features(history):
    parts = []
    for cell, group in history.groupby("cell_id"):
        s = group.set_index("ts").sort_index()
        out = pd.DataFrame(index=s.index)
        for k in KPIS:
            for w in (5, 15, 30):
                out[f"{k}_mean_{w}m"] = s[k].rolling(f"{w * 10}min").mean()
            out[f"{k}_std_15m"] = s[k].rolling("150min").std()
            for n in (1, 5, 10):
                out[f"{k}_lag_{n}"] = s[k].shift(n)
            out[f"{k}_hour_mean"] = s[k].rolling("600min").mean()
        out["cell_load_hour_max"] = s["cell_load"].rolling("600min").max()
        out["hour_of_day"], out["day_of_week"] = s.index.hour, s.index.dayofweek
        parts.append(out.dropna().reset_index().assign(cell_id=cell))
    return pd.concat(parts).sort_values(["cell_id", "ts"], ignore_index=True)


@pytest.mark.parametrize("block_steps", [64, 8192])
def test_features_match_pandas_across_blocks_and_holes(holed, block_steps):
    got = frame(features.build_features(holed, "10 minutes", block_steps=block_steps))
    want = pandas_features(frame(holed))
    assert list(got["ts"]) == list(want["ts"]) and len(got) > 200
    np.testing.assert_allclose(got[feature_names()].astype(float), want[feature_names()].astype(float), rtol=1e-7, atol=1e-6)
    assert len(got.columns) == 45


def test_lags_count_rows_across_holes(holed):
    a = frame(features.lags(holed, "10 minutes", block_steps=8))
    history = frame(holed)
    want = history.groupby("cell_id")["latency"].shift(10)
    np.testing.assert_allclose(a["latency_lag_10"].astype(float), want.astype(float), equal_nan=True)


def test_positions_and_gaps_do_not_depend_on_blocks(holed):
    for block in (8, 8192):
        rows = frame(with_position(holed, "10 minutes", block, totals=True))
        assert (rows["_pos"] == rows.groupby("cell_id").cumcount()).all()
        assert (rows["_rows"] == rows.groupby("cell_id")["ts"].transform("size")).all()
        gaps = {r["cell_id"]: r["irregular"] for r in explore.grid_gaps(holed, "10 minutes", block).collect()}
        deltas = frame(holed).groupby("cell_id")["ts"].apply(lambda s: (s.diff().dropna() != pd.Timedelta("10min")).sum())
        assert gaps == deltas.to_dict()


def test_autocorrelation_does_not_depend_on_blocks(holed):
    got = explore.autocorrelation(holed, "10 minutes", [1, 5, 30], block_steps=32).where("kpi = 'latency'").collect()
    history = frame(holed)
    for r in got:
        want = history[history["cell_id"] == r["cell_id"]]["latency"].autocorr(r["lag"])
        assert abs(r["autocorr"] - want) < 1e-9


def test_point_delta_does_not_depend_on_blocks(spark):
    raw = load_raw(spark, SMALL)
    a = frame(monitor.point_delta(raw, 60))
    history = frame(raw)
    want = history.groupby("cell_id")["latency"].diff().fillna(0.0)
    np.testing.assert_allclose(a["latency_delta"].astype(float), want)


def test_short_windows(series):
    table = series({"a": range(8)})
    rolled = frame(features.rolling(table, {"n": (F.count, "latency", 5), "m": (F.avg, "latency", 5), "s": (F.stddev_samp, "latency", 5)}))
    assert list(rolled["n"]) == [1, 2, 3, 4, 5, 5, 5, 5]
    assert rolled["m"][0] == 0 and np.isnan(rolled["s"][0])


def test_feature_rows_are_clean_rows_less_ten_per_cell(series):
    table = series({"a": range(100), "b": range(100)})
    assert features.build_features(table).count() == 200 - 20


def test_prepared_has_57_columns_and_ratio_of_zero_level(spark, series):
    table = features.build_features(series({"a": [0] * 40}))
    prepared = features.prepare_features(table)
    assert len(prepared.columns) == 57
    assert prepared.select("latency_ratio_to_hour").distinct().collect()[0][0] == 1.0
    assert len(features.anomaly_features(prepared)) == 23


def test_infinite_and_nan_rows_are_dropped(spark, series):
    table = features.build_features(series({"a": range(40)}))
    odd = table.withColumn("latency_lag_1", F.when(F.col("latency_lag_1") == 20, float("inf")).when(F.col("latency_lag_1") == 21, float("nan")).otherwise(F.col("latency_lag_1")))
    assert features.prepare_features(odd).count() == table.count() - 2


def test_leakage_is_refused(spark, series):
    table = series({"a": range(3)}).withColumn("is_anomaly", F.lit(True))
    with pytest.raises(features.LeakageError):
        features.select_features(table, ["latency", "is_anomaly"])
    with pytest.raises(features.LeakageError):
        features.feature_columns(table.select("cell_id", "ts", "is_anomaly"))
    assert "is_anomaly" not in features.select_features(table).columns


def test_page_and_unknown_cell(series):
    table = series({"a": range(5), "b": range(5)})
    page = select.page(table, 3, 8)
    assert page.rows.count() == 2 and page.summary.first().asDict() == {"total": 10, "count": 2, "has_more": False}
    with pytest.raises(ValueError):
        select.page(table, 10_001)
    with pytest.raises(select.UnknownCellError):
        select.require_cell(table, "c")
    seen, last = [], (None, None)
    while rows := select.page_after(table, 3, *last).collect():
        seen += [(r["ts"], r["cell_id"]) for r in rows]
        last = seen[-1]
    assert seen == sorted((r["ts"], r["cell_id"]) for r in table.collect())

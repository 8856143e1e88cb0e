import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from kpiloom.operators import clean, episodes, features
from kpiloom.operators.select import latest_per_cell
from kpiloom.plans import catalog
from kpiloom.schema import CLEAN, FEATURES, KPIS, RAW
from kpiloom.session import cut, new_path
from kpiloom.sources import files, tables
from kpiloom.sources.events import load_raw
from kpiloom.streaming import live


def same(a, b):
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_upsert_twice_is_upsert_once(spark):
    raw = cut(load_raw(spark, SMALL))
    path = new_path(spark, "raw")
    tables.upsert(raw, path)
    newer = raw.where("source = 'stream'").withColumn("latency", F.lit(-1.0))
    tables.upsert(newer, path)
    once = cut(tables.scan(spark, path, RAW))
    tables.upsert(newer, path)
    assert same(once, tables.scan(spark, path, RAW)) and once.count() == raw.count()
    assert once.where("latency = -1").count() == newer.count()


def test_scan_pushes_filters_and_prunes(spark):
    path = new_path(spark, "clean")
    tables.append(clean.clean_series(load_raw(spark, SMALL), "1 hour"), path)
    rows = tables.scan(spark, path, CLEAN, ["ts", "latency"], since="2024-01-20 00:00:00")
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan and "GreaterThanOrEqual(ts" in plan
    assert "throughput" not in plan


def test_store_modes(spark):
    store = tables.Store(spark, new_path(spark, "store"), load_raw(spark, SMALL), "auto", "1 hour")
    assert store.active_source() == "local"
    local = cut(store.features())
    store.refresh()
    assert store.active_source() == "tables" and store.features().count() == local.count()
    with pytest.raises(FileNotFoundError):
        tables.Store(spark, new_path(spark, "none"), mode="tables").history()
    with pytest.raises(KeyError):
        store.require_cell("nowhere")


def test_csv_checks_its_header(spark):
    path = new_path(spark, "csv")
    load_raw(spark, SMALL).drop("latency").write.option("header", True).csv(path)
    with pytest.raises(files.MissingColumnsError):
        files.read_csv(spark, path)
    with pytest.raises(FileNotFoundError):
        files.first_existing(spark, [path + "-absent"])
    assert files.read_table(spark, path + "-absent", CLEAN).isEmpty()


def test_stream_means_equal_batch_means(spark):
    means = cut(catalog.QUERIES["stream_means"](spark, SMALL))
    bins = clean.resample_mean(load_raw(spark, SMALL), "1 hour")
    sizes = {"5m": 5, "15m": 15, "30m": 30, "60m": 60}
    batch = catalog.finish(features.rolling(bins, {f"{k}_mean_{w}": (F.avg, k, n) for k in KPIS for w, n in sizes.items()}, "1 hour"))
    joined = means.alias("s").join(batch.alias("b"), ["cell_id", "ts"])
    assert joined.count() == means.count() == batch.count() > 700
    for k in KPIS:
        for w in ("5m", "15m", "30m", "60m"):
            assert joined.where(F.abs(F.col(f"s.{k}_mean_{w}") - F.col(f"b.{k}_mean_{w}")) > 1e-5).isEmpty()


def test_stream_episodes_equal_batch_episodes(spark):
    live_rows = cut(catalog.QUERIES["stream_episodes"](spark, SMALL))
    labels = clean.labels_on_grid(load_raw(spark, SMALL), "1 hour")
    batch = catalog.finish(episodes.episodes(labels, "is_anomaly", "1 hour").drop("episode_id"))
    assert same(live_rows, batch.select(live_rows.columns))


def test_replayed_batches_change_nothing(spark):
    path = new_path(spark, "raw")
    stream = live.read_landing(spark, catalog._landing(spark, SMALL), files_per_batch=1)
    for _ in range(2):
        catalog._run(live.upsert_stream(stream, path, new_path(spark, "ckpt")))
    assert tables.scan(spark, path, RAW).count() == load_raw(spark, SMALL).count()


def _random_raw(spark, seed):
    """Two cells with holes of up to 3 000 steps and NULLs, as batches: in order, or shuffled so that most rows are late."""
    rng = random.Random(seed)
    start, rows = dt.datetime(2024, 1, 1), []
    for cell in "ab":
        at = 0
        for _ in range(4):
            n = rng.randint(3, 40)
            for i in range(n):
                if rng.random() < 0.85:
                    ts = start + dt.timedelta(minutes=at + i)
                    rows.append((ts, cell, *[None if rng.random() < 0.15 else round(rng.uniform(1, 90), 3) for _ in KPIS], False, "stream", ts))
            at += n + rng.choice([1, 2, 5, 9, 70, 400, 3000])
    rng.shuffle(rows) if seed % 2 else rows.sort()
    size = len(rows) // 3
    return [spark.createDataFrame(rows[i * size : (i + 1) * size if i < 2 else len(rows)], RAW) for i in range(3)]


@pytest.mark.parametrize("seed", [1, 2])
def test_refresh_equals_the_full_recomputation(spark, seed):
    folder = new_path(spark, "store")
    for batch in _random_raw(spark, seed):
        tables.upsert(batch, f"{folder}/raw", ["cell_id", "ts", "ingested_at"])
        live.refresh_touched(batch, folder, "1 minute")
    rounded = lambda df: df.select(*[F.round(c, 7).alias(c) if kind == "double" else F.col(c) for c, kind in df.dtypes])
    whole = cut(clean.clean_series(tables.scan(spark, f"{folder}/raw", RAW), "1 minute").select(*CLEAN.fieldNames()))
    assert same(rounded(whole), rounded(tables.scan(spark, f"{folder}/clean", CLEAN)))
    built = features.build_features(whole, "1 minute").select(*FEATURES.fieldNames())
    assert same(rounded(built), rounded(tables.scan(spark, f"{folder}/features", FEATURES)))


def test_replace_empties_a_day(spark):
    path = new_path(spark, "clean")
    day = lambda n: dt.datetime(2024, 1, n, 5)
    table = spark.createDataFrame([(day(n), "a", *[1.0] * len(KPIS), False) for n in (1, 2, 3)], CLEAN)
    tables.append(table, path)
    ranges = spark.createDataFrame([("a", day(2), day(2))], "cell_id string, _from timestamp, _to timestamp")
    tables.replace(table.limit(0), path, ranges)
    assert [r["ts"].day for r in tables.scan(spark, path, CLEAN).orderBy("ts").collect()] == [1, 3]


def test_malformed_numbers_fail_the_read(spark):
    path = new_path(spark, "csv")
    load_raw(spark, SMALL).withColumn("latency", F.lit("fast")).write.option("header", True).csv(path)
    with pytest.raises(Exception, match="MALFORMED|malformed|FAILFAST"):
        files.read_csv(spark, path).collect()


def test_ties_are_resolved_by_the_rows_alone(spark):
    ts = dt.datetime(2024, 1, 1)
    rows = [(ts, "a", float(v), *[0.0] * (len(KPIS) - 1), False, s, ts) for v, s in ((3, "b"), (1, "c"), (2, "b"))]
    for order in (rows, rows[::-1]):
        df = spark.createDataFrame(order, RAW).repartition(3)
        assert tables.first_per_key(df).select("throughput").first()[0] == 2.0
        assert latest_per_cell(df).select("throughput").first()[0] == 1.0


# -- plans ------------------------------------------------------------------


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_features_stay_in_the_engine_and_shuffle_the_series_once(spark):
    path = new_path(spark, "clean")
    clean.clean_series(load_raw(spark, SMALL), "1 hour").write.parquet(path)
    plan = plan_of(features.build_features(spark.read.parquet(path), "1 hour"))
    assert "Python" not in plan and "Pandas" not in plan
    # One exchange of all rows; the other carries at most ten rows per block and task,
    # and the last one row per block.
    assert plan.count("Exchange hashpartitioning(cell_id") == 3
    assert plan.count("WindowGroupLimit") == 2
    assert "SinglePartition" not in plan and "CartesianProduct" not in plan


def test_dedupe_limits_groups_before_the_shuffle(spark):
    plan = plan_of(clean.dedupe_first(load_raw(spark, SMALL)))
    assert plan.count("WindowGroupLimit") == 2


def test_no_query_uses_a_cross_join_or_a_python_row_function(spark):
    for name in ("clean_series", "feature_build", "targets", "episode_metrics", "ranking", "sweep", "robust_scale", "forecast_table"):
        plan = plan_of(catalog.QUERIES[name](spark, SMALL))
        assert "CartesianProduct" not in plan and "BatchEvalPython" not in plan, name

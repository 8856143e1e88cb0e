"""Every operator as a query over the driver's tables.

RAW comes from ``events``.  The grid is an hour, windows count grid steps.
CLEAN, FEATURES and the split are stored once per session and folder, as they are
in production; queries about those steps themselves start from RAW.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kpiloom.functions import qos, timegrid
from kpiloom.models import boosting, store
from kpiloom.models import forecasters as fc
from kpiloom.models.detectors import (
    Autoencoder,
    DensityDetector,
    IsolationForest,
    LinearReconstruction,
    ThresholdDetector,
    build_detectors,
    stored_scaler,
)
from kpiloom.models.store import scored
from kpiloom.operators import blocks, clean, explore, features, joins, metrics, monitor, scaling, select, split
from kpiloom.operators import episodes as ep
from kpiloom.operators.quantiles import quantile_scalar
from kpiloom.plans import anomaly as anomaly_plan
from kpiloom.plans import forecast as forecast_plan
from kpiloom.schema import CLEAN, FEATURES, HORIZONS, KPIS, RAW, target_name
from kpiloom.session import cut, new_path
from kpiloom.sources import files, tables
from kpiloom.sources.events import load_raw, with_late_copies
from kpiloom.sources.snapshots import SnapshotTable
from kpiloom.streaming import live, stateful

GRID = "1 hour"
MINUTES = 60
FINE_GRID = "10 minutes"
Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
_STORED: dict[tuple, DataFrame] = {}


# Lifts exact ties off the rounding boundary, where the last bit of a sum would decide.
NUDGE = 1.7e-8


def finish(df: DataFrame, digits: int = 6) -> DataFrame:
    """Comparable output: rounded doubles, 64-bit integers, times without zone."""
    out = {}
    for f in df.schema:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            out[f.name] = F.round(c.cast("double") + F.lit(NUDGE), digits) + F.lit(0.0)
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            out[f.name] = c.cast("long")
        elif isinstance(f.dataType, T.TimestampType):
            out[f.name] = c.cast("timestamp_ntz")
    return df.withColumns(out)


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        # Times leave a query without zone; only here, where results are shown, does the session's zone matter.
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return finish(fn(spark, sf_dir))

    QUERIES[fn.__name__] = run
    return fn


def _stored(name: str, spark: SparkSession, sf_dir: str, make: Callable[[], DataFrame]) -> DataFrame:
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _STORED:
        _STORED[key] = cut(make())
    return _STORED[key]


def history(spark, sf_dir):
    return _stored("clean", spark, sf_dir, lambda: clean.clean_series(load_raw(spark, sf_dir), GRID))


def feature_table(spark, sf_dir):
    return _stored("features", spark, sf_dir, lambda: features.build_features(history(spark, sf_dir), GRID))


def prepared_table(spark, sf_dir):
    return _stored("prepared", spark, sf_dir, lambda: features.prepare_features(feature_table(spark, sf_dir)))


def label_table(spark, sf_dir):
    return _stored("labels", spark, sf_dir, lambda: clean.labels_on_grid(load_raw(spark, sf_dir), GRID))


def labelled_history(spark, sf_dir):
    return joins.with_labels(history(spark, sf_dir), label_table(spark, sf_dir))


def split_table(spark, sf_dir):
    """PREPARED with truth and segment; truth is for evaluation only."""

    def make():
        rows = joins.with_labels(prepared_table(spark, sf_dir), label_table(spark, sf_dir))
        return split.temporal_split(rows, GRID)

    return _stored("split", spark, sf_dir, make)


def supervised_table(spark, sf_dir):
    def make():
        rows = joins.supervised(prepared_table(spark, sf_dir), history(spark, sf_dir), grid=GRID)
        return split.temporal_split(rows, GRID)

    return _stored("supervised", spark, sf_dir, make)


def score_table(spark, sf_dir):
    """Scores of two unlearned detectors on every segment."""

    def make():
        rows = split_table(spark, sf_dir)
        keep = ["segment", "ts", "cell_id", "is_anomaly"]
        level = rows.withColumn("score", F.round("latency_ratio_to_hour", 6))
        ratio = level.select(F.lit("ratio_latence").alias("detector"), *keep, "score")
        return scored([ThresholdDetector()], rows, keep).unionByName(ratio)

    return _stored("scores", spark, sf_dir, make)


def alert_table(spark, sf_dir):
    """Prepared rows with truth, a score and the alerts above its 0.9 quantile."""
    rows = joins.with_labels(prepared_table(spark, sf_dir), label_table(spark, sf_dir)).withColumn(
        "score", F.round("latency_ratio_to_hour", 6)
    )
    return rows.withColumn("is_anomaly_pred", F.col("score") >= quantile_scalar(rows, "score", 0.9))


def baselines(spark, sf_dir):
    return [fc.Persistence(), fc.MovingAverage(), fc.SeasonalNaive(history(spark, sf_dir), GRID)]


def test_rows(spark, sf_dir):
    return supervised_table(spark, sf_dir).where("segment = 'test'").drop("segment")


# -- sources and sinks ------------------------------------------------------


def _raw_csv(spark, sf_dir) -> str:
    path = new_path(spark, "csv")
    load_raw(spark, sf_dir).drop("source", "ingested_at").write.option("header", True).option(
        "timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"
    ).csv(path)
    return path


@query
def csv_scan(spark, sf_dir):
    return files.read_csv(spark, _raw_csv(spark, sf_dir)).drop("ingested_at")


@query
def raw_append(spark, sf_dir):
    path = new_path(spark, "raw")
    tables.append(load_raw(spark, sf_dir), path)
    return tables.scan(spark, path, RAW)


@query
def scan_since(spark, sf_dir):
    path = new_path(spark, "clean")
    tables.append(history(spark, sf_dir), path)
    return tables.scan(spark, path, CLEAN, ["ts", "cell_id", *KPIS], since="2024-01-15 00:00:00")


@query
def upsert(spark, sf_dir):
    raw = load_raw(spark, sf_dir)
    newer = with_late_copies(raw).where(F.col("ingested_at") > F.col("ts"))
    return tables.merge_rows(raw, newer)


@query
def table_upsert(spark, sf_dir):
    path = new_path(spark, "raw")
    raw = load_raw(spark, sf_dir)
    tables.upsert(raw, path)
    newer = with_late_copies(raw).where((F.col("ingested_at") > F.col("ts")) & (F.col("source") == "stream"))
    tables.upsert(newer, path)
    tables.upsert(newer, path)
    return tables.scan(spark, path, RAW)


@query
def snapshot_upsert(spark, sf_dir):
    """The same rows through versions of a snapshot table, compacted and merged on read."""
    raw = load_raw(spark, sf_dir)
    table = SnapshotTable(spark, new_path(spark, "snapshots"), RAW)
    table.commit(raw)
    newer = with_late_copies(raw).where((F.col("ingested_at") > F.col("ts")) & (F.col("source") == "stream"))
    table.commit(newer.where("cell_id < 'cell_003'"))
    table.compact()
    table.commit(newer)
    return table.read()


@query
def snapshot_version(spark, sf_dir):
    """An earlier version stays readable, one day of it opened."""
    raw = load_raw(spark, sf_dir)
    table = SnapshotTable(spark, new_path(spark, "snapshots"), RAW)
    version = table.commit(raw)
    table.commit(with_late_copies(raw).where(F.col("ingested_at") > F.col("ts")))
    return table.read(version, start="2024-01-05 00:00:00", end="2024-01-05 23:59:59.999999")


@query
def store_features(spark, sf_dir):
    store = tables.Store(spark, new_path(spark, "store"), load_raw(spark, sf_dir), "auto", GRID)
    store.refresh()
    return store.features(start="2024-01-05 00:00:00").select(
        "cell_id", "ts", "throughput_mean_5m", "latency_lag_10", "jitter_std_15m", "hour_of_day"
    )


@query
def store_labels(spark, sf_dir):
    store = tables.Store(spark, new_path(spark, "store"), load_raw(spark, sf_dir), "local", GRID)
    return store.labels(cell_id="cell_002")


@query
def metric_sink(spark, sf_dir):
    path = new_path(spark, "metrics")
    table = explore.state_distribution(qos.classify(history(spark, sf_dir)))
    files.write_table(table, path)
    return files.read_table(spark, path, table.schema)


@query
def sample_kpi(spark, sf_dir):
    return files.sample_tables(load_raw(spark, sf_dir), 2, 3, GRID)["sample_kpi"]


@query
def sample_labels(spark, sf_dir):
    return files.sample_tables(load_raw(spark, sf_dir), 2, 3, GRID)["sample_kpi_with_labels"]


@query
def sample_features(spark, sf_dir):
    table = files.sample_tables(load_raw(spark, sf_dir), 2, 3, GRID)["sample_features"]
    return table.select("cell_id", "ts", "throughput_mean_5m", "latency_lag_10", "cell_load_hour_max")


# -- cleaning ---------------------------------------------------------------


@query
def clip_bounds(spark, sf_dir):
    return clean.clip_bounds(load_raw(spark, sf_dir)).select("ts", "cell_id", *KPIS)


@query
def dedupe_first(spark, sf_dir):
    return clean.dedupe_first(with_late_copies(load_raw(spark, sf_dir)))


@query
def resample_mean(spark, sf_dir):
    return clean.resample_mean(clean.clip_bounds(load_raw(spark, sf_dir)), GRID)


@query
def regular_grid(spark, sf_dir):
    bins = clean.resample_mean(clean.clip_bounds(load_raw(spark, sf_dir)), FINE_GRID)
    return clean.regular_grid(bins, FINE_GRID)


@query
def gap_fill(spark, sf_dir):
    bins = clean.resample_mean(clean.clip_bounds(load_raw(spark, sf_dir)), FINE_GRID)
    return clean.fill_gaps(bins, FINE_GRID, whole_grid=True)


@query
def clean_series(spark, sf_dir):
    return clean.clean_series(load_raw(spark, sf_dir), GRID)


@query
def clean_series_fine(spark, sf_dir):
    return clean.clean_series(load_raw(spark, sf_dir), FINE_GRID)


@query
def clean_from_duplicates(spark, sf_dir):
    return clean.clean_series(with_late_copies(load_raw(spark, sf_dir)), GRID)


@query
def labels_grid(spark, sf_dir):
    return clean.labels_on_grid(load_raw(spark, sf_dir), FINE_GRID)


@query
def labels_floor(spark, sf_dir):
    return joins.align_label_minutes(load_raw(spark, sf_dir).select("ts", "cell_id", "is_anomaly"), "1 minute")


# -- features ---------------------------------------------------------------


@query
def rolling_mean(spark, sf_dir):
    rows = features.rolling_means(history(spark, sf_dir), GRID)
    return rows.select("cell_id", "ts", *[f"{k}_mean_{w}" for k in KPIS for w in ("5m", "15m", "30m")])


@query
def rolling_std(spark, sf_dir):
    rows = features.rolling_stds(history(spark, sf_dir), GRID)
    return rows.select("cell_id", "ts", *[f"{k}_std_15m" for k in KPIS])


@query
def lags(spark, sf_dir):
    rows = features.lags(clean.clean_series(load_raw(spark, sf_dir), FINE_GRID), FINE_GRID)
    return rows.select("cell_id", "ts", *[f"{k}_lag_{n}" for k in KPIS for n in (1, 5, 10)])


@query
def hour_stats(spark, sf_dir):
    rows = features.hour_stats(history(spark, sf_dir), GRID)
    return rows.select("cell_id", "ts", *[f"{k}_hour_mean" for k in KPIS], "cell_load_hour_max")


@query
def feature_build(spark, sf_dir):
    return features.build_features(clean.clean_series(load_raw(spark, sf_dir), GRID), GRID)


@query
def feature_build_fine(spark, sf_dir):
    rows = features.build_features(clean.clean_series(load_raw(spark, sf_dir), FINE_GRID), FINE_GRID)
    return rows.select(
        "cell_id", "ts", "throughput_mean_30m", "latency_std_15m", "jitter_lag_10", "packet_loss_hour_mean", "day_of_week"
    )


@query
def cyclic(spark, sf_dir):
    rows = features.add_cyclic(history(spark, sf_dir).select("cell_id", "ts"))
    return rows.withColumn("load_factor", timegrid.daily_load_factor(timegrid.hour_of_day(F.col("ts"))))


@query
def derived(spark, sf_dir):
    rows = features.add_derived(feature_table(spark, sf_dir))
    return rows.select(
        "cell_id", "ts", *[f"{k}_trend_5m_30m" for k in KPIS], *[f"{k}_ratio_to_hour" for k in KPIS]
    )


@query
def prepared(spark, sf_dir):
    return features.prepare_features(feature_table(spark, sf_dir))


@query
def detector_inputs(spark, sf_dir):
    rows = prepared_table(spark, sf_dir)
    return features.select_features(rows, features.anomaly_features(rows))


# -- selection --------------------------------------------------------------


@query
def range_filter(spark, sf_dir):
    return select.where_range(history(spark, sf_dir), "cell_003", "2024-01-03 05:00:00", "2024-01-09 05:00:00")


@query
def since_last(spark, sf_dir):
    return select.since_last(history(spark, sf_dir), "48 HOURS")


@query
def served_rows(spark, sf_dir):
    return select.served(labelled_history(spark, sf_dir))


@query
def cells(spark, sf_dir):
    return select.cells(history(spark, sf_dir))


@query
def thresholds(spark, sf_dir):
    """How often each bound of the threshold table is broken."""
    bounds = select.threshold_table(spark)
    worse = F.when(F.col("higher_is_worse"), F.col("value") > F.col("degraded")).otherwise(
        F.col("value") < F.col("degraded")
    )
    return (
        explore.long_kpis(history(spark, sf_dir))
        .join(bounds, "kpi")
        .groupBy("kpi", "unit", "good", "degraded", "contract_version")
        .agg(F.count_if(worse).alias("critical_rows"))
    )


@query
def page(spark, sf_dir):
    return select.page(history(spark, sf_dir), limit=100, offset=50).rows


@query
def page_summary(spark, sf_dir):
    return select.page(history(spark, sf_dir), limit=100, offset=50, cell_id="cell_001").summary


@query
def page_after(spark, sf_dir):
    return select.page_after(history(spark, sf_dir), 100, "2024-01-02 03:00:00", "cell_003")


@query
def latest_n(spark, sf_dir):
    return select.latest(history(spark, sf_dir), 100)


@query
def stream_rows(spark, sf_dir):
    return select.stream_rows(load_raw(spark, sf_dir))


@query
def stream_tail(spark, sf_dir):
    return select.stream_tail(load_raw(spark, sf_dir), 50)


@query
def latest_state(spark, sf_dir):
    """Current state and dominant cause of each cell, from RAW."""
    rows = features.rolling_means(clean.clean_series(load_raw(spark, sf_dir), GRID), GRID, {"5m": 5})
    now = monitor.current_state(rows, "_mean_5m")
    return now.select(
        "cell_id", "ts", *[f"{k}_mean_5m" for k in KPIS], "qos_state", "qos_state_rank", "cause_kpi", "cause_excess"
    )


@query
def first_cells(spark, sf_dir):
    return select.first_cells(history(spark, sf_dir), 2)


@query
def origins(spark, sf_dir):
    return select.evaluation_origins(prepared_table(spark, sf_dir), GRID, 30).select("cell_id", "ts")


@query
def systematic_sample(spark, sf_dir):
    return select.systematic_sample(prepared_table(spark, sf_dir), GRID, 500).select("cell_id", "ts")


# -- joins ------------------------------------------------------------------


@query
def align_labels(spark, sf_dir):
    rows = joins.align_labels(prepared_table(spark, sf_dir), label_table(spark, sf_dir))
    return rows.select("cell_id", "ts", "is_anomaly")


@query
def match_rate(spark, sf_dir):
    return joins.match_rate(prepared_table(spark, sf_dir), label_table(spark, sf_dir))


@query
def history_labels(spark, sf_dir):
    return labelled_history(spark, sf_dir)


@query
def targets(spark, sf_dir):
    rows = joins.build_targets(prepared_table(spark, sf_dir), history(spark, sf_dir), grid=GRID)
    return rows.select("cell_id", "ts", *[target_name(k, h) for k in KPIS for h in HORIZONS])


@query
def supervised(spark, sf_dir):
    rows = supervised_table(spark, sf_dir)
    return rows.select("cell_id", "ts", "segment", *[target_name(k, h) for k in KPIS for h in HORIZONS])


@query
def seasonal_naive(spark, sf_dir):
    model = fc.SeasonalNaive(history(spark, sf_dir), GRID)
    rows = model.prepare(prepared_table(spark, sf_dir))
    return rows.select("cell_id", "ts", *[model.forecast("latency", h).alias(f"y_hat_{h}") for h in HORIZONS])


@query
def alert_semi_join(spark, sf_dir):
    alerts = alert_table(spark, sf_dir).where("is_anomaly_pred")
    return joins.at_alerts(history(spark, sf_dir), alerts)


@query
def shifted_forecast(spark, sf_dir):
    rows = fc.Persistence().predict(prepared_table(spark, sf_dir), "latency", 15).select("cell_id", "ts", "y_hat")
    return joins.announced_at(rows, 15, GRID)


@query
def arima_context(spark, sf_dir):
    model = fc.AutoRegression(history(spark, sf_dir), GRID)
    rows = model.contexts(select.evaluation_origins(test_rows(spark, sf_dir), GRID))
    return rows.groupBy("cell_id", "origin").agg(
        F.count(F.lit(1)).alias("n"), F.min("ts").alias("first_ts"), F.avg("latency").alias("latency")
    )


# -- exploration ------------------------------------------------------------


@query
def qos_state(spark, sf_dir):
    return qos.classify(history(spark, sf_dir)).select(
        "cell_id", "ts", "qos_state", "qos_state_rank", *[f"{k}_state" for k in KPIS]
    )


@query
def dominant_cause(spark, sf_dir):
    return qos.with_cause(history(spark, sf_dir)).select("cell_id", "ts", "cause_kpi", "cause_excess")


@query
def state_distribution(spark, sf_dir):
    return explore.state_distribution(qos.classify(history(spark, sf_dir)))


@query
def state_by_cell(spark, sf_dir):
    rows = explore.state_by_cell(qos.classify(history(spark, sf_dir)))
    return rows.withColumnRenamed("dégradé", "degrade")


@query
def state_by_kpi(spark, sf_dir):
    rows = explore.state_by_kpi(qos.classify(history(spark, sf_dir)))
    return rows.withColumnRenamed("dégradé", "degrade")


@query
def state_truth_crosstab(spark, sf_dir):
    return explore.state_truth_crosstab(qos.classify(labelled_history(spark, sf_dir)))


@query
def independence(spark, sf_dir):
    rows = qos.classify(history(spark, sf_dir))
    return explore.independence_check(explore.state_by_kpi(rows), explore.state_distribution(rows))


@query
def describe_kpi(spark, sf_dir):
    return explore.describe(history(spark, sf_dir))


@query
def normal_vs_anomaly(spark, sf_dir):
    return explore.normal_vs_anomaly(labelled_history(spark, sf_dir))


@query
def hourly_profile(spark, sf_dir):
    return explore.hourly_profile(history(spark, sf_dir))


@query
def amplitude(spark, sf_dir):
    return explore.amplitude(explore.hourly_profile(history(spark, sf_dir)))


@query
def correlation(spark, sf_dir):
    return explore.correlation(history(spark, sf_dir))


@query
def strongest_pairs(spark, sf_dir):
    rows = explore.strongest_pairs(explore.correlation(history(spark, sf_dir).withColumn("cell_load", F.col("cell_load") + F.col("jitter"))))
    return rows


@query
def autocorrelation(spark, sf_dir):
    return explore.autocorrelation(history(spark, sf_dir), GRID)


@query
def contract_audit(spark, sf_dir):
    return explore.contract_audit(labelled_history(spark, sf_dir), GRID)


@query
def grid_gaps(spark, sf_dir):
    return explore.grid_gaps(clean.clean_series(load_raw(spark, sf_dir), FINE_GRID), FINE_GRID)


@query
def histogram(spark, sf_dir):
    return explore.histogram(explore.long_kpis(history(spark, sf_dir)), 80)


# -- protocol ---------------------------------------------------------------


@query
def chronological_split(spark, sf_dir):
    return split.temporal_split(prepared_table(spark, sf_dir), GRID).select("cell_id", "ts", "segment")


@query
def split_by_time(spark, sf_dir):
    rows = split.split_by_timestamp(prepared_table(spark, sf_dir), "2024-01-18 00:00:00", "2024-01-24 00:00:00", 60, GRID)
    return rows.select("cell_id", "ts", "segment")


@query
def split_summary(spark, sf_dir):
    return split.split_summary(split_table(spark, sf_dir))


@query
def chronology(spark, sf_dir):
    return split.chronology(split_table(spark, sf_dir))


# -- episodes and metrics ---------------------------------------------------


@query
def episodes(spark, sf_dir):
    return ep.episodes(label_table(spark, sf_dir), "is_anomaly", GRID)


@query
def episode_overlap(spark, sf_dir):
    return ep.episode_overlap(alert_table(spark, sf_dir), grid=GRID)


@query
def episode_metrics(spark, sf_dir):
    return ep.episode_metrics(alert_table(spark, sf_dir), minutes_per_point=MINUTES, grid=GRID)


@query
def episode_total(spark, sf_dir):
    return ep.episode_totals(ep.episode_metrics(alert_table(spark, sf_dir), minutes_per_point=MINUTES, grid=GRID))


@query
def episode_errors(spark, sf_dir):
    return ep.error_analysis(alert_table(spark, sf_dir), minutes_per_point=MINUTES, grid=GRID)


@query
def episode_error_summary(spark, sf_dir):
    return ep.error_summary(ep.error_analysis(alert_table(spark, sf_dir), minutes_per_point=MINUTES, grid=GRID))


@query
def confusion(spark, sf_dir):
    return metrics.confusion(alert_table(spark, sf_dir), ["cell_id"])


@query
def ranking(spark, sf_dir):
    return metrics.ranking_metrics(score_table(spark, sf_dir).where("segment = 'test'"))


@query
def sweep(spark, sf_dir):
    return metrics.sweep_threshold(score_table(spark, sf_dir).where("segment = 'val'"))


@query
def precision_recall_curve(spark, sf_dir):
    return metrics.sweep_threshold(score_table(spark, sf_dir).where("segment = 'test'")).select(
        "detector", "rappel", "precision"
    )


@query
def best_threshold(spark, sf_dir):
    return metrics.best_threshold(score_table(spark, sf_dir).where("segment = 'val'"))


@query
def score_threshold(spark, sf_dir):
    return metrics.score_thresholds(score_table(spark, sf_dir).where("segment = 'train'"), 0.02)


@query
def score_histogram(spark, sf_dir):
    rows = score_table(spark, sf_dir).where("segment = 'test'")
    return explore.histogram(rows, 60, ["detector", "is_anomaly"], "score")


@query
def threshold_detector(spark, sf_dir):
    model = ThresholdDetector()
    rows = prepared_table(spark, sf_dir)
    return model.predict(rows, model.default_threshold(model.score(rows))).select("cell_id", "ts", "score", "is_anomaly_pred")


def _compared(spark, sf_dir):
    scores = score_table(spark, sf_dir)
    chosen = metrics.best_threshold(scores.where("segment = 'val'")).select(
        "detector", F.lit("f1_optimal").alias("point_de_fonctionnement"), "seuil"
    )
    free = metrics.score_thresholds(scores.where("segment = 'train'"), 0.02).select(
        "detector", F.lit("exploitation").alias("point_de_fonctionnement"), "seuil"
    )
    return anomaly_plan.compare(scores, cut(free.unionByName(chosen)), GRID, MINUTES)


@query
def detector_comparison(spark, sf_dir):
    return _compared(spark, sf_dir)


@query
def threshold_sensitivity(spark, sf_dir):
    return metrics.sweep_gap(_compared(spark, sf_dir))


# -- scaling ----------------------------------------------------------------


@query
def robust_parameters(spark, sf_dir):
    rows = split_table(spark, sf_dir).where("segment = 'train'")
    scaler = scaling.RobustCellScaler(features.anomaly_features(rows)).fit(rows)
    return scaler.parameters().withColumn("cell_id", F.coalesce("cell_id", F.lit("*")))


@query
def robust_scale(spark, sf_dir):
    rows = split_table(spark, sf_dir)
    columns = ["latency_mean_5m", "throughput_std_15m", "cell_load_hour_max"]
    scaler = scaling.RobustCellScaler(columns).fit(rows.where("segment = 'train' AND cell_id <> 'cell_005'"))
    return scaler.transform(rows.where("segment = 'test'").select("cell_id", "ts", *columns))


@query
def global_scale(spark, sf_dir):
    rows = split_table(spark, sf_dir)
    columns = ["latency_mean_5m", "throughput_std_15m", "cell_load_hour_max"]
    train, test = rows.where("segment = 'train'"), rows.where("segment = 'test'").select("cell_id", "ts", *columns)
    standard = scaling.scale_all(test, train, columns, "standard").withColumn("kind", F.lit("standard"))
    return scaling.scale_all(test, train, columns).withColumn("kind", F.lit("robust")).unionByName(standard)


@query
def trim_extremes(spark, sf_dir):
    rows = split_table(spark, sf_dir).where("segment = 'train'")
    columns = ["latency_mean_5m", "throughput_std_15m", "cell_load_hour_max"]
    scaler = scaling.RobustCellScaler(columns).fit(rows)
    return scaling.trim_extremes(scaler.vectors(rows.select("cell_id", "ts", *columns)), 0.05).select("cell_id", "ts")


# -- forecasts without learning --------------------------------------------


def _forecast_table(spark, sf_dir):
    rows = test_rows(spark, sf_dir)
    return _stored(
        "errors", spark, sf_dir,
        lambda: forecast_plan.forecast_table(fc.long_forecasts(baselines(spark, sf_dir), rows)),
    )


@query
def forecast_table(spark, sf_dir):
    rows = fc.long_forecasts(baselines(spark, sf_dir), test_rows(spark, sf_dir))
    # MAPE explodes where the truth is near zero; six decimals are beyond a double there.
    return forecast_plan.forecast_table(rows).withColumn("mape", F.round("mape", 2))


@query
def forecast_scopes(spark, sf_dir):
    rows = test_rows(spark, sf_dir)
    table = forecast_plan.forecast_study(baselines(spark, sf_dir), rows, select.evaluation_origins(rows, GRID))
    return table.select("scope", "model", "kpi", "horizon_min", "mae", "n")


@query
def gain_pivot(spark, sf_dir):
    return forecast_plan.gain_pivot(_forecast_table(spark, sf_dir))


@query
def mae_pivot(spark, sf_dir):
    return forecast_plan.mae_pivot(_forecast_table(spark, sf_dir), [m.name for m in baselines(spark, sf_dir)])


@query
def best_model(spark, sf_dir):
    return forecast_plan.best_model(_forecast_table(spark, sf_dir))


@query
def state_accuracy(spark, sf_dir):
    return forecast_plan.state_accuracy(forecast_plan.predicted_states(fc.Persistence(), test_rows(spark, sf_dir)))


@query
def state_confusion(spark, sf_dir):
    return forecast_plan.state_confusion(forecast_plan.predicted_states(fc.Persistence(), test_rows(spark, sf_dir)))


def _states_by_model(spark, sf_dir):
    rows = test_rows(spark, sf_dir)
    told = [forecast_plan.predicted_states(m, rows).withColumn("model", F.lit(m.name)) for m in baselines(spark, sf_dir)]
    return reduce(DataFrame.unionByName, told)


@query
def state_accuracy_by_model(spark, sf_dir):
    return forecast_plan.state_accuracy(_states_by_model(spark, sf_dir), ["model"])


@query
def state_confusion_by_model(spark, sf_dir):
    return forecast_plan.state_confusion(_states_by_model(spark, sf_dir), ["model"])


@query
def announced_state(spark, sf_dir):
    rows = forecast_plan.announced_state(fc.Persistence(), prepared_table(spark, sf_dir), GRID)
    return rows.select("cell_id", "ts", "horizon_min", "announced_for", "qos_state", "cause_kpi", "cause_excess")


# -- monitoring -------------------------------------------------------------


@query
def alerts_by_cell(spark, sf_dir):
    return monitor.alerts_by_cell(alert_table(spark, sf_dir).where("is_anomaly_pred"))


@query
def freshness(spark, sf_dir):
    now = F.lit("2024-01-31 00:00:00").cast("timestamp")
    return monitor.freshness(select.stream_rows(load_raw(spark, sf_dir)), now, 600)


@query
def point_delta(spark, sf_dir):
    rows = monitor.point_delta(select.stream_rows(load_raw(spark, sf_dir)))
    return rows.select("cell_id", "ts", *[f"{k}_delta" for k in KPIS])


# -- learned models ---------------------------------------------------------


def _learned(spark, sf_dir, make):
    rows = split_table(spark, sf_dir)
    model = make(features.anomaly_features(rows)).fit(rows.where("segment = 'train'"))
    return model, rows


def _fitted_scores(spark, sf_dir, make):
    model, rows = _learned(spark, sf_dir, make)
    return model.score(rows.where("segment = 'test'")).select("cell_id", "ts", "is_anomaly", "score")


@query
def isolation_forest(spark, sf_dir):
    return _fitted_scores(spark, sf_dir, IsolationForest)


@query
def dbscan(spark, sf_dir):
    return _fitted_scores(spark, sf_dir, lambda c: DensityDetector(c, grid=GRID))


@query
def pca_error(spark, sf_dir):
    return _fitted_scores(spark, sf_dir, LinearReconstruction)


@query
def autoencoder(spark, sf_dir):
    return _fitted_scores(spark, sf_dir, Autoencoder)


@query
def autoencoder_grid(spark, sf_dir):
    rows = split_table(spark, sf_dir)
    return anomaly_plan.select_autoencoder(features.anomaly_features(rows), rows)[1]


@query
def explain(spark, sf_dir):
    model, rows = _learned(spark, sf_dir, Autoencoder)
    return model.explain(rows.where("segment = 'test'")).select("cell_id", "ts", "score", "causes")


@query
def learned_comparison(spark, sf_dir):
    rows = split_table(spark, sf_dir)
    columns = features.anomaly_features(rows)
    detectors = anomaly_plan.tuned_detectors(list(build_detectors(columns, GRID).values()), rows)
    return anomaly_plan.detector_study(detectors, rows, GRID, minutes_per_point=MINUTES)


@query
def learned_counts(spark, sf_dir):
    """What is certain about learned scores: one finite score per row and detector."""
    rows = split_table(spark, sf_dir)
    train, columns = rows.where("segment = 'train'"), features.anomaly_features(rows)
    models = [IsolationForest(columns), DensityDetector(columns, grid=GRID), LinearReconstruction(columns), Autoencoder(columns)]
    scaler = stored_scaler(train, columns)
    scores = scored([m.share_scaler(scaler).fit(train) for m in models], rows, ["segment"])
    finite = F.count_if(F.col("score").isNotNull() & ~F.isnan("score") & (F.abs("score") < float("inf")))
    return scores.groupBy("detector", "segment").agg(F.count(F.lit(1)).alias("n"), finite.alias("finite"))


@query
def forecast_study_counts(spark, sf_dir):
    """Every model forecasts from every origin: rows and finite errors per scope, model, KPI and horizon."""
    rows = test_rows(spark, sf_dir)
    trained = supervised_table(spark, sf_dir).where("segment = 'train'")
    arima = fc.AutoRegression(history(spark, sf_dir), GRID).fit(trained)
    table = forecast_plan.forecast_study([*baselines(spark, sf_dir), arima], rows, select.evaluation_origins(rows, GRID))
    return table.select("scope", "model", "kpi", "horizon_min", "n", (F.col("mae") >= 0).alias("measured"))


@query
def ar_forecast(spark, sf_dir):
    rows = supervised_table(spark, sf_dir)
    model = fc.AutoRegression(history(spark, sf_dir), GRID).fit(rows.where("segment = 'train'"))
    return model.forecasts(select.evaluation_origins(rows.where("segment = 'test'"), GRID))


@query
def ar1_forecast(spark, sf_dir):
    """Forecasts of the order (1, 0, 0) for every series, which SQL can fit too."""
    model = fc.AutoRegression(history(spark, sf_dir), GRID)
    cells = select.cells(history(spark, sf_dir)).select("cell_id")
    orders = [F.struct(F.lit(k).alias("kpi"), F.lit(1).alias("p"), F.lit(0).alias("d"), F.lit(0).alias("q")) for k in KPIS]
    model.orders = cells.select("cell_id", F.explode(F.array(*orders)).alias("o")).select("cell_id", "o.*")
    return model.forecasts(test_rows(spark, sf_dir))


@query
def reloaded_models(spark, sf_dir):
    """Rules and baselines, stored and loaded again, on the test rows."""
    rows = test_rows(spark, sf_dir)
    told = []
    for model in baselines(spark, sf_dir):
        path = new_path(spark, "model")
        store.save(spark, model, path)
        again = store.load(spark, path, history(spark, sf_dir))
        told.append(fc.long_forecasts([again], rows).select("model", "kpi", "horizon_min", "cell_id", "ts", "y_hat"))
    path = new_path(spark, "model")
    store.save(spark, ThresholdDetector(), path)
    scored_rows = store.load(spark, path).score(rows)
    whole = [F.lit("seuils_contrat").alias("model"), F.lit("tous").alias("kpi"), F.lit(0).alias("horizon_min")]
    told.append(scored_rows.select(*whole, "cell_id", "ts", F.col("score").alias("y_hat")))
    return reduce(DataFrame.unionByName, told)


@query
def canonical_order(spark, sf_dir):
    """The stored series in (cell_id, ts) order, each row with its place in its cell."""
    placed = blocks.with_position(history(spark, sf_dir), GRID)
    return placed.orderBy("cell_id", "ts").select("cell_id", "ts", F.col("_pos").alias("place"), "latency")


@query
def known_cells(spark, sf_dir):
    """Which of the asked cells exist: the check that every request of one cell makes first."""
    rows = history(spark, sf_dir)

    def known(cell: str) -> bool:
        try:
            select.require_cell(rows, cell)
        except select.UnknownCellError:
            return False
        return True

    asked = [(c, known(c)) for c in ("cell_001", "cell_005", "cell_999", "")]
    return spark.createDataFrame(asked, "cell_id string, known boolean")


_FITTED: dict[tuple, object] = {}


def boosted_model(spark, sf_dir) -> fc.BoostedTrees:
    """All KPIs and horizons with both losses at full settings, fitted once per application."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _FITTED:
        rows = supervised_table(spark, sf_dir).drop("is_anomaly")
        _FITTED[key] = fc.BoostedTrees().fit(rows.where("segment = 'train'"), rows.where("segment = 'val'"))
    return _FITTED[key]


@query
def gbt_forecast(spark, sf_dir):
    rows = fc.long_forecasts([boosted_model(spark, sf_dir)], test_rows(spark, sf_dir))
    return rows.select("cell_id", "ts", "kpi", "horizon_min", "y", "y_hat")


@query
def gbt_selection(spark, sf_dir):
    return boosted_model(spark, sf_dir).selection_table(spark)


@query
def gbt_objectives(spark, sf_dir):
    return forecast_plan.retained_objectives(boosted_model(spark, sf_dir).selection_table(spark))


@query
def gbt_retained(spark, sf_dir):
    """One loss is retained for each of the models, the one with the least validation error."""
    log = boosted_model(spark, sf_dir).selection_table(spark)
    least = F.min("mae_validation") == F.min(F.when(F.col("retenu"), F.col("mae_validation")))
    return log.groupBy("kpi", "horizon_min").agg(F.count("*").alias("candidats"), F.count_if("retenu").alias("retenus"), least.alias("meilleur"))


@query
def gbt_start(spark, sf_dir):
    """Where every model starts: the mean, or the median for the absolute error, of its target."""
    rows = supervised_table(spark, sf_dir).where("segment = 'train'")
    targets = [target_name(k, h) for k in KPIS for h in HORIZONS]
    booster = boosting.Booster([], targets, fc.LOSSES)
    booster.start(rows)
    told = [(t, loss, float(v)) for (t, loss), v in zip(booster.pairs, booster.base)]
    return spark.createDataFrame(told, "cible string, objectif string, depart double")


@query
def gbt_importance(spark, sf_dir):
    model = boosted_model(spark, sf_dir)
    tables = [
        model.feature_importance(spark, k, h).select(F.lit(k).alias("kpi"), F.lit(h).alias("horizon_min"), "feature", "importance") for k in KPIS for h in HORIZONS
    ]
    return reduce(DataFrame.unionByName, tables)


@query
def gbt_states(spark, sf_dir):
    """Accuracy of the state that the boosted models announce."""
    return forecast_plan.state_accuracy(forecast_plan.predicted_states(boosted_model(spark, sf_dir), test_rows(spark, sf_dir)))


@query
def gbt_announced(spark, sf_dir):
    rows = forecast_plan.announced_state(boosted_model(spark, sf_dir), prepared_table(spark, sf_dir), GRID)
    return rows.select("cell_id", "ts", "horizon_min", "announced_for", "qos_state", "cause_kpi", "cause_excess")


@query
def forecast_benchmark(spark, sf_dir):
    """All five models: on the whole test segment, and on common origins with ARIMA."""
    rows = test_rows(spark, sf_dir)
    trained = supervised_table(spark, sf_dir).where("segment = 'train'")
    arima = fc.AutoRegression(history(spark, sf_dir), GRID).fit(trained)
    models = [*baselines(spark, sf_dir), arima, boosted_model(spark, sf_dir)]
    return forecast_plan.forecast_study(models, rows, select.evaluation_origins(rows, GRID))


# -- streaming --------------------------------------------------------------


def _landing(spark, sf_dir, parts: int = 3) -> str:
    """RAW as files that arrive one after the other, split by time."""
    path = new_path(spark, "landing")
    raw = load_raw(spark, sf_dir)
    bounds = [f"2024-01-{1 + 30 * n // parts:02d} 00:00:00" for n in range(1, parts)]
    for low, high in zip([None, *bounds], [*bounds, None]):
        part = raw
        if low:
            part = part.where(F.col("ts") >= F.lit(low).cast("timestamp"))
        if high:
            part = part.where(F.col("ts") < F.lit(high).cast("timestamp"))
        part.write.mode("append").parquet(path)
    return path


def _arrivals(spark, path: str, parts: int = 3) -> DataFrame:
    """The landed files as a stream of about as many batches as there were parts."""
    files = len(spark.read.schema(RAW).parquet(path).inputFiles())
    return live.read_landing(spark, path, files_per_batch=max(1, -(-files // parts)))


def _run(writer) -> None:
    writer.trigger(availableNow=True).start().awaitTermination()


def _sink(stream: DataFrame, spark: SparkSession) -> DataFrame:
    """Run a stream over what has arrived and return its appended rows."""
    out = new_path(spark, "out")
    _run(
        stream.writeStream.format("parquet").outputMode("append")
        .option("path", out).option("checkpointLocation", new_path(spark, "ckpt"))
    )
    return spark.read.schema(stream.schema).parquet(out)


@query
def stream_ingest(spark, sf_dir):
    stream = live.as_stream_rows(_arrivals(spark, _landing(spark, sf_dir)))
    out = new_path(spark, "raw")
    _run(live.ingest(stream, out, new_path(spark, "ckpt")))
    return tables.scan(spark, out, RAW)


@query
def stream_snapshots(spark, sf_dir):
    """Live rows into a snapshot table: every batch a version, files bounded by compaction."""
    stream = live.as_stream_rows(_arrivals(spark, _landing(spark, sf_dir)))
    table = SnapshotTable(spark, new_path(spark, "snapshots"), RAW, most_entries=2)
    _run(table.stream_into(stream, new_path(spark, "ckpt")))
    return table.read()


@query
def stream_latest(spark, sf_dir):
    stream = live.latest_points(_arrivals(spark, _landing(spark, sf_dir)))
    out = new_path(spark, "out")

    def keep(batch, _):
        batch.write.mode("overwrite").parquet(out)

    _run(stream.writeStream.outputMode("complete").option("checkpointLocation", new_path(spark, "ckpt")).foreachBatch(keep))
    return spark.read.schema(stream.schema).parquet(out)


@query
def stream_state(spark, sf_dir):
    stream = live.instant_state(_arrivals(spark, _landing(spark, sf_dir)))
    return _sink(stream.select("cell_id", "ts", "qos_state", "cause_kpi", "cause_excess"), spark)


@query
def stream_liveness(spark, sf_dir):
    out = new_path(spark, "out")
    now = F.lit("2024-01-31 00:00:00").cast("timestamp")
    stream = _arrivals(spark, _landing(spark, sf_dir))
    _run(live.liveness(stream, now, out, new_path(spark, "ckpt"), 600))
    return spark.read.parquet(out)


@query
def stream_means(spark, sf_dir):
    folder = new_path(spark, "means")
    stream = _arrivals(spark, _landing(spark, sf_dir))
    _run(live.means_stream(stream, folder, new_path(spark, "ckpt"), GRID))
    return tables.scan(spark, f"{folder}/means", live.MEANS)


@query
def stream_episodes(spark, sf_dir):
    flags_at, out = new_path(spark, "flags"), new_path(spark, "episodes")
    label_table(spark, sf_dir).repartition(3, "cell_id", "ts").write.parquet(flags_at)
    flags = spark.readStream.schema("cell_id string, ts timestamp, is_anomaly boolean").option("maxFilesPerTrigger", 1).parquet(flags_at)
    _run(live.episodes_stream(flags, out, new_path(spark, "ckpt"), GRID))
    return live.read_episodes(spark, out, GRID)


@query
def stream_closed_episodes(spark, sf_dir):
    """Episodes that the watermark has passed, from keyed state with timers; label rows arrive in time order."""
    flags_at, schema = new_path(spark, "flags"), "cell_id string, ts timestamp, is_anomaly boolean"
    flags = label_table(spark, sf_dir)
    for low, high in (("2024-01-01", "2024-01-12"), ("2024-01-12", "2024-01-22"), ("2024-01-22", "2030-01-01")):
        part = flags.where((F.col("ts") >= F.lit(low).cast("timestamp")) & (F.col("ts") < F.lit(high).cast("timestamp")))
        part.write.mode("append").parquet(flags_at)
    files = len(spark.read.schema(schema).parquet(flags_at).inputFiles())
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", max(1, -(-files // 3))).parquet(flags_at)
    setting = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(setting)
    stateful.use_state_store(spark)
    try:
        return _sink(stateful.closed_episodes(stream, "20 days", GRID), spark)
    finally:
        spark.conf.set(setting, before)


def _refreshed(spark, raw: DataFrame) -> DataFrame:
    """FEATURES after the stream has stored RAW in two batches that overlap in time."""
    folder, landing = new_path(spark, "store"), new_path(spark, "landing")
    early = F.col("ts") < F.lit("2024-01-16 00:00:00").cast("timestamp")
    late = F.pmod(F.xxhash64("ts"), F.lit(5)) == 0
    for part in (raw.where(early & ~late), raw.where(~early | late)):
        cut(part).write.mode("append").parquet(landing)
    _run(live.refresh_stream(_arrivals(spark, landing, 2), folder, new_path(spark, "ckpt"), GRID))
    return tables.scan(spark, f"{folder}/features", FEATURES)


@query
def stream_refresh(spark, sf_dir):
    return _refreshed(spark, load_raw(spark, sf_dir))


@query
def stream_refresh_holes(spark, sf_dir):
    """The same with holes of 400 steps in two cells."""
    hole = F.col("cell_id").isin("cell_001", "cell_004") & F.col("ts").between(
        F.lit("2024-01-06 00:00:00").cast("timestamp"), F.lit("2024-01-22 16:00:00").cast("timestamp")
    )
    return _refreshed(spark, load_raw(spark, sf_dir).where(~hole))


@query
def csv_mixed_headers(spark, sf_dir):
    """One folder, two column orders; read in a session of another time zone."""
    path, raw = new_path(spark, "csv"), load_raw(spark, sf_dir).drop("source", "ingested_at")
    even = F.pmod(F.xxhash64("ts"), F.lit(2)) == 0
    for part, columns in ((raw.where(even), raw.columns), (raw.where(~even), raw.columns[::-1])):
        naive = part.select(*columns).withColumn("ts", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))
        naive.write.mode("append").option("header", True).csv(path)
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        return cut(files.read_csv(spark, path).drop("ingested_at"))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@query
def served_elsewhere(spark, sf_dir):
    """ISO times and calendar features of a session of another time zone."""
    clean_rows = history(spark, sf_dir)
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        timed = clean_rows.select("cell_id", "ts", timegrid.hour_of_day(F.col("ts")).alias("hour_of_day"), timegrid.day_of_week(F.col("ts")).alias("day_of_week"))
        return cut(select.served(timed))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")

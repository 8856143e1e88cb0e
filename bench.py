"""Time the headline work on ``$BENCH_SF_DIR`` with ``local[$BENCH_CPUS]``; print one JSON line.

The minute-grid entries use the grid of the published figures.  Every entry
starts from its inputs; the minute-grid entries share the stored tables of the
refresh, as in production.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark import cloudpickle  # noqa: E402
from pyspark.sql import DataFrame  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

import kpiloom  # noqa: E402
from kpiloom.models import forecasters as fc  # noqa: E402
from kpiloom.models.detectors import IsolationForest, ThresholdDetector  # noqa: E402
from kpiloom.operators import explore, features, joins, select, split  # noqa: E402
from kpiloom.plans import anomaly, catalog, forecast  # noqa: E402
from kpiloom.schema import CLEAN, FEATURES  # noqa: E402
from kpiloom.session import cut, local_session, new_path  # noqa: E402
from kpiloom.sources import tables  # noqa: E402
from kpiloom.sources.events import load_raw  # noqa: E402

cloudpickle.register_pickle_by_value(kpiloom)

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
HEADLINE = [
    "clean_series", "feature_build", "latest_state", "dominant_cause", "point_delta", "autocorrelation",
    "chronological_split", "targets", "episode_metrics", "ranking", "sweep", "robust_parameters",
    "forecast_table", "state_accuracy", "upsert",
    # all four detectors with the tuned net, and all five forecasters, at full settings on the hourly grid
    "learned_comparison", "forecast_benchmark",
]


def drain(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = local_session(CPUS, shuffle_partitions=int(CPUS))
    timings: dict[str, float] = {}

    def timed(name: str, work):
        start = time.perf_counter()
        result = work()
        timings[name] = round(time.perf_counter() - start, 3)
        print(f"{name} {timings[name]}", file=sys.stderr, flush=True)
        return result

    spark.range(1000).agg(F.sum("id")).collect()

    # Raw to clean to features, stored, on the minute grid.
    store = tables.Store(spark, new_path(spark, "bench"), load_raw(spark, SF_DIR))
    timed("refresh_minute_grid", store.refresh)
    clean = tables.scan(spark, store.path("clean"), CLEAN)
    feature_rows = tables.scan(spark, store.path("features"), FEATURES)
    timed("feature_page_10000", lambda: select.page(feature_rows, 10_000).rows.collect())

    def exploration():
        rows = cut(joins.with_labels(clean, store.labels()))
        for table in (
            explore.describe(rows),
            explore.normal_vs_anomaly(rows),
            explore.hourly_profile(rows),
            explore.correlation(rows),
            explore.autocorrelation(rows),
            explore.contract_audit(rows),
        ):
            table.collect()

    timed("exploration_minute_grid", exploration)

    def detectors():
        prepared = features.prepare_features(feature_rows)
        rows = cut(split.temporal_split(joins.with_labels(prepared, store.labels())))
        columns = features.anomaly_features(rows)
        return anomaly.detector_study([ThresholdDetector(), IsolationForest(columns)], rows).collect()

    timed("detectors_minute_grid", detectors)

    def forecasts():
        prepared = features.prepare_features(feature_rows)
        rows = cut(split.temporal_split(joins.supervised(prepared, clean)).where("segment = 'test'"))
        models = [fc.Persistence(), fc.MovingAverage(), fc.SeasonalNaive(clean)]
        return forecast.forecast_study(models, rows).collect()

    timed("forecast_baselines_minute_grid", forecasts)

    for name in HEADLINE:
        catalog._STORED.clear()  # every entry pays for its own upstream tables
        catalog._FITTED.clear()
        timed(name, lambda name=name: drain(catalog.QUERIES[name](spark, SF_DIR)))

    print(
        json.dumps(
            {
                "metric": "headline queries, total wall time",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()

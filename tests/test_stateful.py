"""Stateful episodes: closed once, bounded state, restart, late rows."""

import datetime as dt
import random

import pytest

from kpiloom.session import new_path
from kpiloom.streaming import stateful

START = dt.datetime(2024, 1, 1)
SCHEMA = "cell_id string, ts timestamp, is_anomaly boolean"


def test_runs_are_joined_where_they_touch():
    assert stateful.merged_runs([(5, 5), (1, 2), (3, 3), (9, 9), (2, 2)], 1) == [(1, 3), (5, 5), (9, 9)]


def plain(rows, until):
    out = []
    for cell in sorted({r[0] for r in rows}):
        minutes = sorted({int((t - START).total_seconds() // 60) for c, t, flag in rows if c == cell and flag})
        runs = []
        for m in minutes:
            if runs and m <= runs[-1][1] + 1:
                runs[-1][1] = m
            else:
                runs.append([m, m])
        out += [(cell, a, b, b - a + 1) for a, b in runs if b + 1 < until]
    return sorted(out)


@pytest.fixture
def store(spark):
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    stateful.use_state_store(spark)
    yield
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)


def test_each_episode_is_emitted_once_also_across_a_restart(spark, store):
    rng = random.Random(6)
    rows = [(c, START + dt.timedelta(minutes=m), rng.random() < 0.5) for c in "ab" for m in range(120)]
    # batches of half an hour whose rows are mixed over ten minutes; some rows come twice
    landing, out, checkpoint = new_path(spark, "landing"), new_path(spark, "out"), new_path(spark, "ckpt")
    late = [("a", START, True)]

    def land(part):
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(landing)

    def run():
        stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(landing)
        closed = stateful.closed_episodes(stream, "10 minutes", "1 minute")
        query = closed.writeStream.format("parquet").outputMode("append").option("path", out).option("checkpointLocation", checkpoint)
        query.trigger(availableNow=True).start().awaitTermination()

    order = sorted(rows, key=lambda r: (r[1] - START).total_seconds() / 60 + rng.uniform(0, 8))
    quarter = len(order) // 4
    land(order[:quarter])
    land(order[quarter : 2 * quarter])
    run()  # stopped here, started again below
    first = spark.read.schema(stateful.EPISODE).parquet(out).count()
    land(order[2 * quarter : 3 * quarter] + order[2 * quarter : 2 * quarter + 5] + late)
    land(order[3 * quarter :])
    run()
    got = spark.read.schema(stateful.EPISODE).parquet(out).collect()
    minute = lambda t: int((t - START).total_seconds() // 60)
    told = sorted((r["cell_id"], minute(r["start_ts"]), minute(r["end_ts"]), r["points"]) for r in got)
    assert 0 < first < len(told)
    assert told == plain(rows, 119 - 10)

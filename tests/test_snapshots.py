"""Snapshot tables: what readers see, lost and concurrent writers, compaction, streams."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from kpiloom.session import new_path
from kpiloom.sources.snapshots import SnapshotTable

SCHEMA = "ts timestamp, cell_id string, v double"
START = dt.datetime(2024, 1, 1)


def rows(spark, values, days=2):
    """``{key: value}``; a key is an hour."""
    return spark.createDataFrame([(START + dt.timedelta(hours=k), f"c{k % days}", float(v)) for k, v in values.items()], SCHEMA)


@pytest.fixture
def table(spark):
    return SnapshotTable(spark, new_path(spark, "snap"), rows(spark, {0: 0}).schema, most_entries=3)


def values(df):
    return {int((r["ts"] - START).total_seconds() // 3600): r["v"] for r in df.collect()}


def test_versions_hold_what_was_committed(spark, table):
    assert table.read().count() == 0 and table.versions() == []
    table.commit(rows(spark, {k: k for k in range(60)}))
    table.commit(rows(spark, {5: 500, 100: 1}))
    old = table.read(1)
    table.commit(rows(spark, {5: 501, 6: 600}))
    assert values(old) == {k: k for k in range(60)}
    assert values(table.read()) == {k: float(k) for k in range(60)} | {5: 501.0, 6: 600.0, 100: 1.0}
    assert values(table.read(start="2024-01-03", end="2024-01-03 05:00:00")) == {k: float(k) for k in range(48, 54)}
    repeated = rows(spark, {7: 1}).union(rows(spark, {7: 2}))
    table.commit(repeated)
    assert table.read().where(F.col("ts") == F.lit(START + dt.timedelta(hours=7))).count() == 1


def test_a_lost_writer_leaves_the_old_version(spark, table, monkeypatch):
    table.commit(rows(spark, {1: 1}))
    monkeypatch.setattr(table, "_publish", lambda manifest: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        table.commit(rows(spark, {1: 2, 2: 2}))
    monkeypatch.undo()
    assert values(table.read()) == {1: 1.0}
    assert len(table.vacuum()) == 1 and values(table.read()) == {1: 1.0}


def test_of_two_writers_both_are_kept(spark, table, monkeypatch):
    """The second writer read the manifest before the first published."""
    table.commit(rows(spark, {1: 1}))
    other = SnapshotTable(spark, table.path, table.schema)
    seen = table.manifest()
    other.commit(rows(spark, {2: 2}))
    first = iter([seen])
    real = table.manifest
    monkeypatch.setattr(table, "manifest", lambda version=None: next(first, None) or real(version))
    table.commit(rows(spark, {1: 10, 3: 3}))
    assert values(other.read()) == {1: 10.0, 2: 2.0, 3: 3.0} and other.versions() == [1, 2, 3]


def test_small_batches_leave_few_files_open(spark, table):
    for k in range(14):
        table.commit(rows(spark, {k % 5: k, 30 + k: k}))
    manifest = table.manifest()
    assert max(len(e) for e in manifest.holders().values()) <= table.most_entries + 1
    assert values(table.read()) == {k % 5: float(k) for k in range(14)} | {30 + k: float(k) for k in range(14)}
    table.vacuum(keep=1)
    folders = os.listdir(f"{table.path.removeprefix('file:')}/data")
    assert set(f"data/{f}" for f in folders) == {e["folder"] for e in manifest.entries}
    assert len(values(table.read())) == 19


def test_a_stream_commits_each_batch_once(spark, table):
    landing, checkpoint = new_path(spark, "landing"), new_path(spark, "ckpt")

    def run():
        stream = spark.readStream.schema(table.schema).option("maxFilesPerTrigger", 1).parquet(landing)
        table.stream_into(stream, checkpoint).trigger(availableNow=True).start().awaitTermination()

    rows(spark, {1: 1, 2: 2}).coalesce(1).write.mode("append").parquet(landing)
    run()
    rows(spark, {2: 3}).coalesce(1).write.mode("append").parquet(landing)
    run()
    assert values(table.read()) == {1: 1.0, 2: 3.0}
    before = table.manifest()
    assert table.commit(rows(spark, {9: 9}), "ingest", before.done["ingest"]) == before.version  # a replayed batch
    assert values(table.read()) == {1: 1.0, 2: 3.0}

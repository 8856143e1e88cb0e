"""Structured Streaming forms of ingest, tail, state, refresh, means and episodes."""

from __future__ import annotations

from datetime import timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from kpiloom.functions import qos
from kpiloom.functions.timegrid import floor_to_grid, grid_us, shift, utc_date
from kpiloom.operators.clean import clean_series, dedupe_first, resample_mean
from kpiloom.operators.features import build_features, rolling
from kpiloom.operators.monitor import freshness
from kpiloom.operators.select import join_params, latest_per_cell
from kpiloom.schema import CLEAN, FEATURES, GRID, HOUR_STEPS, KPIS, LAGS, MEAN_WINDOWS, RAW, STREAM_CADENCE_SECONDS
from kpiloom.session import cut
from kpiloom.sources import tables
from kpiloom.sources.files import path_exists


def read_landing(spark: SparkSession, path: str, fmt: str = "parquet", files_per_batch: int | None = None) -> DataFrame:
    """A stream of RAW rows from files that arrive in a folder."""
    reader = spark.readStream.schema(RAW).format(fmt)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def as_stream_rows(stream: DataFrame) -> DataFrame:
    """Mark the origin of live rows."""
    return stream.withColumns(
        {"source": F.lit("stream"), "ingested_at": F.coalesce("ingested_at", F.current_timestamp())}
    )


def ingest(stream: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """Append live rows to a RAW table partitioned by day, exactly once."""
    dated = stream.withColumn("date", utc_date(F.col("ts")))
    return (
        dated.writeStream.format("parquet")
        .outputMode("append")
        .partitionBy("date")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )


def latest_points(stream: DataFrame) -> DataFrame:
    """The newest point of each cell; use update or complete mode."""
    return latest_per_cell(stream.select("cell_id", "ts", *KPIS))


def instant_state(stream: DataFrame) -> DataFrame:
    """State and cause of each raw point; keeps no state between batches."""
    return qos.with_cause(qos.classify(stream))


def liveness(stream: DataFrame, now: Column, sink: str, checkpoint: str, cadence: float = STREAM_CADENCE_SECONDS) -> DataStreamWriter:
    """Write the age of each cell's newest point after every batch."""
    newest = stream.groupBy("cell_id").agg(F.max("ts").alias("ts"))

    def report(batch: DataFrame, _: int) -> None:
        freshness(batch, now, cadence).write.mode("overwrite").parquet(sink)

    return newest.writeStream.outputMode("complete").option("checkpointLocation", checkpoint).foreachBatch(report)


def upsert_stream(stream: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """Insert or replace every batch in a stored table; a replayed batch changes nothing."""
    return (
        stream.writeStream.outputMode("append")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(lambda batch, _: tables.upsert(batch, path))
    )


class _Touched:
    """The cells a batch touches, and how far its effect reaches in a stored table.

    A series has holes of any length, so neighbours are looked up by position:
    the search reads the days next to the batch first and goes on to more days
    only while some touched cell lacks a neighbour.
    """

    def __init__(self, path: str, schema: T.StructType, ranges: DataFrame) -> None:
        self.stored = ranges.sparkSession.read.schema(tables.dated(schema)).parquet(path)
        self.ranges = ranges
        ends = self.stored.agg(F.min("date").alias("low"), F.max("date").alias("high")).first()
        self.low, self.high = ends["low"], ends["high"]

    def rows(self, low, high, columns: list[str]) -> DataFrame:
        days = self.stored.where((F.col("date") >= F.lit(low)) & (F.col("date") <= F.lit(high)))
        return join_params(days.select("cell_id", "ts", *columns), self.ranges, how="inner")

    def search(self, before: bool, columns: list[str], bound: Column, complete: Column) -> DataFrame:
        """``cell_id, _at`` from an aggregation of the rows on one side of each range."""
        edge = self.ranges.agg(utc_date(F.min("_from")).alias("a"), utc_date(F.max("_to")).alias("b")).first()
        reach = 1
        while True:
            span = timedelta(days=reach)
            low, high = (edge["a"] - span, edge["b"]) if before else (edge["a"], edge["b"] + span)
            near = self.rows(low, high, columns)
            near = near.where(F.col("ts") < F.col("_from")) if before else near.where(F.col("ts") > F.col("_to"))
            found = cut(near.groupBy("cell_id").agg(bound.alias("_at"), complete.alias("_complete")))
            seen_all = self.low is None or (low <= self.low if before else high >= self.high)
            if seen_all or self.ranges.join(found.where("_complete"), "cell_id", "left_anti").isEmpty():
                return found.drop("_complete")
            reach *= 8


def _extended(ranges: DataFrame, before: DataFrame, after: DataFrame) -> DataFrame:
    wide = ranges.join(before.withColumnRenamed("_at", "_low"), "cell_id", "left")
    wide = wide.join(after.withColumnRenamed("_at", "_high"), "cell_id", "left")
    return cut(wide.select("cell_id", F.least("_from", "_low").alias("_from"), F.greatest("_to", "_high").alias("_to")))


def _between_measurements(path: str, ranges: DataFrame, grid: str) -> DataFrame:
    """Ranges widened to the nearest measurement of every KPI on both sides, which fills interpolate towards."""
    us = grid_us(grid)
    table = _Touched(path, RAW, ranges.select("cell_id", "_from", shift(F.col("_to"), us - 1).alias("_to")))
    known = lambda side: [side(F.when(F.col(k).isNotNull(), F.col("ts"))) for k in KPIS]
    every = lambda found: reduce(lambda a, b: a & b, [c.isNotNull() for c in found])
    lasts, firsts = known(F.max), known(F.min)
    before = table.search(True, KPIS, floor_to_grid(F.least(*lasts), grid), every(lasts))
    after = table.search(False, KPIS, floor_to_grid(F.greatest(*firsts), grid), every(firsts))
    return _extended(ranges, before, after)


def _lag_reach(path: str, ranges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The instants of the stored CLEAN rows as many positions before and after each range as the longest lag."""
    n = max(LAGS)
    table = _Touched(path, CLEAN, ranges)
    found = []
    for before in (True, False):
        # The search ends at days that hold enough rows; of these the n nearest count.
        enough = table.search(before, [], F.min("ts") if before else F.max("ts"), F.count(F.lit(1)) >= n)
        days = enough.agg(utc_date(F.min("_at")).alias("a"), utc_date(F.max("_at")).alias("b")).first()
        ends = ranges.agg(utc_date(F.min("_from")).alias("a"), utc_date(F.max("_to")).alias("b")).first()
        low, high = (days["a"] or ends["a"], ends["b"]) if before else (ends["a"], days["b"] or ends["b"])
        near = table.rows(low, high, [])
        near = near.where(F.col("ts") < F.col("_from")) if before else near.where(F.col("ts") > F.col("_to"))
        order = Window.partitionBy("cell_id").orderBy(F.col("ts").desc() if before else F.col("ts").asc())
        ranked = near.withColumn("_rn", F.row_number().over(order)).where(F.col("_rn") <= n)
        found.append(cut(ranked.groupBy("cell_id").agg((F.min if before else F.max)("ts").alias("_at"))))
    return found[0], found[1]


def refresh_touched(batch: DataFrame, folder: str, grid: str = GRID) -> None:
    """Recompute CLEAN and FEATURES wherever a stored batch changes them.

    The result equals a recomputation of everything.  A fill interpolates
    between the nearest measurements, however far apart, so CLEAN is replaced from the
    last one before the batch to the first one after it.  FEATURES are replaced from there to
    the last row whose windows (by time) or lags (by row) look back into it.
    """
    us, spark = grid_us(grid), batch.sparkSession
    spans = batch.groupBy("cell_id").agg(F.min("ts").alias("a"), F.max("ts").alias("b"))
    ranges = cut(spans.select("cell_id", floor_to_grid(F.col("a"), grid).alias("_from"), floor_to_grid(F.col("b"), grid).alias("_to")))

    changed = _between_measurements(f"{folder}/raw", ranges, grid)
    # The edges of that range may in turn be interpolated in some KPI.
    needed = _between_measurements(f"{folder}/raw", changed, grid)
    raw = _within(tables.scan_dated(spark, f"{folder}/raw", RAW), needed, us - 1).select(*RAW.fieldNames())
    cleaned = _within(clean_series(raw, grid), changed, 0).select(*CLEAN.fieldNames())
    tables.replace(cleaned, f"{folder}/clean", changed)

    before, after = _lag_reach(f"{folder}/clean", changed)
    hour = (HOUR_STEPS - 1) * us
    reached = changed.join(after.withColumnRenamed("_at", "_high"), "cell_id", "left")
    reached = cut(reached.select("cell_id", "_from", F.greatest(shift(F.col("_to"), hour), "_high").alias("_to")))
    past = reached.join(before.withColumnRenamed("_at", "_low"), "cell_id", "left")
    past = past.select("cell_id", F.least(shift(F.col("_from"), -hour), "_low").alias("_from"), "_to")
    clean = _within(tables.scan_dated(spark, f"{folder}/clean", CLEAN), cut(past), 0).select(*CLEAN.fieldNames())
    built = _within(build_features(clean, grid), reached, 0).select(*FEATURES.fieldNames())
    tables.replace(built, f"{folder}/features", reached)


def _within(rows: DataFrame, ranges: DataFrame, margin: int) -> DataFrame:
    """Rows of the ranged cells inside their range; a table by day is pruned to the days of all ranges."""
    if "date" in rows.columns:
        ends = ranges.agg(utc_date(F.min("_from")).alias("a"), utc_date(F.max("_to")).alias("b")).first()
        rows = rows.where((F.col("date") >= F.lit(ends["a"])) & (F.col("date") <= F.lit(ends["b"])))
    around = join_params(rows, ranges, how="inner")
    return around.where((F.col("ts") >= F.col("_from")) & (F.col("ts") <= shift(F.col("_to"), margin))).drop("_from", "_to")


def refresh_stream(stream: DataFrame, folder: str, checkpoint: str, grid: str = GRID) -> DataStreamWriter:
    """Store each batch and refresh what it touches."""

    def step(batch: DataFrame, _: int) -> None:
        rows = cut(batch.select(*RAW.fieldNames()))  # read once: it is stored, and asked for its ranges
        if rows.isEmpty():
            return
        tables.upsert(rows, f"{folder}/raw", ["cell_id", "ts", "ingested_at"])
        refresh_touched(rows, folder, grid)

    return stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(step)


MEANS = T.StructType(
    [
        T.StructField("ts", T.TimestampType(), False),
        T.StructField("cell_id", T.StringType(), False),
        *[T.StructField(f"{k}_mean_{w}", T.DoubleType()) for k in KPIS for w in (*MEAN_WINDOWS, "60m")],
    ]
)


def means_stream(stream: DataFrame, folder: str, checkpoint: str, grid: str = GRID) -> DataStreamWriter:
    """Means over the last 5, 15, 30 and 60 grid steps, kept up to date in ``folder/means``.

    Every batch is stored, then the steps it touches and the windows that look
    back at them are computed again.  Nothing waits for a watermark: the newest
    windows are there at once, and late rows correct them.  Copies of a key
    count once, the first arrival.
    """
    windows = {**MEAN_WINDOWS, "60m": HOUR_STEPS}
    us = grid_us(grid)

    def step(batch: DataFrame, _: int) -> None:
        rows = cut(batch.select(*RAW.fieldNames()))
        if rows.isEmpty():
            return
        tables.upsert(rows, f"{folder}/raw", ["cell_id", "ts", "ingested_at"])
        spans = rows.groupBy("cell_id").agg(F.min("ts").alias("a"), F.max("ts").alias("b"))
        changed = spans.select("cell_id", floor_to_grid(F.col("a"), grid).alias("_from"), floor_to_grid(F.col("b"), grid).alias("_to"))
        reached = cut(changed.select("cell_id", "_from", shift(F.col("_to"), (HOUR_STEPS - 1) * us).alias("_to")))
        needed = cut(reached.select("cell_id", shift(F.col("_from"), -(HOUR_STEPS - 1) * us).alias("_from"), "_to"))
        raw = _within(tables.scan_dated(batch.sparkSession, f"{folder}/raw", RAW), needed, us - 1)
        bins = resample_mean(dedupe_first(raw.select(*RAW.fieldNames())), grid)
        means = rolling(bins, {f"{k}_mean_{w}": (F.avg, k, n) for k in KPIS for w, n in windows.items()}, grid)
        tables.replace(_within(means, reached, 0).select(*MEANS.fieldNames()), f"{folder}/means", reached)

    return stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(step)


EPISODES = T.StructType(
    [
        T.StructField("ts", T.TimestampType(), False),
        T.StructField("cell_id", T.StringType(), False),
        T.StructField("end_ts", T.TimestampType()),
    ]
)


def episodes_stream(flags: DataFrame, path: str, checkpoint: str, grid: str = GRID) -> DataStreamWriter:
    """Episodes of flagged grid rows, kept up to date in a table by day of their start.

    A batch's rows are merged with the stored episodes they touch, so the running
    episode is there at once and late rows may join two.
    """
    us = grid_us(grid)

    def step(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        found = cut(batch.where("is_anomaly").select("cell_id", "ts").distinct())
        if found.isEmpty():
            return
        pieces = found.select("ts", "cell_id", F.col("ts").alias("end_ts"))
        spans = found.groupBy("cell_id").agg(F.min("ts").alias("_from"), F.max("ts").alias("_to"))
        if path_exists(spark, path):
            # An episode lies under the day of its start: one that reaches this batch began no earlier than the longest known one allows.
            stored = tables.scan_dated(spark, path, EPISODES)
            longest = stored.agg(F.max(F.unix_micros("end_ts") - F.unix_micros("ts"))).first()[0] or 0
            ends = spans.agg(F.min("_from").alias("a"), F.max("_to").alias("b")).select(
                utc_date(shift(F.col("a"), -(longest + us))).alias("a"), utc_date(shift(F.col("b"), us)).alias("b")
            ).first()
            stored = stored.where(F.col("date").between(F.lit(ends["a"]), F.lit(ends["b"])))
            near = join_params(stored.drop("date"), cut(spans), how="inner")
            met = (F.col("end_ts") >= shift(F.col("_from"), -us)) & (F.col("ts") <= shift(F.col("_to"), us))
            pieces = pieces.union(near.where(met).select("ts", "cell_id", "end_ts"))
        pieces = cut(pieces)
        before = Window.partitionBy("cell_id").orderBy("ts", "end_ts").rowsBetween(Window.unboundedPreceding, -1)
        starts = F.coalesce(F.col("ts") > shift(F.max("end_ts").over(before), us), F.lit(True))
        order = Window.partitionBy("cell_id").orderBy("ts", "end_ts")
        numbered = pieces.withColumn("_new", starts.cast("int")).withColumn("_run", F.sum("_new").over(order))
        merged = numbered.groupBy("cell_id", "_run").agg(F.min("ts").alias("ts"), F.max("end_ts").alias("end_ts"))
        ranges = cut(pieces.groupBy("cell_id").agg(F.min("ts").alias("_from"), F.max("ts").alias("_to")))
        tables.replace(merged.select(*EPISODES.fieldNames()), path, ranges)

    return flags.writeStream.option("checkpointLocation", checkpoint).foreachBatch(step)


def read_episodes(spark: SparkSession, path: str, grid: str = GRID) -> DataFrame:
    """``cell_id, start_ts, end_ts, points``; an episode has a row at every step."""
    points = F.floor((F.unix_micros("end_ts") - F.unix_micros("ts")) / grid_us(grid)) + 1
    return tables.scan(spark, path, EPISODES).select("cell_id", F.col("ts").alias("start_ts"), "end_ts", points.alias("points"))

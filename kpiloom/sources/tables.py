"""The stored tables: RAW, CLEAN and FEATURES as parquet partitioned by day."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kpiloom.functions.timegrid import utc_date
from kpiloom.operators.clean import clean_series, labels_on_grid
from kpiloom.operators.features import build_features
from kpiloom.operators.select import join_params, require_cell, where_range
from kpiloom.schema import CLEAN, FEATURES, GRID, KEY, RAW
from kpiloom.session import cut
from kpiloom.sources.files import path_exists


def dated(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField("date", T.DateType())])


def rows_by_day(df: DataFrame) -> DataFrame:
    """Rows ready to be written by day, sorted so that row groups carry tight bounds.

    ``rebalance`` lets Spark split a large day over many tasks and join small days.
    """
    dated = df.withColumn("date", utc_date(F.col("ts")))
    return dated.hint("rebalance", F.col("date")).sortWithinPartitions("date", "cell_id", "ts")


def append(df: DataFrame, path: str) -> None:
    rows_by_day(df).write.mode("append").partitionBy("date").parquet(path)


def merge_rows(old: DataFrame, new: DataFrame, keys: list[str] = KEY) -> DataFrame:
    """``old`` with the rows of ``new`` inserted or, on an equal key, replaced."""
    both = old.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)))
    newest = Window.partitionBy(*keys).orderBy(F.col("_new").desc(), *_arrival(old, keys))
    return both.withColumn("_rn", F.row_number().over(newest)).where("_rn = 1").drop("_rn", "_new")


def _arrival(df: DataFrame, keys: list[str]) -> list[str]:
    """An order of rows with equal keys that depends on nothing but the rows: first arrival, source, values."""
    first = [c for c in ("ingested_at", "source") if c in df.columns and c not in keys]
    return [*first, *[c for c in df.columns if c not in keys and c not in first]]


def first_per_key(df: DataFrame, keys: list[str] = KEY) -> DataFrame:
    """One row per key, the same one in every run; Spark limits each group before the shuffle."""
    order = Window.partitionBy(*keys).orderBy(*(_arrival(df, keys) or keys))
    return df.withColumn("_rn", F.row_number().over(order)).where("_rn = 1").drop("_rn")


def upsert(df: DataFrame, path: str, keys: list[str] = KEY, unique: bool = False) -> None:
    """Insert or replace rows; only the days present in ``df`` are rewritten.

    ``unique`` says that no key repeats in ``df``.  Spark stages the new files and
    swaps each day's folder when the job commits.
    """
    spark = df.sparkSession
    rows = df if unique else first_per_key(df, keys)
    if not path_exists(spark, path):
        append(rows, path)
        return
    # Staged once: the rows are needed for the list of days and for the merge.
    staged = cut(rows)
    days = staged.select(utc_date(F.col("ts")).alias("date")).distinct()
    stored = spark.read.schema(dated(df.schema)).parquet(path)
    touched = stored.join(days, "date", "left_semi").select(*df.columns)
    merged = merge_rows(touched, staged, keys)
    rows_by_day(merged).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("date").parquet(path)


def replace(df: DataFrame, path: str, ranges: DataFrame) -> None:
    """Put ``df`` in place of the stored rows inside ``ranges`` (``cell_id, _from, _to``, one row per cell).

    Only days that hold an old or a new row of a range are rewritten.
    """
    spark, columns = df.sparkSession, df.columns
    if not path_exists(spark, path):
        append(df, path)
        return
    new = cut(df.withColumn("date", utc_date(F.col("ts"))))
    stored = spark.read.schema(dated(df.schema)).parquet(path)
    ends = ranges.agg(utc_date(F.min("_from")).alias("a"), utc_date(F.max("_to")).alias("b")).first()
    near = stored.where((F.col("date") >= F.lit(ends["a"])) & (F.col("date") <= F.lit(ends["b"])))
    inside = (F.col("ts") >= F.col("_from")) & (F.col("ts") <= F.col("_to"))
    marked = join_params(near, ranges).withColumn("_gone", F.coalesce(inside, F.lit(False)))
    days = cut(marked.where("_gone").select("date").union(new.select("date")).distinct())
    kept = marked.join(days, "date", "left_semi").where("NOT _gone").select(*columns)
    merged = cut(kept.unionByName(new.select(*columns)))
    emptied = days.join(merged.select(utc_date(F.col("ts")).alias("date")).distinct(), "date", "left_anti")
    rows_by_day(merged).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("date").parquet(path)
    for row in emptied.collect():  # days that lost their last row: their folder is overwritten with no rows
        merged.limit(0).write.mode("overwrite").parquet(f"{path}/date={row['date']}")


def scan_dated(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All columns of a stored table and its day."""
    return spark.read.schema(dated(schema)).parquet(path)


def scan(spark: SparkSession, path: str, schema: T.StructType, columns: list[str] | None = None, since=None) -> DataFrame:
    """Named columns of a stored table, optionally from an instant on."""
    rows = where_range(spark.read.schema(dated(schema)).parquet(path), start=since)
    return rows.select(*(columns or schema.fieldNames()))


class Store:
    """One set of tables below a folder, and the same tables computed from RAW.

    ``mode`` ``tables`` insists on stored tables, ``local`` on computing from RAW,
    ``auto`` prefers what is stored.
    """

    def __init__(self, spark: SparkSession, folder: str, raw: DataFrame | None = None, mode: str = "auto", grid: str = GRID):
        if mode not in ("auto", "tables", "local"):
            raise ValueError(f"unknown mode {mode!r}")
        self.spark, self.folder, self._raw, self.mode, self.grid = spark, folder.rstrip("/"), raw, mode, grid

    def path(self, table: str) -> str:
        return f"{self.folder}/{table}"

    def active_source(self, table: str = "clean") -> str:
        if self.mode == "local":
            return "local"
        stored = path_exists(self.spark, self.path(table))
        if self.mode == "tables" and not stored:
            raise FileNotFoundError(f"{self.path(table)} was never written")
        return "tables" if stored else "local"

    def raw(self) -> DataFrame:
        if self._raw is not None:
            return self._raw
        return scan(self.spark, self.path("raw"), RAW)

    def _load(self, table: str, schema: T.StructType, compute, cell_id, start, end) -> DataFrame:
        if self.active_source(table) == "tables":
            rows = where_range(self.spark.read.schema(dated(schema)).parquet(self.path(table)), cell_id, start, end)
            rows = rows.select(*schema.fieldNames())
        else:
            rows = where_range(compute(), cell_id, start, end).select(*schema.fieldNames())
        return rows

    def history(self, cell_id: str | None = None, start=None, end=None) -> DataFrame:
        return self._load("clean", CLEAN, lambda: clean_series(self.raw(), self.grid), cell_id, start, end)

    def features(self, cell_id: str | None = None, start=None, end=None) -> DataFrame:
        return self._load("features", FEATURES, lambda: build_features(self.history(), self.grid), cell_id, start, end)

    def labels(self, cell_id: str | None = None, start=None, end=None) -> DataFrame:
        return where_range(labels_on_grid(self.raw(), self.grid), cell_id, start, end).select("ts", "cell_id", "is_anomaly")

    def require_cell(self, cell_id: str) -> None:
        require_cell(self.history(), cell_id)

    def refresh(self) -> None:
        """RAW to CLEAN to FEATURES, each written once; features read the stored CLEAN."""
        upsert(clean_series(self.raw(), self.grid).select(*CLEAN.fieldNames()), self.path("clean"), unique=True)
        clean = scan(self.spark, self.path("clean"), CLEAN)
        upsert(build_features(clean, self.grid).select(*FEATURES.fieldNames()), self.path("features"), unique=True)

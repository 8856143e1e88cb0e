"""Reading measurement files and writing result tables."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kpiloom.operators.clean import clean_series, labels_on_grid
from kpiloom.operators.features import build_features
from kpiloom.operators.joins import with_labels
from kpiloom.schema import GRID, RAW, REQUIRED_RAW
from kpiloom.session import cut


class MissingColumnsError(ValueError):
    """A file lacks contract columns."""


def csv_headers(spark: SparkSession, path: str) -> dict[tuple[str, ...], list[str]]:
    """The files of a CSV folder by their column names, each read from the file's own first line."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"))
    # A file's first line is the first row of its first split.
    heads = lines.where("at = 0").groupBy("file").agg(F.first("value").alias("line"))
    found: dict[tuple[str, ...], list[str]] = {}
    for row in heads.collect():  # one row per file, as in any file listing
        names = tuple(n.strip().strip('"') for n in row["line"].removeprefix("\ufeff").split(","))
        found.setdefault(names, []).append(row["file"])
    return found


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """RAW from a CSV file or folder with an explicit schema.

    Files may order their columns differently: those of one header are read
    together.  Missing required columns fail before any row is read, and a value
    that is not of its column's type fails the query rather than becoming NULL.
    ``source`` and ``ingested_at`` get defaults.  A time without zone is UTC.
    """
    headers = csv_headers(spark, path)
    if not headers:
        raise MissingColumnsError(f"{path} holds no header")
    for header, files in headers.items():
        missing = [c for c in REQUIRED_RAW if c not in header]
        if missing:
            raise MissingColumnsError(f"{files[0]} lacks {missing}")
    return reduce(DataFrame.unionByName, [_read_alike(spark, files, list(header)) for header, files in sorted(headers.items())])


def _read_alike(spark: SparkSession, files: list[str], header: list[str]) -> DataFrame:
    kinds = {f.name: f.dataType for f in RAW}
    schema = T.StructType([T.StructField(c, kinds.get(c, T.StringType())) for c in header])
    reader = spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").option("timeZone", "UTC")
    rows = reader.option("columnPruning", False).csv(files)
    if "source" not in header:
        rows = rows.withColumn("source", F.lit("batch"))
    if "ingested_at" not in header:
        rows = rows.withColumn("ingested_at", F.current_timestamp())
    return rows.withColumn("source", F.coalesce("source", F.lit("batch"))).select(*RAW.fieldNames())


def read_series(spark: SparkSession, path: str) -> DataFrame:
    """A CSV of measurements in ``(cell_id, ts)`` order."""
    return read_csv(spark, path).orderBy("cell_id", "ts")


def write_table(df: DataFrame, path: str, fmt: str = "csv", one_file: bool = True) -> None:
    """Write a result table as CSV or JSON with its header; metric tables, being small, as one file."""
    writer = (df.coalesce(1) if one_file else df).write.mode("overwrite")
    writer.option("header", True).csv(path) if fmt == "csv" else writer.json(path)


def read_table(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "csv") -> DataFrame:
    """Read a result table back; a table that was never written is empty."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    reader = spark.read.schema(schema)
    return reader.option("header", True).csv(path) if fmt == "csv" else reader.json(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def first_existing(spark: SparkSession, candidates: Iterable[str]) -> str:
    """The first path that exists; list the full history before samples."""
    for path in candidates:
        if path_exists(spark, path):
            return path
    raise FileNotFoundError("none of the candidate files exists")


def sample_tables(raw: DataFrame, cells: int = 2, days: int = 1, grid: str = GRID) -> dict[str, DataFrame]:
    """Clean, labelled and feature rows of the first cells over the last days."""
    clean = clean_series(raw, grid)
    newest = clean.agg(F.max("ts").alias("t")).scalar()
    recent = F.col("ts") >= newest - F.make_dt_interval(F.lit(days))
    # Only the chosen cells go through labels and features: a handful of names, found first.
    names = cut(clean.select("cell_id").distinct().orderBy("cell_id").limit(cells))
    own = raw.join(names, "cell_id", "left_semi")
    series = clean_series(own, grid)
    chosen = series.where(recent)
    return {
        "sample_kpi": chosen,
        "sample_kpi_with_labels": with_labels(chosen, labels_on_grid(own, grid)),
        "sample_features": build_features(series, grid).where(recent),
    }


def export_samples(raw: DataFrame, folder: str, cells: int = 2, days: int = 1, grid: str = GRID) -> None:
    for name, table in sample_tables(raw, cells, days, grid).items():
        write_table(table.orderBy("cell_id", "ts"), f"{folder}/{name}", one_file=False)

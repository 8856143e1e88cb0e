"""Session defaults and lineage cuts."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A local session for tests and the bench; clusters bring their own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("kpiloom")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder for checkpoints and intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``.  Only a local master may
    fall back to a folder of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    own = tempfile.mkdtemp(prefix="kpiloom-")
    atexit.register(shutil.rmtree, own, ignore_errors=True)  # nothing in it outlives the process
    spark.conf.set("spark.checkpoint.dir", own)
    return own


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    The result survives lost executors and starts a fresh lineage.
    """
    path = new_path(df.sparkSession, "cut")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def new_path(spark: SparkSession, prefix: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/{prefix}-{uuid.uuid4().hex}"

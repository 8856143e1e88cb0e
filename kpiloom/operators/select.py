"""Filters, pages, tails and samples of a series table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kpiloom.functions.timegrid import iso_utc, utc_date
from kpiloom.operators.blocks import in_ranges, with_position
from kpiloom.schema import CONTRACT_VERSION, GRID, MAX_PAGE, THRESHOLDS


class UnknownCellError(KeyError):
    """The asked cell has no row."""


def where_range(df: DataFrame, cell_id: str | None = None, start=None, end=None) -> DataFrame:
    """Rows of a cell in a time range, both ends included; absent bounds are open.

    On a table partitioned by ``date`` the range also prunes partitions.
    """
    if cell_id is not None:
        df = df.where(F.col("cell_id") == cell_id)
    for bound, keep in ((start, Column.__ge__), (end, Column.__le__)):
        if bound is not None:
            moment = F.lit(bound).cast("timestamp")
            df = df.where(keep(F.col("ts"), moment))
            if "date" in df.columns:
                df = df.where(keep(F.col("date"), utc_date(moment)))
    return df


def require_cell(df: DataFrame, cell_id: str) -> None:
    if df.where(F.col("cell_id") == cell_id).limit(1).isEmpty():
        raise UnknownCellError(cell_id)


def since_last(df: DataFrame, span: str) -> DataFrame:
    """Rows within ``span`` (``"2 days"``) of the table's newest row."""
    newest = df.agg(F.max("ts").alias("newest")).scalar()
    return df.where(F.col("ts") >= newest - F.expr(f"INTERVAL {span}"))


def served(df: DataFrame, hidden: tuple[str, ...] = ("is_anomaly",)) -> DataFrame:
    """Rows as handed out: no ground truth, timestamps as ISO text."""
    shown = df.drop(*hidden)
    times = [f.name for f in shown.schema if f.dataType.typeName().startswith("timestamp")]
    return shown.withColumns({c: iso_utc(F.col(c)) for c in times})


def cells(df: DataFrame) -> DataFrame:
    """The sorted distinct cells, each with the total count."""
    found = df.select("cell_id").distinct()
    total = found.agg(F.count(F.lit(1)).alias("n")).scalar()
    return found.select("cell_id", total.alias("count")).orderBy("cell_id")


def threshold_table(spark, thresholds=THRESHOLDS) -> DataFrame:
    rows = [
        (k, b.unit, b.good, b.degraded, b.higher_is_worse, CONTRACT_VERSION)
        for k, b in thresholds.items()
    ]
    return spark.createDataFrame(
        rows,
        "kpi string, unit string, good double, degraded double, "
        "higher_is_worse boolean, contract_version string",
    )


@dataclass(frozen=True)
class Page:
    """A page of rows and the one-row table ``total, count, has_more``."""

    rows: DataFrame
    summary: DataFrame


def page(
    df: DataFrame, limit: int, offset: int = 0, cell_id: str | None = None, start=None, end=None
) -> Page:
    """Rows ``offset … offset+limit`` in ``(ts, cell_id)`` order."""
    if not 0 <= limit <= MAX_PAGE or offset < 0:
        raise ValueError(f"limit must be at most {MAX_PAGE} and offset not negative")
    matching = where_range(df, cell_id, start, end)
    count = F.greatest(F.least(F.col("total") - offset, F.lit(limit)), F.lit(0))
    summary = (
        matching.agg(F.count(F.lit(1)).alias("total"))
        .withColumn("count", count)
        .withColumn("has_more", F.lit(offset) + F.col("count") < F.col("total"))
    )
    return Page(matching.orderBy("ts", "cell_id").offset(offset).limit(limit), summary)


def page_after(df: DataFrame, limit: int, last_ts=None, last_cell: str | None = None) -> DataFrame:
    """The next page after a known last row; the cost does not grow with depth."""
    if last_ts is not None:
        ts = F.lit(last_ts).cast("timestamp")
        df = df.where((F.col("ts") > ts) | ((F.col("ts") == ts) & (F.col("cell_id") > last_cell)))
    return df.orderBy("ts", "cell_id").limit(limit)


def latest(df: DataFrame, n: int = 100, cell_id: str | None = None) -> DataFrame:
    """The ``n`` newest rows."""
    return where_range(df, cell_id).orderBy(F.col("ts").desc(), "cell_id").limit(n)


def stream_rows(raw: DataFrame) -> DataFrame:
    return raw.where(F.col("source") == "stream")


def stream_tail(raw: DataFrame, limit: int = 50, cell_id: str | None = None) -> DataFrame:
    """The newest raw rows that came from the live feed."""
    return latest(stream_rows(raw), limit, cell_id)


def latest_per_cell(df: DataFrame) -> DataFrame:
    """The newest row of each cell.

    Of several rows at the newest instant the last arrival counts, then the
    greatest values in column order, so all columns come from one row.
    """
    ranked = [c for c in ("ts", "ingested_at", "source") if c in df.columns]
    others = [c for c in df.columns if c not in ("cell_id", *ranked)]
    newest = df.groupBy("cell_id").agg(F.max(F.struct(*ranked, *others)).alias("_row"))
    return newest.select(*[c if c == "cell_id" else F.col(f"_row.{c}") for c in df.columns])


def first_cells(df: DataFrame, n: int) -> DataFrame:
    """Rows of the first ``n`` cells by name."""
    chosen = df.select("cell_id").distinct().orderBy("cell_id").limit(n)
    return df.join(chosen, "cell_id", "left_semi")


def evaluation_origins(df: DataFrame, grid: str = GRID, every: int = 30, most: int | None = None) -> DataFrame:
    """Every ``every``-th row of each cell; ``most`` limits them per cell if given."""
    placed = with_position(df, grid)
    kept = placed.where(F.col("_pos") % every == 0)
    return (kept.where(F.col("_pos") < every * most) if most is not None else kept).drop("_pos")


def systematic_sample(df: DataFrame, grid: str = GRID, most: int = 20_000) -> DataFrame:
    """Every ``n // most``-th row of the table in ``(cell_id, ts)`` order, at most ``most``.

    Positions come from per-cell counts, summed over ranges of cells.
    """
    placed = with_position(df, grid, totals=True)
    sizes = df.groupBy("cell_id").agg(F.count(F.lit(1)).alias("_size"))
    ranged = in_ranges(sizes, "cell_id")
    # One row per range is added up by itself; cells only within their range.
    sums = ranged.groupBy("_range").agg(F.sum("_size").alias("_sum"))
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = sums.select("_range", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_ahead"), F.sum("_sum").over(whole).alias("_n"))
    within = Window.partitionBy("_range").orderBy("cell_id").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranged.join(offsets, "_range").select(
        "cell_id", (F.col("_ahead") + F.coalesce(F.sum("_size").over(within), F.lit(0))).alias("_start"), "_n"
    )
    step = F.greatest(F.floor(F.col("_n") / F.lit(most)), F.lit(1))
    rank = F.col("_start") + F.col("_pos")
    return (
        join_params(placed, starts)
        .where((rank % step == 0) & (rank < step * most))
        .drop("_pos", "_rows", "_start", "_n")
    )


def join_params(df: DataFrame, params: DataFrame, salts: int = 32, how: str = "left") -> DataFrame:
    """Bring one row of parameters per cell to a long table.

    Spark broadcasts ``params`` when it finds it small.  Otherwise both sides are
    shuffled, and the salt spreads a cell that holds a large share of the rows.
    """
    salted = df.withColumn("_salt", F.pmod(F.xxhash64("ts"), F.lit(salts)))
    copies = params.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))))
    return salted.join(copies, ["cell_id", "_salt"], how).drop("_salt")

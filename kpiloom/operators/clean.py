"""From raw measurements to a gap-filled series on a regular grid."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kpiloom.functions.numeric import all_present, clip
from kpiloom.functions.timegrid import floor_to_grid, step_start
from kpiloom.operators.blocks import (
    BEFORE_HERE,
    BLOCK,
    BLOCK_STEPS,
    UP_TO_HERE,
    last_known,
    over_blocks,
    with_block,
)
from kpiloom.schema import FILL_LIMIT, GRID, KPIS, VALUE_BOUNDS


def clip_bounds(df: DataFrame) -> DataFrame:
    """Limit each KPI to its physical range."""
    return df.withColumns(
        {k: clip(F.col(k), *limits) for k, limits in VALUE_BOUNDS.items() if k in df.columns}
    )


def dedupe_first(df: DataFrame) -> DataFrame:
    """Keep the first arrival per ``(cell_id, ts)``.

    Arrival is ``ingested_at``; source and values make the choice unique.  Spark
    limits each group before the shuffle, so copies of one key do not pile up.
    """
    order = [c for c in ("ingested_at", "source", *KPIS) if c in df.columns]
    first = Window.partitionBy("cell_id", "ts").orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(first)).where("_rn = 1").drop("_rn")


def resample_mean(df: DataFrame, grid: str = GRID) -> DataFrame:
    """Mean per grid step; steps without a measurement are not emitted."""
    return df.groupBy("cell_id", floor_to_grid(F.col("ts"), grid).alias("ts")).agg(
        *[F.avg(k).alias(k) for k in KPIS]
    )


def _steps_to_next(df: DataFrame, grid: str, block_steps: int) -> DataFrame:
    """Add ``_i`` and ``_gap``, the distance to the cell's next row (NULL at its end)."""
    blocked = with_block(df, grid, block_steps)
    firsts = blocked.groupBy(*BLOCK).agg(F.min("_i").alias("_first"))
    carry = firsts.select(*BLOCK, F.lead("_first").over(over_blocks()).alias("_after"))
    here = Window.partitionBy(*BLOCK).orderBy("_i")
    following = F.coalesce(F.lead("_i").over(here), F.col("_after"))
    return blocked.join(carry, BLOCK).withColumn("_gap", following - F.col("_i"))


def _every_offset(df: DataFrame, block_steps: int) -> DataFrame:
    """One row per grid step from a row up to the next one, as ``_off``.

    Long gaps are opened in two stages, so no array outgrows a block.
    """
    last = F.coalesce(F.col("_gap"), F.lit(1)) - 1
    pieces = df.withColumn(
        "_piece", F.explode(F.sequence(F.lit(0).cast("long"), F.floor(last / F.lit(block_steps))))
    )
    start = F.col("_piece") * block_steps
    return pieces.withColumn(
        "_off", F.explode(F.sequence(start, F.least(last, start + (block_steps - 1))))
    ).drop("_piece")


def regular_grid(df: DataFrame, grid: str = GRID, block_steps: int = BLOCK_STEPS) -> DataFrame:
    """Emit every grid step between a cell's first and last row; new steps hold NULLs."""
    values = [c for c in df.columns if c not in ("cell_id", "ts")]
    opened = _every_offset(_steps_to_next(df, grid, block_steps), block_steps)
    return opened.select(
        "cell_id",
        step_start(F.col("_i") + F.col("_off"), grid).alias("ts"),
        *[F.when(F.col("_off") == 0, F.col(c)).alias(c) for c in values],
    )


def _interpolated(kpi: str, at: Column, limit: int) -> Column:
    before_i, before_v = F.col(f"_pi_{kpi}"), F.col(f"_pv_{kpi}")
    after_i, after_v = F.col(f"_ni_{kpi}"), F.col(f"_nv_{kpi}")
    since, until = at - before_i, after_i - at
    slope = (after_v - before_v) / (after_i - before_i)
    reached = F.coalesce(since <= limit, F.lit(False)) | F.coalesce(until <= limit, F.lit(False))
    return F.when(since == 0, before_v).when(
        reached, F.coalesce(before_v + slope * since, before_v, after_v)
    )


def fill_gaps(
    df: DataFrame,
    grid: str = GRID,
    limit: int = FILL_LIMIT,
    whole_grid: bool = False,
    block_steps: int = BLOCK_STEPS,
) -> DataFrame:
    """Linear fill of at most ``limit`` steps from each side, and ``is_missing``.

    Takes resampled rows.  ``whole_grid`` emits all steps, unfilled ones as NULL.
    By default only steps a fill can reach are emitted: farther ones hold no
    value in any KPI, and cleaning would drop them again.
    """
    blocked = with_block(df, grid, block_steps)
    known = {k: F.when(F.col(k).isNotNull(), F.col("_i")) for k in KPIS}

    edges = [F.min("_i").alias("_first")]
    for k in KPIS:
        edges += [
            F.min(known[k]).alias(f"_fi_{k}"),
            F.min_by(F.col(k), known[k]).alias(f"_fv_{k}"),
            F.max(known[k]).alias(f"_li_{k}"),
            F.max_by(F.col(k), known[k]).alias(f"_lv_{k}"),
        ]
    summary = blocked.groupBy(*BLOCK).agg(*edges)
    earlier = over_blocks().rowsBetween(*BEFORE_HERE)
    later = over_blocks(descending=True).rowsBetween(*BEFORE_HERE)
    carried = [F.lead("_first").over(over_blocks()).alias("_after")]
    for k in KPIS:
        carried += [
            last_known(F.col(f"_li_{k}"), earlier).alias(f"_cpi_{k}"),
            last_known(F.col(f"_lv_{k}"), earlier).alias(f"_cpv_{k}"),
            last_known(F.col(f"_fi_{k}"), later).alias(f"_cni_{k}"),
            last_known(F.col(f"_fv_{k}"), later).alias(f"_cnv_{k}"),
        ]
    carry = summary.select(*BLOCK, *carried)

    forward = Window.partitionBy(*BLOCK).orderBy("_i")
    backward = Window.partitionBy(*BLOCK).orderBy(F.col("_i").desc())
    so_far, to_come = forward.rowsBetween(*UP_TO_HERE), backward.rowsBetween(*BEFORE_HERE)
    neighbours = {"_gap": F.coalesce(F.lead("_i").over(forward), F.col("_after")) - F.col("_i")}
    for k in KPIS:
        neighbours |= {
            f"_pi_{k}": F.coalesce(last_known(known[k], so_far), F.col(f"_cpi_{k}")),
            f"_pv_{k}": F.coalesce(last_known(F.col(k), so_far), F.col(f"_cpv_{k}")),
            f"_ni_{k}": F.coalesce(last_known(known[k], to_come), F.col(f"_cni_{k}")),
            f"_nv_{k}": F.coalesce(last_known(F.col(k), to_come), F.col(f"_cnv_{k}")),
        }
    placed = blocked.join(carry, BLOCK).withColumns(neighbours)

    if whole_grid:
        opened = _every_offset(placed, block_steps)
    else:
        zero, last = F.lit(0).cast("long"), F.coalesce(F.col("_gap"), F.lit(1)) - 1
        reachable = F.when(last <= 2 * limit, F.sequence(zero, last)).otherwise(
            F.concat(F.sequence(zero, F.lit(limit).cast("long")), F.sequence(last - (limit - 1), last))
        )
        opened = placed.withColumn("_off", F.explode(reachable))
    at = F.col("_i") + F.col("_off")
    return opened.select(
        "cell_id",
        step_start(at, grid).alias("ts"),
        *[_interpolated(k, at, limit).alias(k) for k in KPIS],
        ((F.col("_off") > 0) | F.col("throughput").isNull()).alias("is_missing"),
    )


def drop_long_gaps(df: DataFrame) -> DataFrame:
    """Drop steps whose gap was too long to fill; other KPIs may stay NULL."""
    return df.where(all_present(["throughput", "latency"]))


def clean_series(
    raw: DataFrame, grid: str = GRID, limit: int = FILL_LIMIT, block_steps: int = BLOCK_STEPS
) -> DataFrame:
    """RAW to CLEAN: clip, first arrival, grid mean, gap fill, drop long gaps."""
    bins = resample_mean(dedupe_first(clip_bounds(raw)), grid)
    return drop_long_gaps(fill_gaps(bins, grid, limit, block_steps=block_steps))


def labels_on_grid(raw: DataFrame, grid: str = GRID, block_steps: int = BLOCK_STEPS) -> DataFrame:
    """One label per grid step; a step without measurements is normal."""
    full = regular_grid(labels_by_floor(raw, grid), grid, block_steps)
    return full.withColumn("is_anomaly", F.coalesce("is_anomaly", F.lit(False)))


def labels_by_floor(raw: DataFrame, grid: str = GRID) -> DataFrame:
    """One label per measured grid step: anomalous if any measurement was."""
    return raw.groupBy("cell_id", floor_to_grid(F.col("ts"), grid).alias("ts")).agg(
        F.bool_or(F.coalesce(F.col("is_anomaly"), F.lit(False))).alias("is_anomaly")
    )

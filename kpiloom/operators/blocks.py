"""Ordered work on long series, cut into blocks.

A window over a whole cell puts that cell into one task.  Here every ordered
operator runs on ``(cell_id, block of grid steps)`` instead.  What a block needs
from its neighbours arrives in one of two ways:

* a *halo*: rows near an edge are copied into the neighbouring block;
* a *carry*: each block is reduced to one summary row, a window over the few
  summaries of a cell finds what crosses the edge, and an equi-join on
  ``(cell_id, block)`` brings it back.

A block holds at most ``block_steps`` rows of a gridded table, so no task grows
with the length of a series.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kpiloom.functions.timegrid import step_index, whole_div
from kpiloom.session import cut

BLOCK_STEPS = 8192
BLOCK = ["cell_id", "_block"]


def with_block(df: DataFrame, grid: str, block_steps: int = BLOCK_STEPS) -> DataFrame:
    """Add the step number ``_i`` and its ``_block``."""
    stepped = df.withColumn("_i", step_index(F.col("ts"), grid))
    return stepped.withColumn("_block", whole_div(F.col("_i"), block_steps))


def with_halo(
    df: DataFrame, index: str, before: int = 0, after: int = 0, block_steps: int = BLOCK_STEPS
) -> DataFrame:
    """Assign rows to blocks of ``index`` and copy edge rows into neighbours.

    Each block then also holds the rows of the ``before`` preceding and
    ``after`` following index values; ``_own`` is false on the copies.
    """
    if max(before, after) > block_steps:
        raise ValueError("a halo must not be longer than a block")
    own = whole_div(F.col(index), block_steps)
    inside = F.col(index) - own * block_steps
    targets = F.array_compact(
        F.array(
            own,
            F.when(inside >= block_steps - before, own + 1),
            F.when(inside < after, own - 1),
        )
    )
    return df.withColumn("_block", F.explode(targets)).withColumn("_own", F.col("_block") == own)


def in_block(index: str = "_i") -> Window:
    return Window.partitionBy(*BLOCK).orderBy(index)


def over_blocks(descending: bool = False) -> Window:
    order = F.col("_block").desc() if descending else F.col("_block").asc()
    return Window.partitionBy("cell_id").orderBy(order)


UP_TO_HERE = (Window.unboundedPreceding, Window.currentRow)
BEFORE_HERE = (Window.unboundedPreceding, -1)


def with_position(
    df: DataFrame, grid: str, block_steps: int = BLOCK_STEPS, totals: bool = False
) -> DataFrame:
    """Add ``_pos``, the 0-based row number of a row in its cell by time.

    With ``totals`` also ``_rows``, the number of rows of the cell.
    """
    blocked = with_block(df, grid, block_steps)
    sizes = blocked.groupBy(*BLOCK).agg(F.count(F.lit(1)).alias("_size"))
    carry = sizes.select(
        *BLOCK,
        F.coalesce(F.sum("_size").over(over_blocks().rowsBetween(*BEFORE_HERE)), F.lit(0)).alias("_offset"),
        F.sum("_size").over(Window.partitionBy("cell_id")).alias("_rows"),
    )
    if not totals:
        carry = carry.drop("_rows")
    numbered = blocked.withColumn("_rank", F.row_number().over(in_block()))
    return (
        numbered.join(carry, BLOCK)
        .withColumn("_pos", F.col("_offset") + F.col("_rank") - 1)
        .drop("_rank", "_offset", "_i", "_block")
    )


def in_ranges(df: DataFrame, *order: str) -> DataFrame:
    """Rows in ranges of ``order`` numbered ``_range``, as many ranges as Spark's shuffle makes of the data.

    The rows are written, since range bounds are sampled and would not be the
    same in a second run.  A sum over earlier ranges plus a window within one
    replaces a window over everything.
    """
    return cut(df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()))


def last_known(value: Column, window: Window) -> Column:
    return F.last(value, ignorenulls=True).over(window)

"""Exact quantiles without gathering a group in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kpiloom.operators.select import join_params

# Sketch sizes: one per group, or a finer one when there is only one group.
GROUP_ACCURACY, TABLE_ACCURACY = 1_000, 10_000
# Each bracket is cut into this many equal value ranges; only those with a wanted rank are ordered.
PARTS = 256


def exact_quantiles(
    df: DataFrame,
    columns: list[str],
    probs: list[float],
    by: str | None = None,
    few_groups: bool = False,
    accuracy: int | None = None,
) -> DataFrame:
    """Linearly interpolated quantiles as rows ``(by, name, prob, value, n)``.

    Two passes.  A sketch of fixed size brackets each wanted rank.  The second
    pass counts what lies below a bracket and the distinct values inside it, a
    share of about ``8 / accuracy``.  Brackets are cut into ranges, and only the
    ranges that hold a wanted rank are ordered.  Equal values are counted before
    the shuffle.  Groups of at most ``accuracy`` values are bracketed whole.

    ``by`` may be ``cell_id``, or any column of ``few_groups`` values.
    """
    keys = [by] if by else []
    accuracy = accuracy or (GROUP_ACCURACY if by else TABLE_ACCURACY)
    salt_source = ["ts"] if by == "cell_id" and not few_groups else []
    packed = df.select(*keys, *salt_source, F.array(*[F.col(c).cast("double") for c in columns]).alias("_x"))
    sketch = _brackets(packed, keys, probs, accuracy)
    if by is None:
        both = packed.withColumn("_s", sketch.select("_s").scalar())
    elif few_groups:
        both = packed.join(sketch, by)
    elif by == "cell_id":
        # A left join keeps the long side where it is, however small Spark believes it to be.
        both = join_params(packed, sketch)
    else:
        raise ValueError("many groups are supported for cell_id only")

    # Each value travels with its own column's brackets only.
    paired = F.transform(
        "_x", lambda v, i: F.struct(i.alias("at"), v.alias("v"), F.try_element_at("_s", i).alias("q"))
    )
    reached = F.filter(F.col("_z.q.ranges"), lambda r: F.col("_z.v") <= r["high"])
    low, high = F.col("_r.low"), F.col("_r.high")
    place = F.when(high > low, F.least(F.floor((F.col("_v") - low) / (high - low) * PARTS), F.lit(PARTS - 1)))
    counted = (
        both.select(*keys, F.explode(paired).alias("_z"))
        .select(
            *keys,
            F.col("_z.at").alias("_at"),
            F.col("_z.v").alias("_v"),
            F.col("_z.q.n").alias("n"),
            F.explode(reached).alias("_r"),
        )
        .withColumn("_in", F.col("_v") >= low)
        .select(
            *keys,
            "_at",
            F.col("_r.prob").alias("prob"),
            "n",
            F.when(F.col("_in"), F.coalesce(place, F.lit(0))).otherwise(-1).alias("_part"),
            F.when(F.col("_in"), F.col("_v")).alias("value"),
        )
        .groupBy(*keys, "_at", "prob", "n", "_part", "value")
        .agg(F.count(F.lit(1)).alias("_c"))
    )
    one = [*keys, "_at", "prob", "n"]
    rank = F.col("prob") * (F.col("n") - 1)
    low_rank, high_rank = F.floor(rank), F.ceil(rank)

    def holds(wanted: Column) -> Column:
        return (wanted >= F.col("_before")) & (wanted < F.col("_before") + F.col("_size"))

    # At most PARTS + 1 rows per wanted rank.
    sizes = counted.groupBy(*one, "_part").agg(F.sum("_c").alias("_size"))
    earlier = Window.partitionBy(*one).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    ranged = sizes.withColumn("_before", F.coalesce(F.sum("_size").over(earlier), F.lit(0)))
    chosen = ranged.where(holds(low_rank) | holds(high_rank)).drop("_size")

    ordered = Window.partitionBy(*one, "_part").orderBy("value")
    running = counted.join(chosen, [*one, "_part"]).withColumn(
        "_upto", F.col("_before") + F.sum("_c").over(ordered.rowsBetween(Window.unboundedPreceding, 0))
    )

    def at_rank(wanted: Column) -> Column:
        mine = (F.col("_upto") > wanted) & (F.col("_upto") - F.col("_c") <= wanted)
        return F.max(F.when(mine, F.col("value")))

    found = running.groupBy(*one).agg(at_rank(low_rank).alias("_low"), at_rank(high_rank).alias("_high"))
    # A rank outside its bracket would leave a NULL here.
    safe = F.col("_low").isNotNull() & F.col("_high").isNotNull()
    value = F.col("_low") + (F.col("_high") - F.col("_low")) * (rank - low_rank)
    return found.select(
        *keys,
        F.get(F.array(*[F.lit(c) for c in columns]), F.col("_at")).alias("name"),
        "prob",
        F.when(safe, value).otherwise(F.raise_error(F.lit("quantile bracket missed its rank"))).alias("value"),
        "n",
    )


def _brackets(packed: DataFrame, keys: list[str], probs: list[float], accuracy: int) -> DataFrame:
    """One row per group: a map from column number to ``n`` and a value range per wanted rank."""
    margin = 4.0 / accuracy
    bounds = [x for p in probs for x in (max(p - margin, 0.0), min(p + margin, 1.0))]
    sketched = (
        packed.select(*keys, F.posexplode("_x").alias("_at", "_v"))
        .where(F.col("_v").isNotNull())
        .groupBy(*keys, "_at")
        .agg(
            F.count("_v").alias("n"),
            F.min("_v").alias("lowest"),
            F.max("_v").alias("highest"),
            F.percentile_approx("_v", F.array(*[F.lit(b) for b in bounds]), F.lit(accuracy)).alias("b"),
        )
    )
    small = F.col("n") <= accuracy
    ranges = F.array(
        *[
            F.struct(
                F.lit(float(p)).alias("prob"),
                F.when(small | F.lit(p <= margin), F.col("lowest")).otherwise(F.get("b", F.lit(2 * k))).alias("low"),
                F.when(small | F.lit(p >= 1 - margin), F.col("highest")).otherwise(F.get("b", F.lit(2 * k + 1))).alias("high"),
            )
            for k, p in enumerate(probs)
        ]
    )
    entry = F.struct(F.col("_at"), F.struct(F.col("n"), ranges.alias("ranges")))
    return sketched.groupBy(*keys).agg(F.map_from_entries(F.collect_list(entry)).alias("_s"))


def quantile_scalar(df: DataFrame, column: str, prob: float) -> Column:
    """One exact quantile of a table as a scalar subquery."""
    return exact_quantiles(df, [column], [prob]).select("value").scalar()

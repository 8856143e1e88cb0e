"""Episodes: runs of consecutive flagged rows within a cell."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpiloom.functions.numeric import ratio
from kpiloom.operators.blocks import BEFORE_HERE, BLOCK, BLOCK_STEPS, UP_TO_HERE, in_block, over_blocks, with_block
from kpiloom.schema import GRID


def with_episode_ids(
    df: DataFrame, flags: list[str], grid: str = GRID, block_steps: int = BLOCK_STEPS
) -> DataFrame:
    """Add ``{flag}_episode`` (1, 2, … per cell, NULL off episodes) and the row number ``_pos``.

    A run may cross blocks: the carry tells a block how many runs began before it
    and whether its first row continues one.
    """
    blocked = with_block(df, grid, block_steps)
    previous = in_block()
    set_flags = {f: F.coalesce(F.col(f), F.lit(False)) for f in flags}
    marked = blocked.withColumns(
        {"_rank": F.row_number().over(previous)}
        | {f"_begin_{f}": set_flags[f] & ~F.lag(set_flags[f], 1, True).over(previous) for f in flags}
    )
    ends = [F.count(F.lit(1)).alias("_size")]
    for f in flags:
        ends += [
            F.count_if(f"_begin_{f}").alias(f"_begins_{f}"),
            F.min_by(set_flags[f], "_i").alias(f"_first_{f}"),
            F.max_by(set_flags[f], "_i").alias(f"_last_{f}"),
        ]
    summary = marked.groupBy(*BLOCK).agg(*ends)
    opened = summary.withColumns(
        {
            f"_opens_{f}": F.col(f"_first_{f}")
            & ~F.coalesce(F.lag(f"_last_{f}").over(over_blocks()), F.lit(False))
            for f in flags
        }
    )
    earlier = over_blocks().rowsBetween(*BEFORE_HERE)
    carried = [F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_offset")]
    for f in flags:
        begun = F.col(f"_begins_{f}") + F.col(f"_opens_{f}").cast("int")
        carried += [
            (F.coalesce(F.sum(begun).over(earlier), F.lit(0)) + F.col(f"_opens_{f}").cast("int")).alias(f"_base_{f}")
        ]
    carry = opened.select(*BLOCK, *carried)
    so_far = in_block().rowsBetween(*UP_TO_HERE)
    numbered = marked.join(carry, BLOCK).withColumns(
        {"_pos": F.col("_offset") + F.col("_rank") - 1}
        | {
            f"{f}_episode": F.when(
                set_flags[f], F.col(f"_base_{f}") + F.sum(F.col(f"_begin_{f}").cast("int")).over(so_far)
            )
            for f in flags
        }
    )
    return numbered.select(*df.columns, "_pos", *[f"{f}_episode" for f in flags])


def episodes(df: DataFrame, flag: str = "is_anomaly", grid: str = GRID, **kw) -> DataFrame:
    """One row per episode: ``cell_id, episode_id, start_ts, end_ts, points``."""
    numbered = with_episode_ids(df, [flag], grid, **kw)
    return (
        numbered.where(F.col(f"{flag}_episode").isNotNull())
        .groupBy("cell_id", F.col(f"{flag}_episode").alias("episode_id"))
        .agg(
            F.min("ts").alias("start_ts"),
            F.max("ts").alias("end_ts"),
            F.count(F.lit(1)).alias("points"),
        )
    )


def _numbered(df: DataFrame, truth: str, alert: str, by: list[str], grid: str, **kw) -> DataFrame:
    """Episode ids of truth and alert; ``by`` names the runs kept apart besides the cell."""
    if not by:
        return with_episode_ids(df, [truth, alert], grid, **kw)
    # Several detectors share the table: each (detector, cell) is a series of its own.
    series = df.withColumn("_cell", F.col("cell_id")).withColumn(
        "cell_id", F.to_json(F.struct(*by, "cell_id"))
    )
    numbered = with_episode_ids(series, [truth, alert], grid, **kw)
    return numbered.withColumn("cell_id", F.col("_cell")).drop("_cell")


def _true_episodes(numbered: DataFrame, truth: str, alert: str, by: list[str], extra: list[Column] = ()) -> DataFrame:
    alerted = F.coalesce(F.col(alert), F.lit(False))
    return (
        numbered.where(F.col(f"{truth}_episode").isNotNull())
        .groupBy(*by, "cell_id", f"{truth}_episode")
        .agg(
            F.min("ts").alias("debut"),
            F.max("ts").alias("fin"),
            F.count(F.lit(1)).alias("points"),
            F.count_if(alerted).alias("alertes"),
            (F.min(F.when(alerted, F.col("_pos"))) - F.min("_pos")).alias("delai"),
            *extra,
        )
    )


def _alert_episodes(numbered: DataFrame, truth: str, alert: str, by: list[str]) -> DataFrame:
    return (
        numbered.where(F.col(f"{alert}_episode").isNotNull())
        .groupBy(*by, "cell_id", f"{alert}_episode")
        .agg(
            F.min("ts").alias("debut"),
            F.max("ts").alias("fin"),
            F.count(F.lit(1)).alias("points"),
            F.count_if(F.coalesce(F.col(truth), F.lit(False))).alias("vrais"),
        )
    )


def episode_overlap(
    df: DataFrame, truth: str = "is_anomaly", alert: str = "is_anomaly_pred", grid: str = GRID, **kw
) -> DataFrame:
    """Each alert episode with the number of true points it covers.

    Both masks live on the same rows, so overlap is a count inside the run and
    needs no interval join.
    """
    runs = _alert_episodes(_numbered(df, truth, alert, [], grid, **kw), truth, alert, [])
    return runs.select(
        "cell_id", "debut", "fin", "points", "vrais", (F.col("vrais") == 0).alias("fausse_alerte")
    )


def episode_metrics(
    df: DataFrame,
    truth: str = "is_anomaly",
    alert: str = "is_anomaly_pred",
    minutes_per_point: float = 1,
    grid: str = GRID,
    by: list[str] | None = None,
    **kw,
) -> DataFrame:
    """Recall, delay and false alarms per cell (and per value of ``by``)."""
    by = list(by or [])
    keys = [*by, "cell_id"]
    numbered = _numbered(df, truth, alert, by, grid, **kw)
    minutes = F.lit(float(minutes_per_point))
    real = _true_episodes(numbered, truth, alert, by).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("episodes_reels"),
        F.count_if(F.col("alertes") > 0).alias("episodes_detectes"),
        # Delays are whole steps, so the exact median keeps few distinct values.
        (F.percentile("delai", F.lit(0.5)) * minutes).alias("delai_median_min"),
        (F.max("delai") * minutes).alias("delai_max_min"),
    )
    false = _alert_episodes(numbered, truth, alert, by).groupBy(*keys).agg(
        F.count_if(F.col("vrais") == 0).alias("episodes_fausse_alerte")
    )
    rows = df.groupBy(*keys).agg((F.count(F.lit(1)) * minutes / 60.0).alias("_hours"))
    counts = ["episodes_reels", "episodes_detectes", "episodes_fausse_alerte"]
    joined = rows.join(real, keys, "left").join(false, keys, "left").na.fill(0, counts)
    return joined.select(
        *keys,
        "episodes_reels",
        "episodes_detectes",
        F.try_divide(F.col("episodes_detectes"), F.col("episodes_reels")).alias("rappel_episode"),
        "delai_median_min",
        "delai_max_min",
        "episodes_fausse_alerte",
        ratio(F.col("episodes_fausse_alerte").cast("double"), F.col("_hours")).alias("fausses_alertes_par_heure"),
        F.round("_hours", 1).alias("duree_evaluee_heures"),
    )


def episode_totals(per_cell: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Sums over cells; the delay is the median of the cells' medians."""
    total = per_cell.groupBy(*(by or [])).agg(
        F.sum("episodes_reels").alias("episodes_reels"),
        F.sum("episodes_detectes").alias("episodes_detectes"),
        F.percentile("delai_median_min", F.lit(0.5)).alias("delai_median_min"),
        F.sum("episodes_fausse_alerte").alias("episodes_fausse_alerte"),
        F.sum("duree_evaluee_heures").alias("_hours"),
    )
    return total.select(
        *(by or []),
        "episodes_reels",
        "episodes_detectes",
        F.try_divide(F.col("episodes_detectes"), F.col("episodes_reels")).alias("rappel_episode"),
        "delai_median_min",
        "episodes_fausse_alerte",
        ratio(F.col("episodes_fausse_alerte").cast("double"), F.col("_hours")).alias("fausses_alertes_par_heure"),
    )


def error_analysis(
    df: DataFrame,
    truth: str = "is_anomaly",
    alert: str = "is_anomaly_pred",
    minutes_per_point: float = 1,
    grid: str = GRID,
    **kw,
) -> DataFrame:
    """What each true episode looked like and whether it was noticed."""
    numbered = _numbered(df, truth, alert, [], grid, **kw)
    peaks = [
        F.max("latency_ratio_to_hour").alias("pic_latence_ratio"),
        F.max("packet_loss_mean_5m").alias("pic_packet_loss"),
        F.max("score").alias("score_max"),
    ]
    found = _true_episodes(numbered, truth, alert, [], peaks)
    return found.select(
        "cell_id",
        "debut",
        (F.col("points") * F.lit(minutes_per_point)).alias("duree_min"),
        (F.col("alertes") > 0).alias("detecte"),
        F.round(F.col("alertes") / F.col("points"), 3).alias("part_points_detectes"),
        F.round("pic_latence_ratio", 3).alias("pic_latence_ratio"),
        F.round("pic_packet_loss", 3).alias("pic_packet_loss"),
        F.round("score_max", 4).alias("score_max"),
    ).orderBy("detecte", "duree_min", "cell_id", "debut")


def error_summary(errors: DataFrame) -> DataFrame:
    """Counts and median durations of missed and detected episodes."""
    missed, noticed = ~F.col("detecte"), F.col("detecte")
    return errors.agg(
        F.count(F.lit(1)).alias("episodes_test"),
        F.count_if(missed).alias("episodes_manques"),
        F.percentile(F.when(missed, F.col("duree_min")), F.lit(0.5)).alias("duree_mediane_manques"),
        F.percentile(F.when(noticed, F.col("duree_min")), F.lit(0.5)).alias("duree_mediane_detectes"),
        F.percentile(F.when(noticed, F.col("part_points_detectes")), F.lit(0.5)).alias("part_mediane_detectee"),
    )

"""Point-wise detection metrics, threshold sweeps and forecast errors.

Detection metrics work on a long score table: ``detector, score, is_anomaly``.
Tables keyed by detector are left to Spark's own size check.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kpiloom.functions.numeric import finite, ratio
from kpiloom.operators.blocks import in_ranges
from kpiloom.operators.quantiles import exact_quantiles

SWEEP_POINTS = 200
SWEEP_LOW, SWEEP_HIGH = 0.50, 0.9995


def _share(top: Column, bottom: Column) -> Column:
    """A ratio of counts that is 0 where undefined."""
    return F.coalesce(F.try_divide(top.cast("double"), F.nullif(bottom.cast("double"), F.lit(0.0))), F.lit(0.0))


def _scores_from_counts(vp: Column, fp: Column, vn: Column, fn: Column) -> dict[str, Column]:
    precision, recall = _share(vp, vp + fp), _share(vp, vp + fn)
    return {
        "precision": precision,
        "rappel": recall,
        "f1": _share(2 * vp, 2 * vp + fp + fn),
        "vp": vp,
        "fp": fp,
        "vn": vn,
        "fn": fn,
        "n": vp + fp + vn + fn,
        "taux_alerte_pct": _share(vp + fp, vp + fp + vn + fn) * 100,
        "prevalence_pct": _share(vp + fn, vp + fp + vn + fn) * 100,
        "specificite": _share(vn, vn + fp),
    }


def confusion(df: DataFrame, by: list[str], truth: str = "is_anomaly", alert: str = "is_anomaly_pred") -> DataFrame:
    """Counts and ratios per value of ``by`` in one aggregation."""
    y, p = F.col(truth), F.col(alert)
    counted = df.groupBy(*by).agg(
        F.count_if(y & p).alias("_vp"),
        F.count_if(~y & p).alias("_fp"),
        F.count_if(~y & ~p).alias("_vn"),
        F.count_if(y & ~p).alias("_fn"),
    )
    named = _scores_from_counts(F.col("_vp"), F.col("_fp"), F.col("_vn"), F.col("_fn"))
    return counted.select(*by, *[c.alias(n) for n, c in named.items()])


def cumulative_scores(df: DataFrame, by: str = "detector", truth: str = "is_anomaly") -> DataFrame:
    """Distinct scores with counts of lower rows.

    Columns ``score, n, pos, n_below, pos_below, n_all, pos_all, _range``.  Equal
    scores are counted first.  The running sums work in ranges whose number
    follows the data, so no window spans all scores of a detector.
    """
    counts = df.groupBy(by, "score").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col(truth)).alias("pos")
    )
    ranged = in_ranges(counts, by, "score")
    sums = ranged.groupBy(by, "_range").agg(F.sum("n").alias("_n"), F.sum("pos").alias("_pos"))
    earlier = Window.partitionBy(by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(by)
    starts = sums.select(
        by,
        "_range",
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_n0"),
        F.coalesce(F.sum("_pos").over(earlier), F.lit(0)).alias("_pos0"),
        F.sum("_n").over(whole).alias("n_all"),
        F.sum("_pos").over(whole).alias("pos_all"),
    )
    lower = Window.partitionBy(by, "_range").orderBy("score").rowsBetween(Window.unboundedPreceding, -1)
    return ranged.join(starts, [by, "_range"]).select(
        by,
        "score",
        "n",
        "pos",
        (F.col("_n0") + F.coalesce(F.sum("n").over(lower), F.lit(0))).alias("n_below"),
        (F.col("_pos0") + F.coalesce(F.sum("pos").over(lower), F.lit(0))).alias("pos_below"),
        "n_all",
        "pos_all",
        "_range",
    )


def ranking_metrics(df: DataFrame, by: str = "detector", truth: str = "is_anomaly") -> DataFrame:
    """Average precision and ROC area per detector; NULL when one class is absent."""
    ranked = cumulative_scores(df, by, truth)
    negatives = F.col("n_all") - F.col("pos_all")
    hits = F.col("pos_all") - F.col("pos_below")
    alerts = F.col("n_all") - F.col("n_below")
    middle = F.col("n_below") + (F.col("n") + 1) / 2.0
    positives = F.max("pos_all")
    both = (positives > 0) & (F.max(negatives) > 0)
    steps = F.sum(F.col("pos") * hits / alerts)
    ranks = F.sum(F.col("pos") * middle) - positives * (positives + 1) / 2.0
    return ranked.groupBy(by).agg(
        F.when(both, F.try_divide(steps, positives)).alias("pr_auc"),
        F.when(both, F.try_divide(ranks, positives * F.max(negatives))).alias("roc_auc"),
    )


def sweep_threshold(
    df: DataFrame, by: str = "detector", truth: str = "is_anomaly", points: int = SWEEP_POINTS
) -> DataFrame:
    """Metrics at up to ``points`` score quantiles, an alert being ``score >= seuil``."""
    ranked = cumulative_scores(df, by, truth)
    width = (SWEEP_HIGH - SWEEP_LOW) / (points - 1) if points > 1 else 0.0
    probs = [SWEEP_LOW + k * width for k in range(points - 1)] + [SWEEP_HIGH]
    sizes = ranked.groupBy(by, "_range").agg(
        F.max("n_all").alias("n_all"),
        F.min("n_below").alias("_from"),
        F.max(F.col("n_below") + F.col("n")).alias("_to"),
    )
    rank = F.col("prob") * (F.col("n_all") - 1)
    # One row per range and detector meets `points` wanted ranks.
    wanted = (
        sizes.withColumn("prob", F.explode(F.array(*[F.lit(p) for p in probs])))
        .withColumn("rank", rank)
        .withColumn("_at", F.explode(F.array(F.floor("rank"), F.ceil("rank"))))
        .where((F.col("_at") >= F.col("_from")) & (F.col("_at") < F.col("_to")))
        .select(by, "_range", "prob", "rank", "_at")
        .distinct()
    )
    hit = ranked.join(wanted, [by, "_range"]).where(
        (F.col("_at") >= F.col("n_below")) & (F.col("_at") < F.col("n_below") + F.col("n"))
    )
    floor = F.col("_at") == F.floor("rank")
    ends = hit.groupBy(by, "prob", "rank").agg(
        *[F.max(F.when(floor, F.col(c))).alias(f"_{c}") for c in ("score", "n", "pos", "n_below", "pos_below")],
        F.max(F.when(F.col("_at") == F.ceil("rank"), F.col("score"))).alias("_next"),
        F.max("n_all").alias("n_all"),
        F.max("pos_all").alias("pos_all"),
    )
    between = F.col("_next") > F.col("_score")
    part = F.col("rank") - F.floor("rank")
    above = between & (part > 0)
    cut = ends.select(
        by,
        F.when(above, F.col("_score") + (F.col("_next") - F.col("_score")) * part).otherwise(F.col("_score")).alias("seuil"),
        (F.col("n_all") - F.col("_n_below") - F.when(above, F.col("_n")).otherwise(0)).alias("_alerts"),
        (F.col("pos_all") - F.col("_pos_below") - F.when(above, F.col("_pos")).otherwise(0)).alias("_hits"),
        "n_all",
        "pos_all",
    ).dropDuplicates([by, "seuil"])
    vp, fp = F.col("_hits"), F.col("_alerts") - F.col("_hits")
    fn = F.col("pos_all") - F.col("_hits")
    vn = F.col("n_all") - F.col("pos_all") - fp
    named = _scores_from_counts(vp, fp, vn, fn)
    shown = ["taux_alerte_pct", "precision", "rappel", "f1"]
    return cut.select(by, "seuil", *[named[n].alias(n) for n in shown])


def best_threshold(
    df: DataFrame, by: str = "detector", truth: str = "is_anomaly", criterion: str = "f1"
) -> DataFrame:
    """The lowest threshold with the best criterion."""
    curve = sweep_threshold(df, by, truth)
    return curve.groupBy(by).agg(
        F.max_by("seuil", F.struct(F.col(criterion), -F.col("seuil"))).alias("seuil"),
        F.max(criterion).alias(criterion),
    )


def score_thresholds(df: DataFrame, contamination: float, by: str = "detector") -> DataFrame:
    """Unsupervised threshold: the score quantile above which ``contamination`` lies."""
    found = exact_quantiles(df, ["score"], [1 - contamination], by=by, few_groups=True)
    return found.select(by, F.col("value").alias("seuil"))


def regression_metrics(
    df: DataFrame, by: list[str], actual: str = "y", predicted: str = "y_hat", epsilon: float = 1e-6
) -> DataFrame:
    """MAE, RMSE, MAPE, sMAPE, bias and n over pairs that both exist."""
    y, p = finite(F.col(actual)), finite(F.col(predicted))
    pairs = df.withColumns({"_y": F.when(p.isNotNull(), y), "_p": F.when(y.isNotNull(), p)})
    error = F.col("_p") - F.col("_y")
    size = F.greatest(F.abs("_y"), F.lit(epsilon))
    mean_size = F.greatest((F.abs("_y") + F.abs("_p")) / 2, F.lit(epsilon))
    return pairs.groupBy(*by).agg(
        F.avg(F.abs(error)).alias("mae"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        (F.avg(F.when(error.isNotNull(), F.abs(error) / size)) * 100).alias("mape"),
        (F.avg(F.when(error.isNotNull(), F.abs(error) / mean_size)) * 100).alias("smape"),
        F.avg(error).alias("biais"),
        F.count(error).alias("n"),
    )


def skill(model: Column, base: Column) -> Column:
    """Gain over a baseline in percent; NULL without a usable baseline."""
    return ratio(base - model, base) * 100


def with_skill(table: DataFrame, keys: list[str], model: str = "model", base: str = "persistance") -> DataFrame:
    """Add the MAE gain over the baseline model in the same group."""
    baseline = table.where(F.col(model) == base).select(*keys, F.round("mae", 4).alias("_base"))
    return (
        table.join(baseline, keys, "left")
        .withColumn("gain_mae_vs_persistance_pct", F.round(skill(F.round("mae", 4), F.col("_base")), 2))
        .drop("_base")
    )


def sweep_gap(results: DataFrame) -> DataFrame:
    """F1 at the chosen threshold minus F1 at the unsupervised one, per detector."""
    point = F.col("point_de_fonctionnement")
    return results.groupBy("detector").agg(
        (F.max(F.when(point == "f1_optimal", F.col("f1"))) - F.max(F.when(point == "exploitation", F.col("f1")))).alias(
            "ecart_f1"
        )
    )

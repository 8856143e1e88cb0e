"""Detector study: fit, score, two operating points, metrics."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiloom.models.detectors import AUTOENCODER_GRID, Autoencoder, Detector, fit_autoencoders, stored_scaler
from kpiloom.models.store import scored
from kpiloom.operators import metrics
from kpiloom.operators.episodes import episode_metrics, episode_totals
from kpiloom.operators.scaling import RobustCellScaler
from kpiloom.schema import CONTAMINATION, GRID
from kpiloom.session import cut

KEEP = ["cell_id", "ts", "is_anomaly"]


def score_table(detectors: list[Detector], split: DataFrame) -> DataFrame:
    """Scores of fitted detectors on every segment."""
    return scored(detectors, split, ["segment", *KEEP])


def operating_points(scores: DataFrame, detectors: list[Detector], contamination: float) -> DataFrame:
    """``detector, point_de_fonctionnement, seuil``: one without truth, one from validation."""
    trained = scores.where("segment = 'train'")
    unsupervised = reduce(
        DataFrame.unionByName,
        [
            # A detector with a natural threshold says so; the others use a score quantile.
            scores.sparkSession.range(1).select(
                F.lit(d.name).alias("detector"),
                F.lit("exploitation").alias("point_de_fonctionnement"),
                d.default_threshold(trained.where(F.col("detector") == d.name), contamination).alias("seuil"),
            )
            for d in detectors
        ],
    )
    chosen = metrics.best_threshold(scores.where("segment = 'val'")).select(
        "detector", F.lit("f1_optimal").alias("point_de_fonctionnement"), "seuil"
    )
    return unsupervised.unionByName(chosen)


def compare(scores: DataFrame, points: DataFrame, grid: str = GRID, minutes_per_point: float = 1) -> DataFrame:
    """Point-wise, ranking and episode metrics of each detector at each operating point."""
    test = scores.where("segment = 'test'")
    keys = ["detector", "point_de_fonctionnement"]
    alerts = test.join(points, "detector").withColumn(
        "is_anomaly_pred", F.col("score") >= F.col("seuil")
    )
    flat = metrics.confusion(alerts, [*keys, "seuil"])
    runs = episode_totals(
        episode_metrics(alerts, minutes_per_point=minutes_per_point, grid=grid, by=keys), by=keys
    )
    return flat.join(runs, keys, "left").join(metrics.ranking_metrics(test), "detector", "left")


def detector_study(
    detectors: list[Detector],
    split: DataFrame,
    grid: str = GRID,
    contamination: float = CONTAMINATION,
    minutes_per_point: float = 1,
) -> DataFrame:
    """Fit on train, choose thresholds, and report on test."""
    train = split.where("segment = 'train'")
    scalers: dict[tuple, RobustCellScaler] = {}
    for d in detectors:
        columns = tuple(getattr(d, "columns", ()))
        if columns:
            # Detectors on the same columns share one fit of the scaler.
            if columns not in scalers:
                scalers[columns] = stored_scaler(train, list(columns))
            d.share_scaler(scalers[columns])
        d.fit(train)
    scores = cut(score_table(detectors, split))
    points = cut(operating_points(scores, detectors, contamination))
    return compare(scores, points, grid, minutes_per_point)


def select_autoencoder(columns: list[str], split: DataFrame, grid=AUTOENCODER_GRID, **settings):
    """Fit all shapes together and keep the one with the best validation average precision."""
    spark = split.sparkSession
    models = fit_autoencoders([Autoencoder(columns, **shape, **settings) for shape in grid], split.where("segment = 'train'"))
    held = split.where("segment = 'val'")
    parts = [m.score(held).select(F.lit(str(i)).alias("detector"), *KEEP, "score") for i, m in enumerate(models)]
    area = {r["detector"]: r["pr_auc"] for r in metrics.ranking_metrics(reduce(DataFrame.unionByName, parts)).collect()}  # one row per shape
    rows = [(str(tuple(m.hidden)), float(m.trim), m.rows_kept, area.get(str(i))) for i, m in enumerate(models)]
    table = spark.createDataFrame(
        rows, "goulot string, filtrage_extremes double, lignes_entrainement long, pr_auc_validation double"
    )
    best = max(range(len(models)), key=lambda i: (rows[i][3] is not None, rows[i][3] or 0.0, -i))
    return models[best], table.orderBy(F.col("pr_auc_validation").desc_nulls_last())


def tuned_detectors(detectors: list[Detector], split: DataFrame, grid=AUTOENCODER_GRID) -> list[Detector]:
    """The same detectors with the network that the grid chooses in place of theirs."""
    net = next(d for d in detectors if isinstance(d, Autoencoder))
    best, _ = select_autoencoder(net.columns, split, grid)
    return [Autoencoder(net.columns, hidden=best.hidden, trim=best.trim) if d is net else d for d in detectors]

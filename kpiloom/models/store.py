"""Fitted models as parquet tables."""

from __future__ import annotations

import dataclasses
import json
from functools import reduce

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kpiloom.models import forecasters
from kpiloom.models.detectors import Autoencoder, DensityDetector, Detector, IsolationForest, LinearReconstruction, ThresholdDetector
from kpiloom.operators.scaling import RobustCellScaler
from kpiloom.schema import Bounds


def save_scaler(scaler: RobustCellScaler, path: str) -> None:
    scaler.per_cell.write.mode("overwrite").parquet(f"{path}/per_cell")
    scaler.overall.write.mode("overwrite").parquet(f"{path}/overall")


def load_scaler(spark: SparkSession, path: str, columns: list[str]) -> RobustCellScaler:
    scaler = RobustCellScaler(columns)
    scaler.per_cell = spark.read.parquet(f"{path}/per_cell")
    scaler.overall = spark.read.parquet(f"{path}/overall")
    return scaler


def save_forest(model: IsolationForest, path: str) -> None:
    save_scaler(model.scaler, path)
    model.nodes.write.mode("overwrite").parquet(f"{path}/nodes")


def load_forest(spark: SparkSession, path: str, model: IsolationForest, points: int) -> IsolationForest:
    model.scaler = load_scaler(spark, path, model.columns)
    model.nodes = spark.read.parquet(f"{path}/nodes")
    model.points = points
    return model


def weights_table(spark: SparkSession, model: Autoencoder) -> DataFrame:
    """The parameter vector; its length depends on the network only."""
    return spark.createDataFrame([(i, float(w)) for i, w in enumerate(model.weights)], "at long, weight double")


def save_autoencoder(model: Autoencoder, path: str) -> None:
    save_scaler(model.scaler, path)
    weights_table(model.scaler.per_cell.sparkSession, model).write.mode("overwrite").parquet(f"{path}/weights")


def load_autoencoder(spark: SparkSession, path: str, model: Autoencoder) -> Autoencoder:
    model.scaler = load_scaler(spark, path, model.columns)
    rows = spark.read.parquet(f"{path}/weights").orderBy("at").limit(model.net.length).collect()
    model.weights = np.array([r["weight"] for r in rows])
    return model


def scored(detectors: list[Detector], df: DataFrame, keep: list[str] = ("cell_id", "ts")) -> DataFrame:
    """Long score table ``detector, …, score`` of several detectors."""
    parts = [d.score(df).select(F.lit(d.name).alias("detector"), *keep, "score") for d in detectors]
    return reduce(DataFrame.unionByName, parts)


# -- one format for every model: a row of settings and the tables the model holds

_SCALED = {c.name: c for c in (IsolationForest, DensityDetector, Autoencoder, LinearReconstruction)}
_PLAIN = {c.name: c for c in (forecasters.Persistence, forecasters.MovingAverage)}


def _settings(model) -> dict:
    if isinstance(model, ThresholdDetector):
        return {"thresholds": {k: dataclasses.asdict(t) for k, t in model.thresholds.items()}, "suffix": model.suffix}
    if isinstance(model, IsolationForest):
        return {"columns": model.columns, "trees": model.trees, "sample": model.sample, "seed": model.seed, "points": model.points}
    if isinstance(model, DensityDetector):
        return {
            "columns": model.columns, "eps": model.eps, "min_samples": model.min_samples, "max_points": model.max_points,
            "eps_quantile": model.eps_quantile, "grid": model.grid, "noise_ratio": model.noise_ratio,
        }
    if isinstance(model, Autoencoder):
        return {
            "columns": model.columns, "hidden": list(model.hidden), "max_iter": model.max_iter, "trim": model.trim, "patience": model.patience,
            "memory": model.memory, "decay": model.decay, "seed": model.seed, "rows_kept": model.rows_kept, "epochs": model.epochs,
        }
    if isinstance(model, LinearReconstruction):
        return {"columns": model.columns, "components": model.components}
    if isinstance(model, forecasters.SeasonalNaive):
        return {"grid": model.grid, "horizons": model.horizons}
    if isinstance(model, forecasters.AutoRegression):
        return {"grid": model.grid, "horizons": model.horizons, "context": model.context, "least": model.least}
    if type(model) in _PLAIN.values():
        return {}
    raise TypeError(f"no stored form of {type(model).__name__}")


def save(spark: SparkSession, model, path: str) -> None:
    """Write a fitted detector or forecaster with all that ``load`` needs."""
    if isinstance(model, forecasters.BoostedTrees):
        model.save(f"{path}/trees")
        settings: dict = {}
    else:
        settings = _settings(model)
    if isinstance(model, tuple(_SCALED.values())):
        save_scaler(model.scaler, path)
    if isinstance(model, IsolationForest):
        model.nodes.write.mode("overwrite").parquet(f"{path}/nodes")
    elif isinstance(model, DensityDetector):
        model.kept.write.mode("overwrite").parquet(f"{path}/kept")
    elif isinstance(model, Autoencoder):
        weights_table(spark, model).write.mode("overwrite").parquet(f"{path}/weights")
    elif isinstance(model, LinearReconstruction):
        rows = [(i, [float(v) for v in row]) for i, row in enumerate(model.basis)]
        spark.createDataFrame(rows, "at int, row array<double>").write.mode("overwrite").parquet(f"{path}/basis")
    elif isinstance(model, forecasters.AutoRegression):
        model.orders.write.mode("overwrite").parquet(f"{path}/orders")
    # Last, so that a folder with settings is complete.
    spark.createDataFrame([(model.name, json.dumps(settings))], "kind string, settings string").write.mode("overwrite").parquet(f"{path}/model")


def load(spark: SparkSession, path: str, history: DataFrame | None = None):
    """The model stored at ``path``; forecasters that look back need the ``history`` of their series."""
    row = spark.read.parquet(f"{path}/model").first()
    kind, settings = row["kind"], json.loads(row["settings"])
    if kind in _PLAIN:
        return _PLAIN[kind]()
    if kind == forecasters.BoostedTrees.name:
        return forecasters.BoostedTrees.load(spark, f"{path}/trees")
    if kind == ThresholdDetector.name:
        return ThresholdDetector({k: Bounds(**t) for k, t in settings["thresholds"].items()}, settings["suffix"])
    if kind in (forecasters.SeasonalNaive.name, forecasters.AutoRegression.name):
        if history is None:
            raise ValueError(f"{kind} needs the history of its series")
        if kind == forecasters.SeasonalNaive.name:
            return forecasters.SeasonalNaive(history, **settings)
        model = forecasters.AutoRegression(history, **settings)
        model.orders = spark.read.parquet(f"{path}/orders")
        return model
    found = {name: settings.pop(name) for name in ("points", "noise_ratio", "rows_kept", "epochs") if name in settings}
    model = _SCALED[kind](**settings)
    for name, value in found.items():
        setattr(model, name, value)
    model.share_scaler(load_scaler(spark, path, model.columns))
    if kind == IsolationForest.name:
        model.nodes = spark.read.parquet(f"{path}/nodes")
    elif kind == DensityDetector.name:
        model.kept = spark.read.parquet(f"{path}/kept")
    elif kind == Autoencoder.name:
        rows = spark.read.parquet(f"{path}/weights").orderBy("at").limit(model.net.length).collect()
        model.weights = np.array([r["weight"] for r in rows])
    else:
        rows = spark.read.parquet(f"{path}/basis").orderBy("at").limit(len(model.columns)).collect()
        model.basis = np.array([r["row"] for r in rows])
    return model

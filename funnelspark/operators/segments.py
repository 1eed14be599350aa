"""Customer segmentation: features, scaler + PCA + k-means, assignments, run
log, monitor and per-cluster profile (K1-K10, P6-P8, J3, A16, O1, O2).

All fitting is MLlib on executors: the scaler and PCA are one pass each
(d x d covariance, d = 18), k-means iterates over the assembled vectors, which
are persisted for the three fits and released afterwards.  The driver only
sees model coefficients and k-row summaries.

One model-age decision is taken for the whole pipeline (T22): either the
saved ``PipelineModel`` is fresh enough and is reused, or scaler, PCA and
k-means are refit together.  When a model is fitted its cluster labels are
numbered by ascending mean spend; the numbering is saved with it, so labels
keep their meaning until the next fit.
"""

from __future__ import annotations

import datetime as dt
import json
import time
import uuid
from collections.abc import Callable
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from funnelspark.functions.columns import as_timestamp
from funnelspark.schemas import (KMEANS_K, KMEANS_SEED, METRIC_STEPS, MODEL_MAX_AGE_DAYS,
                                 PCA_COMPONENTS, PROFILE_FEATURES, REQUESTED_FEATURES, RUN_LOG)
from funnelspark.session import list_names, publish_text, read_text

ID = "customer_id"


# ---------------------------------------------------------------- features
def feature_columns(df: DataFrame, requested=REQUESTED_FEATURES) -> tuple[list[str], list[str]]:
    """(present, dropped): requested features that exist, in order."""
    present = [c for c in requested if c in df.columns]
    dropped = [c for c in requested if c not in df.columns]
    if not present:
        raise ValueError("no feature column present")
    return present, dropped


def feature_frame(profiles: DataFrame, features: list[str], fill: float = 0.0) -> DataFrame:
    """Id + features as doubles, NULL filled (P6-P8, T14: NULL recency becomes ``fill``)."""
    cols = [F.col(ID)]
    for f in features:
        dtype = profiles.schema[f].dataType
        c = F.col(f).cast("double") if isinstance(dtype, (T.DecimalType, T.NumericType)) else F.col(f)
        cols.append(c.alias(f))
    return profiles.select(*cols).fillna(fill, subset=features)


def segmentation_pipeline(features: list[str], k: int = KMEANS_K, seed: int = KMEANS_SEED,
                          components: int = PCA_COMPONENTS) -> Pipeline:
    """Assemble (K1) -> standardize with mean and sample std (K2) -> PCA (K3) -> k-means (K4)."""
    return Pipeline(stages=[
        VectorAssembler(inputCols=features, outputCol="features"),
        StandardScaler(inputCol="features", outputCol="scaled", withMean=True, withStd=True),
        PCA(k=components, inputCol="scaled", outputCol="pca2"),
        KMeans(k=k, seed=seed, featuresCol="pca2", predictionCol="raw_cluster"),
    ])


def scaled_columns(model: PipelineModel, frame: DataFrame, features: list[str]) -> DataFrame:
    """Scaled feature values as columns (the K2 output, one column per feature)."""
    scaled = PipelineModel(stages=model.stages[:2]).transform(frame)
    arr = vector_to_array(F.col("scaled"))
    return scaled.select(ID, *[arr[i].alias(f) for i, f in enumerate(features)])


# ---------------------------------------------------------------- saved model
@dataclass(frozen=True)
class SegmentModel:
    """A fitted pipeline with what belongs to it: its features, the time of the fit and
    the label of each raw cluster (ordered by mean spend when it was fitted)."""
    pipeline: PipelineModel
    features: tuple[str, ...]
    fitted_s: float
    labels: tuple[int, ...]


def label_order(pipeline: PipelineModel, frame: DataFrame, order_by: str = "total_spend_usd"
                ) -> tuple[int, ...]:
    """Label of each raw cluster, by ascending mean of ``order_by`` (T22): k rows."""
    k = pipeline.stages[3].getK()
    means = {r.raw_cluster: r.m for r in pipeline.transform(frame).groupBy("raw_cluster")
             .agg(F.avg(order_by).alias("m")).collect()}
    order = sorted(range(k), key=lambda c: (means.get(c, float("inf")), c))
    return tuple(order.index(c) for c in range(k))


def fit_model(frame: DataFrame, features: list[str], now_s: float) -> SegmentModel:
    pipeline = segmentation_pipeline(features).fit(frame)
    return SegmentModel(pipeline, tuple(features), now_s, label_order(pipeline, frame))


def save_model(spark: SparkSession, model: SegmentModel, path: str) -> None:
    """Each model is written to a new place; its description is published last."""
    place = f"{path}/model-{uuid.uuid4().hex}"
    model.pipeline.write().save(place)
    n = 1 + max((int(x[8:-5]) for x in list_names(spark, path) if x.startswith("current-")), default=0)
    publish_text(spark, f"{path}/current-{n:08d}.json", json.dumps(
        {"place": place, "features": model.features, "fitted_s": model.fitted_s, "labels": model.labels}))


def load_model(spark: SparkSession, path: str) -> SegmentModel | None:
    """The newest saved model, or ``None`` if there is none."""
    names = [x for x in list_names(spark, path) if x.startswith("current-")]
    if not names:
        return None
    d = json.loads(read_text(spark, f"{path}/{names[-1]}"))
    return SegmentModel(PipelineModel.load(d["place"]), tuple(d["features"]), d["fitted_s"],
                        tuple(d["labels"]))


def load_or_fit(spark: SparkSession, model_path: str | None, frame: DataFrame, features: list[str], *,
                now_s: float | None = None, max_age_days: float = MODEL_MAX_AGE_DAYS
                ) -> tuple[SegmentModel, str, str]:
    """Reuse the saved model if it was fitted at most ``max_age_days`` ago on the same
    features; fit and save when there is none, it is older, its features differ or it
    can't be loaded (K6).  Returns (model, step, message) for the run log."""
    now_s = time.time() if now_s is None else now_s
    reason = "model_missing: trained new model"
    if model_path:
        try:
            model = load_model(spark, model_path)
        except Exception as e:  # noqa: BLE001 - any broken model is replaced
            model, reason = None, f"model_broken: {type(e).__name__}, retrained"
        if model is not None:
            age = (now_s - model.fitted_s) / 86400.0
            if model.features != tuple(features):
                reason = "model_features_changed: retrained"
            elif age > max_age_days:
                reason = f"model_stale: stale (age={age:.1f} days), retrained"
            else:
                return model, "model_load", f"loaded (age={age:.1f} days)"
    model = fit_model(frame, features, now_s)
    if model_path:
        save_model(spark, model, model_path)
    return model, "model_train", reason


# ---------------------------------------------------------------- assignment
def assign_clusters(model: SegmentModel, frame: DataFrame, run_date) -> DataFrame:
    """(customer_id, cluster, run_date) for every customer (K5), labelled as when the
    model was fitted."""
    labels = F.array(*[F.lit(x) for x in model.labels])
    return model.pipeline.transform(frame).select(
        ID, F.get(labels, F.col("raw_cluster")).cast("int").alias("cluster"),
        as_timestamp(run_date).alias("run_date"))


# ---------------------------------------------------------------- run log
def log_rows(spark: SparkSession, run_date, entries: list[tuple[str, str, str]]) -> DataFrame:
    """Run-log rows (K7): (run_date, step, status, message)."""
    when = run_date if isinstance(run_date, dt.datetime) else dt.datetime.fromisoformat(
        str(run_date))
    return spark.createDataFrame([(when, s, st, m) for s, st, m in entries], RUN_LOG)


def model_metrics(model: PipelineModel, features: list[str]) -> list[tuple[str, str, str]]:
    """The three metric entries the monitor reads (T13): scaler means and
    standard deviations, PCA explained variance, k-means cost and sizes."""
    scaler, pca, km = model.stages[1], model.stages[2], model.stages[3]
    mean = ", ".join(f"{f}={float(v)!r}" for f, v in zip(features, scaler.mean.toArray()))
    std = ", ".join(f"{f}={float(v)!r}" for f, v in zip(features, scaler.std.toArray()))
    var = ", ".join(f"{v:.6f}" for v in pca.explainedVariance.toArray())
    summary = km.summary
    sizes = ", ".join(str(s) for s in summary.clusterSizes)
    return [
        ("scaler_params", "INFO", f"mean: {mean}; std: {std}"),
        ("pca_params", "INFO", f"k={pca.getK()}; explained_variance: {var}"),
        ("kmeans_metrics", "INFO",
         f"k={km.getK()}; cost={summary.trainingCost:.6f}; sizes: {sizes}"),
    ]


def monitor(log: DataFrame, steps=METRIC_STEPS) -> DataFrame:
    """Newest metric entries first."""
    return log.filter(F.col("step").isin(*steps)).orderBy(F.col("run_date").desc())


def scaler_entries(log: DataFrame) -> DataFrame:
    """The logged scaler parameters as rows (run_date, feature, mean, deviation) (K9)."""
    def pairs(part: str) -> Column:
        text = F.regexp_extract("message", rf"{part}: ([^;]*)", 1)
        return F.transform(F.split(text, ", "), lambda p: F.split(p, "="))
    return log.where(F.col("step") == "scaler_params") \
        .select("run_date", F.explode(F.arrays_zip(pairs("mean").alias("m"), pairs("std").alias("d"))).alias("x")) \
        .select("run_date", F.col("x.m")[0].alias("feature"), F.col("x.m")[1].cast("double").alias("mean"),
                F.col("x.d")[1].cast("double").alias("deviation"))


# ---------------------------------------------------------------- the job
Logger = Callable[[str, str, str], None]


@contextmanager
def logged(log: Logger, step: str):
    """A failing step leaves an ERROR row with its message (K7) and fails the job."""
    try:
        yield
    except Exception as e:
        log(step, "ERROR", f"{type(e).__name__}: {str(e)[:500]}")
        raise


def cluster_customers(spark: SparkSession, profiles: DataFrame, run_date, log: Logger, *,
                      model_path: str | None = None, now_s: float | None = None,
                      requested=REQUESTED_FEATURES, write=lambda df: df) -> DataFrame:
    """The clustering job (K1-K7): returns the assignments that ``write`` has stored;
    ``log(step, status, message)`` is called as each step ends."""
    with logged(log, "load_data"):
        features, dropped = feature_columns(profiles, requested)
        log("load_data", "INFO", "profile mart loaded")
    if dropped:
        log("select_features", "WARN", "missing features dropped: " + ", ".join(dropped))
    frame = feature_frame(profiles, features).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        log("assemble_features", "INFO", f"{len(features)} features")
        with logged(log, "model_train"):
            model, step, msg = load_or_fit(spark, model_path, frame, features, now_s=now_s)
            log(step, "INFO", msg)
            if step == "model_train":
                for entry in model_metrics(model.pipeline, features):
                    log(*entry)
        with logged(log, "save_clusters"):
            stored = write(assign_clusters(model, frame, run_date))
            log("save_clusters", "SUCCESS", "clusters assigned")
    finally:
        frame.unpersist()
    log("process_complete", "SUCCESS", "customer clustering completed")
    return stored


# ---------------------------------------------------------------- cluster profile
def exact_avg(col: str) -> F.Column:
    """Mean as a double rounded to 6 places, computed on exact decimals."""
    return F.round(F.avg(F.col(col).cast("decimal(38,6)")), 6).cast("double")


def cluster_profile(profiles: DataFrame, clusters: DataFrame, analysis_time,
                    features=PROFILE_FEATURES) -> DataFrame:
    """Per-cluster feature means and size (K8, J3, A16, O2): one row per cluster."""
    joined = profiles.join(clusters.select(ID, "cluster"), ID, "inner")
    agg = joined.groupBy("cluster").agg(
        *[exact_avg(c).alias(f"avg_{c}") for c in features],
        F.count(F.lit(1)).alias("rows_in_cluster"))
    return agg.withColumn("analysis_timestamp", as_timestamp(analysis_time)).orderBy("cluster")

"""The scheduled segmentation job with its tables.

Order of the daily job: publish the profile mart to the lake table, cluster
the customers (writing assignments and the run log), then append the
per-cluster statistics to the cluster history.  Tables are catalog names when
a catalog is configured, else Parquet paths in the shared storage.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from funnelspark.operators import segments
from funnelspark.sources import lake


@dataclass(frozen=True)
class SegmentTables:
    profiles: str        # lake copy of the profile mart (S15)
    clusters: str        # customer -> cluster, replaced each run (S18)
    log: str             # run log, appended (S17)
    history: str         # per-cluster statistics, one set of rows for each run (S19)
    model: str           # saved PipelineModel (K6)


def run_segmentation_job(spark: SparkSession, profile_mart: DataFrame, tables: SegmentTables,
                         run_date, now_s: float | None = None) -> None:
    """The job may be repeated for a run date: replaced tables get a new version, the
    history rows of the date are replaced, and the log gets one row as each step ends
    (an ERROR row for the one that fails)."""
    def log(step: str, status: str, message: str) -> None:
        lake.create_or_append(spark, segments.log_rows(spark, run_date, [(step, status, message)]),
                              tables.log)

    with segments.logged(log, "publish_profiles"):
        profiles = lake.create_or_replace(spark, profile_mart, tables.profiles, ["customer_id"])
    clusters = segments.cluster_customers(
        spark, profiles, run_date, log, model_path=tables.model, now_s=now_s,
        write=lambda df: lake.create_or_replace(spark, df, tables.clusters, ["customer_id"]))
    with segments.logged(log, "cluster_profile"):
        stats = segments.cluster_profile(profiles, clusters, run_date)
        lake.replace_run(spark, stats, tables.history, "analysis_timestamp")


def read_log(spark: SparkSession, tables: SegmentTables) -> DataFrame | None:
    return lake.read_table(spark, tables.log)


def read_history(spark: SparkSession, tables: SegmentTables) -> DataFrame | None:
    """The whole cluster history."""
    return lake.read_table(spark, tables.history)

"""Scheduled jobs, in the order the scheduler ran them (M11, K-pipeline).

    python -m funnelspark.plans.jobs batch   --web P --purchases P --profiles P \\
        --root ROOT --as-of "2024-02-01 00:00:00" [--mode touched|replace_batch] [--keep N]
    python -m funnelspark.plans.jobs segment --root ROOT --tables TROOT --as-of ...

``batch`` applies one incremental run of all warehouse models to the newest
committed run under ``--root`` (landed raw tables as Parquet in, model tables
out).  ``segment`` clusters the newest profile mart and appends the cluster
statistics.  A failing step raises and stops the chain (T23).
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from funnelspark.plans import model_runs, segment_job, warehouse
from funnelspark.session import build_session


def batch_job(spark: SparkSession, web: str, purchases: str, profiles: str, root: str, as_of,
              mode: str = "touched") -> str:
    """One run; a retry or a rerun at the same time starts from the run before it and
    replaces what that time had committed only when it is complete."""
    warehouse.check_time(spark, root, as_of)
    prev = warehouse.load_models(spark, root, before=as_of)
    store = warehouse.new_store(spark, root, as_of)
    models = model_runs.run_models(prev, spark.read.parquet(web), spark.read.parquet(purchases),
                                   spark.read.parquet(profiles), as_of, mode=mode, store=store)
    return warehouse.commit_models(spark, models, root, as_of, store)


def segment_tables(root: str) -> segment_job.SegmentTables:
    return segment_job.SegmentTables(profiles=f"{root}/lake_profiles",
                                     clusters=f"{root}/customer_clusters",
                                     log=f"{root}/customer_clusters_log",
                                     history=f"{root}/customers_clusters_analysis",
                                     model=f"{root}/segment_model")


def segment_job_run(spark: SparkSession, root: str, tables_root: str, as_of) -> None:
    models = warehouse.load_models(spark, root)
    if models is None or models.profiles is None:
        raise RuntimeError(f"no committed profile mart under {root}")
    segment_job.run_segmentation_job(spark, models.profiles, segment_tables(tables_root), as_of)


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="funnelspark.plans.jobs")
    sub = ap.add_subparsers(dest="job", required=True)
    b = sub.add_parser("batch")
    for opt in ("--web", "--purchases", "--profiles", "--root", "--as-of"):
        b.add_argument(opt, required=True)
    b.add_argument("--mode", default="touched", choices=("touched", "replace_batch"))
    b.add_argument("--keep", type=int, default=0,
                   help="afterwards delete tables that the newest KEEP runs don't read")
    s = sub.add_parser("segment")
    for opt in ("--root", "--tables", "--as-of"):
        s.add_argument(opt, required=True)
    args = ap.parse_args(argv)
    spark = build_session(app_name=f"funnelspark-{args.job}")
    if args.job == "batch":
        batch_job(spark, args.web, args.purchases, args.profiles, args.root, args.as_of, args.mode)
        if args.keep:
            warehouse.expire(spark, args.root, args.keep)
    else:
        segment_job_run(spark, args.root, args.tables, args.as_of)


if __name__ == "__main__":
    main()

"""Table reads and writes of the lake and marts.

Tables are addressed by name when a catalog is configured (``writeTo`` with
create-or-replace / append on a v2 catalog such as Iceberg), otherwise by a
Parquet path in the shared storage.  A path table that is replaced gets a new
``version=`` folder and then a pointer file with the next number; readers take
the newest pointer, so a failed or running write never harms the table.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from funnelspark.session import list_names, path_exists, publish_text, read_text


def sorted_for_storage(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Range-partition and sort by the table's key so Parquet row-group
    statistics skip data on key filters (S21).  Range bounds come from a
    sample, so partitions stay even whatever the key distribution; their
    number is left to adaptive execution."""
    return df.repartitionByRange(*[F.col(k) for k in keys]).sortWithinPartitions(*keys)


def export_parquet(df: DataFrame, path: str, keys: Sequence[str] | None = None) -> None:
    """Truncating Parquet export (S14), optionally in key order."""
    (sorted_for_storage(df, keys) if keys else df).write.mode("overwrite").parquet(path)


def _is_catalog_table(spark: SparkSession, name: str) -> bool:
    parts = name.split(".")
    return len(parts) > 1 and spark.conf.get(f"spark.sql.catalog.{parts[0]}", None) is not None


def _pointers(spark: SparkSession, target: str) -> list[int]:
    return sorted(int(n[8:-5]) for n in list_names(spark, target)
                  if n.startswith("current-") and n.endswith(".text"))


def create_or_replace(spark: SparkSession, df: DataFrame, target: str,
                      sort_by: Sequence[str] | None = None) -> DataFrame:
    """Create or replace a table (S15, S18): catalog name or Parquet path."""
    out = sorted_for_storage(df, sort_by) if sort_by else df
    if _is_catalog_table(spark, target):
        out.writeTo(target).createOrReplace()
        return spark.table(target)
    version = f"version={uuid.uuid4().hex}"
    out.write.parquet(f"{target}/{version}")
    publish_text(spark, f"{target}/current-{max(_pointers(spark, target), default=0) + 1:08d}.text",
                 version)
    return spark.read.parquet(f"{target}/{version}")


def create_or_append(spark: SparkSession, df: DataFrame, target: str) -> None:
    """Append to a table, creating it on first use."""
    if _is_catalog_table(spark, target):
        if spark.catalog.tableExists(target):
            df.writeTo(target).append()
        else:
            df.writeTo(target).create()
        return
    df.write.mode("append").parquet(target)


def replace_run(spark: SparkSession, df: DataFrame, target: str, run_col: str) -> None:
    """Append the rows of a run (S19); rows that an earlier attempt of the same run
    left (equal ``run_col``) are replaced, so a retry doesn't repeat them."""
    if _is_catalog_table(spark, target):
        if spark.catalog.tableExists(target):
            runs = [r[0] for r in df.select(F.col(run_col).cast("string")).distinct().collect()]
            df.writeTo(target).overwrite(F.col(run_col).cast("string").isin(runs))
        else:
            df.writeTo(target).create()
        return
    df.withColumn("_run", F.date_format(run_col, "yyyyMMdd'T'HHmmss.SSSSSS")).write \
        .mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("_run").parquet(target)


def read_table(spark: SparkSession, target: str) -> DataFrame | None:
    """Whole table read (S16, S20); ``None`` when it does not exist yet."""
    if _is_catalog_table(spark, target):
        return spark.table(target) if spark.catalog.tableExists(target) else None
    pointers = _pointers(spark, target)
    if pointers:
        version = read_text(spark, f"{target}/current-{pointers[-1]:08d}.text").strip()
        return spark.read.parquet(f"{target}/{version}")
    return spark.read.parquet(target).drop("_run") if path_exists(spark, target) else None


def load_and_count(spark: SparkSession, source_path: str, target: str) -> tuple[DataFrame, int]:
    """Parquet export -> lake table -> row count check."""
    table = create_or_replace(spark, spark.read.parquet(source_path), target)
    return table, table.count()


def preview(df: DataFrame, keys: Sequence[str], n: int = 5) -> DataFrame:
    """First rows by key for a look at a table (O4): a limit is the feature here."""
    return df.orderBy(*keys).limit(n)

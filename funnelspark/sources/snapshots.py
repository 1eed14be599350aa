"""Append-only marts on storage, one folder for each load.

A snapshot is written to ``<path>/_load=<time>`` (colons left out), and the folder's name is the
load time: the newest load is found by listing names, and only its files are read.  An attempt
writes to a folder of its own below it and publishes a pointer last, so a failed attempt is never
seen and a load that is repeated replaces itself.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession

from funnelspark.session import list_names, publish_text, read_text

_PREFIX = "_load="
_FORMAT = "%Y-%m-%dT%H%M%S.%f"


def _name(load_time) -> str:
    t = load_time if isinstance(load_time, dt.datetime) else dt.datetime.fromisoformat(str(load_time))
    return _PREFIX + t.strftime(_FORMAT)


def append(spark: SparkSession, path: str, snapshot: DataFrame, load_time) -> None:
    """Add a full snapshot loaded at ``load_time``."""
    base = f"{path}/{_name(load_time)}"
    attempt = f"data-{uuid.uuid4().hex}"
    snapshot.write.parquet(f"{base}/{attempt}")
    numbers = [int(n[:-4]) for n in list_names(spark, base) if n.endswith(".ptr")]
    publish_text(spark, f"{base}/{max(numbers, default=0) + 1:06d}.ptr", attempt)


def _data(spark: SparkSession, base: str) -> str | None:
    pointers = [n for n in list_names(spark, base) if n.endswith(".ptr")]
    return f"{base}/{read_text(spark, f'{base}/{max(pointers)}').strip()}" if pointers else None


def loads(spark: SparkSession, path: str) -> list[str]:
    """Folders of the published loads' files, oldest first."""
    bases = [f"{path}/{n}" for n in list_names(spark, path) if n.startswith(_PREFIX)]
    return [d for d in (_data(spark, b) for b in bases) if d]


def latest(spark: SparkSession, path: str, schema) -> DataFrame:
    """The newest snapshot; no other load's files are opened."""
    newest = loads(spark, path)[-1:]
    reader = spark.read.schema(schema)
    return reader.parquet(*newest) if newest else spark.createDataFrame([], schema)


def history(spark: SparkSession, path: str, schema) -> DataFrame:
    """All snapshots."""
    every = loads(spark, path)
    return spark.read.schema(schema).parquet(*every) if every else spark.createDataFrame([], schema)

"""Helpers shared by the training-data operators."""

from __future__ import annotations

import os

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from funnelspark.session import (delete_path, ensure_session_defaults, materialize,
                                 scratch_path)

_PACKAGE_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def prepare(spark: SparkSession) -> None:
    """Session defaults, and this package on the import path of Python workers
    that a local master starts (a cluster has the package installed)."""
    ensure_session_defaults(spark)
    # Rows of an Arrow batch: some hold whole long texts.
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    env = spark.sparkContext.environment
    paths = [p for p in (env.get("PYTHONPATH", ""), _PACKAGE_ROOT) if p]
    if _PACKAGE_ROOT not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(paths)


class Workspace:
    """Tables of an operator's run in the shared folder, deleted by ``close`` once what is
    made from them has been written."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: list[str] = []

    def save(self, df: DataFrame, name: str) -> DataFrame:
        path = scratch_path(self.spark, name)
        self.paths.append(path)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)   # known: no job reads it from the files

    def close(self) -> None:
        for path in self.paths:
            delete_path(self.spark, path)
        self.paths = []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def map_batches(df: DataFrame, fn, schema: str) -> DataFrame:
    """``fn(pyarrow.RecordBatch) -> pyarrow.RecordBatch`` over every Arrow batch."""
    def run(batches):
        for batch in batches:
            if batch.num_rows:
                yield fn(batch)
    return df.mapInArrow(run, schema)


def unused(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until ``df`` has no such column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def column_ddl(df: DataFrame) -> list[str]:
    """``name type`` of every column, quoted."""
    return [f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in df.schema]


def columns_of(df: DataFrame) -> list:
    """The columns of ``df`` as they are, whatever their names."""
    return [F.col(f"`{c.replace('`', '``')}`") for c in df.columns]


def text_bytes(value: str | None) -> bytes:
    return b"" if value is None else value.encode("utf-8")


# ------------------------------------------------------------------ hashing
_SEED = np.random.default_rng(20240201)
_BYTE_HASH = _SEED.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INV = pow(_BASE, -1, 2**64)


class RollingHash:
    """64-bit hashes of any substring of a byte array, all positions at once.

    ``H[i] = sum(T[b_j] * p**j, j < i) mod 2**64``; since p is odd it has an
    inverse, so ``(H[e] - H[s]) * p**-s`` depends on the bytes s..e only.
    """

    _powers = (np.ones(1, np.uint64), np.ones(1, np.uint64))

    @classmethod
    def powers(cls, n: int):
        if len(cls._powers[0]) < n:
            size = max(n, 1 << 16, 2 * len(cls._powers[0]))
            out = []
            for base in (_BASE, _BASE_INV):
                steps = np.full(size, base, np.uint64)
                steps[0] = 1
                out.append(np.cumprod(steps, dtype=np.uint64))
            cls._powers = tuple(out)
        return cls._powers

    def __init__(self, data: bytes):
        raw = np.frombuffer(data, np.uint8)
        up, self.down = self.powers(len(raw) + 1)
        self.prefix = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(_BYTE_HASH[raw] * up[:len(raw)], out=self.prefix[1:])

    def spans(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix64((self.prefix[end] - self.prefix[start]) * self.down[start])


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the 64 output bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


__all__ = ["prepare", "Workspace", "table", "map_batches", "text_bytes", "unused", "column_ddl", "columns_of", "materialize",
           "RollingHash", "mix64"]

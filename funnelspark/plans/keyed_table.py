"""Tables of one row per key, kept as levels of changed rows.

A run writes only the rows that it changes: a new level over the ones before.  Readers see, for
each key, the row of its newest level; a removed key is a marked row.  A level is merged into the
one below when it has at least half as many rows, so the levels shrink geometrically (their
number grows with the logarithm of the rows) and each row is rewritten a logarithmic number of
times, never once per run.

Every level is bucketed by the hash of the key into the same number of buckets and sorted in
them: levels are merged, and tables of one key and bucket count are joined, without an exchange.
No level is broadcast, whatever its files' compressed size: the driver would hold all its keys.
Buckets need a catalog while they are written and opened; the entry is dropped at once (the
files and the ``KeyedTable``, which the run's manifest holds, are all that stays).

Keys compare NULL-safely: the key is one text made of all parts, each with its length.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

KEY = "_key"
GONE = "_gone"


def key_of(parts: Sequence[str]) -> Column:
    """One text for the values of the key's columns; NULL is a value of its own."""
    texts = [F.col(p).cast("string") for p in parts]
    return F.concat(*[F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("-"))
                      for t in texts])


def ddl_of(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)


def write_bucketed(df: DataFrame, path: str, buckets: int) -> None:
    """Files bucketed by ``KEY``, one for each bucket."""
    name = f"level_{uuid.uuid4().hex}"
    try:
        df.repartition(buckets, KEY).write.bucketBy(buckets, KEY).sortBy(KEY) \
            .option("path", path).saveAsTable(name)
    finally:
        df.sparkSession.sql(f"DROP TABLE IF EXISTS {name}")


def open_bucketed(spark: SparkSession, schema: str, path: str, buckets: int) -> DataFrame:
    name, quoted = f"level_{uuid.uuid4().hex}", path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"CREATE TABLE {name} ({schema}) USING parquet CLUSTERED BY (`{KEY}`) "
              f"SORTED BY (`{KEY}`) INTO {buckets} BUCKETS LOCATION '{quoted}'")
    try:
        return spark.table(name)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def newest(older: DataFrame, newer: DataFrame) -> DataFrame:
    """The rows of two levels: those of ``newer``, and of ``older`` what it doesn't replace."""
    return older.join(newer.select(KEY).hint("merge"), KEY, "left_anti").unionByName(newer)


@dataclass(frozen=True)
class KeyedTable:
    spark: SparkSession
    key: tuple[str, ...]
    schema: str                  # of the rows, without KEY and GONE
    buckets: int
    levels: tuple[tuple[str, int], ...] = ()   # (path, rows), oldest first

    @classmethod
    def new(cls, rows: DataFrame, key: Sequence[str], buckets: int | None = None) -> KeyedTable:
        """An empty table for rows like these."""
        spark = rows.sparkSession
        return cls(spark, tuple(key), ddl_of(rows),
                   buckets or int(spark.conf.get("spark.sql.shuffle.partitions")))

    def manifest(self) -> dict:
        return {"key": list(self.key), "schema": self.schema, "buckets": self.buckets,
                "levels": [list(x) for x in self.levels]}

    @classmethod
    def from_manifest(cls, spark: SparkSession, held: dict) -> KeyedTable:
        return cls(spark, tuple(held["key"]), held["schema"], held["buckets"],
                   tuple((path, rows) for path, rows in held["levels"]))

    @property
    def _stored(self) -> str:
        return f"{self.schema}, `{GONE}` boolean, `{KEY}` string"

    def _open(self, level: tuple[str, int]) -> DataFrame:
        return open_bucketed(self.spark, self._stored, level[0], self.buckets)

    def keyed(self) -> DataFrame:
        """The rows with their ``KEY``, bucketed by it."""
        if not self.levels:
            return self.spark.createDataFrame([], f"{self.schema}, `{KEY}` string")
        out = self._open(self.levels[0])
        for level in self.levels[1:]:
            out = newest(out, self._open(level))
        return out.where(~F.col(GONE)).drop(GONE)

    def read(self) -> DataFrame:
        return self.keyed().drop(KEY)

    def look_up(self, rows: DataFrame, columns: Sequence[str], prefix: str = "old_") -> DataFrame:
        """``rows`` (with the key's columns) and, NULL where there is none, the stored ``columns``;
        only ``rows`` are moved."""
        stored = self.keyed().select(KEY, *[F.col(c).alias(prefix + c) for c in columns])
        return rows.withColumn(KEY, key_of(self.key)).join(stored.hint("merge"), KEY, "left").drop(KEY)

    def apply(self, store, name: str, changes: DataFrame, gone: Column | None = None) -> KeyedTable:
        """The table with these rows put in (one for each key; those where ``gone`` holds taken
        out), written as a level through ``store``."""
        columns = self.spark.createDataFrame([], self.schema).columns
        level = changes.withColumn(GONE, F.coalesce(gone, F.lit(False)) if gone is not None else F.lit(False)) \
            .select(*columns, GONE).withColumn(KEY, key_of(self.key))
        levels = [*self.levels, self._write(store, name, level)]
        if not levels[-1][1] and len(levels) > 1:
            return self
        while len(levels) > 1 and 2 * levels[-1][1] >= levels[-2][1]:
            merged = newest(self._open(levels[-2]), self._open(levels[-1]))
            if len(levels) == 2:
                merged = merged.where(~F.col(GONE))
            levels[-2:] = [self._write(store, name, merged)]
        return replace(self, levels=tuple(levels))

    def _write(self, store, name: str, level: DataFrame) -> tuple[str, int]:
        path = store.new_path(name)
        write_bucketed(level, path, self.buckets)
        return path, self.spark.read.schema(self._stored).parquet(path).count()   # from the footers

    @property
    def paths(self) -> list[str]:
        return [path for path, _ in self.levels]

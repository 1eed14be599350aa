"""Which parts of a table hold a key, without reading the table's keys.

For each part of a table the manifest holds the smallest and largest key and the path of a Bloom
filter.  A filter is a table itself: keys fall into buckets by their hash, and a row holds the bits
of one bucket (``WORDS`` longs), so filters of any size are built and asked in parallel: a key is
moved once, to its bucket, whose bits are set there (about ``BUCKET_KEYS`` keys at once).  A part is
opened only if its range and its filter answer, and then for the key column alone, which settles
the filter's false answers (below one in a thousand for a key).
"""

from __future__ import annotations

from dataclasses import asdict, dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from funnelspark.session import list_names

#: Keys of a full bucket, bits for each, bits set for each.
BUCKET_KEYS = 4096
BITS = 16
HASHES = 11
WORDS = BUCKET_KEYS * BITS // 64


@dataclass(frozen=True)
class PartFilter:
    path: str
    buckets: int
    low: str
    high: str

    def meets(self, low: str, high: str) -> bool:
        return self.low <= high and low <= self.high

    manifest = asdict


def _bucket(key: str, buckets: Column) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(0)), buckets.cast("long"))


def _first_and_step(key: str) -> tuple[Column, Column]:
    size = F.lit(WORDS * 64)
    return F.pmod(F.xxhash64(key, F.lit(1)), size), F.pmod(F.xxhash64(key, F.lit(2)), size)


def _places(key: str) -> Column:
    """The bits of a key in its bucket."""
    first, step = _first_and_step(key)
    return F.array(*[F.pmod(first + F.lit(i) * step, F.lit(WORDS * 64)) for i in range(HASHES)])


def _bit(place: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), (place % 64).cast("int"))


def build(rows: DataFrame, key: str, part: str, path: str) -> dict[str, PartFilter]:
    """Filters of the parts of ``rows`` (column ``part``), written under ``path``."""
    spark = rows.sparkSession
    keys = rows.select(F.col(part).alias("_part"), F.col(key).alias("k")).where("k is not null")
    sizes = keys.groupBy("_part").agg(F.count("*").alias("n"), F.min("k").alias("low"),
                                      F.max("k").alias("high")).collect()   # a row for each part
    if not sizes:
        return {}
    found = {r._part: (1 << max(0, (-(-r.n // BUCKET_KEYS) - 1)).bit_length(), r.low, r.high) for r in sizes}
    names = sorted(found)
    number = F.create_map(*[F.lit(x) for i, p in enumerate(names) for x in (p, i)])
    counts = F.array(*[F.lit(found[p][0]) for p in names])
    held = keys.select(number[F.col("_part")].alias("number"), "k").withColumn("buckets", F.get(counts, F.col("number")))
    first, step = _first_and_step("k")
    places = held.select("number", "buckets", _bucket("k", F.col("buckets")).cast("int").alias("bucket"),
                         first.cast("int").alias("first"), step.cast("int").alias("step"))
    size, hashes = WORDS * 64, HASHES

    def filled(keys: pa.Table) -> pa.Table:
        one, by = (keys.column(c).to_numpy().astype(np.int64) for c in ("first", "step"))
        bits = np.zeros(size, np.uint8)
        for i in range(hashes):
            bits[(one + i * by) % size] = 1
        words = np.packbits(bits, bitorder="little").view("<i8")
        return keys.slice(0, 1).select(["number", "buckets", "bucket"]).append_column(
            "bits", pa.array([words], pa.list_(pa.int64())))

    places.groupBy("number", "buckets", "bucket") \
        .applyInArrow(filled, "number int, buckets int, bucket int, bits array<long>") \
        .select(F.get(F.array(*[F.lit(p) for p in names]), F.col("number")).alias("_part"),
                "buckets", F.col("bucket").cast("long").alias("bucket"), "bits") \
        .hint("rebalance", "_part").write.partitionBy("_part").parquet(path)
    written = {n[6:]: f"{path}/{n}" for n in list_names(spark, path) if n.startswith("_part=")}
    return {p: PartFilter(written[p], *found[p]) for p in found}


def answering(spark: SparkSession, filters: dict[str, PartFilter], keys: DataFrame, key: str) -> set[str]:
    """The parts whose range and filter answer to one of ``keys``."""
    low, high = keys.agg(F.min(key), F.max(key)).first()
    asked = {p: f for p, f in filters.items() if low is not None and f.meets(low, high)}
    if not asked:
        return set()
    # one read of all filters; a row's part is in its file's path
    stored = spark.read.schema("buckets int, bucket long, bits array<long>") \
        .parquet(*[f.path for _, f in sorted(asked.items())]) \
        .withColumn("part", F.regexp_extract("_metadata.file_path", "_part=([^/]+)/", 1))
    counts = sorted({f.buckets for f in asked.values()})   # powers of two
    probes = keys.select(F.col(key).alias("k")).where("k is not null").distinct() \
        .withColumn("buckets", F.explode(F.array(*[F.lit(c) for c in counts]))) \
        .select("buckets", _bucket("k", F.col("buckets")).alias("bucket"), _places("k").alias("places")) \
        .hint("merge")   # a batch's keys, each with its places: not for the driver to hold
    s, p = stored.alias("s"), probes.alias("p")
    holds = F.forall("p.places", lambda x: F.get("s.bits", F.floor(x / 64).cast("int")).bitwiseAND(_bit(x)) != 0)
    hit = p.join(s, (F.col("p.buckets") == F.col("s.buckets")) & (F.col("p.bucket") == F.col("s.bucket")) & holds)
    return {r.part for r in hit.select("part").distinct().collect()}

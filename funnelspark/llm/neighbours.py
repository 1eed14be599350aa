"""Approximate nearest neighbours by cross-polytope hashing.

Unit vectors are turned by pseudo-rotations (three rounds of random signs and
the fast Hadamard transform) and hashed to the nearest signed axis, the corner
of the cross-polytope.  A table concatenates as many such hashes as give about
``BUCKETS_PER_ROOT`` times the square root of the rows buckets, so the share of
the rows that a query meets falls as the table grows.  Every row is filed once
in each of ``tables`` tables; a query probes, in each table, the ``probes``
buckets of the smallest summed loss, the loss of an axis being the squared
difference from the largest one (multiprobe).  All members of a probed bucket
are candidates and are ranked by their exact inner product.

Nearness is the inner product, so lengths count: rows are taken in bands of
length (a factor of two each), divided by the largest length of their band and
given one more coordinate that makes them unit vectors; queries have 0 there.
In a band the inner product with a query then orders rows as the angle does.
Every band is probed.  A band of up to ``20 * k`` vector values is one bucket.
A query with fewer than ``k`` found is compared with all rows, in blocks.

Rows of one vector value form a class that is filed once, with its smallest
``k + 1`` ids; equal queries are searched once.  Neighbouring buckets of a
table (about ``GROUP_ROWS`` classes) share a shuffle key.  The classes of a
large key are split by hash into slices of about ``slice_rows`` and its queries
into parts of about ``part_rows``; each pair of a slice and a part is one group,
so no task holds a whole hot bucket or all that ask for it.  A group returns at
most its best ``k + 1`` for a query.

Defined cases: vectors that are null, zero, of another length than most, or
with null or non-finite components take no part; rows with a null id neither;
repeated ids count once, with the largest of their vectors (compared
component by component); equal scores are ordered by the smaller id; with fewer candidates
than ``k`` all are returned; an empty table gives no rows.
"""

from __future__ import annotations

import math
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from funnelspark.llm.common import Workspace, materialize

TABLES = 20
PROBES = 16
BUCKETS_PER_ROOT = 9
#: Classes of the neighbouring buckets that share a shuffle key, on average.
GROUP_ROWS = 512
#: Classes in one slice and queries in one part of a key (128 doubles each: about 4 MB).
SLICE_ROWS = 4096
PART_ROWS = 4096
#: Inner products closer than this are settled by the exact sum.
_SLACK = 1e-9
#: Bits of a key that number the buckets of one table.
_BUCKET_BITS = 44


class CrossPolytope:
    """``tables`` concatenations of cross-polytope hashes of vectors of one length.

    ``widths`` are the signed axes that each hash of a table tells apart."""

    def __init__(self, dim: int, tables: int, buckets: int = 0, seed: int = 11):
        self.size = 1 << max(0, dim - 1).bit_length()
        widest = 2 * self.size
        left, self.widths = max(2, buckets or widest), []
        while left > 1:
            self.widths.append(min(left, widest))
            left //= self.widths[-1]
        self.buckets = math.prod(self.widths)
        rng = np.random.default_rng(seed)
        self.signs = rng.choice([-1.0, 1.0], (tables, len(self.widths), 3, self.size))

    def turn(self, vectors: np.ndarray, table: int, part: int = 0) -> np.ndarray:
        out = np.zeros((len(vectors), self.size))
        out[:, :vectors.shape[1]] = vectors
        for signs in self.signs[table, part]:
            out = hadamard(out * signs)
        return out

    def _both(self, vectors, table, part):
        turned = self.turn(vectors, table, part)[:, :self.widths[part] // 2]
        return np.hstack([turned, -turned])

    def bucket(self, vectors: np.ndarray, table: int) -> np.ndarray:
        """Number of the bucket: the nearest signed axis of every hash, first hash foremost."""
        out = np.zeros(len(vectors), np.int64)
        for part, width in enumerate(self.widths):
            out = out * width + np.argmax(self._both(vectors, table, part), axis=1)
        return out

    def probes(self, vectors: np.ndarray, table: int, probes: int) -> np.ndarray:
        """The ``probes`` buckets of the smallest summed loss.  A sum among the smallest has
        its first terms among the smallest, so each step keeps no more than ``probes``."""
        loss, number = np.zeros((len(vectors), 1)), np.zeros((len(vectors), 1), np.int64)
        for part, width in enumerate(self.widths):
            both = self._both(vectors, table, part)
            step = (both.max(axis=1, keepdims=True) - both) ** 2
            axes = _smallest(step, min(probes, width))
            step = np.take_along_axis(step, axes, 1)
            loss = (loss[:, :, None] + step[:, None, :]).reshape(len(vectors), -1)
            number = (number[:, :, None] * width + axes[:, None, :]).reshape(len(vectors), -1)
            keep = _smallest(loss, min(probes, loss.shape[1]))
            loss, number = np.take_along_axis(loss, keep, 1), np.take_along_axis(number, keep, 1)
        return number


def _smallest(x: np.ndarray, n: int) -> np.ndarray:
    return np.argpartition(x, n - 1, axis=1)[:, :n]


def hadamard(x: np.ndarray) -> np.ndarray:
    """Orthonormal fast Hadamard transform of every row (length a power of two): the
    transform of length a * b is that of length b of each of a pieces, then that of
    length a across them, so blocks of 16 are small matrix products."""
    n = x.shape[1]
    out, done = x, 1
    while done < n:
        step = min(16, n // done)
        # The last axis is transformed and goes to the front; after all, the order is the old one.
        out = out.reshape(-1, step) @ _small_hadamard(step)
        out = np.ascontiguousarray(out.reshape(len(x), n // step, step).transpose(0, 2, 1)).reshape(len(x), n)
        done *= step
    return out


def _small_hadamard(n: int) -> np.ndarray:
    h = np.ones((1, 1))
    while len(h) < n:
        h = np.block([[h, h], [h, -h]])
    return h / np.sqrt(n)


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, v) with double vectors that take part, of the most common length."""
    v = F.col("v")
    rows = vectors.select(F.col(id_col).cast("long").alias("id"),
                          F.col(vector_col).cast("array<double>").alias("v")) \
        .where(F.col("id").isNotNull() & v.isNotNull() & (F.size(v) > 0)) \
        .where(F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))) \
        .where(F.exists(v, lambda x: x != 0))
    length = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    return rows.where(F.size("v") == (length.n if length else 0)) \
        .groupBy("id").agg(F.max("v").alias("v"))


def classes_of(rows: DataFrame, keep: int) -> DataFrame:
    """One row for each vector value: its smallest ``keep`` ids; the class is named by the first.

    The smallest ids are taken in two steps (by a hash of the id, then over
    all), so a value that most rows have isn't gathered in one place."""
    part = rows.withColumn("part", F.pmod(F.xxhash64("id"), F.lit(64)))
    near = Window.partitionBy("v", "part").orderBy("id")
    first = part.withColumn("r", F.row_number().over(near)).where(F.col("r") <= keep)
    whole = Window.partitionBy("v").orderBy("id")
    return first.withColumn("r", F.row_number().over(whole)).where(F.col("r") <= keep) \
        .groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids")) \
        .withColumn("class", F.element_at("ids", 1))


class Band(NamedTuple):
    """Vector values of about one length: log2 of the largest, and how many there are."""
    number: int
    longest: float
    classes: int


class Hashing:
    """Buckets of rows and of queries, for each band of length."""

    def __init__(self, dim: int, bands: list[Band], k: int, tables: int, probes: int):
        self.tables, self.n_probes, self.bands = tables, probes, bands
        self.of, self.shift = [], []
        for band in bands:
            if band.classes <= 20 * k:
                self.of.append(None)
                self.shift.append(0)
                continue
            wanted = BUCKETS_PER_ROOT * math.sqrt(band.classes)
            # One more coordinate than the vectors have, but no more axes for it.
            hashing = CrossPolytope(dim + 1, tables, 1 << round(math.log2(wanted)))
            self.of.append(hashing)
            share = GROUP_ROWS * hashing.buckets / band.classes
            self.shift.append(max(0, min(hashing.buckets.bit_length() - 1, int(math.log2(share)))))

    def key(self, band: int, table: int, group):
        return ((band * self.tables + table) << _BUCKET_BITS) + group

    def file(self, vectors: np.ndarray, length: np.ndarray, band_of: np.ndarray):
        """(keys, buckets within the key), one column for each table; -1 where a band has one."""
        keys = np.full((len(vectors), self.tables), -1, np.int64)
        subs = np.zeros((len(vectors), self.tables), np.int32)
        for b, band in enumerate(self.bands):
            at = np.flatnonzero(band_of == band.number)
            if not len(at):
                continue
            if self.of[b] is None:
                keys[at, 0] = self.key(b, 0, 0)
                continue
            part = np.minimum(1.0, np.exp2(length[at] - band.longest))[:, None]
            lifted = np.hstack([vectors[at] * part, np.sqrt(np.maximum(0.0, 1 - part * part))])
            for t in range(self.tables):
                bucket = self.of[b].bucket(lifted, t)
                keys[at, t] = self.key(b, t, bucket >> self.shift[b])
                subs[at, t] = bucket & ((1 << self.shift[b]) - 1)
        return keys, subs

    def probe(self, vectors: np.ndarray):
        """(query, key, bucket within the key) of every probe."""
        lifted = np.hstack([vectors, np.zeros((len(vectors), 1))])
        every = np.arange(len(vectors))
        for b, hashing in enumerate(self.of):
            if hashing is None:
                yield every, np.full(len(every), self.key(b, 0, 0)), np.zeros(len(every), np.int64)
                continue
            for t in range(self.tables):
                buckets = hashing.probes(lifted, t, self.n_probes)
                flat = buckets.ravel()
                yield np.repeat(every, buckets.shape[1]), self.key(b, t, flat >> self.shift[b]), \
                    flat & ((1 << self.shift[b]) - 1)


def nearest(vectors: DataFrame, k: int = 20, query_every: int = 20, id_col: str = "vec_id",
            vector_col: str = "embedding", tables: int = TABLES, probes: int = PROBES,
            slice_rows: int = SLICE_ROWS, part_rows: int = PART_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest found of every row whose
    id is divisible by ``query_every``, among all other rows."""
    work = Workspace(vectors.sparkSession)
    try:
        return materialize(_search(work, vectors, k, query_every, id_col, vector_col, tables,
                                   probes, slice_rows, part_rows), "neighbours")
    finally:
        work.close()


def _search(work, vectors, k, query_every, id_col, vector_col, tables, probes, slice_rows, part_rows):
    rows = usable(vectors, id_col, vector_col)
    classes = work.save(classes_of(rows, k + 1).withColumn("length", _log_length("v")), "neighbour-classes")
    band = F.floor(F.col("length") + 0.5).cast("int")
    # At most one row for each binary exponent of a double.
    bands = [Band(r.band, r.longest, r.n) for r in classes.groupBy(band.alias("band")).agg(
        F.max("length").alias("longest"), F.count("*").alias("n")).orderBy("band").collect()]
    sample = classes.select("v").first()
    hashing = Hashing(len(sample.v) if sample else 1, bands, k, tables, probes)

    # A query class: each query id in it is answered from the class's result.
    queries = work.save(rows.where(F.pmod(F.col("id"), F.lit(query_every)) == 0)
                        .join(classes.select("v", F.col("class").alias("q")), "v")
                        .select(F.col("id").alias("query_id"), "q"), "neighbour-queries")
    query_classes = classes.join(queries.select(F.col("q").alias("class")).distinct(), "class") \
        .select("class", "v")

    filed = work.save(classes.select("class", "v", "length", band.alias("band"))
                      .mapInArrow(_filer(hashing), "class long, v array<double>, "
                                  "filed array<struct<key:long,sub:int>>"), "neighbour-filed")
    asked = work.save(query_classes.mapInArrow(
        _prober(hashing), "class long, v array<double>, probed array<struct<key:long,subs:array<int>>>"),
        "neighbour-probes")
    members = filed.select("class", F.explode("filed").alias("f"), "v").select("f.key", "f.sub", "class", "v")
    probing = asked.select("class", F.explode("probed").alias("p"), "v").select("p.key", "p.subs", "class", "v")
    found = work.save(_ranked(work, members, probing, k, slice_rows, part_rows), "neighbour-found")

    # Queries that met too few: all rows, in slices and parts.
    enough = found.groupBy("q").agg(F.count("*").alias("n")).where(F.col("n") > min(k, _total(bands) - 1))
    short = work.save(query_classes.join(enough, query_classes["class"] == enough["q"], "left_anti"),
                      "neighbour-short")
    if short.limit(1).count():
        every = F.lit(0).cast("long").alias("key")
        found = found.unionByName(_ranked(
            work, classes.select(every, F.lit(0).alias("sub"), "class", "v"),
            short.select(every, F.array(F.lit(0)).alias("subs"), "class", "v"),
            k, slice_rows, part_rows)).dropDuplicates(["q", "class"])
    best = Window.partitionBy("q").orderBy(F.desc("score"), "class")
    top = found.withColumn("r", F.row_number().over(best)).where(F.col("r") <= k + 1)

    # Class results to rows: at most (k + 1) classes of (k + 1) ids a query.
    listed = top.join(classes.select("class", "ids"), "class") \
        .select("q", "score", F.explode("ids").alias("vec_id"))
    by_class = Window.partitionBy("q").orderBy(F.desc("score"), "vec_id")
    listed = listed.withColumn("r", F.row_number().over(by_class)).where(F.col("r") <= k + 1).drop("r")
    final = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return queries.join(listed, "q").where("vec_id <> query_id") \
        .withColumn("rank", F.row_number().over(final)).where(F.col("rank") <= k) \
        .select("query_id", "rank", "vec_id", "score")


def _total(bands: list[Band]) -> int:
    return sum(b.classes for b in bands)


def _log_length(vector_col: str):
    """log2 of a vector's length, for any finite components."""
    v = F.col(vector_col)
    # (largest, sum of squares divided by its square), the largest looked for once
    start = F.struct(F.greatest(F.array_max(v), -F.array_min(v)).alias("largest"), F.lit(0.0).alias("total"))
    return F.aggregate(
        v, start, lambda at, x: F.struct(at["largest"].alias("largest"), (
            at["total"] + (x / at["largest"]) * (x / at["largest"])).alias("total")),
        lambda at: F.log2(at["largest"]) + 0.5 * F.log2(at["total"]))


def _ranked(work, members: DataFrame, probing: DataFrame, k: int, slice_rows: int, part_rows: int) -> DataFrame:
    """(q, class, score) of the pairs that share a key and a bucket of it: for each
    query at least its best ``k + 1`` of each group."""
    sizes = members.groupBy("key").agg(F.ceil(F.count("*") / slice_rows).cast("int").alias("slices")).where("slices > 1")
    asking = probing.groupBy("key").agg(F.ceil(F.count("*") / part_rows).cast("int").alias("parts")).where("parts > 1")
    # Large keys only; written, so that the planner knows their size when it chooses the joins.
    split = work.save(sizes.join(asking, "key", "full_outer").select(
        "key", F.coalesce("slices", F.lit(1)).alias("slices"), F.coalesce("parts", F.lit(1)).alias("parts")),
        "neighbour-splits")
    slices, parts = F.coalesce("slices", F.lit(1)), F.coalesce("parts", F.lit(1))
    left = members.join(split, "key", "left") \
        .withColumn("slice", F.pmod(F.xxhash64("class"), slices).cast("int")) \
        .withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1))) \
        .select("key", "slice", "part", "sub", "class", "v")
    right = probing.join(split, "key", "left") \
        .withColumn("part", F.pmod(F.xxhash64("class"), parts).cast("int")) \
        .withColumn("slice", F.explode(F.sequence(F.lit(0), slices - 1))) \
        .select("key", "slice", "part", "subs", F.col("class").alias("q"), "v")
    right = right.toDF(*right.columns)  # names of its own, where both sides come from one table
    key = ["key", "slice", "part"]
    return left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(
        _ranker(k + 1), "q long, class long, score double").dropDuplicates(["q", "class"])


def _matrix(column) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1).astype(np.float64, copy=False)


def _units(v: np.ndarray) -> np.ndarray:
    v = v / np.abs(v).max(axis=1, keepdims=True)
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def _lists(offsets, values) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)


def _filer(hashing: Hashing):
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            keys, subs = hashing.file(_units(_matrix(batch.column("v"))), batch.column("length").to_numpy(),
                                      batch.column("band").to_numpy())
            used = keys >= 0
            entries = pa.StructArray.from_arrays([pa.array(keys[used]), pa.array(subs[used])], ["key", "sub"])
            yield pa.RecordBatch.from_arrays(
                [batch.column("class"), batch.column("v"),
                 _lists(np.concatenate([[0], np.cumsum(used.sum(axis=1))]), entries)], ["class", "v", "filed"])
    return run


def _prober(hashing: Hashing):
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            query, key, sub = (np.concatenate(x) for x in zip(*hashing.probe(_units(_matrix(batch.column("v"))))))
            order = np.lexsort((sub, key, query))
            query, key, sub = query[order], key[order], sub[order]
            new = np.flatnonzero(np.concatenate([[True], (query[1:] != query[:-1]) | (key[1:] != key[:-1])]))
            entries = pa.StructArray.from_arrays(
                [pa.array(key[new]), _lists(np.append(new, len(key)), pa.array(sub.astype(np.int32)))],
                ["key", "subs"])
            yield pa.RecordBatch.from_arrays(
                [batch.column("class"), batch.column("v"),
                 _lists(np.searchsorted(query[new], np.arange(batch.num_rows + 1)), entries)],
                ["class", "v", "probed"])
    return run


def _ranker(k):
    empty = pa.table({"q": pa.array([], pa.int64()), "class": pa.array([], pa.int64()),
                      "score": pa.array([], pa.float64())})

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return empty
        ids, data, sub = left.column("class").to_numpy(), _matrix(left.column("v")), left.column("sub").to_numpy()
        queries, subs = _matrix(right.column("v")), right.column("subs").combine_chunks()
        starts = subs.offsets.to_numpy()
        of, wanted = np.repeat(np.arange(len(queries)), np.diff(starts)), subs.flatten().to_numpy()
        asking, members = [], []
        for s in np.unique(wanted):
            at = np.flatnonzero(sub == s)
            if len(at):
                asking.append(of[wanted == s])
                members.append(at)
        # Blocks of queries, each query's buckets together.
        out = []
        for low in range(0, len(queries), 256):
            pairs = []
            for who, at in zip(asking, members):
                who = who[(who >= low) & (who < low + 256)]
                if len(who):
                    rough = queries[who] @ data[at].T
                    if len(at) > k:  # a bucket's own best are enough
                        line, col = np.nonzero(rough >= _floor(np.partition(rough, -k, axis=1)[:, -k])[:, None])
                    else:
                        line, col = np.indices(rough.shape).reshape(2, -1)
                    pairs.append((who[line], at[col], rough[line, col]))
            if pairs:
                out.append(_best(*(np.concatenate(x) for x in zip(*pairs)), k))
        if not out:
            return empty
        q, c = (np.concatenate(x) for x in zip(*out))
        scores = np.concatenate([(data[c[i:i + 65536]] * queries[q[i:i + 65536]]).sum(axis=1)
                                 for i in range(0, len(q), 65536)])
        return pa.table({"q": pa.array(right.column("q").to_numpy()[q]),
                         "class": pa.array(ids[c]), "score": pa.array(scores)})
    return run


def _floor(kth: np.ndarray) -> np.ndarray:
    return kth - _SLACK * np.maximum(1.0, np.abs(kth))


def _best(q, c, rough, k):
    """Pairs that are among the best ``k`` of their query, or too close to them to tell."""
    order = np.lexsort((-rough, q))
    q, c, rough = q[order], c[order], rough[order]
    first = np.flatnonzero(np.concatenate([[True], q[1:] != q[:-1]]))
    size = np.diff(np.append(first, len(q)))
    kth = np.where(size > k, rough[np.minimum(first + k - 1, len(q) - 1)], -np.inf)
    keep = rough >= _floor(np.repeat(kth, size))
    return q[keep], c[keep]

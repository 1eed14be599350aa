"""Hard negatives of embedding anchors by a secondary-sort shuffle.

A row's score is its inner product with the anchor, over components multiplied by ``scale``
and rounded down to integers.  An anchor's positives are its first ``positives`` other rows of
the same label; a positive with score p opens the window ``low * p <= score <= p``, and the
first ``negatives`` rows of other labels in it are the positive's hard negatives.  First means
by descending score, then by ascending id.

* *Scores.*  Anchors and rows are cut into blocks by a hash of the id, and each pair of an
  anchor block and a row block is one group of bounded size, multiplied as matrices.  No group
  lists its pairs: it returns, for each anchor, only rows that can be in the result - first the
  block's own best rows of the same label, then, with the positives known, the block's own best
  rows of other labels in each window.
* *Secondary sort.*  What the blocks return is packed into the key (anchor, descending score,
  positive before negative, id), shuffled by anchor and sorted inside the partitions
  (``repartition`` and ``sortWithinPartitions``, the DataFrame form of
  repartitionAndSortWithinPartitions).
* *Stream.*  An iterator reads the sorted keys: a positive opens its window, a negative is
  given to every open window that has room, a score below a window closes it.  It holds the
  open windows of one anchor (``positives`` at most), not the anchor's rows.

Defined cases: rows with a null id, label or vector, or with a null or non-finite component,
take no part; rows of one id count once, with the largest (vector, label); a shorter vector
counts as padded with zeros; equal scores are ordered by the smaller id; with fewer rows all
are returned; an anchor without a positive, or a positive without rows in its window, gives no
rows; scores are exact, and those beyond 64 bits stand at the largest or smallest long; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from funnelspark.llm.common import Workspace, materialize

ANCHOR_EVERY = 100
POSITIVES = 5
NEGATIVES = 5
#: A negative's score is at least this share of the positive's.
LOW = (80, 100)
SCALE = 256
#: Rows and anchors of a block (at 64 components: 4 and 8 MB).
ROW_BLOCK = 8192
ANCHOR_BLOCK = 16384
#: Scores held at once in a group.
_CELLS = 1 << 22
_EXACT = float(1 << 53)
_LONG = (1 << 63) - 1
_KEY = ["anchor", "down", "kind", "id"]
_RESULT = ("anchor_id long, positive_id long, rank int, negative_id long, positive_score long, "
           "negative_score long")


def lowest(score: int, low: tuple[int, int] = LOW) -> int:
    """The smallest integer score of a window: ``low[0] * score <= low[1] * lowest``."""
    return -((-low[0] * score) // low[1])


def usable(rows: DataFrame, id_col: str, vector_col: str, label_col) -> DataFrame:
    """(id, label, v) of the rows that take part, one for each id."""
    label = F.col(f"`{label_col}`") if isinstance(label_col, str) else label_col
    vector = F.col(f"`{vector_col}`")
    double = vector.cast("array<double>")
    return rows.where(F.col(f"`{id_col}`").isNotNull() & label.isNotNull() & vector.isNotNull()) \
        .where(F.forall(double, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))) \
        .select(F.col(f"`{id_col}`").cast("long").alias("id"), label.alias("label"), vector.alias("v")) \
        .groupBy("id").agg(F.max(F.struct("v", "label")).alias("x")).select("id", "x.label", "x.v")


# ----------------------------------------------------------------- scores
def whole_matrix(vectors: pa.ChunkedArray, scale: int) -> np.ndarray:
    """Components times ``scale``, rounded down, in rows padded with zeros."""
    lengths = pc.list_value_length(vectors).to_numpy()
    values = pc.list_flatten(vectors).to_numpy().astype(np.float64)
    out = np.zeros((len(lengths), int(lengths.max(initial=0))))
    out[np.arange(out.shape[1]) < lengths[:, None]] = values
    return np.floor(out * scale)


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer inner products of the rows, as longs."""
    width = min(a.shape[1], b.shape[1])
    a, b = a[:, :width], b[:, :width]
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), np.int64)
    if float(np.abs(a).max()) * float(np.abs(b).max()) * width < _EXACT:
        return (a @ b.T).astype(np.int64)  # sums of integers below 2**53
    whole = lambda m: np.array([[int(x) for x in row] for row in m], object)
    return np.array([[max(-_LONG, min(_LONG, x)) for x in row]
                     for row in whole(a).dot(whole(b).T)], np.int64)


def _first(scores: np.ndarray, at: np.ndarray, count: int) -> np.ndarray:
    """Of the places ``at`` (ascending ids) the first ``count`` by descending score."""
    if len(at) > count:
        kth = np.partition(scores[at], len(at) - count)[len(at) - count]
        at = at[scores[at] >= kth]
    return at[np.argsort(-scores[at], kind="stable")][:count]


class _Block:
    """The rows of a block, by ascending id."""

    def __init__(self, rows: pa.Table, scale: int):
        order = np.argsort(rows.column("id").to_numpy())
        rows = rows.take(pa.array(order))
        self.ids = rows.column("id").to_numpy()
        self.labels = rows.column("label").to_numpy(zero_copy_only=False)
        self.matrix = whole_matrix(rows.column("v"), scale)


def _keys(found: list[tuple[int, np.ndarray, np.ndarray]]) -> pa.Table:
    """(anchor, score, id) of the places found."""
    lengths = [len(ids) for _, _, ids in found]
    joined = lambda parts: np.concatenate(parts) if parts else np.zeros(0, np.int64)
    return pa.table({
        "anchor": np.repeat(np.array([a for a, _, _ in found], np.int64), lengths),
        "score": joined([s for _, s, _ in found]), "id": joined([i for _, _, i in found])})


def _scored(anchors: _Block, rows: _Block):
    """(anchor number, scores against all rows), in bounded pieces."""
    step = max(1, _CELLS // max(1, len(rows.ids)))
    for start in range(0, len(anchors.ids), step):
        for i, line in enumerate(_products(anchors.matrix[start:start + step], rows.matrix)):
            yield start + i, line


def _best_of_label(count: int, scale: int):
    """For each anchor the block's first rows of the same label."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        found = []
        if left.num_rows and right.num_rows:
            anchors, rows = _Block(left, scale), _Block(right, scale)
            for label in np.unique(anchors.labels):
                mine, own = (np.flatnonzero(x.labels == label) for x in (anchors, rows))
                if not len(own):
                    continue
                step = max(1, _CELLS // len(own))
                for s in range(0, len(mine), step):
                    part = mine[s:s + step]
                    for a, line in zip(part, _products(anchors.matrix[part], rows.matrix[own])):
                        at = _first(line, np.flatnonzero(rows.ids[own] != anchors.ids[a]), count)
                        found.append((anchors.ids[a], line[at], rows.ids[own][at]))
        return _keys(found)
    return run


def _best_in_windows(count: int, low: tuple[int, int], scale: int):
    """For each anchor the block's first rows of other labels in each of its windows."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        found = []
        if left.num_rows and right.num_rows:
            order = np.argsort(left.column("id").to_numpy())
            tops = left.column("tops").take(pa.array(order)).to_pylist()
            anchors, rows = _Block(left, scale), _Block(right, scale)
            for a, line in _scored(anchors, rows):
                other, chosen = rows.labels != anchors.labels[a], []
                for top in set(tops[a]):
                    at = np.flatnonzero(other & (line <= top) & (line >= lowest(top, low)))
                    chosen.append(_first(line, at, count))
                at = np.unique(np.concatenate(chosen))
                found.append((anchors.ids[a], line[at], rows.ids[at]))
        return _keys(found)
    return run


# ----------------------------------------------------------------- streams
def _sorted_keys(keys: DataFrame) -> DataFrame:
    """Keys (anchor, score, kind, id) shuffled by anchor, in the order of the stream."""
    return keys.select("anchor", (-F.col("score")).alias("down"), "kind", "id") \
        .repartition("anchor").sortWithinPartitions(*_KEY)


def _records(batches) -> Iterator[tuple[int, int, int, int]]:
    """(anchor, score, kind, id) of the sorted keys."""
    for batch in batches:
        anchor, down, kind, ids = (batch.column(c).to_numpy() for c in _KEY)
        yield from zip(anchor.tolist(), (-down).tolist(), kind.tolist(), ids.tolist())


def first_of_anchor(records, count: int) -> Iterator[tuple[int, int, int]]:
    """(anchor, score, id): the first ``count`` records of each anchor."""
    current, taken = None, 0
    for anchor, score, _, row in records:
        if anchor != current:
            current, taken = anchor, 0
        taken += 1
        if taken <= count:
            yield anchor, score, row


def window_negatives(records, count: int, low: tuple[int, int] = LOW) -> Iterator[tuple]:
    """(anchor, positive, rank, negative, positive score, negative score) of sorted records."""
    current, windows = None, []
    for anchor, score, kind, row in records:
        if anchor != current:
            current, windows = anchor, []
        if kind == 0:
            if lowest(score, low) <= score:
                windows.append([row, score, lowest(score, low), 0])
            continue
        windows = [w for w in windows if score >= w[2] and w[3] < count]
        for w in windows:
            w[3] += 1
            yield anchor, w[0], w[3], row, w[1], score


def _streamed(keys: DataFrame, fn, schema: str, kinds) -> DataFrame:
    names = [part.split()[0] for part in schema.split(", ")]

    def run(batches):
        out = []
        for record in fn(_records(batches)):
            out.append(record)
            if len(out) == 8192:
                yield _frame(out, names, kinds)
                out = []
        if out:
            yield _frame(out, names, kinds)
    return _sorted_keys(keys).mapInArrow(run, schema)


def _frame(rows, names, kinds) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)


# ----------------------------------------------------------------- operator
def mine(rows: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", label_col="label",
         anchor_every: int = ANCHOR_EVERY, positives: int = POSITIVES, negatives: int = NEGATIVES,
         low: tuple[int, int] = LOW, scale: int = SCALE, row_block: int = ROW_BLOCK,
         anchor_block: int = ANCHOR_BLOCK) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Anchors are the rows whose id is divisible by ``anchor_every``; ``label_col`` is a column
    name or expression."""
    work = Workspace(rows.sparkSession)
    try:
        taking = work.save(usable(rows, id_col, vector_col, label_col), "negative-rows")
        is_anchor = F.col("id") % anchor_every == 0
        n, n_anchors = taking.agg(F.count("*"), F.count_if(is_anchor)).first()
        row_parts, anchor_parts = -(-n // row_block) or 1, -(-n_anchors // anchor_block) or 1
        by_id = lambda parts, seed: F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(parts)).cast("int")
        every = lambda parts: F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))
        blocks = taking.select("id", "label", "v", by_id(row_parts, 1).alias("row_part"),
                               every(anchor_parts).alias("anchor_part"))

        def against_rows(anchors: DataFrame, fn) -> DataFrame:
            left = anchors.withColumns({"anchor_part": by_id(anchor_parts, 2), "row_part": every(row_parts)})
            left = left.toDF(*left.columns)   # attributes of its own beside those of the rows
            return left.groupBy("anchor_part", "row_part") \
                .cogroup(blocks.groupBy("anchor_part", "row_part")) \
                .applyInArrow(fn, "anchor long, score long, id long")

        anchors = taking.where(is_anchor)
        near = against_rows(anchors, _best_of_label(positives, scale)).withColumn("kind", F.lit(0))
        longs = [pa.int64()] * 3
        tops = work.save(_streamed(near, lambda r: first_of_anchor(r, positives),
                                   "anchor long, score long, id long", longs), "negative-positives")
        with_tops = anchors.join(tops.groupBy(F.col("anchor").alias("id"))
                                 .agg(F.collect_list("score").alias("tops")), "id")
        found = against_rows(with_tops, _best_in_windows(negatives, low, scale))
        keys = found.withColumn("kind", F.lit(1)).unionByName(tops.withColumn("kind", F.lit(0)))
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
        return materialize(_streamed(keys, lambda r: window_negatives(r, negatives, low), _RESULT, kinds),
                           "hard-negatives")
    finally:
        work.close()


def shifted_label(id_col: str = "vec_id", label_col: str = "label", every: int = 7, labels: int = 10):
    """The label, moved to the next of ``labels`` where the id is divisible by ``every``."""
    label = F.col(label_col).cast("long")
    return F.when(F.col(id_col) % every == 0, (label + 1) % labels).otherwise(label)

"""Toxicity as ordered severity grades: cumulative-link ordinal regression on
sparse text features.

``P(grade <= j) = sigmoid(t_j - w.x)``: one weight vector ``w`` is shared by
the ordered thresholds ``t_0 < t_1 < ...``.  Features are the words of a text
and the beginnings of its words, hashed into ``2**HASH_BITS`` slots; each
partition of labelled rows counts slots by grade, and the ``N_FEATURES`` slots
that tell the grades apart best are kept.  The output is the expected grade,
``sum_j P(grade > j)``.

The fit uses at most about ``max_labelled`` labelled rows (chosen by a hash of
the id); scoring covers all whole texts.

Defined cases: a null text counts as empty and is scored; label rows with a
null id or grade are ignored, of several grades of an id the highest counts; a
null id is scored but never used for learning; repeated documents give one row
each; without labels, or with one grade only, the severity is that grade (0
when there are none).
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from funnelspark.llm.common import materialize

MAX_LABELLED = 20_000
HASH_BITS = 20
N_FEATURES = 2048
#: Lengths of the word beginnings that are features beside the whole word.
BEGINNINGS = (3, 4, 5, 6, 7, 8)
PENALTY = 2e-5
#: Rows whose hash of the id falls in this fold (modulo 4) are not learned from.
HELD_OUT_FOLD = 2

_WORDS = re.compile(r"[^\W\d_]+")
_CACHED_WORDS = 300_000


def slots_of(word: str) -> list[int]:
    """Hash slots of a word: the whole word, then its beginnings."""
    mask = (1 << HASH_BITS) - 1
    out = [zlib.crc32(b"w " + word.encode("utf-8")) & mask]
    out += [zlib.crc32(b"b " + word[:n].encode("utf-8")) & mask for n in BEGINNINGS if n < len(word)]
    return out


def words_of(text: str | None) -> Counter:
    return Counter(_WORDS.findall((text or "").lower()))


def labelled_rows(docs: DataFrame, grades: DataFrame, id_col: str, text_col: str, grade_col: str,
                  max_labelled: int) -> DataFrame:
    """(_id_, grade, text) of at most about ``max_labelled`` labelled rows outside the held-out fold."""
    marks = grades.where(F.col(grade_col).isNotNull() & F.col(id_col).isNotNull()) \
        .groupBy(F.col(id_col).alias("_id_")).agg(F.max(grade_col).cast("int").alias("grade")) \
        .where(F.pmod(F.crc32(F.col("_id_").cast("string")), F.lit(4)) != HELD_OUT_FOLD)
    n = marks.count()
    if n > max_labelled:
        marks = marks.where(F.pmod(F.xxhash64("_id_"), F.lit(1_000_000))
                            < int(1_000_000 * max_labelled / n))
    return docs.select(F.col(id_col).alias("_id_"), F.col(text_col).alias("text")) \
        .join(F.broadcast(marks), "_id_").select("_id_", "grade", "text")


def slot_counts(rows: DataFrame) -> tuple[np.ndarray, int, int]:
    """(documents with a slot, by graded 0 or above), and the two document counts."""
    def run(batches):
        counts = np.zeros((2, 1 << HASH_BITS), np.int32)
        n = [0, 0]
        for batch in batches:
            for grade, text in zip(batch.column("grade").to_pylist(), batch.column("text").to_pylist()):
                slots = {s for w in words_of(text) for s in slots_of(w)}
                side = int(grade > 0)
                n[side] += 1
                counts[side, list(slots)] += 1
        if sum(n):
            yield pa.RecordBatch.from_pydict({
                "c": pa.array([zlib.compress(counts.tobytes(), 1)], pa.binary()),
                "n0": pa.array([n[0]]), "n1": pa.array([n[1]])})
    total, n0, n1 = np.zeros((2, 1 << HASH_BITS), np.int64), 0, 0
    for r in rows.coalesce(8).mapInArrow(run, "c binary, n0 long, n1 long").toLocalIterator():
        total += np.frombuffer(zlib.decompress(bytes(r.c)), np.int32).reshape(2, -1)
        n0, n1 = n0 + r.n0, n1 + r.n1
    return total, n0, n1


def choose_slots(counts: np.ndarray, n0: int, n1: int, n_features: int) -> np.ndarray:
    """Slots by the size of their standardised log odds ratio, the largest first."""
    c0, c1 = counts[0] + 0.5, counts[1] + 0.5
    ratio = np.log(c1 / (n1 - counts[1] + 0.5)) - np.log(c0 / (n0 - counts[0] + 0.5))
    deviation = np.sqrt(1 / c1 + 1 / (n1 - counts[1] + 0.5) + 1 / c0 + 1 / (n0 - counts[0] + 0.5))
    z = np.where(counts.sum(0) >= 3, ratio / deviation, 0.0)
    order = np.argsort(-np.abs(z), kind="stable")[:n_features]
    return order[z[order] != 0]


class Featurizer:
    """Sparse values ``log(1 + occurrences)`` at the chosen slots of a text."""

    def __init__(self, slots: np.ndarray):
        self.index = {int(s): i for i, s in enumerate(slots)}
        self.known: dict[str, tuple[int, ...]] = {}

    def __call__(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        totals: dict[int, int] = {}
        for word, n in words_of(text).items():
            at = self.known.get(word)
            if at is None:
                if len(self.known) >= _CACHED_WORDS:
                    self.known.clear()
                at = self.known[word] = tuple({self.index[s] for s in slots_of(word) if s in self.index})
            for i in at:
                totals[i] = totals.get(i, 0) + n
        return (np.fromiter(totals, np.int64, len(totals)),
                np.log1p(np.fromiter(totals.values(), np.float64, len(totals))))


@dataclass
class SeverityModel:
    slots: np.ndarray
    weights: np.ndarray
    thresholds: np.ndarray

    def above(self, f: np.ndarray) -> np.ndarray:
        """P(grade > j) for every threshold j, one row a text."""
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - f[:, None], -40, 40)))


def fit_cumulative(rows, grades: np.ndarray, n_features: int, penalty: float,
                   steps: int = 800) -> tuple[np.ndarray, np.ndarray]:
    """(weights, thresholds) by full-batch Adam on the penalised likelihood."""
    where = np.repeat(np.arange(len(rows)), [len(i) for i, _ in rows])
    at = np.concatenate([i for i, _ in rows]) if len(rows) else np.zeros(0, np.int64)
    values = np.concatenate([v for _, v in rows]) if len(rows) else np.zeros(0)
    top = int(grades.max())
    share = np.array([(grades > j).mean() for j in range(top)]).clip(1e-6, 1 - 1e-6)
    start = np.log((1 - share) / share)
    # thresholds as a first one and positive gaps keep their order
    gaps = np.log(np.maximum(np.diff(start), 1e-2))
    x = np.concatenate([np.zeros(n_features), start[:1], gaps])
    m, v = np.zeros_like(x), np.zeros_like(x)
    n = len(grades)
    for step in range(1, steps + 1):
        w, first, widths = x[:n_features], x[n_features], np.exp(x[n_features + 1:])
        t = first + np.concatenate([[0.0], np.cumsum(widths)])
        f = np.bincount(where, values * w[at], minlength=n)
        edges = np.concatenate([[-np.inf], t, [np.inf]])
        hi, lo = edges[grades + 1] - f, edges[grades] - f
        s_hi, s_lo = (1 / (1 + np.exp(-np.clip(z, -40, 40))) for z in (hi, lo))
        p = np.maximum(s_hi - s_lo, 1e-9)
        d_hi, d_lo = s_hi * (1 - s_hi) / p, s_lo * (1 - s_lo) / p
        d_hi[grades == top], d_lo[grades == 0] = 0.0, 0.0
        grad_w = np.bincount(at, values * (d_hi - d_lo)[where], minlength=n_features) / n + penalty * w
        grad_t = np.array([-d_hi[grades == j].sum() + d_lo[grades == j + 1].sum()
                           for j in range(top)]) / n
        grad_gaps = np.array([grad_t[j + 1:].sum() for j in range(top - 1)]) * widths
        g = np.concatenate([grad_w, [grad_t.sum()], grad_gaps])
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        x = x - 0.05 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
    widths = np.exp(x[n_features + 1:])
    return x[:n_features], x[n_features] + np.concatenate([[0.0], np.cumsum(widths)])


def fit(docs: DataFrame, grades: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        grade_col: str = "grade", max_labelled: int = MAX_LABELLED, n_features: int = N_FEATURES,
        penalty: float = PENALTY) -> SeverityModel:
    """Model of the grades 0, 1, 2, ... of the labelled rows outside the held-out fold."""
    rows = materialize(labelled_rows(docs, grades, id_col, text_col, grade_col, max_labelled),
                       "toxicity-rows")
    counts, n0, n1 = slot_counts(rows)
    if not n0 or not n1:
        top = rows.agg(F.max("grade")).first()[0] or 0
        return SeverityModel(np.zeros(0, np.int64), np.zeros(0), np.full(max(1, top), -40.0 if top else 40.0))
    slots = choose_slots(counts, n0, n1, n_features)

    def run(batches):
        features = Featurizer(slots)
        for batch in batches:
            if batch.num_rows:
                got = [features(t) for t in batch.column("text").to_pylist()]
                yield pa.RecordBatch.from_pydict({
                    "grade": batch.column("grade"),
                    "at": pa.array([i.astype(np.int32) for i, _ in got], pa.list_(pa.int32())),
                    "value": pa.array([v for _, v in got], pa.list_(pa.float64()))})
    # the labelled sample, bounded by max_labelled, as sparse rows
    sparse = [(r.grade, np.array(r.at, np.int64), np.array(r.value))
              for r in rows.mapInArrow(run, "grade int, at array<int>, value array<double>")
              .toLocalIterator()]
    weights, thresholds = fit_cumulative([(i, v) for _, i, v in sparse],
                                         np.array([g for g, _, _ in sparse]), len(slots), penalty)
    return SeverityModel(slots, weights, thresholds)


def severity(docs: DataFrame, model: SeverityModel, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """One row per document row: doc_id, severity (expected grade), grade (most
    likely by thresholds), toxic (grade above 0 is likelier than not)."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = held.value
        features = Featurizer(m.slots)
        for batch in batches:
            if not batch.num_rows:
                continue
            got = [features(t) for t in batch.column("text").to_pylist()]
            f = np.array([float(m.weights[i] @ v) if len(i) else 0.0 for i, v in got])
            above = m.above(f)
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"), "severity": pa.array(above.sum(1)),
                "grade": pa.array((above >= 0.5).sum(1).astype(np.int32)),
                "toxic": pa.array(above[:, 0] >= 0.5)})
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, "
                                "severity double, grade int, toxic boolean")


def graded_labels(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  toxic_col: str = "toxic", max_labelled: int = MAX_LABELLED) -> DataFrame:
    """Grades from yes/no labels, for the labelled rows that a fit may use: 0 for
    unmarked documents; marked ones get 1, 2 or 3 by how many occurrences of words
    typical of marked documents they hold (thirds of the marked rows)."""
    marks = labels.select(id_col, F.col(toxic_col).cast("int").alias("grade"))
    rows = materialize(labelled_rows(docs, marks, id_col, text_col, "grade", max_labelled),
                       "toxicity-marks")
    counts, n0, n1 = slot_counts(rows)
    known = rows.groupBy(F.col("_id_").alias(id_col)).agg(F.max("grade").alias("grade"))
    if not n0 or not n1:
        return known
    slots = choose_slots(counts, n0, n1, 256)
    slots = slots[counts[1, slots] * n0 > 4 * counts[0, slots] * n1]
    marked = rows.where("grade > 0")
    id_type = marked.schema["_id_"].dataType.simpleString()

    def run(batches):
        features = Featurizer(slots)
        for batch in batches:
            got = [float(features(t)[1].sum()) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_pydict({"_id_": batch.column("_id_"),
                                              "hits": pa.array(got, pa.float64())})
    hits = marked.select("_id_", "text").mapInArrow(run, f"_id_ {id_type}, hits double") \
        .groupBy("_id_").agg(F.max("hits").alias("hits"))
    cuts = hits.approxQuantile("hits", [1 / 3, 2 / 3], 0.01)
    graded = hits.select(F.col("_id_").alias(id_col), (
        1 + (F.col("hits") > cuts[0]).cast("int") + (F.col("hits") > cuts[1]).cast("int")).alias("grade"))
    return known.where("grade = 0").unionByName(graded)

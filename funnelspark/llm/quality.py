"""Quality classifier: random Fourier features over document statistics, ridge
scores from partition-summed normal equations, isotonic calibration.

1. Every whole text gives a vector of statistics (repetition, case, symbols,
   word lengths, line structure, compressibility).
2. Random Fourier features ``sqrt(2/D) cos(W s + b)`` of the standardised
   statistics approximate a Gaussian kernel.
3. Each partition of labelled rows adds up its share of ``Z'Z`` and ``Z'y``;
   the sums are solved once for ridge weights.
4. Isotonic regression on labelled rows that the ridge fit has not seen maps
   the ridge output to a probability.

The fit uses at most about ``max_labelled`` labelled rows (chosen by a hash of
the id, the same on every run); everything else covers all rows.

Defined cases: a null text counts as empty and is scored; a label row with a
null id or label is ignored, of several labels for an id the largest counts;
a null id is scored but never used for learning; repeated documents give one
row each; with no usable labels, or labels of one class only, every score is
the share of good labels (0.5 when there are none).
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from funnelspark.llm.common import column_ddl, columns_of, materialize, text_bytes, unused

MAX_LABELLED = 60_000
N_FOURIER = 512
RIDGE = 1e-4
ACCEPT_SCORE = 0.7
#: Learning rows are dealt into four folds; fold 2 is held out, fold 3 calibrates.
HELD_OUT_FOLD, CALIBRATION_FOLD = 2, 3

_LOWER, _UPPER, _DIGIT = slice(97, 123), slice(65, 91), slice(48, 58)


def fold(id_col: str):
    """crc32 of the id as text, modulo 4 (null for a null id)."""
    return F.pmod(F.crc32(F.col(id_col).cast("string")), F.lit(4))


def text_statistics(text: str | None) -> list[float]:
    """Statistics of one whole text; all finite, also for an empty one."""
    raw = text_bytes(text)
    n = max(1, len(raw))
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    lower, upper, digits = (int(counts[s].sum()) for s in (_LOWER, _UPPER, _DIGIT))
    high, space = int(counts[128:].sum()), int(counts[32] + counts[9])
    newline, marks = int(counts[10]), int(counts[46] + counts[44])
    ascii_other = int(counts[33:128].sum()) - lower - upper - digits - marks
    words = raw.split()
    n_words = max(1, len(words))
    distinct = len(set(words))
    same_next = sum(a == b for a, b in zip(words, words[1:]))
    lengths = np.fromiter(map(len, words), np.int64, len(words)) if words else np.zeros(1)
    lines = raw.split(b"\n")
    trigrams = set(zip(words, words[1:], words[2:]))
    packed = len(zlib.compress(raw, 1)) / n if raw else 1.0
    return [
        np.log1p(len(words)), np.log1p(n / n_words), float(lengths.std()) / 10.0,
        float((lengths <= 1).mean()), float((lengths > 20).mean()),
        lower / n, upper / n, digits / n, high / n, space / n, 10 * newline / n, 5 * marks / n,
        ascii_other / n, np.sqrt(ascii_other / n), float((counts[33:128] > 0).sum()) / 95,
        counts[124] / n_words, counts[33] / n_words,
        distinct / n_words, distinct / n_words ** 0.75, same_next / n_words,
        len(trigrams) / max(1, len(words) - 2) if len(words) > 2 else 1.0,
        len(set(lines)) / len(lines), min(packed, 1.5), np.log1p(len(lines)),
    ]


N_STATISTICS = len(text_statistics(""))


@dataclass
class QualityModel:
    """Standardisation, Fourier frequencies, ridge weights, calibration points."""
    mean: np.ndarray
    scale: np.ndarray
    frequencies: np.ndarray
    phases: np.ndarray
    weights: np.ndarray
    steps: np.ndarray
    values: np.ndarray

    def fourier(self, stats: np.ndarray) -> np.ndarray:
        z = np.clip((stats - self.mean) / self.scale, -8, 8)
        f = np.sqrt(2.0 / len(self.phases)) * np.cos(z @ self.frequencies + self.phases)
        return np.hstack([f, z, np.ones((len(f), 1))])

    def ridge(self, stats: np.ndarray) -> np.ndarray:
        return self.fourier(stats) @ self.weights

    def score(self, stats: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.ridge(stats), self.steps, self.values), 0.0, 1.0)


def constant_model(share: float) -> QualityModel:
    k = N_STATISTICS
    return QualityModel(np.zeros(k), np.ones(k), np.zeros((k, 1)), np.zeros(1),
                        np.zeros(k + 2), np.array([0.0]), np.array([share]))


def statistics(docs: DataFrame, text_col: str, keep: list[str]) -> DataFrame:
    """``keep`` columns and ``stats``, the statistics of every whole text."""
    kept = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text_col}`").alias("_text_"))
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema
                        if f.name != "_text_"] + ["stats array<double>"])

    def run(batches):
        for batch in batches:
            rows = [text_statistics(t) for t in batch.column("_text_").to_pylist()]
            cols = {c: batch.column(c) for c in batch.schema.names if c != "_text_"}
            yield pa.RecordBatch.from_pydict(cols | {"stats": pa.array(rows, pa.list_(pa.float64()))})
    return kept.mapInArrow(run, schema)


def labelled_rows(docs: DataFrame, labels: DataFrame, label_col: str, id_col: str, text_col: str,
                  max_labelled: int) -> DataFrame:
    """Statistics and label of at most about ``max_labelled`` rows outside the held-out fold."""
    marks = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()
                         & (fold(id_col) != HELD_OUT_FOLD)) \
        .groupBy(F.col(id_col).alias("_id_")).agg(F.max(label_col).cast("double").alias("y"))
    n = marks.count()
    if n > max_labelled:
        marks = marks.where(F.pmod(F.xxhash64("_id_"), F.lit(1_000_000))
                            < int(1_000_000 * max_labelled / n))
    some = docs.select(F.col(id_col).alias("_id_"), F.col(text_col).alias("_t_")) \
        .join(F.broadcast(marks), "_id_")  # about max_labelled rows, so the texts stay in place
    return statistics(some, "_t_", ["_id_", "y"])


def normal_equations(rows: DataFrame, model: QualityModel) -> tuple[np.ndarray, np.ndarray]:
    """Sums of ``Z'Z`` and ``Z'y``: one partial sum for each partition, of fixed size."""
    def run(batches):
        total = None
        for batch in batches:
            if not batch.num_rows:
                continue
            z = model.fourier(np.array(batch.column("stats").to_pylist()))
            y = batch.column("y").to_numpy(zero_copy_only=False)
            part = np.hstack([z, y[:, None]]).T @ z
            total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_pydict({"s": pa.array([total.tobytes()], pa.binary())})
    parts = rows.coalesce(8).mapInArrow(run, "s binary").toLocalIterator()
    d = N_STATISTICS + len(model.phases) + 1
    total = np.zeros((d + 1, d))
    for row in parts:
        total += np.frombuffer(bytes(row.s)).reshape(d + 1, d)
    return total[:d], total[d]


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id",
        text_col: str = "text", max_labelled: int = MAX_LABELLED, n_fourier: int = N_FOURIER,
        ridge: float = RIDGE, seed: int = 7) -> QualityModel:
    """Model fitted on the labelled rows outside the held-out fold."""
    rows = materialize(labelled_rows(docs, labels, label_col, id_col, text_col, max_labelled),
                       "quality-rows")
    stat = rows.select("y", *[F.col("stats")[i].alias(f"s{i}") for i in range(N_STATISTICS)]).agg(
        F.count("y").alias("n"), F.avg("y").alias("share"),
        *[f(f"s{i}").alias(f"{k}{i}") for i in range(N_STATISTICS)
          for k, f in (("m", F.avg), ("d", F.stddev_pop))]).first()
    if not stat.n:
        return constant_model(0.5)
    if stat.share in (0.0, 1.0):
        return constant_model(stat.share)
    mean = np.array([stat[f"m{i}"] for i in range(N_STATISTICS)])
    scale = np.array([stat[f"d{i}"] for i in range(N_STATISTICS)])
    scale[scale < 1e-9] = 1.0
    rng = np.random.default_rng(seed)
    width = np.sqrt(N_STATISTICS)
    model = QualityModel(mean, scale, rng.normal(0, 1 / width, (N_STATISTICS, n_fourier)),
                         rng.uniform(0, 2 * np.pi, n_fourier), np.zeros(0),
                         np.array([0.0, 1.0]), np.array([0.0, 1.0]))
    learn = rows.where(fold("_id_") != CALIBRATION_FOLD)
    gram, target = normal_equations(learn, model)
    model.weights = np.linalg.solve(gram + ridge * max(1.0, gram[-1, -1]) * np.eye(len(gram)), target)
    return calibrate(rows.where(fold("_id_") == CALIBRATION_FOLD), model)


def calibrate(rows: DataFrame, model: QualityModel) -> QualityModel:
    def run(batches):
        for b in batches:
            if b.num_rows:
                yield pa.RecordBatch.from_pydict({
                    "feature": pa.array(model.ridge(np.array(b.column("stats").to_pylist()))),
                    "label": b.column("y")})
    scored = rows.mapInArrow(run, "feature double, label double")
    if scored.isEmpty():
        return model
    fitted = IsotonicRegression(featuresCol="feature", labelCol="label").fit(scored)
    model.steps = np.array(fitted.boundaries.toArray())
    model.values = np.array(fitted.predictions.toArray())
    return model


def score(docs: DataFrame, model: QualityModel, text_col: str = "text",
          score_col: str = "score") -> DataFrame:
    """``docs`` with every column kept and ``score_col`` added (replaced if there)."""
    kept = docs.drop(score_col)
    schema = ", ".join([*column_ddl(kept), f"`{score_col}` double"])
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            stats = np.array([text_statistics(t) for t in batch.column(text_col).to_pylist()])
            cols = {c: batch.column(c) for c in batch.schema.names}
            yield pa.RecordBatch.from_pydict(cols | {score_col: pa.array(held.value.score(stats))})
    return kept.mapInArrow(run, schema)


def quality_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id",
                   text_col: str = "text", **options) -> DataFrame:
    """One row per document row: doc_id, held_out, score, predicted."""
    model = fit(docs, labels, id_col=id_col, text_col=text_col, **options)
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return score(texts, model).select(
        "doc_id", F.coalesce(fold("doc_id") == HELD_OUT_FOLD, F.lit(False)).alias("held_out"),
        "score", (F.col("score") >= ACCEPT_SCORE).cast("int").alias("predicted"))


def accepted(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """``docs`` without the rows scored under ``ACCEPT_SCORE``, columns as they were."""
    model, name = fit(docs, labels, **options), unused(docs, "_score")
    return score(docs, model, score_col=name).where(F.col(name) >= ACCEPT_SCORE) \
        .select(*columns_of(docs))

import zlib

from funnelspark.llm import quality

from .helpers import DOCS, SF_MID


def test_held_out_accuracy_and_fold(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    labels = spark.read.parquet(f"{SF_MID}/labels.parquet")
    got = {r.doc_id: r for r in quality.quality_scores(docs, labels).collect()}
    assert len(got) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 4 == 2) for d, r in got.items())
    assert all(0.0 <= r.score <= 1.0 and r.predicted == int(r.score >= 0.7) for r in got.values())
    held = [(got[x.doc_id].predicted, x.quality) for x in labels.collect() if got[x.doc_id].held_out]
    assert sum(p == q for p, q in held) / len(held) > 0.95


def test_held_out_labels_are_never_learned(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    labels = spark.read.parquet(f"{SF_MID}/labels.parquet")
    turned = labels.selectExpr("doc_id", "if(pmod(crc32(string(doc_id)), 4) = 2, 1 - quality, quality) "
                               "as quality")
    a = {r.doc_id: r.score for r in quality.quality_scores(docs, labels).collect()}
    b = {r.doc_id: r.score for r in quality.quality_scores(docs, turned).collect()}
    assert all(abs(a[d] - b[d]) < 1e-9 for d in a)


def test_edge_rows(spark):
    rows = [(1, None), (2, ""), (3, "x" * 200_000), (None, "some words"), (4, "a b"), (4, "a b"), (5, "\n\n")]
    docs = spark.createDataFrame([(d, t, 0.5) for d, t in rows], "doc_id long, text string, score double")
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in quality.quality_scores(docs, none).collect()} == {0.5}
    one = spark.createDataFrame([(1, 1), (2, 1), (3, None), (None, 0)], "doc_id long, quality int")
    got = quality.quality_scores(docs, one).collect()
    assert len(got) == len(rows) and {r.score for r in got} == {1.0}
    assert [r.held_out for r in got if r.doc_id is None] == [False]
    kept = quality.accepted(docs, one)
    assert kept.columns == docs.columns and kept.count() == len(rows)
    assert {r.score for r in kept.collect()} == {0.5}
    assert quality.quality_scores(docs.limit(0), one).count() == 0


def test_label_sample_is_bounded(spark):
    docs = spark.createDataFrame([(i, f"word {i}") for i in range(400)], DOCS)
    labels = docs.selectExpr("doc_id", "int(doc_id % 2) as quality")
    assert quality.labelled_rows(docs, labels, "quality", "doc_id", "text", 100).count() < 150

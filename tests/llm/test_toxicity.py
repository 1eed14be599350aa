import zlib

import numpy as np

from funnelspark.llm import queries, toxicity

from .helpers import DOCS, SF_MID


def test_held_out_toxic_documents_are_caught(spark):
    got = {r.doc_id: r for r in queries.QUERIES["op10_toxicity"](spark, SF_MID).collect()}
    labels = spark.read.parquet(f"{SF_MID}/labels.parquet").collect()
    held = [(got[x.doc_id].toxic, x.toxic) for x in labels if zlib.crc32(str(x.doc_id).encode()) % 4 == 2]
    clean, toxic = [t for t, y in held if not y], [t for t, y in held if y]
    assert np.mean(toxic) > 0.6 and np.mean(clean) < 0.05
    assert all(r.toxic == (r.grade > 0) and r.severity >= 0 for r in got.values())


def test_cumulative_link_recovers_order():
    rng = np.random.default_rng(0)
    x = rng.integers(0, 4, 400)
    rows = [(np.array([0]), np.array([float(v)])) for v in x]
    weights, thresholds = toxicity.fit_cumulative(rows, np.minimum(x, 3), 1, 1e-4)
    assert weights[0] > 0 and (np.diff(thresholds) > 0).all()
    model = toxicity.SeverityModel(np.array([0]), weights, thresholds)
    assert (model.above(weights[0] * np.arange(4.0)) >= 0.5).sum(1).tolist() == [0, 1, 2, 3]


def test_edge_rows(spark):
    rows = [(1, None), (2, ""), (3, "vile " * 100_000), (None, "vile"), (4, "fine"), (4, "fine")]
    docs = spark.createDataFrame([(d, t, "x") for d, t in rows], "doc_id long, text string, grade string")
    none = spark.createDataFrame([], "doc_id long, grade int")
    got = toxicity.severity(docs, toxicity.fit(docs, none)).collect()
    assert len(got) == len(rows) and not any(r.toxic for r in got)
    only = spark.createDataFrame([(i, 0) for i in (1, 2, 3, 4)] + [(None, 2), (5, None)],
                                 "doc_id long, grade int")
    assert not any(r.toxic for r in toxicity.severity(docs, toxicity.fit(docs, only)).collect())
    assert toxicity.severity(docs.limit(0), toxicity.fit(docs, only)).count() == 0


def test_scale_of_grades(spark):
    docs = spark.createDataFrame(
        [(i, "plain text here " + "vile " * (i % 3)) for i in range(300)], DOCS)
    grades = docs.selectExpr("doc_id", "int(doc_id % 3) as grade")
    got = toxicity.severity(docs, toxicity.fit(docs, grades)).collect()
    assert np.mean([r.grade == r.doc_id % 3 for r in got]) > 0.95

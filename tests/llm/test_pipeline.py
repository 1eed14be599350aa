"""Each stage against a plain version on its own input."""

import hashlib

import corpus_pipeline
from funnelspark.llm import quality
from funnelspark.llm.common import materialize, table

from .helpers import (SF_MID, brute_components, brute_contamination, reference_encoding, rows_by_id)


def test_stages_keep_what_the_plain_versions_keep(spark):
    docs = table(spark, SF_MID, "documents")
    columns, kept = docs.columns, [docs]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept.append(materialize(stage(spark, kept[-1], SF_MID), "pipeline-test"))
        assert kept[-1].columns == columns
    start, good, single, clean, safe = (rows_by_id(d) for d in kept)
    scores = rows_by_id(quality.quality_scores(docs, table(spark, SF_MID, "labels")))
    assert set(good) == {d for d in start if scores[d]["score"] >= quality.ACCEPT_SCORE}
    parts = brute_components([(d, r["text"]) for d, r in good.items()])
    assert set(single) == {d for d, (_, c) in parts.items() if c == d}
    items = [(r.item_id, r.text) for r in table(spark, SF_MID, "benchmark").collect()]
    hits = brute_contamination([(d, r["text"]) for d, r in single.items()], items)
    assert set(clean) == {d for d, (n, h, _) in hits.items() if not (h and 20 * h >= n)}
    assert len(start) > len(good) > len(single) > len(clean) > 0
    assert set(safe) == set(clean)
    changed = [d for d in safe if safe[d]["text"] != clean[d]["text"]]
    assert changed and all(safe[d]["n_chars"] == len(safe[d]["text"]) for d in safe)
    assert all('token = "[secret]"' in safe[d]["text"].replace("TOKEN", "token") for d in changed)
    out = rows_by_id(corpus_pipeline.tokens(spark, kept[-1], SF_MID))
    encoding = reference_encoding()
    for d, r in safe.items():
        ids = encoding.encode_ordinary(r["text"])
        assert out[d]["n_tokens"] == len(ids)
        assert out[d]["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert out[d]["decoded_sha256"] == hashlib.sha256(r["text"].encode()).hexdigest()


def test_stages_name_their_operators():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "decontamination",
                                                      "secrets", "tokens"]


def pipeline_tables(spark, path, docs, schema):
    word = lambda i, n=60: " ".join(f"{i}w{j}" for j in range(n))
    spark.createDataFrame(docs(word), schema).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(i, 1, 0) for i in range(1, 40)], "doc_id long, quality int, toxic int") \
        .write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, word("bench", 30)), (2, None), (None, "x")], "item_id long, text string") \
        .write.parquet(f"{path}/benchmark.parquet")


SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, n_words string, node int, "
          "th int, hit_items string, findings string, _score string, n_tokens string")


def test_edge_rows_go_through_all_stages(spark, tmp_dir):
    more = ("en", None, 3, "x", 1, 2, "h", "f", "s", "t")
    key = "9f8e7d6c5b4a39281706f5e4d3c2b1a09f8e7d6c"

    def docs(word):
        rows = [(1, None), (2, ""), (3, word("a")), (4, word("a") + " end"), (None, word("a")), (5, word("b")),
                (5, word("b")), (5, word("c")), (6, word("bench", 30)), (7, f'x token = "{key}" y'),
                (8, "long " * 200_000), (None, None)]
        return [(*r, *more) for r in rows]
    pipeline_tables(spark, tmp_dir, docs, SCHEMA)
    kept = [table(spark, tmp_dir, "documents")]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept.append(materialize(stage(spark, kept[-1], tmp_dir), "pipeline-test"))
        assert kept[-1].columns == kept[0].columns
    ids = [sorted((r.doc_id or 0 for r in d.collect())) for d in kept]
    assert ids[1] == ids[0] == [0, 0, 1, 2, 3, 4, 5, 5, 5, 6, 7, 8]    # one class of labels: all are accepted
    assert ids[2] == [0, 0, 1, 2, 3, 5, 5, 5, 6, 7, 8]
    assert ids[3] == ids[4] == [0, 0, 1, 2, 3, 5, 5, 5, 7, 8]
    safe = {r.doc_id: r for r in kept[4].where("doc_id is not null").collect()}
    assert safe[7].text == 'x token = "[secret]" y' and safe[7].n_words == "x" and safe[7].n_chars == len(safe[7].text)
    assert safe[1].text is None and safe[2].text == "" and safe[3].n_chars == 3
    out = corpus_pipeline.run(spark, tmp_dir).collect()
    tokens = {r.doc_id: r.n_tokens for r in out if r.doc_id is not None}
    assert len(out) >= 9 and tokens[1] == tokens[2] == 0 and tokens[8] >= 200_000


def test_an_empty_table_gives_an_empty_result(spark, tmp_dir):
    pipeline_tables(spark, tmp_dir, lambda word: [], SCHEMA)
    assert corpus_pipeline.run(spark, tmp_dir).collect() == []

import hashlib
import random
import zlib

import numpy as np
import pytest

from funnelspark.llm import line_dedup

from .helpers import DOCS


def brute(docs, min_docs, min_chars=1, keep="none"):
    """Counter of (doc_id, n_lines, n_dropped, kept digest) by definition."""
    def key(line):
        return line.strip(" \t\n\x0b\x0c\r").translate({c: c + 32 for c in range(65, 91)})
    lines = [(d, (t or "").split("\n")) for d, t in docs]
    held = {}
    for d, ls in lines:
        for x in ls:
            held.setdefault(key(x), set()).add(d)
    common = {k for k, ds in held.items() if len(k) >= min_chars and len(ds) >= min_docs}
    seen, out = set(), []
    for d, ls in sorted(lines, key=lambda r: (r[0] is not None, r[0])) if keep == "first" else lines:
        kept = []
        for x in ls:
            k = key(x)
            if k not in common or (keep == "first" and k not in seen):
                kept.append(x)
            seen.add(k)
        out.append((d, len(ls), len(ls) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=str)


def report(spark, docs, parts=4, **options):
    rows = line_dedup.line_report(spark.createDataFrame(docs, DOCS).repartition(parts), **options).collect()
    return sorted(((r.doc_id, r.n_lines, r.n_dropped, r.kept_sha256) for r in rows), key=str)


def documents(seed=1, n=300):
    rng = random.Random(seed)
    pool = [" Cookie notice", "cookie NOTICE\t", "Ünïcode", "ÜNÏCODE", "", "   ", "x", "©", "Sign up"] + \
        [f"line {i}" for i in range(60)]
    weights = [60, 60, 20, 20, 30, 30, 10, 5, 80] + [3] * 60
    docs = [(i, "\n".join(rng.choices(pool, weights, k=rng.randint(0, 12)))) for i in range(n)]
    return docs + [(n, None), (n + 1, ""), (n + 2, "\n"), (n + 3, "\r\n x\r\n"), (n + 4, "a\x85 \xa0b\n\xa0x")]


@pytest.mark.parametrize("min_docs,min_chars", [(10, 1), (3, 1), (2, 5), (1, 0), (400, 1)])
def test_report_equals_brute_force(spark, min_docs, min_chars):
    docs = documents()
    assert report(spark, docs, min_docs=min_docs, min_chars=min_chars) == brute(docs, min_docs, min_chars)


@pytest.mark.parametrize("min_docs", [1, 2, 10])
def test_first_occurrence_is_kept(spark, min_docs):
    docs = documents(2)
    assert report(spark, docs, min_docs=min_docs, keep="first") == brute(docs, min_docs, keep="first")


@pytest.mark.parametrize("keep", ["none", "first"])
def test_a_key_over_many_partitions(spark, keep):
    """Runs that begin, end and go on at partition edges, decided or not in each."""
    docs = [(i, "hot\nhot") for i in range(200)] + [(1000 + i, f"own {i}\nrare {i // 9}") for i in range(90)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "37")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for min_docs in (5, 9, 10, 150, 201):
            assert report(spark, docs, 7, min_docs=min_docs, keep=keep) == brute(docs, min_docs, keep=keep)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_stream_holds_few_rows_and_settles_what_it_passes_on(spark, monkeypatch):
    stream = line_dedup._Stream(min_docs=10, keep_first=False)
    monkeypatch.setattr(line_dedup, "HELD_ROWS", 20)
    for th in range(1000):   # one document in 1,000 versions
        stream.add((1, 1), [(7, th, 0, None)], False)
        assert stream.run is None or len(stream.run.held) <= 21
    for doc in range(8, 18):
        stream.add((1, 1), [(doc, 0, 0, None)], False)
    stream.close(last=False)
    kinds = [row[0] for row in stream.out]
    assert kinds.count(line_dedup._KNOWN) == 1 and kinds.count(line_dedup._OPEN) >= 999
    versions = [(7, f"hot\nv{i}") for i in range(60)] + [(8 + i, "hot") for i in range(9)]
    assert report(spark, versions, min_docs=10) == brute(versions, 10)


def test_repeated_rows_null_ids_and_empty_tables(spark):
    text = "a\nb\na"
    docs = [(1, text), (1, text), (1, "a"), (None, "a\nq"), (None, "a"), (2, "B \n"), (3, None)]
    assert report(spark, docs, min_docs=3) == brute(docs, 3)    # a: 1 and null
    assert report(spark, docs, min_docs=2) == brute(docs, 2)
    empty = spark.createDataFrame([], DOCS)
    assert line_dedup.line_report(empty).collect() == []
    assert line_dedup.line_bitmaps(empty).collect() == []


def test_bitmaps_and_texts_beside_clashing_columns(spark):
    docs = [(i, "menu\n" + ("x" * i)) for i in range(12)] + [(99, None)]
    df = spark.createDataFrame(docs, DOCS).selectExpr(
        "doc_id", "text", "1 as n_lines", "2 as keep", "3 as th", "'z' as _b_keep", "4 as text_hash")
    kept = line_dedup.keep_lines(df)
    assert kept.columns == df.columns
    got = {r.doc_id: (r.text, r.n_lines, r.keep, r.th, r._b_keep) for r in kept.collect()}
    assert got == {**{i: ("x" * i, 1, 2, 3, "z") for i in range(12)}, 99: (None, 1, 2, 3, "z")}
    for r in line_dedup.line_bitmaps(df).collect():
        bits = np.unpackbits(np.frombuffer(zlib.decompress(r.keep), np.uint8), count=r.n_lines)
        assert bits.tolist() == ([1] if r.doc_id == 99 else [0, 1])


def test_a_very_long_text(spark):
    docs = [(i, "\n".join(["dup"] * 50_000 + [f"own {i}"])) for i in range(10)] + [(10, "y" * 3_000_000)]
    assert report(spark, docs) == brute(docs, 10)

import hashlib

import duckdb
import pytest

from funnelspark.llm import decontaminate, queries

from .helpers import DOCS, SF_SMALL, brute_contamination, rows_by_id

ITEM = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron"
ITEMS = [(1, ITEM), (2, "short item"), (3, None), (None, "left out"), (10, "Short, ITEM!"),
         (4, "..."), (5, "é ü")]
TEXTS = [
    (1, "x " + ITEM.upper().replace(" ", ", ") + " y"), (2, None), (3, ""), (4, "clean words only"),
    (5, "a short item in " + "many words " * 30), (6, "left out"), (7, "É ü é ü"),
    (8, " ".join(ITEM.split()[:13])), (9, " ".join(ITEM.split()[:12])), (10, "short item " * 5000),
    (None, "short item"), (1, "short item"),
]


def expected(docs, items):
    return list((d, n, h, len(i), hashlib.sha256(",".join(i).encode()).hexdigest(),
                   h > 0 and 20 * h >= n)
                  for x, t in docs for d, (n, h, i) in brute_contamination([(x, t)], items).items())


@pytest.mark.parametrize("block_bytes", [1 << 20, 40])
def test_hits_equal_brute_force(spark, block_bytes):
    docs = spark.createDataFrame(TEXTS, DOCS)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = decontaminate.contamination_report(docs, items, block_bytes=block_bytes)
    known = [(i, t) for i, t in ITEMS if i is not None]
    key = lambda r: tuple(str(x) for x in r)
    assert sorted((tuple(r) for r in got.collect()), key=key) == sorted(expected(TEXTS, known), key=key)


def test_query_equals_sql(spark):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    name = "op6_decontamination"
    got = queries.QUERIES[name](spark, SF_SMALL)
    want = con.execute(f"SELECT {', '.join(got.columns)} FROM ({queries.ORACLES[name]})").fetchall()
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_dropping_keeps_columns_with_clashing_names(spark):
    docs = spark.createDataFrame([(1, ITEM, "n", 5), (2, "clean", "m", None)],
                                 "doc_id long, text string, n_words string, _hit_items int")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = decontaminate.drop_contaminated(docs, items)
    assert got.columns == docs.columns
    assert [tuple(r) for r in got.collect()] == [(2, "clean", "m", None)]


def test_empty_tables(spark):
    docs, none = spark.createDataFrame(TEXTS, DOCS), spark.createDataFrame([], DOCS)
    items = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.contamination_report(none, items).count() == 0
    assert not any(r.contaminated or r.n_items for r in
                   decontaminate.contamination_report(docs, items).collect())
    assert len(rows_by_id(decontaminate.contamination_report(docs, items))) == 11


def test_shift_never_jumps_over_a_window():
    import random
    random.seed(2)
    for _ in range(300):
        words = [random.choice([b"a", b"b", b"c"]) for _ in range(random.randint(0, 40))]
        length = random.randint(1, 6)
        windows = {tuple(random.choice([b"a", b"b", b"c"]) for _ in range(length)): {"i"}
                   for _ in range(random.randint(1, 4))}
        got = {(s, e) for s, e, _ in decontaminate.WuManber(windows, length).find(words)}
        assert got == {(i, i + length) for i in range(len(words) - length + 1)
                       if tuple(words[i:i + length]) in windows}


def test_a_benchmark_of_five_blocks_rewrites_no_document(spark, monkeypatch):
    items = [(i, f"{ITEM} number {i} " + " ".join(f"w{i}x{j}" for j in range(12))) for i in range(20)]
    docs = TEXTS + [(100 + i, f"before {t} after") for i, t in items] + [(200, " ".join(t for _, t in items))] * 3
    frame = spark.createDataFrame(items, "item_id long, text string")
    size = sum(len(t) for _, t in items) // 5 + 1
    assert decontaminate.benchmark_blocks(frame, "item_id", "text", size)[0] == 5
    written = []
    for target, name in ((decontaminate.Workspace, "save"), (decontaminate, "materialize")):
        whole = getattr(target, name)

        def recorded(*args, whole=whole):
            df = next(a for a in args if hasattr(a, "columns"))
            written.append((set(df.columns), df.count()))
            return whole(*args)
        monkeypatch.setattr(target, name, recorded)
    got = decontaminate.contamination_report(spark.createDataFrame(docs, DOCS).repartition(3), frame, block_bytes=size)
    key = lambda r: tuple(str(x) for x in r)
    assert sorted((tuple(r) for r in got.collect()), key=key) == sorted(expected(docs, items), key=key)
    assert len(written) == 6 and all(c == {"h1", "h2", "starts", "ends", "items"} for c, _ in written)
    assert written[-1][1] == 23      # the different texts with hits

import random

import duckdb
import numpy as np

from funnelspark.llm import components, jaccard, queries
from funnelspark.llm.components import connected_components

from .helpers import DOCS, SF_SMALL, brute_components, shingle_set


def documents(seed=4):
    """Near and exact copies, a passage in many texts, short texts, chains of edits."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 5)))
    passage = [word() for _ in range(40)]
    out = [(0, None), (1, ""), (2, " \t\n"), (3, "one"), (4, "ONE"), (5, "a b c d e"), (6, "A b c d e f")]
    for _ in range(12):
        base = [word() for _ in range(rng.choice([6, 20, 60, 200, 900]))]
        for _ in range(rng.randint(1, 8)):
            copy = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, len(base) // 40])):
                copy[rng.randrange(len(copy))] = word()
            if rng.random() < 0.3:
                base = copy
            out.append((len(out), rng.choice([" ", "\n"]).join(copy)))
    for _ in range(30):
        out.append((len(out), " ".join(passage + [word() for _ in range(rng.choice([3, 8, 30, 100]))])))
    rng.shuffle(out)
    return out


def test_components_equal_brute_force(spark):
    docs = documents()
    got = jaccard.link_components(spark.createDataFrame(docs, DOCS).repartition(5))
    want = brute_components(docs)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got.collect()} == want
    assert len(set(c for _, c in want.values())) < len(docs) - 10


def test_query_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF_SMALL}/documents.parquet')")
    got = queries.QUERIES["op5_jaccard_join"](spark, SF_SMALL)
    want = con.execute(f"SELECT {', '.join(got.columns)} FROM "
                       f"({queries.ORACLES['op5_jaccard_join']})").fetchall()
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_repeated_null_and_empty_rows(spark):
    text = " ".join(f"w{i}" for i in range(50))
    docs = spark.createDataFrame([(7, text), (7, text), (3, text + " end"), (None, text), (9, None)], DOCS)
    got = sorted(map(tuple, jaccard.link_components(docs).collect()))
    assert got == [(3, 47, 3), (7, 46, 3), (9, 0, 9)]
    assert jaccard.link_components(docs.limit(0)).count() == 0
    extra = docs.selectExpr("doc_id", "text", "1 as node", "2 as component_id")
    kept = jaccard.one_of_each_group(extra)
    assert kept.columns == extra.columns
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect()) == [
        (False, 3), (False, 9), (True, 0)]


def test_similar_sets_share_a_block():
    rng = np.random.default_rng(1)
    frequent = np.zeros(0, np.uint64)
    for _ in range(400):
        n = int(rng.choice([4, 5, 8, 15, 16, 31, 32, 63, 64, 65, 100, 127, 128, 500, 1023, 1024]))
        base = np.unique(rng.integers(0, 2**64, n + n // 4, dtype=np.uint64))
        a = base[:n]
        frequent = np.sort(base[::3])
        for cut in range(0, n // 5 + 1, max(1, n // 10)):
            b = np.sort(np.concatenate([a[cut:], base[n:n + max(0, n // 4 - 2 * cut)]]))
            common = len(np.intersect1d(a, b))
            if 100 * common >= 80 * (len(a) + len(b) - common):
                assert set(jaccard.block_tokens(np.sort(a), frequent).tolist()) \
                    & set(jaccard.block_tokens(b, frequent).tolist()), (n, cut)


def test_shingle_counts_follow_the_contract():
    texts = ["", None, "a", "a b c d", "a b c d e f a b c d e", "x\x0by\x0cz\x1cw v u t", "É É É É É É É"]
    assert [len(s) for s in jaccard.shingles(texts)] == [len(shingle_set(t)) for t in texts]


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(200, 200)]
    got = connected_components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.node: r.label for r in got} == {**{i: 0 for i in range(41)},
                                              **{i: 100 for i in range(100, 140)}}


def test_components_of_stars_need_no_round(spark, monkeypatch):
    star, calls = components._star, []

    def counted(edges, large):
        calls.append(large)
        return star(edges, large)
    monkeypatch.setattr(components, "_star", counted)
    stars = [(100 * s, 100 * s + i) for s in range(8) for i in range(1, 30)]
    got = connected_components(spark.createDataFrame(stars, "a long, b long").repartition(4)).collect()
    assert {r.node: r.label for r in got} == {n: n // 100 * 100 for s in stars for n in s}
    assert len(got) == 240 and not calls


def test_local_stars_connect_the_same_nodes_whatever_is_held(spark):
    rng = random.Random(8)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(250)]
    df = spark.createDataFrame(edges, "a long, b long").repartition(3)
    want = {r.node: r.label for r in connected_components(df).collect()}
    for held in (0, 5, 1000):
        stars = components._local_stars(df, held)
        assert all(r.a > r.b for r in stars.collect())
        assert {r.node: r.label for r in connected_components(stars).collect()} == want
    root = {n: n for e in edges for n in e}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n
    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    assert want == {n: find(n) for e in edges if e[0] != e[1] for n in e}


def near_copies(size, words=300, seed=7):
    """A text and copies with 3 to 5 changed words: each links with the text, few with each other."""
    rng = random.Random(seed)
    base = [f"w{rng.randrange(10**6)}" for _ in range(words)]
    out = [(0, " ".join(base))]
    for i in range(1, size):
        copy = list(base)
        for at in rng.sample(range(words), rng.randint(3, 5)):
            copy[at] = f"x{rng.randrange(10**6)}"
        out.append((i, " ".join(copy)))
    return out


def test_compared_pairs_grow_with_a_group_of_near_copies_not_with_its_square(spark, monkeypatch):
    verify, pairs = jaccard._verify, []

    def counted(given, texts, keep=()):
        pairs.append(given.count())
        return verify(given, texts, keep)
    monkeypatch.setattr(jaccard, "_verify", counted)
    compared = {}
    for size in (150, 300):
        pairs.clear()
        docs = near_copies(size)
        rng = random.Random(1)
        rng.shuffle(docs)
        got = jaccard.link_components(spark.createDataFrame(docs, DOCS).repartition(4)).collect()
        assert {r.component_id for r in got} == {0} and len(got) == size
        compared[size] = sum(pairs)
    assert compared[300] < 2.5 * compared[150], compared
    assert compared[300] < 300 * 10


def test_sketches_bound_the_symmetric_difference_at_any_size(spark):
    rng = np.random.default_rng(5)
    rows, want = [], []
    for n in (4, 200, 511, 513, 1030, 3000, 20_000):
        a = np.unique(rng.integers(0, 2**64, n, dtype=np.uint64))
        for other in (n // 9, n // 2, n):
            b = np.unique(np.concatenate([a[other:], rng.integers(0, 2**64, other, dtype=np.uint64)]))
            b = b[:max(1, int(len(b) * 0.9))]
            rows.append((jaccard.parity_bits(a), jaccard.parity_bits(b)))
            want.append((n, len(np.setxor1d(a, b)), 9 * len(np.setxor1d(a, b)) > 2 * (len(a) + len(b))))
    df = spark.createDataFrame(rows, "a array<long>, b array<long>").coalesce(1)
    got = [r[0] for r in df.select(jaccard._distance("a", "b")).collect()]
    for d, (n, most, far) in zip(got, want):
        assert d <= most, n
        if far and n >= 200:   # sets that are far apart are told apart, long ones too
            assert d > 0.4 * n, (n, d)


def test_texts_of_one_id_stand_for_themselves(spark):
    long = lambda i, n=60: " ".join(f"{i}w{j}" for j in range(n))
    docs = [(1, long(1)), (2, long(1) + " end"), (2, long(2)), (2, long(2)), (3, long(3)), (None, long(1))]
    kept = jaccard.one_of_each_group(spark.createDataFrame(docs, DOCS)).collect()
    assert sorted(map(str, kept)) == sorted(map(str, spark.createDataFrame(
        [docs[0], docs[2], docs[3], docs[4], docs[5]], DOCS).collect()))


def test_few_edges_in_many_partitions_need_no_round(spark, monkeypatch):
    star, calls = components._star, []

    def counted(edges, large):
        calls.append(large)
        return star(edges, large)
    monkeypatch.setattr(components, "_star", counted)
    edges = [(i, i + 1) for i in range(60)] + [(100 + i, 101 + i) for i in range(20)]
    df = spark.createDataFrame(edges, "a long, b long").repartition(8)
    want = {**{i: 0 for i in range(61)}, **{100 + i: 100 for i in range(21)}}
    assert {r.node: r.label for r in connected_components(df).collect()} == want and not calls
    monkeypatch.setattr(components, "TASK_EDGES", 30)   # more than a task is given: rounds follow
    got = connected_components(df).collect()
    assert {r.node: r.label for r in got} == want and len(got) == len(want)
    assert connected_components(df.where("a < 0")).collect() == []


def test_rows_of_tokens_in_several_components_with_their_links(spark):
    rows = spark.createDataFrame([(1, 10, 5), (1, 11, 5), (2, 10, 5), (2, 12, 6), (3, 13, 7), (3, 14, 7), (4, 15, 8)],
                                 "token long, node long, n long")
    labels = spark.createDataFrame([(10, 10), (11, 10), (12, 12), (13, 13)], "node long, label long")
    links = spark.createDataFrame([(11, 10), (13, 10)], "a long, b long")
    got = jaccard._open(jaccard._labelled(rows, labels, jaccard._degrees(links))).collect()
    assert sorted(map(tuple, got)) == [(2, 10, 10, 5, 2), (2, 12, 12, 6, 0), (3, 13, 13, 7, 1), (3, 14, 14, 7, 0)]


def test_a_saved_table_is_read_back_without_a_job(spark):
    df = spark.range(5).selectExpr("id", "array(cast(id as string)) as `odd name`", "cast(null as date) as day")
    work, sc = components.Workspace(spark), spark.sparkContext
    try:
        sc.setJobGroup("saved", "saved")
        saved = work.save(df, "saved")
        jobs = sc.statusTracker().getJobIdsForGroup("saved")
    finally:
        sc._jsc.clearJobGroup()
    assert len(jobs) == 1   # that which writes it
    assert saved.dtypes == df.dtypes and sorted(map(tuple, saved.collect())) == sorted(map(tuple, df.collect()))
    assert work.save(df.where("id < 0"), "saved").collect() == []
    work.close()

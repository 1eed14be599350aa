import uuid

import numpy as np

from funnelspark.llm import neighbours, queries

from .helpers import SF_MID


def brute(ids, vectors, k, every):
    out = {}
    for i, q in enumerate(ids):
        if q % every == 0:
            scores = (vectors * vectors[i]).sum(1)
            order = [j for j in np.lexsort((ids, -scores)) if ids[j] != q][:k]
            out[int(q)] = [(int(ids[j]), float(scores[j])) for j in order]
    return out


def found(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(out[r.query_id])
    return out


def test_recall_and_scores(spark):
    rows = spark.read.parquet(f"{SF_MID}/embeddings.parquet").orderBy("vec_id").collect()
    ids = np.array([r.vec_id for r in rows])
    want = brute(ids, np.array([r.embedding for r in rows], np.float64), 20, 20)
    got = found(queries.QUERIES["op9_neighbours"](spark, SF_MID))
    assert got.keys() == want.keys()
    recall = np.mean([len({v for v, _ in got[q]} & {v for v, _ in want[q]}) / 20 for q in want])
    assert recall >= 0.9
    score = {q: dict(brute(ids, np.array([r.embedding for r in rows], np.float64), 500, 20)[q]) for q in want}
    assert all(abs(score[q][v] - s) < 1e-12 for q in got for v, s in got[q])


def test_ties_copies_slices_and_rows_that_take_no_part(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(60, 8))
    rows = [(i, base[i % 60].tolist()) for i in range(240)]
    bad = [(1000, None), (1020, [0.0] * 8), (1040, [float("nan")] + [1.0] * 7), (1060, [None] + [1.0] * 7),
           (1080, [1.0] * 5), (1100, [float("inf")] * 8), (None, base[0].tolist()), (0, base[0].tolist())]
    df = spark.createDataFrame([(i, v, "x") for i, v in rows + bad],
                               "vec_id long, embedding array<double>, axis string").repartition(4)
    got = found(neighbours.nearest(df, k=5, query_every=20, slice_rows=3, part_rows=2))
    want = brute(np.array([i for i, _ in rows]), np.array([v for _, v in rows]), 5, 20)
    assert {q: [v for v, _ in x] for q, x in got.items()} == {q: [v for v, _ in x] for q, x in want.items()}


def test_few_and_no_rows(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 0.5])], "vec_id long, embedding array<float>")
    assert found(neighbours.nearest(df)) == {0: [(1, 0.5)]}
    assert neighbours.nearest(df.limit(0)).count() == 0
    assert neighbours.nearest(df.where("vec_id = 0")).count() == 0


def test_turning_keeps_lengths():
    v = np.random.default_rng(1).normal(size=(10, 6))
    turned = neighbours.CrossPolytope(6, 2).turn(v, 1)
    assert turned.shape == (10, 8)
    assert np.allclose(np.linalg.norm(turned, axis=1), np.linalg.norm(v, axis=1))


def test_fast_transform_is_the_hadamard_matrix():
    for n in (1, 2, 16, 64, 512):
        h = np.array([[(-1) ** bin(i & j).count("1") for j in range(n)] for i in range(n)]) / np.sqrt(n)
        x = np.random.default_rng(n).normal(size=(3, n))
        assert np.allclose(neighbours.hadamard(x), x @ h)


def test_probes_are_the_buckets_of_smallest_loss():
    hashing = neighbours.CrossPolytope(5, 2, 64)
    assert hashing.widths == [16, 4]
    v = np.random.default_rng(2).normal(size=(20, 5))
    for t in range(2):
        turned = [hashing.turn(v, t, p)[:, :w // 2] for p, w in enumerate(hashing.widths)]
        loss = [(b.max(1, keepdims=True) - b) ** 2 for b in (np.hstack([x, -x]) for x in turned)]
        whole = (loss[0][:, :, None] + loss[1][:, None, :]).reshape(20, -1)
        probes = hashing.probes(v, t, 7)
        assert all(set(p) == set(np.argsort(w)[:7]) for p, w in zip(probes, whole))
        assert (hashing.bucket(v, t) == whole.argmin(1)).all()


def candidates(vectors, queries, k=20):
    """(share of the rows that a query meets, recall of the k nearest), in plain numpy."""
    length = np.log2(np.linalg.norm(vectors, axis=1))
    band = np.floor(length + 0.5).astype(int)
    bands = [neighbours.Band(int(b), length[band == b].max(), int((band == b).sum())) for b in np.unique(band)]
    hashing = neighbours.Hashing(vectors.shape[1], bands, k, neighbours.TABLES, neighbours.PROBES)
    keys, subs = hashing.file(neighbours._units(vectors), length, band)
    met = np.zeros((len(queries), len(vectors)), bool)
    for who, key, sub in hashing.probe(neighbours._units(vectors[queries])):
        column = (key[0] >> neighbours._BUCKET_BITS) % hashing.tables
        filed, probed = keys[:, column] * 2**12 + subs[:, column], key * 2**12 + sub
        for i in range(len(queries)):
            met[i] |= np.isin(filed, probed[who == i])
    scores = vectors[queries] @ vectors.T
    scores[np.arange(len(queries)), queries] = -np.inf
    best = np.argsort(-scores, axis=1)[:, :k]
    return met.mean(), np.take_along_axis(met, best, 1).mean()


def test_share_of_candidates_falls_as_rows_grow():
    rng = np.random.default_rng(5)
    vectors = rng.normal(size=(50_000, 64))
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    share_small, recall_small = candidates(vectors[:2000], np.arange(60))
    share, recall = candidates(vectors, np.arange(60))
    assert recall_small >= 0.9 and recall >= 0.9
    assert share <= 0.2 and share < share_small / 2


def test_recall_by_inner_product_of_vectors_of_many_lengths(spark):
    rng = np.random.default_rng(8)
    vectors = rng.normal(size=(2000, 32)) * rng.uniform(0.5, 1.5, (2000, 1))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    got, want = found(neighbours.nearest(df)), brute(np.arange(2000), vectors, 20, 20)
    assert got.keys() == want.keys()
    assert np.mean([len({v for v, _ in got[q]} & {v for v, _ in want[q]}) / 20 for q in want]) >= 0.9


def test_lone_query_is_compared_with_all_rows(spark):
    rng = np.random.default_rng(9)
    vectors = np.abs(rng.normal(size=(600, 8))) * 0.01 + np.eye(8)[0]
    vectors[0] = -vectors[1]                      # its buckets hold no other row
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    got, want = found(neighbours.nearest(df, query_every=300, slice_rows=100)), brute(np.arange(600), vectors, 20, 300)
    assert [v for v, _ in got[0]] == [v for v, _ in want[0]]
    assert len(got[300]) == 20


def test_hot_bucket_is_split_for_rows_and_queries(spark, tmp_path):
    rng = np.random.default_rng(10)
    vectors = rng.normal(size=(900, 8)) * 0.001 + np.eye(8)[2]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "class long, v array<double>")
    zero = neighbours.F.lit(0)
    members = df.select(zero.cast("long").alias("key"), zero.alias("sub"), "class", "v")
    probing = df.select(zero.cast("long").alias("key"), neighbours.F.array(zero).alias("subs"), "class", "v")
    most = []
    plain = neighbours._ranker

    def noting(k):
        run = plain(k)

        def group(left, right):
            with open(f"{tmp_path}/{uuid.uuid4().hex}", "w") as f:
                f.write(f"{left.num_rows} {right.num_rows}")
            return run(left, right)
        return group
    neighbours._ranker = noting
    try:
        got = neighbours._ranked(neighbours.Workspace(spark), members, probing, 3, 100, 50).collect()
    finally:
        neighbours._ranker = plain
    for f in tmp_path.iterdir():
        most.append(tuple(map(int, f.read_text().split())))
    assert max(a for a, _ in most) <= 150 and max(b for _, b in most) <= 80 and len(most) == 9 * 18
    score = vectors @ vectors.T
    best = {(int(q), int(c)) for q in range(900) for c in np.argsort(-score[q])[:4]}
    assert best <= {(r.q, r["class"]) for r in got}

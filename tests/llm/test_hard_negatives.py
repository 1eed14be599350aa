import math
import random

import numpy as np
import pytest

from funnelspark.llm import hard_negatives as hn

ROWS = "vec_id long, embedding array<float>, label int"


def brute(rows, every=100, positives=5, negatives=5):
    """By definition, with Python integers."""
    taking = {}
    for i, v, label in rows:
        if i is not None and label is not None and v is not None and \
                all(x is not None and math.isfinite(x) for x in v):
            v = [float(np.float32(x)) for x in v]
            taking[i] = max(taking.get(i, (v, label)), (v, label))
    whole = {i: ([math.floor(256 * x) for x in v], label) for i, (v, label) in taking.items()}
    out = []
    for a, (va, la) in whole.items():
        if a % every:
            continue
        score = {i: sum(x * y for x, y in zip(va, v)) for i, (v, _) in whole.items() if i != a}
        order = sorted(score, key=lambda i: (-score[i], i))
        same = [i for i in order if whole[i][1] == la][:positives]
        for p in same:
            found = [i for i in order if whole[i][1] != la and
                     80 * score[p] <= 100 * score[i] <= 100 * score[p]][:negatives]
            out += [(a, p, r, i, score[p], score[i]) for r, i in enumerate(found, 1)]
    return sorted(out)


def mined(spark, rows, **options):
    df = spark.createDataFrame(rows, ROWS).repartition(3)
    return sorted(map(tuple, hn.mine(df, **options).collect()))


def vectors(seed, n=900, dim=12, labels=4):
    rng = np.random.default_rng(seed)
    centres = rng.normal(0, 1, (labels, dim)) + 1
    out = []
    for i in range(n):
        label = int(rng.integers(labels))
        v = (centres[label] * 0.3 + rng.normal(0, 0.6, dim) + 0.5).round(1)
        out.append((i, v.tolist(), label))
    return out


@pytest.mark.parametrize("blocks", [{}, {"row_block": 50, "anchor_block": 3}])
def test_equals_brute_force(spark, blocks):
    rows = vectors(3)
    want = brute(rows)
    assert len(want) > 100
    assert mined(spark, rows, **blocks) == want


def test_ties_copies_and_a_common_vector(spark):
    rng = random.Random(5)
    rows = [(i, [1.0, 0.5, -0.25], rng.randrange(3)) for i in range(0, 400)]
    rows += [(i, [rng.choice([-1.0, 0.0, 0.9, 1.0])] * 3, rng.randrange(3)) for i in range(400, 900)]
    want = brute(rows)
    assert any(r[4] == r[5] and r[3] < r[1] for r in want)   # tied negatives of a smaller id
    assert mined(spark, rows, row_block=64, anchor_block=2) == want


def test_rows_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = vectors(8, 300)
    rows += [(None, [1.0] * 12, 0), (1000, None, 0), (1001, [1.0] * 12, None), (1100, [nan] + [1.0] * 11, 1),
             (1200, [1.0, None] + [1.0] * 10, 1), (1300, [inf] * 12, 1), (1400, [], 1), (1500, [2.0, 1.0], 2),
             (1600, [0.0] * 12, 3), (1700, [-1.0] * 12, 3), (7, [9.0] * 12, 1), (7, [9.0] * 12, 2), (7, [9.0] * 12, 2)]
    want = brute(rows)
    assert mined(spark, rows) == want
    assert {r[0] for r in want} >= {0, 100, 200}


def test_few_rows_and_empty_tables(spark):
    assert mined(spark, [(0, [1.0], 1)]) == []
    assert mined(spark, [(0, [1.0], 1), (1, [1.0], 1)]) == []
    assert mined(spark, [(0, [1.0], 1), (1, [1.0], 1), (2, [1.0], 2)]) == [(0, 1, 1, 2, 65536, 65536)]
    assert hn.mine(spark.createDataFrame([], ROWS)).collect() == []
    clash = spark.createDataFrame([(0, [1.0], 1), (1, [1.0], 1), (2, [1.0], 2)], ROWS) \
        .selectExpr("*", "5 as id", "6 as v", "7 as anchor", "8 as row_part", "9 as score")
    assert len(hn.mine(clash).collect()) == 1


def test_scores_are_exact_beyond_doubles(spark):
    rows = [(0, [1e7, 1.0], 1), (1, [1e7, 1.0], 1), (2, [1e7, 0.99609375], 2), (3, [1e30, 0.0], 2)]
    assert mined(spark, rows) == brute(rows[:3])


def test_windows_and_packed_order():
    assert [hn.lowest(s) for s in (100, 99, 1, 0, -10)] == [80, 80, 1, 0, -8]
    keys = [(1, 10, 0, 5), (1, 10, 1, 2), (1, 9, 0, 6), (1, 9, 1, 3), (1, 8, 1, 4), (1, 7, 1, 9), (2, 9, 1, 1)]
    assert list(hn.window_negatives(keys, 2)) == [
        (1, 5, 1, 2, 10, 10), (1, 5, 2, 3, 10, 9), (1, 6, 1, 3, 9, 9), (1, 6, 2, 4, 9, 8)]
    assert list(hn.first_of_anchor(keys, 1)) == [(1, 10, 5), (2, 9, 1)]


def test_keys_that_reach_the_shuffle_do_not_grow_with_the_rows_of_an_anchor(spark):
    """A block returns at most ``negatives`` for each window, however many rows are in it."""
    import pyarrow as pa
    n = 2000
    rows = pa.table({"id": np.arange(1, n + 1), "label": pa.array([1] * n, pa.int64()),
                     "v": pa.array([[1.0]] * n, pa.list_(pa.float32()))})
    anchor = pa.table({"id": np.array([0]), "label": pa.array([0], pa.int64()),
                       "v": pa.array([[1.0]], pa.list_(pa.float32())), "tops": pa.array([[65536, 70000]])})
    found = hn._best_in_windows(5, hn.LOW, 256)(anchor, rows)
    assert found.column("id").to_pylist() == [1, 2, 3, 4, 5]


def test_label_shift(spark):
    got = spark.createDataFrame([(7, 9), (14, 2), (8, 9), (7, None)], "vec_id long, label int") \
        .select(hn.shifted_label()).collect()
    assert [r[0] for r in got] == [0, 3, 9, None]

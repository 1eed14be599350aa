import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from funnelspark.llm import lexical

from .helpers import DOCS

ITEMS = "item_id long, text string"


def terms(text):
    found = re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text or "")
    return [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in found]


def brute(docs, items, k=20):
    counts = [(d, Counter(terms(t))) for d, t in docs if d is not None]
    counts = [(d, c) for d, c in counts if c]
    n_docs, n_terms = len(counts), sum(c.total() for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    queries = {}
    for i, text in items:
        if i is not None and terms(text):
            queries.setdefault(i, Counter()).update(terms(text))
    out = []
    for i, q in queries.items():
        scored = []
        for d, c in counts:
            m = 75 + (25 * c.total() * n_docs) // n_terms
            s = sum(n * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    * ((10**9 * c[t]) // (1000 * c[t] + 12 * m)) for t, n in q.items() if t in c)
            if s > 0:
                scored.append((-s, d))
        out += [(i, r, d, -s) for r, (s, d) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out)


def ranked(spark, docs, items, **options):
    got = lexical.rank_documents(spark.createDataFrame(docs, DOCS).repartition(5),
                                 spark.createDataFrame(items, ITEMS), **options)
    return sorted(map(tuple, got.select("item_id", "rank", "doc_id", "score").collect()))


def corpus(seed, n=400, vocabulary=300):
    rng = random.Random(seed)
    words = ["the", "OF", "é", "№5", "a1"] + ["w" + str(i) for i in range(vocabulary)]
    weights = [200, 100, 20, 5, 5] + [100 / (i + 1) for i in range(vocabulary)]
    text = lambda k: rng.choice([" ", ", ", "\n"]).join(rng.choices(words, weights, k=k))
    docs = [(i, text(rng.choice([0, 1, 5, 30, 300]))) for i in range(n)]
    copy = text(25)
    docs += [(n + i, copy) for i in range(60)] + [(n + 100, None), (n + 101, " .,;")]
    return docs, [(i, text(rng.choice([1, 3, 12, 40]))) for i in range(30)] + [(50, copy), (51, copy.upper())]


@pytest.mark.parametrize("options", [{}, {"block_terms": 60}, {"k": 3}])
def test_equals_brute_force(spark, options):
    docs, items = corpus(2)
    assert ranked(spark, docs, items, **options) == brute(docs, items, options.get("k", 20))


def test_small_trees(spark, monkeypatch):
    docs, items = corpus(3)
    block, vectors = block_of(docs, items)
    for size in (64, 100, 4096):
        monkeypatch.setattr(lexical, "TREE_DOCS", size)
        search = lexical.Searcher(block, 20)
        for v in vectors:
            search.add(*v)
        search.finish()
        got = [(block.items[i], r, d, s) for i, best in enumerate(search.best)
               for r, (s, d) in enumerate(best, 1)]
        assert sorted(got) == brute(docs, items)


def block_of(docs, items):
    numbers, held = {}, {}
    for i, text in items:
        for t, q in Counter(lexical.terms_of(text)).items():
            held.setdefault(i, {})[numbers.setdefault(t, len(numbers))] = q
    vectors = []
    for d, text in docs:
        words = lexical.terms_of(text)
        if words:
            known = np.array([numbers[w] for w in words if w in numbers], np.int32)
            vectors.append((d, len(words), *np.unique(known, return_counts=True)))
    df = np.zeros(len(numbers), np.int64)
    for v in vectors:
        df[v[2]] += 1
    return lexical.make_block(held, df, len(vectors), sum(v[1] for v in vectors)), vectors


def tree_of(block, vectors):
    out = []
    for d, n, t, f in vectors:
        at = block.place[t]
        order = np.argsort(at)
        out.append((at[order], f[order], lexical.length_measure(n, block.n_docs, block.n_terms), d))
    return lexical.FpTree(out, len(block.place))


def test_tree_holds_every_document_once_and_bounds_hold():
    docs, items = corpus(4)
    block, vectors = block_of(docs, items)
    tree = tree_of(block, vectors)
    assert sorted(d for ds in tree.docs for d in ds) == sorted(v[0] for v in vectors)
    assert max(map(len, tree.docs)) >= 60          # equal vectors are one leaf

    def leaves(node):
        if node < tree.n_leaves:
            return [node]
        return [x for c in tree._below(np.array([node - tree.n_leaves])).tolist() for x in leaves(c)]
    assert sorted(leaves(tree.root)) == list(range(tree.n_leaves))
    for item in range(0, len(block.items), 5):
        t, w = block.terms[item], block.weights[item]
        for node in range(tree.n_leaves, tree.root + 1):
            top = max(tree.score(x, t, w) for x in leaves(node))
            assert int(tree.bounds(np.array([node]), t, w)[0]) >= top


def test_search_leaves_subtrees_out():
    docs, items = corpus(5, 3000, 2000)
    block, vectors = block_of(docs, items)
    tree, looked = tree_of(block, vectors), 0
    for t, w in zip(block.terms, block.weights):
        looked += tree.search(t, w, 20, [])[1]
    assert looked < 0.8 * len(block.items) * (tree.root + 1)


def test_counts_beyond_the_table_of_maxima(spark):
    docs = [(i, "many " * (250 + i) + "few " * (i % 3)) for i in range(40)] + [(99, "few other")]
    items = [(1, "many"), (2, "few many many"), (3, "other few")]
    assert ranked(spark, docs, items) == brute(docs, items)


def test_defined_cases(spark):
    docs = [(1, "a b"), (1, "a b"), (2, "a"), (None, "a b c"), (3, None), (4, ""), (5, "x " * 200_000 + "b")]
    items = [(1, "a"), (1, "b b"), (None, "a"), (2, None), (3, "?!"), (4, "zzz"), (5, "X x")]
    assert ranked(spark, docs, items) == brute(docs, items)
    empty, no_items = spark.createDataFrame([], DOCS), spark.createDataFrame([], ITEMS)
    full = spark.createDataFrame(docs, DOCS)
    assert lexical.rank_documents(empty, spark.createDataFrame(items, ITEMS)).collect() == []
    assert lexical.rank_documents(full, no_items).collect() == []
    clash = lexical.rank_documents(full.selectExpr("*", "1 as item", "2 as doc", "3 as score", "4 as n"),
                                   spark.createDataFrame(items, ITEMS).selectExpr("*", "1 as term", "2 as q"))
    assert clash.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, clash.collect())) == brute(docs, items)

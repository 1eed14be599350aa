"""Ranked lexical search over document FP-trees, by branch and bound for each item.

The score of a document for an item is the sum, over the item's terms with repeats, of
``w * ((10**9 * tf) div (1000 * tf + 12 * m))``: w the term's weight from its document frequency,
tf its occurrences in the document, m a measure of the document's length.

* *Restricted vectors.*  Documents are read once for a block of items: each becomes its number of
  terms and the counts of the terms that the block's items hold, written to the shared folder.
  Document frequencies, the number of documents and the number of terms are summed from there,
  over all documents.
* *FP-tree.*  A task puts the vectors of a bounded number of documents, each as its terms in the
  order of their document frequency (most frequent first, so that paths are shared), into a trie.  Shared paths are one node, chains are one edge, equal vectors
  one leaf.  A node keeps, for its whole subtree, the largest tf of each term and the smallest m.
* *Branch and bound.*  A score grows with tf and falls with m, so a node's maxima and minimum
  bound the scores below it.  For each item the tree is searched depth first, best bounds first;
  what is bound below the item's k-th best score so far is left out with its subtree.  The best
  scores are carried from tree to tree of a task; each task returns ``k`` documents at most for
  an item, and these are ranked over all tasks.

Only bounded things are broadcast: a block of items (about ``BLOCK_TERMS`` pairs of item and
term; an item is never cut) with the weights of its terms.  The corpus is read once for each
block.

Defined cases: documents without terms (null, empty) count nowhere and are never returned; rows
with a null id are left out; every other row is a document of its own, also with a repeated id;
rows that repeat an item id are one item with the terms of all of them; items with a null id or
without terms give no rows; equal scores are ordered by the smaller id; empty tables give no
rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from funnelspark.llm.common import Workspace, materialize
from funnelspark.llm.decontaminate import words_of as terms_of

TOP = 20
#: (item, term) pairs in one block of items.
BLOCK_TERMS = 100_000
#: Documents of one tree, and cells of its table of maxima.
TREE_DOCS = 4096
TREE_CELLS = 1 << 25
#: Nodes whose children are bounded in one step.
_STEP = 256
#: A tf of the table that stands for any larger one.
_MANY = 255
_LONG = (1 << 63) - 1


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def length_measure(n: int, n_docs: int, n_terms: int) -> int:
    return 100 - 25 + (25 * n * n_docs) // n_terms


# ----------------------------------------------------------------- items, vectors
def item_terms(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(item, term, q): how often an item holds a term."""
    kind = items.schema[id_col].dataType
    arrow = to_arrow_type(kind)

    def run(batches):
        for batch in batches:
            out = [[], [], []]
            for item, text in zip(*(batch.column(c).to_pylist() for c in ("item", "text"))):
                for term, q in Counter(terms_of(text)).items():
                    for column, value in zip(out, (item, term, q)):
                        column.append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(out, (arrow, pa.binary(), pa.int64()))], ["item", "term", "q"])
    return items.select(F.col(f"`{id_col}`").alias("item"), F.col(f"`{text_col}`").alias("text")) \
        .where("item is not null and text is not null") \
        .mapInArrow(run, f"item {kind.simpleString()}, term binary, q long") \
        .groupBy("item", "term").agg(F.sum("q").alias("q"))


def restricted_vectors(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """(doc, n, terms, tfs) of the documents (doc, text) with terms: ``n`` counts all their
    terms, the arrays those of the vocabulary."""
    kind = docs.schema["doc"].dataType
    arrow = to_arrow_type(kind)
    held = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches):
        number = held.value.get
        for batch in batches:
            ids, n, terms, tfs = [], [], [], []
            for doc, text in zip(*(batch.column(c).to_pylist() for c in ("doc", "text"))):
                words = terms_of(text)
                if not words:
                    continue
                known = np.array([t for t in map(number, words) if t is not None], np.int32)
                at, count = np.unique(known, return_counts=True)
                ids.append(doc)
                n.append(len(words))
                terms.append(at)
                tfs.append(count)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, arrow), pa.array(n, pa.int64()), pa.array(terms, pa.list_(pa.int32())),
                 pa.array(tfs, pa.list_(pa.int64()))], ["doc", "n", "terms", "tfs"])
    return docs.mapInArrow(run, f"doc {kind.simpleString()}, n long, terms array<int>, tfs array<long>")


# ----------------------------------------------------------------- tree
def parts_of_score(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """``(10**9 * tf) div (1000 * tf + 12 * m)``, as longs."""
    tf = tf.astype(np.int64)
    return (1_000_000_000 * tf) // (1000 * tf + 12 * m)


class FpTree:
    """A trie of restricted vectors.  Nodes from ``n_leaves`` on are inner ones, the last is the
    root; ``tf`` has the subtree maxima by (node, term), ``m`` the subtree minima."""

    def __init__(self, vectors: list[tuple[np.ndarray, np.ndarray, int, object]], n_terms: int):
        """``vectors``: (terms in tree order ascending, tfs, m, document)."""
        paths = [(v[0].astype(">u4").tobytes(), v[1].tobytes(), v[2]) for v in vectors]
        order = sorted(range(len(vectors)), key=lambda i: (*paths[i], vectors[i][3]))
        self.docs: list[list] = []          # of each leaf, ascending
        self.exact: list[tuple] = []        # terms and tfs of each leaf
        before, keys = None, []
        for i in order:
            if paths[i] != before:
                before = paths[i]
                keys.append(before[0])
                self.docs.append([])
                self.exact.append(vectors[i][:2])
            self.docs[-1].append(vectors[i][3])
        self.n_leaves = n = len(keys)
        self.tf = np.zeros((2 * n + 1, n_terms), np.uint8)
        self.m = np.zeros(2 * n + 1, np.int64)
        firsts = np.cumsum([0] + [len(d) for d in self.docs])
        for leaf, (terms, tfs) in enumerate(self.exact):
            self.tf[leaf, terms] = np.minimum(tfs, _MANY)
            self.m[leaf] = vectors[order[firsts[leaf]]][2]
        self._closed: list[np.ndarray] = []
        self._link(keys)
        self.first = np.cumsum([0] + [len(c) for c in self._closed])
        self.children = np.concatenate(self._closed)

    def _link(self, keys: list[bytes]) -> None:
        """Inner nodes from the common prefixes of neighbouring leaves."""
        depths = [_common(a, b) for a, b in zip(keys, keys[1:])] + [-1]
        stack: list[tuple[int, list[int]]] = [(0, [])]
        for leaf, depth in enumerate(depths):
            child = leaf
            while stack and stack[-1][0] > depth:
                stack[-1][1].append(child)
                child = self._close(stack.pop()[1])
            if not stack:
                break
            if stack[-1][0] == depth:
                stack[-1][1].append(child)
            else:
                stack.append((depth, [child]))

    def _close(self, children: list[int]) -> int:
        node, at = self.n_leaves + len(self._closed), np.array(children)
        self._closed.append(at)
        self.tf[node] = self.tf[at].max(axis=0)
        self.m[node] = self.m[at].min()
        return node

    def _below(self, inner: np.ndarray) -> np.ndarray:
        """The children of inner nodes (numbered from 0)."""
        first, count = self.first[inner], self.first[inner + 1] - self.first[inner]
        skip = np.cumsum(count) - count
        return self.children[np.arange(count.sum()) + np.repeat(first - skip, count)]

    @property
    def root(self) -> int:
        return self.n_leaves + len(self.first) - 2

    def bounds(self, nodes: np.ndarray, terms: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """No document below a node scores more; for a leaf without a capped tf, its score."""
        tf = self.tf[nodes[:, None], terms]
        part = parts_of_score(tf, self.m[nodes][:, None])
        return np.where(tf == _MANY, 1_000_000, part) @ weights

    def score(self, leaf: int, terms: np.ndarray, weights: np.ndarray) -> int:
        own, tfs = self.exact[leaf]
        at = np.minimum(np.searchsorted(own, terms), max(len(own) - 1, 0))
        tf = np.where(own[at] == terms, tfs[at], 0) if len(own) else np.zeros(len(terms), np.int64)
        return int(parts_of_score(tf, self.m[leaf]) @ weights)

    def search(self, terms: np.ndarray, weights: np.ndarray, k: int, best: list[tuple[int, object]]
               ) -> tuple[list[tuple[int, object]], int]:
        """The ``k`` best (score, document) of ``best`` and of this tree, and the number of nodes
        that were bounded."""
        least = best[-1][0] if len(best) == k else 1
        stack, looked = [(np.array([self.root]), np.array([_LONG]))], 0
        while stack:
            nodes, above = stack.pop()
            if len(nodes) > _STEP:
                stack.append((nodes[:-_STEP], above[:-_STEP]))
                nodes, above = nodes[-_STEP:], above[-_STEP:]
            nodes = nodes[above >= least]   # the k-th score may have grown since they were bounded
            if not len(nodes):
                continue
            at = self._below(nodes - self.n_leaves)
            bound = self.bounds(at, terms, weights)
            looked += len(at)
            order = np.argsort(bound, kind="stable")   # the best last: taken first
            order = order[np.searchsorted(bound[order], least):]
            at, bound = at[order], bound[order]
            leaf = at < self.n_leaves
            if leaf.any():
                best, least = self._add(at[leaf], bound[leaf], terms, weights, k, best, least)
            if not leaf.all():
                stack.append((at[~leaf], bound[~leaf]))
        return best, looked

    def _add(self, leaves, bounds, terms, weights, k, best, least):
        found = list(best)
        for leaf, bound in zip(leaves[::-1].tolist(), bounds[::-1].tolist()):
            if len(found) >= k and bound < least:
                break
            capped = (self.tf[leaf, terms] == _MANY).any()
            score = self.score(leaf, terms, weights) if capped else bound
            if score >= least:
                found += [(score, doc) for doc in self.docs[leaf][:k]]
                if len(found) >= 4 * k:
                    found = _top(found, k)
                    least = max(least, found[-1][0])
        found = _top(found, k)
        return found, max(least, found[-1][0]) if len(found) == k else least


def _top(found: list[tuple[int, object]], k: int) -> list[tuple[int, object]]:
    return sorted(found, key=lambda x: (-x[0], x[1]))[:k]


def _common(a: bytes, b: bytes) -> int:
    """Bytes of the common prefix, in whole terms."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    x, y = (np.frombuffer(k[:n], np.uint32) for k in (a, b))
    return 4 * int(np.argmax(x != y))


@dataclass(frozen=True)
class Block:
    """A block of items with the weights of its terms, numbered by descending document
    frequency (``place``: from the number of a term in the vectors)."""
    items: list
    terms: list[np.ndarray]
    weights: list[np.ndarray]
    place: np.ndarray
    n_docs: int
    n_terms: int

    @property
    def tree_docs(self) -> int:
        return max(64, min(TREE_DOCS, TREE_CELLS // (2 * max(1, len(self.place)))))


def make_block(items: dict, df: np.ndarray, n_docs: int, n_terms: int) -> Block:
    """``items``: id -> {term number: count}."""
    order = np.lexsort((np.arange(len(df)), -df))
    place = np.empty(len(df), np.int64)
    place[order] = np.arange(len(df))
    weights = np.array([weight(n_docs, d) for d in df.tolist()], np.int64)
    terms, by_item = [], []
    for held in items.values():
        t = np.array(list(held), np.int64)
        q = np.array(list(held.values()), np.int64)
        in_use = df[t] > 0
        terms.append(place[t[in_use]])
        by_item.append(weights[t[in_use]] * q[in_use])
    return Block(list(items), terms, by_item, place, n_docs, n_terms)


class Searcher:
    """The best documents of each item of a block, over trees of bounded size."""

    def __init__(self, block: Block, k: int):
        self.block, self.k = block, k
        self.best: list[list] = [[] for _ in block.items]
        self.vectors: list[tuple] = []
        self.looked = 0

    def add(self, doc, n: int, terms: np.ndarray, tfs: np.ndarray) -> None:
        if len(terms):
            at = self.block.place[terms]
            order = np.argsort(at)
            m = length_measure(n, self.block.n_docs, self.block.n_terms)
            self.vectors.append((at[order], tfs[order], m, doc))
            if len(self.vectors) >= self.block.tree_docs:
                self.finish()

    def finish(self) -> None:
        if not self.vectors:
            return
        tree, self.vectors = FpTree(self.vectors, len(self.block.place)), []
        for i, (terms, weights) in enumerate(zip(self.block.terms, self.block.weights)):
            if len(terms):
                self.best[i], looked = tree.search(terms, weights, self.k, self.best[i])
                self.looked += looked


# ----------------------------------------------------------------- operator
def _best_of_tasks(vectors: DataFrame, block: Block, k: int) -> DataFrame:
    """(item, score, doc): the best ``k`` of each item in each task."""
    kind = vectors.schema["doc"].dataType
    arrow = to_arrow_type(kind)
    held = vectors.sparkSession.sparkContext.broadcast(block)

    def run(batches):
        search = Searcher(held.value, k)
        for batch in batches:
            terms, tfs = (batch.column(c) for c in ("terms", "tfs"))
            t, f = (c.flatten().to_numpy(zero_copy_only=False) for c in (terms, tfs))
            ends = np.cumsum(terms.value_lengths().to_numpy())
            for i, (doc, n) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("doc", "n")))):
                start = ends[i - 1] if i else 0
                search.add(doc, n, t[start:ends[i]], f[start:ends[i]])
        search.finish()
        found = [(i, score, doc) for i, best in enumerate(search.best) for score, doc in best]
        if found:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, x) for c, x in zip(zip(*found), (pa.int32(), pa.int64(), arrow))],
                ["item", "score", "doc"])
    return vectors.mapInArrow(run, f"item int, score long, doc {kind.simpleString()}")


def _best_of_all(found: DataFrame, k: int) -> DataFrame:
    """Ranks the tasks' rows in two steps, so that no task sorts those of all tasks."""
    near = Window.partitionBy("item", "part").orderBy(F.desc("score"), "doc")
    over = Window.partitionBy("item").orderBy(F.desc("score"), "doc")
    parts = found.withColumn("part", F.pmod(F.xxhash64("doc"), F.lit(64)))
    return parts.withColumn("rank", F.row_number().over(near)).where(F.col("rank") <= k) \
        .withColumn("rank", F.row_number().over(over)).where(F.col("rank") <= k).drop("part")


def rank_documents(docs: DataFrame, items: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                   item_col: str = "item_id", item_text_col: str = "text", k: int = TOP,
                   block_terms: int = BLOCK_TERMS) -> DataFrame:
    """item_id, rank, doc_id, score: the ``k`` documents of highest positive score of each item."""
    spark = docs.sparkSession
    given = docs.select(F.col(f"`{id_col}`").alias("doc"), F.col(f"`{text_col}`").alias("text")) \
        .where("doc is not null and text is not null")
    work = Workspace(spark)
    item_kind, doc_kind = items.schema[item_col].dataType, given.schema["doc"].dataType
    schema = f"item_id {item_kind.simpleString()}, rank int, doc_id {doc_kind.simpleString()}, score long"
    parts = []
    try:
        wanted = work.save(item_terms(items, item_col, item_text_col), "lexical-items")
        n_blocks = -(-wanted.count() // block_terms) or 1
        for b in range(n_blocks):
            rows = wanted.where(F.pmod(F.xxhash64("item"), F.lit(n_blocks)) == b).orderBy("item", "term")
            held: dict = {}
            vocabulary: dict[bytes, int] = {}
            for r in rows.toLocalIterator():
                number = vocabulary.setdefault(bytes(r.term), len(vocabulary))
                held.setdefault(r.item, {})[number] = r.q
            if not held:
                continue
            vectors = work.save(restricted_vectors(given, vocabulary), "lexical-vectors")
            n_docs, n_terms = vectors.agg(F.count("*"), F.sum("n")).first()
            df = np.zeros(len(vocabulary), np.int64)
            for r in vectors.select(F.explode("terms").alias("t")).groupBy("t").count().collect():
                df[r.t] = r["count"]   # a row for each term of the block
            block = make_block(held, df, n_docs, n_terms or 0)
            ranked = _best_of_all(_best_of_tasks(vectors, block, k), k)
            names = spark.createDataFrame(list(enumerate(block.items)), f"item int, item_id {item_kind.simpleString()}")
            parts.append(work.save(ranked.join(F.broadcast(names), "item")   # a block's items
                                   .select("item_id", "rank", F.col("doc").alias("doc_id"), "score"),
                                   "lexical-ranks"))
        if not parts:
            return spark.createDataFrame([], schema)
        out = parts[0]
        for part in parts[1:]:
            out = out.unionByName(part)
        return materialize(out, "lexical")
    finally:
        work.close()

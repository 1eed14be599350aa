"""Benchmark decontamination by Wu-Manber search over words.

A window is 13 consecutive words of a benchmark item (a shorter item is one
window).  All windows of one length form one Wu-Manber pattern set: the shift
table tells from the last two words under the cursor how far the cursor can
jump without passing an occurrence (12 words on text that shares no word pair
with any item); a zero shift selects the bucket of windows that end in those
two words, and direct comparison of the words confirms the occurrence.

The documents are scanned in place: no shuffle.  The benchmark reaches the
tasks in blocks of at most about ``block_bytes`` of text, so what is broadcast
at once is bounded however large the benchmark is.  With several blocks the
texts are read once for each and only the hits are written (by a hash of the
text: equal texts have equal hits); they are joined to the documents at the end,
so no document is rewritten for a block.

Defined cases: a null or word-less document has no words and no hits (one row
all the same); items with a null id or without words are left out; rows that
repeat an item id count as one item holding the windows of all of them;
repeated documents give one row each; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from funnelspark.llm.common import (Workspace, column_ddl, columns_of, materialize, text_bytes,
                                    unused)

WINDOW_WORDS = 13
#: Share of hit words from which a document counts as contaminated.
HIT_SHARE = (1, 20)
#: Benchmark text that is broadcast at once.
BLOCK_BYTES = 1 << 20

# Lower-cases A-Z, keeps 0-9, a-z and bytes from 0x80, turns all else into a space.
_WORD_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122
                    else 32 for c in range(256))


def words_of(text: str | None) -> list[bytes]:
    return text_bytes(text).translate(_WORD_BYTES).split()


class WuManber:
    """Multi-pattern search for word windows of one length."""

    def __init__(self, windows: dict[tuple[bytes, ...], set[str]], length: int):
        self.length = length
        self.block = block = min(2, length)
        self.far = length - block + 1
        self.shift: dict[tuple[bytes, ...], int] = {}
        self.buckets: dict[tuple[bytes, ...], dict[tuple[bytes, ...], set[str]]] = {}
        for window, items in windows.items():
            for end in range(block, length + 1):
                key, jump = window[end - block:end], length - end
                if self.shift.get(key, self.far) > jump:
                    self.shift[key] = jump
            self.buckets.setdefault(window[length - block:], {})[window] = items

    def find(self, words: list[bytes]) -> Iterator[tuple[int, int, set[str]]]:
        """(start, end, items) of every occurrence, by ascending end."""
        length, block, far = self.length, self.block, self.far
        shift, buckets, n = self.shift, self.buckets, len(words)
        end = length
        while end <= n:
            key = tuple(words[end - block:end])
            jump = shift.get(key, far)
            if jump:
                end += jump
                continue
            items = buckets[key].get(tuple(words[end - length:end]))
            if items is not None:
                yield end - length, end, items
            end += 1


def build_searchers(items: Iterable[tuple[str, str | None]]) -> list[WuManber]:
    """One searcher for each window length that the items have."""
    by_length: dict[int, dict[tuple[bytes, ...], set[str]]] = {}
    for item_id, text in items:
        words = words_of(text)
        size = min(WINDOW_WORDS, len(words))
        if not size:
            continue
        windows = by_length.setdefault(size, {})
        for i in range(len(words) - size + 1):
            windows.setdefault(tuple(words[i:i + size]), set()).add(item_id)
    return [WuManber(windows, size) for size, windows in sorted(by_length.items())]


def scan(words: list[bytes], searchers: list[WuManber]) -> tuple[list[tuple[int, int]], set[str]]:
    """Merged hit spans (in words) and the items found."""
    found, items = [], set()
    for searcher in searchers:
        for start, end, ids in searcher.find(words):
            found.append((start, end))
            items |= ids
    return merge_spans(found), items


def merge_spans(spans: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            if end > out[-1][1]:
                out[-1] = (out[-1][0], end)
        else:
            out.append((start, end))
    return out


def benchmark_blocks(benchmark: DataFrame, id_col: str, text_col: str,
                     block_bytes: int) -> tuple[int, Iterator[list[tuple[str, str]]]]:
    """How many blocks of about ``block_bytes`` the items make, and the blocks as (id text, text)."""
    items = benchmark.select(F.col(id_col).cast("string").alias("i"), F.col(text_col).alias("t")) \
        .where("i is not null and t is not null")
    total = items.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    n_blocks = -(-total // block_bytes) or 1

    def blocks():
        for block in range(n_blocks):
            part = items.where(F.pmod(F.xxhash64("i", "t"), F.lit(n_blocks)) == block)
            yield [(r.i, r.t) for r in part.toLocalIterator()]
    return n_blocks, blocks()


_HIT_FIELDS = (("n_words", pa.int64(), "long"), ("hit_starts", pa.list_(pa.int32()), "array<int>"),
               ("hit_ends", pa.list_(pa.int32()), "array<int>"),
               ("hit_items", pa.list_(pa.string()), "array<string>"))


def find_contamination(docs: DataFrame, benchmark: DataFrame, text_col: str = "text",
                       item_col: str = "item_id", item_text_col: str = "text",
                       block_bytes: int = BLOCK_BYTES, prefix: str = "") -> DataFrame:
    """``docs`` with every column kept, plus ``n_words``, the merged hit spans
    (``hit_starts``, ``hit_ends``, in words) and ``hit_items`` (sorted ids), each name with
    ``prefix`` before it.  Columns of those names in ``docs`` are replaced."""
    spark = docs.sparkSession
    fields = [(prefix + n, t, sql) for n, t, sql in _HIT_FIELDS]
    out = docs.drop(*[n for n, _, _ in fields])
    schema = ", ".join(column_ddl(out) + [f"`{n}` {sql}" for n, _, sql in fields])
    n_blocks, blocks = benchmark_blocks(benchmark, item_col, item_text_col, block_bytes)
    if n_blocks == 1:
        return out.mapInArrow(_scanner(spark.sparkContext.broadcast(next(blocks)), text_col, fields), schema)
    keys = [unused(out, n) for n in ("_text_1", "_text_2")]
    by_text = out.withColumns(dict(zip(keys, _text_hash(text_col))))
    hits = _hits_of_blocks(out.select(F.col(f"`{text_col}`").alias("text")), blocks)
    names = [unused(out, n) for n in ("_starts", "_ends", "_items")]
    joined = by_text.join(hits.toDF(*keys, *names), keys, "left").drop(*keys)
    return joined.mapInArrow(_merger(text_col, fields, names), schema)


def _text_hash(text_col: str) -> list:
    """128 bits for a text."""
    text = F.col(f"`{text_col}`")
    return [F.xxhash64(text), F.xxhash64(text, F.lit(1))]


def _hits_of_blocks(texts: DataFrame, blocks) -> DataFrame:
    """(h1, h2, starts, ends, items) of each different text with hits, of all blocks."""
    spark, work, found = texts.sparkSession, Workspace(texts.sparkSession), None
    hashes = [h.alias(n) for h, n in zip(_text_hash("text"), ("h1", "h2"))]
    try:
        for items in blocks:
            held = spark.sparkContext.broadcast(items)
            hits = work.save(texts.select("text", *hashes).mapInArrow(_hit_scanner(held), _HITS)
                             .dropDuplicates(["h1", "h2"]), "decontaminate-block")
            held.unpersist()
            found = hits if found is None else found.unionByName(hits)
        merged = found.groupBy("h1", "h2").agg(*[F.flatten(F.collect_list(c)).alias(c)
                                                 for c in ("starts", "ends", "items")])
        return materialize(merged, "decontaminate-hits")
    finally:
        work.close()


_HITS = "h1 long, h2 long, starts array<int>, ends array<int>, items array<string>"


def _hit_scanner(items):
    def run(batches):
        searchers = build_searchers(items.value)
        for batch in batches:
            rows = [[], [], [], []]
            for i, text in enumerate(batch.column("text").to_pylist()):
                spans, ids = scan(words_of(text), searchers)
                if spans:
                    for column, value in zip(rows, (i, [s for s, _ in spans], [e for _, e in spans], sorted(ids))):
                        column.append(value)
            take = pa.array(rows[0], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("h1").take(take), batch.column("h2").take(take), pa.array(rows[1], pa.list_(pa.int32())),
                 pa.array(rows[2], pa.list_(pa.int32())), pa.array(rows[3], pa.list_(pa.string()))],
                ["h1", "h2", "starts", "ends", "items"])
    return run


def _merger(text_col: str, fields, names: list[str]):
    """The hits of all blocks as the columns of ``find_contamination``."""
    def run(batches):
        for batch in batches:
            starts, ends, items = (batch.column(n).to_pylist() for n in names)
            spans = [merge_spans(zip(s or (), e or ())) for s, e in zip(starts, ends)]
            rows = ([len(words_of(t)) for t in batch.column(text_col).to_pylist()],
                    [[s for s, _ in x] for x in spans], [[e for _, e in x] for x in spans],
                    [sorted(set(x or ())) for x in items])
            new = {n: pa.array(v, t) for (n, t, _), v in zip(fields, rows)}
            cols = {n: batch.column(n) for n in batch.schema.names if n not in new and n not in names}
            yield pa.RecordBatch.from_pydict(cols | new)
    return run


def _scanner(items, text_col: str, fields):
    def run(batches):
        searchers = build_searchers(items.value)
        for batch in batches:
            rows = [[], [], [], []]
            for text in batch.column(text_col).to_pylist():
                words = words_of(text)
                spans, ids = scan(words, searchers)
                for column, value in zip(rows, (len(words), [s for s, _ in spans],
                                                [e for _, e in spans], sorted(ids))):
                    column.append(value)
            new = {n: pa.array(v, t) for (n, t, _), v in zip(fields, rows)}
            cols = {n: batch.column(n) for n in batch.schema.names if n not in new}
            yield pa.RecordBatch.from_pydict(cols | new)
    return run


def contaminated(n_hit, n_words):
    """The contamination rule as a column."""
    num, den = HIT_SHARE
    return (n_hit > 0) & (n_hit * den >= n_words * num)


def hit_words(prefix: str = ""):
    """Hit words of a row of ``find_contamination``."""
    total = lambda c: F.aggregate(F.col(prefix + c).cast("array<long>"),
                                  F.lit(0).cast("long"), lambda acc, x: acc + x)
    return total("hit_ends") - total("hit_starts")


def contamination_report(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id",
                         text_col: str = "text", **options) -> DataFrame:
    """One row per document row: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    found = find_contamination(docs.select(F.col(id_col).alias("doc_id"),
                                           F.col(text_col).alias("text")),
                               benchmark, **options)
    return found.select(
        "doc_id", "n_words", hit_words().alias("n_hit"),
        F.size("hit_items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "hit_items"), 256).alias("items_sha256"),
    ).withColumn("contaminated", contaminated(F.col("n_hit"), F.col("n_words")))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``docs`` without its contaminated rows, columns as they were."""
    prefix = "_"
    while {(prefix + n).lower() for n, _, _ in _HIT_FIELDS} & {c.lower() for c in docs.columns}:
        prefix += "_"
    found = find_contamination(docs, benchmark, prefix=prefix, **options)
    return found.where(~contaminated(hit_words(prefix), F.col(prefix + "n_words"))) \
        .select(*columns_of(docs))

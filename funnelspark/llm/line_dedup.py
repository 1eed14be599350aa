"""Line deduplication: sorted line hashes in, compressed keep bitmaps out.

A text is split at ``\\n``.  A line's key is the line without white space at its ends,
A-Z lower-cased, and is carried as a 128-bit hash
(equal hashes count as equal keys).  Each row keeps one bit for each of its
lines; texts are neither shuffled by line nor rewritten.

* *Hashes.*  One row for each distinct key of a row (key, document, first position, further
  positions) is written to the shared folder; keys shorter than ``min_chars`` aren't.
* *Range partition with secondary sort.*  The rows are range-partitioned and sorted by
  (key, document, position).  The bounds are taken over the whole order, so a key that a
  third of all documents hold is spread over as many partitions as its rows need.
* *Stream.*  Each partition is read once in order.  A key's rows are held until
  ``min_docs`` documents are seen; from then on every occurrence is marked as it passes
  (``keep="none"``: all of them, ``keep="first"``: all but the first by document and
  position).  Only keys at the two edges of a partition can go on in another one: what is
  undecided there (fewer than ``min_docs`` documents, ``HELD_ROWS`` rows at most before
  they are passed on) is settled by a count over these edge rows alone.
* *Bitmaps.*  The marks of a row are gathered by (document, hash of the text) and become a
  zlib-compressed bitmap, bit i (most significant first) standing for line i.

Defined cases: a null or empty text is one empty line; rows with one id are one document
when documents are counted, and a null id is an id like any other; rows that differ in text
have bitmaps of their own, equal rows share one; an empty table gives no rows; other columns
are ignored by ``line_bitmaps`` and kept by ``keep_lines``.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from funnelspark.llm.common import Workspace, column_ddl, materialize, text_bytes, unused

MIN_DOCS = 10
MIN_CHARS = 1
#: Rows of an undecided key that a partition holds.
HELD_ROWS = 1024

_SPACE = b" \t\n\x0b\x0c\r"
_ORDER = ("h1", "h2", "doc", "th", "pos", "seq")
_DROP, _OPEN, _KNOWN = 0, 1, 2


def line_key(line: bytes) -> bytes:
    return line.strip(_SPACE).lower()


def line_keys(text: str | None) -> list[bytes]:
    return [line_key(line) for line in text_bytes(text).split(b"\n")]


def _long_enough(key: bytes, min_chars: int) -> bool:
    return len(key) >= min_chars and (min_chars <= 1 or len(key.decode("utf-8")) >= min_chars)


def pack_bits(n_lines: int, dropped) -> bytes:
    """Keep bitmap of a document without the lines ``dropped``."""
    bits = np.ones(n_lines, np.uint8)
    bits[np.asarray(dropped, np.int64)] = 0
    return zlib.compress(np.packbits(bits).tobytes())


def kept_lines(text: str | None, bitmap: bytes) -> bytes:
    """The lines that a bitmap keeps, joined by ``\\n``."""
    lines = text_bytes(text).split(b"\n")
    bits = np.unpackbits(np.frombuffer(zlib.decompress(bitmap), np.uint8), count=len(lines))
    return b"\n".join([lines[i] for i in np.flatnonzero(bits).tolist()])


# ----------------------------------------------------------------- hashes
def _line_rows(docs: DataFrame, min_chars: int) -> DataFrame:
    """(doc, th, h1, h2, pos, more, seq) of each distinct key of each row, and a row with
    ``n_lines`` and a null key for each row itself."""
    id_type = docs.schema["doc"].dataType
    arrow_id = to_arrow_type(id_type)

    def run(batches):
        seq = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 36
        for batch in batches:
            for rows in _slices(batch):
                owner, h1, h2, pos, more, n_lines = [], [], [], [], [], []
                for i, text in enumerate(rows.column("text").to_pylist()):
                    places: dict[bytes, list[int]] = {}
                    keys = line_keys(text)
                    for p, key in enumerate(keys):
                        if _long_enough(key, min_chars):
                            places.setdefault(key, []).append(p)
                    for key, at in places.items():
                        digest = np.frombuffer(xxhash.xxh3_128_digest(key), np.int64)
                        h1.append(digest[0])
                        h2.append(digest[1])
                        pos.append(at[0])
                        more.append(at[1:] or None)
                    owner += [i] * (len(places) + 1)
                    n_lines += [None] * len(places) + [len(keys)]
                    for column in (h1, h2, pos, more):
                        column.append(None)
                take = pa.array(owner, pa.int64())
                yield pa.RecordBatch.from_pydict({
                    "doc": rows.column("doc").take(take).cast(arrow_id),
                    "th": rows.column("th").take(take),
                    "h1": pa.array(h1, pa.int64()), "h2": pa.array(h2, pa.int64()),
                    "pos": pa.array(pos, pa.int32()), "more": pa.array(more, pa.list_(pa.int32())),
                    "seq": pa.array(np.arange(seq, seq + len(owner))),
                    "n_lines": pa.array(n_lines, pa.int64())})
                seq += len(owner)
    return docs.mapInArrow(run, f"doc {id_type.simpleString()}, th long, h1 long, h2 long, pos int, "
                                "more array<int>, seq long, n_lines long")


def _slices(batch: pa.RecordBatch, most: int = 8 << 20):
    """Parts of a batch with about ``most`` bytes of text (one row at least)."""
    sizes = np.array([len(t) if t else 0 for t in batch.column("text").to_pylist()], np.int64)
    start = 0
    while start < batch.num_rows:
        end = start + max(1, int(np.searchsorted(np.cumsum(sizes[start:]), most, side="right")))
        yield batch.slice(start, end - start)
        start = end


# ----------------------------------------------------------------- stream
class _Run:
    """The rows of one key as they pass."""

    def __init__(self, key, first_of_partition: bool):
        self.key, self.edge = key, first_of_partition
        self.docs, self.doc, self.th = 0, None, None
        self.held: list[tuple] = []
        self.common = self.passed_on = self.started = False


class _Stream:
    def __init__(self, min_docs: int, keep_first: bool):
        self.min_docs, self.keep_first = min_docs, keep_first
        self.run: _Run | None = None
        self.out: list[tuple] = []

    def add(self, key, rows, first_of_partition: bool) -> None:
        """``rows``: (doc, th, pos, more) of one key, in order."""
        if self.run is None or self.run.key != key:
            self.close(last=False)
            self.run = _Run(key, first_of_partition)
        run = self.run
        for doc, th, pos, more in rows:
            if run.started and doc == run.doc and th == run.th:
                continue  # an equal row
            if not run.started or doc != run.doc:
                run.docs += 1
            run.doc, run.th = doc, th
            first = not run.started
            run.started = True
            if not run.common:
                run.held.append((doc, th, pos, more, first))
                if run.docs >= self.min_docs:
                    run.common = True
                    self._flush(run)
                elif len(run.held) > HELD_ROWS:
                    self._pass_on(run)
            else:
                self._drop(run, doc, th, pos, more, first)

    def _flush(self, run: _Run) -> None:
        for row in run.held:
            self._drop(run, *row)
        run.held = []
        if run.edge or run.passed_on:
            self.out.append((_KNOWN, None, None, None, *run.key))

    def _pass_on(self, run: _Run) -> None:
        for doc, th, pos, more, _ in run.held:
            self.out.append((_OPEN, doc, th, [pos, *(more or ())], *run.key))
        run.held, run.passed_on = [], True

    def _drop(self, run: _Run, doc, th, pos, more, first: bool) -> None:
        if self.keep_first and first:
            if run.edge:  # the key may begin in the partition before
                self.out.append((_OPEN, doc, th, [pos, *(more or ())], *run.key))
                return
            run.held_first = (doc, th, pos, more)
            if more:
                self.out.append((_DROP, doc, th, list(more), *run.key))
            return
        self.out.append((_DROP, doc, th, [pos, *(more or ())], *run.key))

    def close(self, last: bool) -> None:
        run, self.run = self.run, None
        if run is None:
            return
        if not run.common and (run.edge or last or run.passed_on):
            self._pass_on(run)
        elif run.common and last and not run.edge and not run.passed_on:
            self.out.append((_KNOWN, None, None, None, *run.key))
            if self.keep_first:  # the next partition must know where the key begins
                doc, th, pos, _ = run.held_first
                self.out.append((_OPEN, doc, th, [pos], *run.key))


def _marks(lines: DataFrame, min_docs: int, keep_first: bool) -> DataFrame:
    """(kind, doc, th, places, h1, h2): marks, undecided rows of edge keys, edge keys known
    to be common."""
    id_type = lines.schema["doc"].dataType
    arrow_id = to_arrow_type(id_type)

    def frame(rows):
        columns = list(zip(*rows))
        kinds = (pa.int32(), arrow_id, pa.int64(), pa.list_(pa.int32()), pa.int64(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)],
                                          ["kind", "doc", "th", "places", "h1", "h2"])

    def run(batches):
        stream, opened = _Stream(min_docs, keep_first), False
        lone = min_docs > 1  # a key with one row, away from the edges, loses nothing
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            h1, h2 = (batch.column(c).to_numpy() for c in ("h1", "h2"))
            new = np.ones(n + 1, bool)
            new[1:n] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
            starts = np.flatnonzero(new)
            wanted = np.ones(len(starts) - 1, bool)
            if lone:
                wanted = np.diff(starts) > 1
                wanted[[0, -1]] = True
            for j in np.flatnonzero(wanted).tolist():
                s, e = int(starts[j]), int(starts[j + 1])
                part = [batch.column(c).slice(s, e - s).to_pylist() for c in ("doc", "th", "pos", "more")]
                key = (int(h1[s]), int(h2[s]))
                # rows between two wanted runs are runs of their own and end the one before
                stream.add(key, zip(*part), not opened)
                opened = True
                if j + 1 < len(wanted):
                    stream.close(last=False)
            if stream.out:
                yield frame(stream.out)
                stream.out = []
        stream.close(last=True)
        if stream.out:
            yield frame(stream.out)
    return lines.mapInArrow(
        run, f"kind int, doc {id_type.simpleString()}, th long, places array<int>, h1 long, h2 long")


def _settled(marks: DataFrame, min_docs: int, keep_first: bool) -> DataFrame:
    """(doc, th, places) of the undecided rows of edge keys that turn out common.  There are at
    most two such keys for each partition, with ``HELD_ROWS`` rows or so in each."""
    rows = marks.where(F.col("kind") == _OPEN)
    known = marks.where(F.col("kind") == _KNOWN).select("h1", "h2", F.lit(True).alias("known"))
    key = ["h1", "h2"]
    counts = rows.groupBy(*key).agg(
        F.count_distinct(F.struct("doc")).alias("n"),
        F.min(F.struct("doc", "th")).alias("first"))
    common = counts.join(known.distinct(), key, "left") \
        .where(F.coalesce("known", F.lit(False)) | (F.col("n") >= min_docs))
    found = rows.join(common.select(*key, "first"), key)
    if keep_first:
        here = F.struct("doc", "th").eqNullSafe(F.col("first"))
        found = found.withColumn("places", F.when(here, F.slice("places", 2, F.size("places")))
                                 .otherwise(F.col("places"))).where(F.size("places") > 0)
    return found.select("doc", "th", "places")


def line_bitmaps(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *,
                 min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS, keep: str = "none",
                 work: Workspace | None = None) -> DataFrame:
    """``id_col``, text_hash (xxhash64), n_lines, n_dropped, keep (compressed bitmap): one row
    for each different (id, text).

    Lines whose key has at least ``min_chars`` code points and is found in at least
    ``min_docs`` documents go: everywhere, or (``keep="first"``) but for their first
    occurrence by (id, hash of the text, position)."""
    if keep not in ("none", "first") or min_docs < 1 or min_chars < 0:
        raise ValueError(f"keep={keep!r}, min_docs={min_docs}, min_chars={min_chars}")
    work = work or Workspace(docs.sparkSession)
    given = docs.select(F.col(f"`{id_col}`").alias("doc"), F.col(f"`{text_col}`").alias("text"),
                        F.xxhash64(F.col(f"`{text_col}`")).alias("th"))
    rows = work.save(_line_rows(given, min_chars), "line-hashes")
    lines = rows.where("h1 is not null").drop("n_lines") \
        .repartitionByRange(*_ORDER).sortWithinPartitions(*_ORDER)
    first = keep == "first"
    marks = work.save(_marks(lines, min_docs, first), "line-marks")
    none = F.lit(None).cast("long")
    every = rows.where("n_lines is not null").select("doc", "th", "n_lines", F.lit(None).cast("array<int>")
                                                     .alias("places")) \
        .unionByName(marks.where(F.col("kind") == _DROP).select("doc", "th", none.alias("n_lines"), "places")) \
        .unionByName(_settled(marks, min_docs, first).select("doc", "th", none.alias("n_lines"), "places"))
    by_row = every.groupBy("doc", "th").agg(
        F.max("n_lines").alias("n_lines"),
        F.array_distinct(F.flatten(F.collect_list("places"))).alias("dropped"))

    def run(batches):
        for batch in batches:
            dropped = batch.column("dropped").to_pylist()
            maps = [pack_bits(n, d) for n, d in zip(batch.column("n_lines").to_pylist(), dropped)]
            yield pa.RecordBatch.from_pydict({
                "doc": batch.column("doc"), "th": batch.column("th"), "n_lines": batch.column("n_lines"),
                "n_dropped": pa.array([len(d) for d in dropped], pa.int64()),
                "keep": pa.array(maps, pa.binary())})
    kind = given.schema["doc"].dataType.simpleString()
    return by_row.mapInArrow(run, f"doc {kind}, th long, n_lines long, n_dropped long, keep binary") \
        .toDF(id_col, "text_hash", "n_lines", "n_dropped", "keep")


def _with_bitmaps(docs: DataFrame, bitmaps: DataFrame, id_col: str, text_col: str, names: list[str]
                  ) -> DataFrame:
    """``docs`` with n_lines, n_dropped and keep of each row, under ``names``."""
    b_id, b_hash = unused(docs, "_b_id"), unused(docs, "_b_hash")
    b = bitmaps.toDF(b_id, b_hash, *names)
    return docs.join(b, (F.xxhash64(docs[f"`{text_col}`"]) == b[b_hash])
                     & docs[f"`{id_col}`"].eqNullSafe(b[b_id])).drop(b_id, b_hash)


def keep_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs``, every row and column, with the texts that the bitmaps leave (null stays null)."""
    names = [unused(docs, n) for n in ("_b_lines", "_b_dropped", "_b_keep")]
    work = Workspace(docs.sparkSession)

    def run(batches):
        for batch in batches:
            texts, maps = (batch.column(c).to_pylist() for c in (text_col, names[2]))
            kept = [None if t is None else kept_lines(t, m).decode("utf-8") for t, m in zip(texts, maps)]
            i = batch.schema.get_field_index(text_col)
            yield batch.set_column(i, text_col, pa.array(kept, pa.string())).drop_columns(names)
    try:
        bitmaps = line_bitmaps(docs, id_col, text_col, work=work, **options)
        joined = _with_bitmaps(docs, bitmaps, id_col, text_col, names)
        return materialize(joined.mapInArrow(run, ", ".join(column_ddl(docs))), "kept-lines")
    finally:
        work.close()


def line_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept_sha256 of every row."""
    given = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    work = Workspace(docs.sparkSession)
    kind = given.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            digests = [hashlib.sha256(kept_lines(t, m)).hexdigest() for t, m in
                       zip(batch.column("text").to_pylist(), batch.column("keep").to_pylist())]
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"), "n_lines": batch.column("n_lines"),
                "n_dropped": batch.column("n_dropped"), "kept_sha256": pa.array(digests, pa.string())})
    try:
        bitmaps = line_bitmaps(given, "doc_id", "text", work=work, **options)
        joined = _with_bitmaps(given, bitmaps, "doc_id", "text", ["n_lines", "n_dropped", "keep"])
        return materialize(joined.mapInArrow(
            run, f"doc_id {kind}, n_lines long, n_dropped long, kept_sha256 string"), "line-report")
    finally:
        work.close()

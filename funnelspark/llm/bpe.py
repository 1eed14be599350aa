"""Byte-level BPE encoding and decoding through a global distinct-word shuffle.

1. *Explode.*  Every text is cut into pre-tokens.  A run of documents (a chunk,
   bounded by ``chunk_tokens``) numbers its distinct pre-tokens; each document
   keeps its positions as the list of those numbers.  A chunk also gives, for
   each hash bucket of words, its distinct words in that bucket.
2. *Encode once.*  The words are shuffled by bucket, so equal words of all
   chunks meet; each distinct word is merged by the ranks once.
3. *Join back.*  The ids return to the chunks that hold the words, and every
   document is reassembled by position.  The position lists are written
   bucketed by chunk, so only the word ids move.
4. *Decode.*  Ids are joined with the token-byte table (one row a rank; its
   size is that of the vocabulary file) and the bytes concatenated.

Only distinct words of a chunk are shuffled: a word that makes up a third of
all pre-tokens is one entry for each chunk.

Defined cases: a null text counts as empty (no ids); repeated documents and
null ids give one row for each input row; a text longer than ``chunk_tokens``
is a chunk of its own; unknown ids are an error when decoding; other columns
are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections import OrderedDict

import numpy as np
import pyarrow as pa
import regex
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from funnelspark.llm.common import map_batches
from funnelspark.session import scratch_path


#: Pre-tokens after which a chunk is closed.
CHUNK_TOKENS = 6_000_000


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes -> rank, from a file of ``base64 rank`` lines."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class WordEncoder:
    """Merges one pre-token at a time: repeatedly joins the adjacent pair of lowest rank."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks

    def encode(self, word: bytes) -> list[int]:
        ranks = self.ranks
        whole = ranks.get(word)
        if whole is not None:
            return [whole]
        if len(word) > 256:
            return self._encode_long(word)
        parts = [word[i:i + 1] for i in range(len(word))]
        none = len(ranks) + 1
        pair = [ranks.get(a + b, none) for a, b in zip(parts, parts[1:])]
        while pair:
            low = min(pair)
            if low == none:
                break
            i = pair.index(low)
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
            del pair[i]
            if i < len(pair):
                pair[i] = ranks.get(parts[i] + parts[i + 1], none)
            if i:
                pair[i - 1] = ranks.get(parts[i - 1] + parts[i], none)
        return [ranks[p] for p in parts]

    def _encode_long(self, word: bytes) -> list[int]:
        """The same merges with a heap over linked parts: n log n for very long words."""
        import heapq
        ranks, n = self.ranks, len(word)
        nxt, prev = list(range(1, n + 1)), list(range(-1, n - 1))
        end = list(range(1, n + 1))
        alive = bytearray(b"\1" * n)
        heap = []

        def push(i):
            j = nxt[i]
            if j < n:
                rank = ranks.get(word[i:end[j]])
                if rank is not None:
                    heapq.heappush(heap, (rank, i, end[j]))
        for i in range(n - 1):
            push(i)
        while heap:
            rank, i, stop = heapq.heappop(heap)
            j = nxt[i] if alive[i] else n
            if j >= n or end[j] != stop or not alive[j] or ranks.get(word[i:end[j]]) != rank:
                continue
            alive[j] = 0
            end[i], nxt[i] = end[j], nxt[j]
            if nxt[j] < n:
                prev[nxt[j]] = i
            push(i)
            if prev[i] >= 0:
                push(prev[i])
        out, i = [], 0
        while i < n:
            out.append(ranks[word[i:end[i]]])
            i = nxt[i]
        return out


# ------------------------------------------------------------- 1. explode


def pack_words(words: list[bytes]) -> bytes:
    sizes = np.fromiter(map(len, words), np.uint32, len(words))
    return zstandard.ZstdCompressor(level=3).compress(
        np.uint32(len(words)).tobytes() + sizes.tobytes() + b"".join(words))


def unpack_words(blob: bytes) -> list[bytes]:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    n = int(np.frombuffer(raw, np.uint32, 1)[0])
    ends = np.cumsum(np.frombuffer(raw, np.uint32, n, 4), dtype=np.int64).tolist()
    data, out, start = raw[4 + 4 * n:], [], 0
    for end in ends:
        out.append(data[start:end])
        start = end
    return out


def pack_ids(ids: list[list[int]]) -> bytes:
    sizes = np.fromiter(map(len, ids), np.uint32, len(ids))
    flat = np.array([i for word in ids for i in word], np.uint32)
    return zstandard.ZstdCompressor(level=3).compress(
        np.uint32(len(ids)).tobytes() + sizes.tobytes() + flat.tobytes())


def unpack_ids(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(sizes, flat ids)."""
    raw = zstandard.ZstdDecompressor().decompress(blob)
    n = int(np.frombuffer(raw, np.uint32, 1)[0])
    return np.frombuffer(raw, np.uint32, n, 4), np.frombuffer(raw, np.uint32, -1, 4 + 4 * n)


def pack_numbers(numbers: np.ndarray) -> bytes:
    small = len(numbers) == 0 or numbers.max() < 65536
    kind = np.uint16 if small else np.uint32
    return (b"\0" if small else b"\1") + zstandard.ZstdCompressor(level=3).compress(
        numbers.astype(kind).tobytes())


def unpack_numbers(blob: bytes) -> np.ndarray:
    raw = zstandard.ZstdDecompressor().decompress(blob[1:])
    return np.frombuffer(raw, np.uint16 if blob[:1] == b"\0" else np.uint32).astype(np.int64)


_CHUNKS = ("chunk string, seq int, doc_id {id_type}, positions binary, "
           "bucket int, words binary")


def exploder(pattern: str, n_buckets: int, chunk_tokens: int, id_type: pa.DataType):
    """Documents to position lists and, for each chunk and bucket, the distinct words."""
    fields = [("chunk", pa.string()), ("seq", pa.int32()), ("doc_id", id_type),
              ("positions", pa.binary()), ("bucket", pa.int32()), ("words", pa.binary())]

    def rows(columns):
        return pa.RecordBatch.from_pydict(
            {n: pa.array(v, t) for (n, t), v in zip(fields, columns)})

    def words_of_chunk(chunk, numbers):
        # A word's number in its chunk follows (bucket, order of first use), so
        # that the ids that come back need no number beside them.
        by_bucket: list[list[str]] = [[] for _ in range(n_buckets)]
        for word in numbers:
            by_bucket[zlib.crc32(word.encode("utf-8")) % n_buckets].append(word)
        renumber = np.empty(len(numbers), np.uint32)
        n, out = 0, [[], [], [], [], [], []]
        for bucket, words in enumerate(by_bucket):
            if not words:
                continue
            words.sort()
            renumber[[numbers[w] for w in words]] = np.arange(n, n + len(words), dtype=np.uint32)
            n += len(words)
            for column, value in zip(out, (chunk, None, None, None, bucket,
                                           pack_words([w.encode("utf-8") for w in words]))):
                column.append(value)
        return renumber, out

    def close(docs, numbers):
        chunk = uuid.uuid4().hex
        renumber, words = words_of_chunk(chunk, numbers)
        for start in range(0, len(docs), 1000):
            part = docs[start:start + 1000]
            yield rows([[chunk] * len(part), list(range(start, start + len(part))),
                        [d for d, _ in part],
                        [pack_numbers(renumber[p]) for _, p in part],
                        [None] * len(part), [None] * len(part)])
        if words[0]:
            yield rows(words)

    def run(batches):
        find = regex.compile(pattern).findall
        docs, numbers, n_tokens = [], {}, 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = find(text or "")
                if docs and n_tokens + len(found) > chunk_tokens:
                    yield from close(docs, numbers)
                    docs, numbers, n_tokens = [], {}, 0
                number = numbers.setdefault
                docs.append((doc_id, np.array([number(w, len(numbers)) for w in found], np.uint32)))
                n_tokens += len(found)
        if docs:
            yield from close(docs, numbers)
    return run


# -------------------------------------------------------- 2. encode once

def bucket_encoder(ranks_file: str):
    """Word lists of one bucket after the other (rows sorted by bucket): each
    distinct word of a bucket is merged once."""
    def run(batches):
        encode = WordEncoder(load_ranks(ranks_file)).encode
        bucket, known = None, {}
        for batch in batches:
            out = []
            for b, blob in zip(batch.column("bucket").to_pylist(),
                               batch.column("words").to_pylist()):
                if b != bucket:
                    bucket, known = b, {}
                ids = []
                for word in unpack_words(blob):
                    got = known.get(word)
                    if got is None:
                        got = known[word] = encode(word)
                    ids.append(got)
                out.append(pack_ids(ids))
            yield pa.RecordBatch.from_pydict({
                "chunk": batch.column("chunk"), "bucket": batch.column("bucket"),
                "ids": pa.array(out, pa.binary())})
    return run


# --------------------------------------------------- 3. and 4. join, decode

def token_table(ranks_file: str) -> dict[int, bytes]:
    return {rank: token for token, rank in load_ranks(ranks_file).items()}


def reassembler(fields: list[tuple[str, pa.DataType]], make):
    """One chunk: its position lists joined with the ids of its words.  ``make``
    turns the ids of a batch of documents into the output columns."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        right = right.sort_by("bucket")
        parts = [unpack_ids(b) for b in right.column("ids").to_pylist()]
        sizes = np.concatenate([p[0] for p in parts]).astype(np.int64) if parts else np.zeros(0, np.int64)
        flat = np.concatenate([p[1] for p in parts]) if parts else np.zeros(0, np.uint32)
        starts = np.concatenate([[0], np.cumsum(sizes)])[:-1]
        columns: dict[str, list] = {n: [] for n, _ in fields}
        for doc_id, blob in zip(left.column("doc_id").to_pylist(),
                                left.column("positions").to_pylist()):
            numbers = unpack_numbers(blob)
            n = sizes[numbers]
            total = int(n.sum())
            offset = np.repeat(starts[numbers] - (np.cumsum(n) - n), n)
            row = make(doc_id, flat[offset + np.arange(total)])
            for name in columns:
                columns[name].append(row[name])
        return pa.table({n: pa.array(columns[n], t) for n, t in fields})
    return run


def encode_chunks(docs: DataFrame, ranks_file: str, pattern: str, id_col: str, text_col: str,
                  chunk_tokens: int) -> tuple[DataFrame, DataFrame, str, pa.DataType]:
    """(position lists by chunk, word ids by chunk, id type): steps 1 and 2."""
    from pyspark.sql.pandas.types import to_arrow_type
    spark = docs.sparkSession
    given = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    id_type = given.schema["doc_id"].dataType
    n_buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    exploded = given.mapInArrow(
        exploder(pattern, n_buckets, chunk_tokens, to_arrow_type(id_type)),
        _CHUNKS.format(id_type=id_type.simpleString()))
    name = f"bpe_chunks_{uuid.uuid4().hex}"
    exploded.write.format("parquet").bucketBy(n_buckets, "chunk") \
        .option("path", scratch_path(spark, "bpe-chunks")).saveAsTable(name)
    stored = spark.table(name)
    words = stored.where("bucket is not null").select("chunk", "bucket", "words") \
        .repartition(n_buckets, "bucket").sortWithinPartitions("bucket")
    ids = words.mapInArrow(bucket_encoder(ranks_file), "chunk string, bucket int, ids binary")
    return stored.where("seq is not null").select("chunk", "seq", "doc_id", "positions"), ids, \
        id_type.simpleString(), to_arrow_type(id_type)


def _joined(docs, ranks_file, pattern, id_col, text_col, chunk_tokens, fields, make, schema):
    lists, ids, id_sql, id_type = encode_chunks(docs, ranks_file, pattern, id_col, text_col,
                                                chunk_tokens)
    fields = [("doc_id", id_type), *fields]
    return lists.groupBy("chunk").cogroup(ids.groupBy("chunk")).applyInArrow(
        reassembler(fields, make), f"doc_id {id_sql}, {schema}")


def encode(docs: DataFrame, ranks_file: str, pattern: str, id_col: str = "doc_id",
           text_col: str = "text", chunk_tokens: int = CHUNK_TOKENS) -> DataFrame:
    """One row per document row: doc_id, ids array<int>."""
    return _joined(docs, ranks_file, pattern, id_col, text_col, chunk_tokens,
                   [("ids", pa.list_(pa.int32()))],
                   lambda doc_id, ids: {"doc_id": doc_id, "ids": ids.astype(np.int32)},
                   "ids array<int>")


def decode(encoded: DataFrame, ranks_file: str, ids_col: str = "ids",
           bytes_col: str = "decoded") -> DataFrame:
    """``encoded`` plus the bytes of its ids (null for null ids)."""
    kept = encoded.drop(bytes_col)
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema]
                       + [f"`{bytes_col}` binary"])
    held: dict[str, dict] = {}

    def run(batch):
        if "table" not in held:
            held["table"] = token_table(ranks_file)
        of = held["table"].__getitem__
        out = [None if ids is None else b"".join(map(of, ids))
               for ids in batch.column(ids_col).to_pylist()]
        return pa.RecordBatch.from_pydict(
            {c: batch.column(c) for c in batch.schema.names} | {bytes_col: pa.array(out, pa.binary())})
    return map_batches(kept, run, schema)


class _Digests:
    """Digest columns of a document's ids; the token table is loaded once a worker."""
    tables: OrderedDict = OrderedDict()

    def __init__(self, ranks_file: str):
        self.ranks_file = ranks_file

    def __call__(self, doc_id, ids: np.ndarray) -> dict:
        got = _Digests.tables.get(self.ranks_file)
        if got is None:
            table = token_table(self.ranks_file)
            got = _Digests.tables[self.ranks_file] = (table, {i: str(i) for i in table})
        ids = ids.tolist()
        text = ",".join([got[1][i] for i in ids])
        raw = b"".join([got[0][i] for i in ids])
        return {"doc_id": doc_id, "n_tokens": len(ids),
                "ids_sha256": hashlib.sha256(text.encode()).hexdigest(),
                "decoded_sha256": hashlib.sha256(raw).hexdigest()}


def round_trip_digests(docs: DataFrame, ranks_file: str, pattern: str, id_col: str = "doc_id",
                       text_col: str = "text", chunk_tokens: int = CHUNK_TOKENS) -> DataFrame:
    """One row per document row: doc_id, n_tokens, ids_sha256, decoded_sha256;
    the digests are taken where the document is reassembled and decoded, so the
    ids themselves are not moved again."""
    return _joined(docs, ranks_file, pattern, id_col, text_col, chunk_tokens,
                   [("n_tokens", pa.int64()), ("ids_sha256", pa.string()),
                    ("decoded_sha256", pa.string())],
                   _Digests(ranks_file),
                   "n_tokens long, ids_sha256 string, decoded_sha256 string")

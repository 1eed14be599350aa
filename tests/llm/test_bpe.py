import hashlib

import public_tokenizers as tokenizers
import pytest

from funnelspark.llm import bpe, queries

from .helpers import DOCS, RANKS, SF_SMALL, reference_encoding

TEXTS = ["", "a", "Hello, world's they'll  \n\n x\t", "é日本語 😀 ß", " " * 50, "\x00\x1c\x85\xa0 x",
         "z" * 3000, "ab" * 700 + "'re", "12345 ６７ ½", "the the the", "  ​ á"]


def expected(text, encoding):
    ids = encoding.encode_ordinary(text or "")
    return (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
            hashlib.sha256((text or "").encode()).hexdigest())


@pytest.mark.parametrize("chunk_tokens", [5, 6_000_000])
def test_ids_equal_the_library(spark, chunk_tokens):
    encoding = reference_encoding()
    rows = list(enumerate([*TEXTS, None])) + [(None, "a b"), (1, "a"), (1, "b")]
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows],
                                 "doc_id long, text string, words string, chunk int").repartition(3)
    got = bpe.round_trip_digests(docs, RANKS, tokenizers.PATTERN, chunk_tokens=chunk_tokens).collect()
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(map(tuple, got), key=key) == sorted(
        ((i, *expected(t, encoding)) for i, t in rows), key=key)


def test_encode_then_decode_gives_the_bytes(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), DOCS)
    encoded = bpe.encode(docs, RANKS, tokenizers.PATTERN)
    got = {r.doc_id: (r.ids, bytes(r.decoded)) for r in bpe.decode(encoded, RANKS).collect()}
    encoding = reference_encoding()
    assert got == {i: (encoding.encode_ordinary(t), t.encode()) for i, t in enumerate(TEXTS)}


def test_empty_table_and_null_ids(spark):
    none = spark.createDataFrame([], DOCS)
    assert bpe.round_trip_digests(none, RANKS, tokenizers.PATTERN).count() == 0
    ids = spark.createDataFrame([(1, None), (2, [])], "doc_id long, ids array<int>")
    assert {r.doc_id: r.decoded for r in bpe.decode(ids, RANKS).collect()} == {1: None, 2: b""}


def test_query_equals_the_library_on_whole_documents(spark):
    encoding = reference_encoding()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    got = queries.QUERIES["op3_byte_bpe"](spark, SF_SMALL).collect()
    assert {r.doc_id: tuple(r)[1:] for r in got} == {d: expected(t, encoding) for d, t in texts.items()}


def test_long_words_merge_as_short_ones_do():
    ranks = bpe.load_ranks(RANKS)
    encoder = bpe.WordEncoder(ranks)
    for word in (b"internationalisation" * 3, b"aaaaaaaaaaaaaaaaaaaa", "ééééßß日本".encode() * 4):
        assert encoder._encode_long(word) == encoder.encode(word)

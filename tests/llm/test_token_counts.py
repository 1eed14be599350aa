import random

import public_tokenizers as tokenizers

from funnelspark.llm import queries, token_counts

from .helpers import DOCS, RANKS, SF_SMALL, reference_encoding

PARTS = ["the ", "  ", "\n", "'s", "'", "re", "ll", " ", "a", "Ab", "12", "é", "!!", "ß ", "xxxxx", "\t",
         "日本", "😀", " 'll"]


def test_edits_equal_counting_again():
    rng, encoding = random.Random(3), reference_encoding()
    counter = token_counts.Counter(RANKS, tokenizers.PATTERN)
    make = lambda sizes: "".join(rng.choice(PARTS) for _ in range(rng.choice(sizes)))
    for _ in range(600):
        text = make([0, 1, 5, 50, 600])
        doc = token_counts.Document(text, counter)
        assert doc.tree.total() == len(encoding.encode_ordinary(text))
        edits = [(rng.randint(-2, len(text) + 2), rng.randint(0, len(text) + 2), make([0, 1, 2, 100]))
                 for _ in range(rng.choice([1, 2, 6]))]
        for start, end, new in reversed(token_counts.pick_edits(edits, len(text))):
            text = text[:start] + new + text[end:]
            doc.edit(start, end, new)
            assert doc.text == text and doc.tree.total() == len(encoding.encode_ordinary(text))


def test_only_the_region_of_an_edit_is_counted_again():
    doc = token_counts.Document("plain words here " * 20_000, token_counts.Counter(RANKS, tokenizers.PATTERN))
    doc.edit(170_000, 170_010, "new")
    assert doc.reencoded < 3 * token_counts.LEAF_TOKENS * 4


def test_query_equals_counting_again(spark):
    encoding = reference_encoding()
    import regex
    find = regex.compile(token_counts.REDACTED)
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    got = queries.QUERIES["op8_token_counts"](spark, SF_SMALL).collect()
    assert len(got) == len(texts) and sum(r.n_edits for r in got) > 0
    for r in got:
        after = find.sub("[redacted]", texts[r.doc_id])
        assert (r.n_tokens, r.n_tokens_after, r.n_chars_after) == (
            len(encoding.encode_ordinary(texts[r.doc_id])), len(encoding.encode_ordinary(after)), len(after))


def test_edge_rows(spark):
    docs = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (3, "a b c", "x"), (3, "a b c", "x"),
                                  (None, "d", "x"), (4, "one two three", "x")],
                                 "doc_id long, text string, given string")
    edits = spark.createDataFrame(
        [(1, 0, 0, "new text"), (3, 1, 3, None), (3, 1, 3, None), (3, 2, 9, "overlaps"), (None, 0, 1, "x"),
         (4, None, 1, "x"), (4, 5, 99, ""), (9, 0, 0, "unknown")],
        "doc_id long, start int, end int, replacement string")
    encoding = reference_encoding()
    count = lambda t: len(encoding.encode_ordinary(t))
    got = sorted((r.doc_id or 0, r.n_tokens, r.n_edits, r.n_tokens_after) for r in
                 token_counts.edited_counts(docs, edits, RANKS, tokenizers.PATTERN).collect())
    assert got == [(0, 1, 0, 1), (1, 0, 1, count("new text")), (2, 0, 0, 0), (3, 3, 1, count("a c")),
                   (3, 3, 1, count("a c")), (4, 3, 1, count("one t"))]
    assert token_counts.edited_counts(docs.limit(0), edits, RANKS, tokenizers.PATTERN).count() == 0


def test_next_batch_applies_to_kept_trees(spark):
    encoding = reference_encoding()
    texts = {1: "one two, three's four " * 200, 2: "not touched by any edit " * 300, 3: "", 4: "short", None: "no id 12 " * 90}
    docs = spark.createDataFrame(list(texts.items()), DOCS)
    kept = token_counts.trees(docs, RANKS, tokenizers.PATTERN)
    sums = {r.doc_id: (r.n_tokens, sum(r.tokens), sum(r.chars)) for r in kept.collect()}
    assert sums == {d: (len(encoding.encode_ordinary(t)),) * 2 + (len(t),) for d, t in texts.items()}
    kind = "doc_id long, text string, edits array<struct<start:int,end:int,replacement:string>>"
    for step in ({1: [(100, 130, "a'll b")], 3: [(0, 0, "new text")], None: [(5, 9, "")]},
                 {1: [(90, 110, "x" * 40), (0, 3, "ONE")], 4: [(2, 2, " ")], 3: [(3, 8, "")]}):
        batch = spark.createDataFrame([(d, texts[d], e) for d, e in step.items()], kind)
        changed = token_counts.apply_edits(batch, kept, RANKS, tokenizers.PATTERN)
        rows = {r.doc_id: r for r in changed.collect()}
        assert rows.keys() == step.keys()
        for d, edits in step.items():
            for start, end, new in sorted(edits, reverse=True):
                texts[d] = texts[d][:start] + new + texts[d][end:]
            assert rows[d].text == texts[d] and sum(rows[d].chars) == len(texts[d])
            assert rows[d].n_tokens_after == sum(rows[d].tokens) == len(encoding.encode_ordinary(texts[d]))
        assert rows.get(1).n_reencoded < rows.get(1).n_tokens_after / 2
        # The next batch reads the new leaves of what has changed, the old ones of the rest.
        kept = kept.unionByName(token_counts.kept_after(changed))

"""Token counts that follow edits: a table keeps the leaves of each document's segment
tree over its pre-tokens, and a batch of edits re-encodes only what it can have changed.

``trees`` writes the leaves once for a text; ``apply_edits`` joins the edited documents
with their leaves, builds the trees above them, replaces touched leaves and returns the
changed texts with their new leaves, to which the next batch applies.  Documents without
edits aren't encoded again: their count is the sum kept with their leaves.  Leaves are
found by the id and a 64-bit hash of the text, so rows of one id with other texts are
kept apart.

A tree's leaves are runs of pre-tokens (``LEAF_TOKENS`` at most) with their
length in characters and their token count; inner nodes hold the sums.  Edits
are applied from the last to the first, so offsets stay those of the original
text.  An edit re-cuts the text from the leaf that holds the character
``LOOK_BACK`` places before it (the pattern looks at most that far past a
pre-token) until a new cut falls on an old leaf boundary behind the edit: from
there on the old cuts hold, because where a pre-token ends depends only on the
text from its start.  Only those leaves are replaced, and the sums above them
updated.

Defined cases: a null text counts as empty; edits with a null id, start or end
are ignored; starts and ends are clamped to the text; a null replacement
deletes; of overlapping edits of a document the one that starts first holds
(then the longer, then the smaller replacement) and those it overlaps are
ignored; repeated edits count once; repeated documents give one row each (where a column
holds their edits, the smallest list of those of one id and text holds for all);
edits of unknown documents are ignored; other columns are ignored.
"""

from __future__ import annotations

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from funnelspark.llm.bpe import WordEncoder, load_ranks
from funnelspark.llm.common import Workspace, materialize

LEAF_TOKENS = 64
#: Characters behind a pre-token that decide where it ends (contractions look two ahead).
LOOK_BACK = 3
#: Pre-tokens whose counts a worker process remembers.
_CACHED_WORDS = 800_000


class _KnownCounts(dict):
    """Token counts of pre-tokens, made when first asked for."""

    def __init__(self, encode):
        super().__init__()
        self.encode = encode

    def __missing__(self, word: str) -> int:
        if len(self) >= _CACHED_WORDS:
            self.clear()
        n = self[word] = len(self.encode(word.encode("utf-8")))
        return n


class Counter:
    """Token counts of pre-tokens; what is known is kept by the worker process."""
    _known: dict[str, _KnownCounts] = {}

    def __init__(self, ranks_file: str, pattern: str):
        if ranks_file not in Counter._known:
            Counter._known[ranks_file] = _KnownCounts(WordEncoder(load_ranks(ranks_file)).encode)
        self.known = Counter._known[ranks_file]
        self.cut = regex.compile(pattern)

    def count(self, words: list[str]) -> int:
        return sum(map(self.known.__getitem__, words))


class SegmentTree:
    """Sums of (characters, tokens) over leaves; leaves can be replaced by others."""

    def __init__(self, leaves: list[tuple[int, int]]):
        self._build(leaves)

    def _build(self, leaves):
        self.size = 1 << max(0, len(leaves) - 1).bit_length()
        self.n = len(leaves)
        self.chars = [0] * (2 * self.size)
        self.tokens = [0] * (2 * self.size)
        for i, (chars, tokens) in enumerate(leaves):
            self.chars[self.size + i], self.tokens[self.size + i] = chars, tokens
        for i in range(self.size - 1, 0, -1):
            self._sum(i)

    def _sum(self, i):
        self.chars[i] = self.chars[2 * i] + self.chars[2 * i + 1]
        self.tokens[i] = self.tokens[2 * i] + self.tokens[2 * i + 1]

    def total(self) -> int:
        return self.tokens[1]

    def leaves(self) -> list[tuple[int, int]]:
        """(characters, tokens) of the leaves that hold text."""
        both = zip(self.chars[self.size:], self.tokens[self.size:])
        return [leaf for leaf in both if leaf[0]]

    def leaf_at(self, offset: int) -> tuple[int, int]:
        """(leaf, its first character) of the leaf that holds a character."""
        i, start = 1, 0
        while i < self.size:
            i *= 2
            if offset >= start + self.chars[i]:
                start += self.chars[i]
                i += 1
        return min(i - self.size, max(0, self.n - 1)), start

    def replace(self, first: int, last: int, leaves: list[tuple[int, int]]) -> None:
        """Leaves ``first`` to before ``last`` become ``leaves``; what doesn't fit
        into their places is summed up in the last of them."""
        width = last - first
        if width == 0:
            kept = [(self.chars[self.size + i], self.tokens[self.size + i]) for i in range(self.n)]
            self._build(kept[:first] + leaves + kept[first:])
            return
        if len(leaves) > width:
            rest = leaves[width - 1:]
            leaves = leaves[:width - 1] + [(sum(c for c, _ in rest), sum(t for _, t in rest))]
        leaves = leaves + [(0, 0)] * (width - len(leaves))
        dirty = set()
        for i, (chars, tokens) in enumerate(leaves, self.size + first):
            self.chars[i], self.tokens[i] = chars, tokens
            dirty.add(i // 2)
        while dirty:
            if 0 in dirty:
                dirty.discard(0)
                continue
            for i in dirty:
                self._sum(i)
            dirty = {i // 2 for i in dirty if i > 1}


def leaves_of(words: list[str], counter: Counter) -> list[tuple[int, int]]:
    """(characters, tokens) of each run of ``LEAF_TOKENS`` pre-tokens."""
    out = []
    for i in range(0, len(words), LEAF_TOKENS):
        part = words[i:i + LEAF_TOKENS]
        out.append((sum(map(len, part)), counter.count(part)))
    return out


class Document:
    """Text and segment tree of one document; the leaves are those kept, if given."""

    def __init__(self, text: str, counter: Counter, leaves: list[tuple[int, int]] | None = None):
        self.text, self.counter = text, counter
        self.reencoded = 0
        if leaves is None:
            leaves = self._leaves(counter.cut.findall(text))
        self.tree = SegmentTree(leaves)

    def _leaves(self, words):
        return leaves_of(words, self.counter)

    def _first_char(self, leaf: int) -> int:
        """First character of a leaf: the sum of all before it."""
        i, total = leaf + self.tree.size, 0
        while i > 1:
            if i % 2:
                total += self.tree.chars[i - 1]
            i //= 2
        return total

    def edit(self, start: int, end: int, replacement: str) -> None:
        """Replaces the characters start to before end."""
        if not self.text:
            self.text = replacement
            self.tree = SegmentTree(self._leaves(self.counter.cut.findall(replacement)))
            self.reencoded += self.tree.total()
            return
        tree, old_len = self.tree, len(self.text)
        grown = len(replacement) - (end - start)
        first, from_char = tree.leaf_at(max(0, start - LOOK_BACK - 1))
        last, last_char = tree.leaf_at(min(end, old_len - 1))
        last_char += tree.chars[tree.size + last]
        last += 1
        self.text = self.text[:start] + replacement + self.text[end:]
        words, position = [], from_char
        for m in self.counter.cut.finditer(self.text, from_char):
            while last_char + grown < position and last < tree.n:
                last_char += tree.chars[tree.size + last]
                last += 1
            if position == last_char + grown and position >= start + len(replacement):
                break
            words.append(m.group())
            position = m.end()
        else:
            last = tree.n
        leaves = self._leaves(words)
        self.reencoded += sum(t for _, t in leaves)
        tree.replace(first, last, leaves)


def pick_edits(edits: list[tuple[int, int, str]], length: int) -> list[tuple[int, int, str]]:
    """Clamped edits without overlaps, in order."""
    clamped = sorted({(max(0, min(s, length)), max(0, min(e, length)), r) for s, e, r in edits},
                     key=lambda x: (x[0], -x[1], x[2]))
    out: list[tuple[int, int, str]] = []
    for start, end, text in clamped:
        if end >= start and (not out or (start >= out[-1][1] and (start, end) != out[-1][:2])):
            out.append((start, end, text))
    return out


_EDITS = "array<struct<start:int,end:int,replacement:string>>"


def _hashed(docs: DataFrame, id_col: str, text_col: str, *more) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).alias("doc_id"), text.alias("text"),
                       F.xxhash64(text).alias("text_hash"), *more)


def trees(docs: DataFrame, ranks_file: str, pattern: str, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """One row per document row: doc_id, text_hash, the leaves (chars, tokens) of its tree,
    and their sums n_chars, n_tokens.  To be written and kept."""
    rows = _hashed(docs, id_col, text_col)
    id_type = rows.schema["doc_id"].dataType.simpleString()

    def run(batches):
        counter = Counter(ranks_file, pattern)
        for batch in batches:
            leaves = [leaves_of(counter.cut.findall(t), counter) for t in batch.column("text").to_pylist()]
            chars, tokens = ([[leaf[side] for leaf in x] for x in leaves] for side in (0, 1))
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"), "text_hash": batch.column("text_hash"),
                "chars": pa.array(chars, pa.list_(pa.int32())), "tokens": pa.array(tokens, pa.list_(pa.int32())),
                "n_chars": pa.array(map(sum, chars), pa.int64()),
                "n_tokens": pa.array(map(sum, tokens), pa.int64())})
    return rows.mapInArrow(run, f"doc_id {id_type}, text_hash long, chars array<int>, tokens array<int>, "
                                "n_chars long, n_tokens long")


def _same(left: DataFrame, right: DataFrame):
    """Rows of one id (a null is equal to a null) and text."""
    return left["doc_id"].eqNullSafe(right["doc_id"]) & (left["text_hash"] == right["text_hash"])


def apply_edits(docs: DataFrame, kept: DataFrame, ranks_file: str, pattern: str, id_col: str = "doc_id",
                text_col: str = "text", edits_col: str = "edits") -> DataFrame:
    """The documents that edits change, once for each id and text: doc_id, text_hash (of the
    text before), text, chars, tokens (text and leaves after), n_tokens (before), n_edits,
    n_tokens_after, n_reencoded (tokens counted again), n_chars_after.

    ``docs`` has its edits in ``edits_col``; ``kept`` holds the leaves of its texts, as ``trees``
    or this function (by ``kept_after``) makes them.  Only edited texts are moved, and no text
    is encoded but around its edits."""
    rows = _hashed(docs, id_col, text_col, F.col(edits_col).cast(_EDITS).alias("edits")) \
        .where(F.size("edits") > 0).groupBy("doc_id", "text_hash") \
        .agg(F.min("text").alias("text"), F.min("edits").alias("edits"))
    keys = rows.select("doc_id", "text_hash")
    touched = kept.select("doc_id", "text_hash", "chars", "tokens")
    touched = touched.join(keys, _same(touched, keys), "left_semi").dropDuplicates(["doc_id", "text_hash"])
    both = rows.join(touched, _same(rows, touched)) \
        .select(rows["doc_id"], rows["text_hash"], "text", "edits", "chars", "tokens")
    id_type = rows.schema["doc_id"].dataType.simpleString()

    def run(batches):
        counter = Counter(ranks_file, pattern)
        for batch in batches:
            out = {n: [] for n in ("text", "chars", "tokens", "n_tokens", "n_edits", "n_tokens_after",
                                   "n_reencoded", "n_chars_after")}
            for text, given, chars, tokens in zip(*(batch.column(c).to_pylist()
                                                    for c in ("text", "edits", "chars", "tokens"))):
                chosen = pick_edits([(e["start"], e["end"], e["replacement"] or "")
                                     for e in given if e and e["start"] is not None
                                     and e["end"] is not None], len(text))
                doc = Document(text, counter, list(zip(chars, tokens)))
                before = doc.tree.total()
                for start, end, replacement in reversed(chosen):
                    doc.edit(start, end, replacement)
                leaves = doc.tree.leaves()
                row = (doc.text, [c for c, _ in leaves], [t for _, t in leaves], before, len(chosen),
                       doc.tree.total(), doc.reencoded, len(doc.text))
                for column, value in zip(out.values(), row):
                    column.append(value)
            kinds = [pa.string(), pa.list_(pa.int32()), pa.list_(pa.int32())] + [pa.int64()] * 5
            yield pa.RecordBatch.from_pydict(
                {"doc_id": batch.column("doc_id"), "text_hash": batch.column("text_hash")}
                | {n: pa.array(v, kind) for (n, v), kind in zip(out.items(), kinds)})
    return both.mapInArrow(run, f"doc_id {id_type}, text_hash long, text string, chars array<int>, "
                                "tokens array<int>, n_tokens long, n_edits long, n_tokens_after long, "
                                "n_reencoded long, n_chars_after long")


def kept_after(changed: DataFrame) -> DataFrame:
    """The leaves of changed texts, as ``trees`` would name them."""
    return changed.select("doc_id", F.xxhash64("text").alias("text_hash"), "chars", "tokens",
                          F.col("n_chars_after").alias("n_chars"), F.col("n_tokens_after").alias("n_tokens"))


def edited_counts(docs: DataFrame, edits: DataFrame | None, ranks_file: str, pattern: str,
                  id_col: str = "doc_id", text_col: str = "text",
                  edits_col: str | None = None, kept: DataFrame | None = None) -> DataFrame:
    """One row per document row: doc_id, n_tokens (before), n_edits, n_tokens_after,
    n_reencoded (tokens counted again for the edits), n_chars_after.

    ``edits`` has rows (id, start, end, replacement); or ``edits_col`` names a
    column of ``docs`` that holds them as array<struct<start,end,replacement>>,
    which needs no join.  ``kept`` are the trees of ``docs``; without them they are
    made first."""
    work = Workspace(docs.sparkSession)
    try:
        if kept is None:
            kept = work.save(trees(docs, ranks_file, pattern, id_col, text_col), "token-trees")
        if edits is not None:
            listed = edits.where(F.col(id_col).isNotNull() & F.col("start").isNotNull()
                                 & F.col("end").isNotNull()) \
                .groupBy(F.col(id_col).alias("doc_id")) \
                .agg(F.collect_set(F.struct(F.col("start").cast("int").alias("start"),
                                            F.col("end").cast("int").alias("end"),
                                            "replacement")).alias("edits"))
            docs, id_col, text_col, edits_col = docs.select(
                F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")) \
                .join(listed, "doc_id"), "doc_id", "text", "edits"
        sums = kept.select("doc_id", "text_hash", "n_tokens", "n_chars")
        if edits_col is None:
            nothing = F.lit(0).cast("long")
            return materialize(sums.select(
                "doc_id", "n_tokens", nothing.alias("n_edits"), F.col("n_tokens").alias("n_tokens_after"),
                nothing.alias("n_reencoded"), F.col("n_chars").alias("n_chars_after")), "token-counts")
        changed = work.save(apply_edits(docs, kept, ranks_file, pattern, id_col, text_col, edits_col)
                            .select("doc_id", "text_hash", "n_edits", "n_tokens_after", "n_reencoded",
                                    "n_chars_after"), "token-edits")
        zero = F.lit(0).cast("long")
        return materialize(sums.join(changed, _same(sums, changed), "left").select(
            sums["doc_id"], "n_tokens", F.coalesce("n_edits", zero).alias("n_edits"),
            F.coalesce("n_tokens_after", "n_tokens").alias("n_tokens_after"),
            F.coalesce("n_reencoded", zero).alias("n_reencoded"),
            F.coalesce("n_chars_after", "n_chars").alias("n_chars_after")), "token-counts")
    finally:
        work.close()


#: What the redaction edits replace: mail addresses and quoted hexadecimal tokens.
REDACTED = r"[\w.+-]+@[\w-]+\.[\w.-]*\w|(?<=\")[0-9a-f]{32,}(?=\")"
#: Every match holds one of these, or stands next to it; other texts aren't searched.
REDACTED_NEEDS = ("@", '"')


def redaction_edits(docs: DataFrame, text_col: str = "text", pattern: str = REDACTED,
                    needs: tuple[str, ...] = REDACTED_NEEDS, replacement: str = "[redacted]"
                    ) -> DataFrame:
    """``docs`` with a column ``edits``: one edit for each match of ``pattern``.  Texts
    without any of ``needs`` (if given) can't have a match."""
    kept = docs.drop("edits")
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema]
                       + ["edits array<struct<start:int,end:int,replacement:string>>"])
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()),
                               ("replacement", pa.string())]))

    def run(batches):
        find = regex.compile(pattern).finditer
        for batch in batches:
            found = [[{"start": m.start(), "end": m.end(), "replacement": replacement}
                      for m in find(t)] if t and (not needs or any(c in t for c in needs)) else []
                     for t in batch.column(text_col).to_pylist()]
            yield pa.RecordBatch.from_pydict({c: batch.column(c) for c in batch.schema.names}
                                             | {"edits": pa.array(found, kind)})
    return kept.mapInArrow(run, schema)

"""Jaccard links between documents by a parity-sketch join.

A document is the set of its distinct 5-word shingles (64-bit hashes).  Two
documents link when ``100 |A & B| >= 80 |A | B|``; then at most
``(|A| + |B|) / 9`` shingles are in one set only.

* *Parity sketch.*  The shingle space of a size band is cut into blocks, and a
  block of the sketch is the XOR of the hashes of the document's shingles in
  it.  A shingle in one set only changes one block, so the number of differing
  blocks, like the Hamming distance of a bit sketch, bounds the symmetric
  difference from below.
* *Pigeonhole join.*  Of a document's non-empty blocks at most t differ from
  a partner's, so among the first t + 1 of them in any order that both share
  one must be equal.  The order prefers blocks with many shingles that are not
  frequent in the corpus, so common passages make few candidates.  Bands span
  a factor of two in size; a document also joins the band below if partners
  there can be similar enough.
* *Verify.*  First each document is compared with the two partners, of those next
  to it in its blocks, whose sketches are nearest, and the confirmed links are
  contracted to components.  Then, in rounds while links between components are
  found, every document of a block whose documents are in several components is
  compared with the document of another component that most links were confirmed
  for, and each component with its neighbours in the block: a linear number of
  pairs for each round (the last one is that which finds under one link for
  LAST_ROUND nodes).  A group of near copies is one component after a few rounds.
  Pairs of one block that are still in different components are then all tested: by
  the Hamming distance of parity sketches inside the join, and by exact
  intersection after it.  So no link between components is lost and the pairs
  within a group of copies are never listed.  A sketch has 2 to 4 bits for each
  shingle (1,024 at least); the longer one of two is folded.

Documents of equal sets form one node from the start.  Sets and blocks are
identified by 64-bit hashes; for sets of 64 or more shingles the blocks suffice
unless fewer than t + 1 are non-empty (chance under 1e-18 a document).

Defined cases: null, empty and word-less texts have no shingles and link with
nothing; rows with a null id are left out; repeated rows count once; an id with
several texts gives a row for each different set; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from funnelspark.llm.common import RollingHash, Workspace, materialize, mix64, text_bytes
from funnelspark.llm.components import connected_components

SHINGLE_WORDS = 5
#: A link needs LINK[0] * union <= LINK[1] * intersection.
LINK = (80, 100)
#: Most frequent shingles that the order of blocks puts last (it changes no result).
FREQUENT = 16_384
#: Longs of the shortest sketch, and shingles for each long of a longer one (at most).
SKETCH_LONGS = 16
SKETCH_SHINGLES = 32
#: Nodes for each new link under which no further round follows (what is left is tested at once).
LAST_ROUND = 200
#: Bytes of text hashed at once.
_GROUP_BYTES = 1 << 20


def shingles(texts: list[str | None]) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of every text."""
    out: list[np.ndarray] = []
    group, size = [], 0
    for text in texts:
        raw = text_bytes(text)
        group.append(raw)
        size += len(raw) + 1
        if size > _GROUP_BYTES:
            out += _hash_group(group)
            group, size = [], 0
    return out + _hash_group(group)


# Lower-cases A-Z and turns white space into spaces.
_FOLDED = bytes(c + 32 if 65 <= c <= 90 else 32 if 9 <= c <= 13 else c for c in range(256))
#: Multipliers of the words of a shingle, by place.
_PLACES = mix64(np.arange(1, SHINGLE_WORDS + 1, dtype=np.uint64)) | np.uint64(1)


def _hash_group(raws: list[bytes]) -> list[np.ndarray]:
    if not raws:
        return []
    joined = b" ".join(raws).translate(_FOLDED) + b" "
    data = np.frombuffer(joined, np.uint8)
    word = data != 32
    edge = np.flatnonzero(word[1:] != word[:-1]) + 1
    if len(word) and word[0]:
        edge = np.concatenate([[0], edge])
    starts, ends = edge[::2], edge[1::2]
    if not len(starts):
        return [np.zeros(0, np.uint64) for _ in raws]
    words = RollingHash(joined).spans(starts, ends)
    doc_ends = np.cumsum(np.fromiter(map(len, raws), np.int64, len(raws)) + 1)
    last = np.searchsorted(starts, doc_ends)
    k, n = SHINGLE_WORDS, len(words)
    runs = np.zeros(max(n - k + 1, 0), np.uint64)
    for i in range(k if len(runs) else 0):
        runs += words[i:n - k + 1 + i] * _PLACES[i]
    runs = mix64(runs)
    out, first = [], 0
    for end in last.tolist():
        if end - first >= k:
            out.append(np.unique(runs[first:end - k + 1]))
        elif end > first:  # fewer words: the whole sequence is one shingle
            out.append(mix64((words[first:end] * _PLACES[:end - first]).sum(
                dtype=np.uint64, keepdims=True)))
        else:
            out.append(np.zeros(0, np.uint64))
        first = end
    return out


def fingerprint(hashes: np.ndarray) -> int:
    """64-bit name of a set, as a signed number."""
    mixed = mix64(hashes ^ np.uint64(0x5851F42D4C957F2D))
    total = np.array([np.bitwise_xor.reduce(mixed), mixed.sum(dtype=np.uint64), np.uint64(len(hashes))])
    return int(mix64(mix64(mix64(total[:1]) + total[1:2]) + total[2:])[0].view(np.int64))


# ----------------------------------------------------------------- sketch
def blocks_of_band(band: int) -> int:
    """Blocks for partners of which the smaller has 2**band to 2**(band+1)-1 shingles."""
    return (1 << band) * 4 // 5 if band >= 6 else 1 << 31


def bands(n: int) -> list[tuple[int, int]]:
    """(band, largest possible symmetric difference) in which a set of n looks for partners."""
    own = n.bit_length() - 1
    out = [(own, (n + n * 5 // 4) // 9)]
    below = (1 << own) - 1
    if below and 5 * below >= 4 * n:
        out.append((own - 1, (n + below) // 9))
    return out


def block_tokens(hashes: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    """Tokens (band, block, XOR) of the blocks that a set is filed under."""
    n = len(hashes)
    at = np.searchsorted(frequent, hashes)
    rare = np.ones(n, np.int64) if not len(frequent) else \
        (frequent[np.minimum(at, len(frequent) - 1)] != hashes).astype(np.int64)
    mixed = mix64(hashes + np.uint64(0x9E3779B97F4A7C15))
    out = []
    for band, most in bands(n):
        block = ((hashes >> np.uint64(32)) * np.uint64(blocks_of_band(band))) >> np.uint64(32)
        first = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]]))
        xor = np.bitwise_xor.reduceat(mixed, first)
        token = mix64(mix64(xor + block[first]) + np.uint64(band + 1))
        weight = np.minimum(np.add.reduceat(rare, first), 255).astype(np.uint64)
        if len(token) > most + 1:
            order = ((np.uint64(255) - weight) << np.uint64(56)) | (token >> np.uint64(8))
            token = token[np.argpartition(order, most)[:most + 1]]
        out.append(token)
    return np.concatenate(out)


def parity_bits(hashes: np.ndarray) -> list[int]:
    """Parity sketch, each shingle flips one bit; a power of two of longs that follows the size."""
    longs = max(SKETCH_LONGS, 1 << max(0, -(-len(hashes) // SKETCH_SHINGLES) - 1).bit_length())
    bit = (mix64(hashes + np.uint64(77)) % np.uint64(64 * longs)).astype(np.int64)
    odd = (np.bincount(bit, minlength=64 * longs) & 1).astype(np.uint8)
    return np.packbits(odd, bitorder="little").view(np.int64).tolist()


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    common = len(np.intersect1d(a, b, assume_unique=True))
    return common > 0 and LINK[1] * common >= LINK[0] * (len(a) + len(b) - common)


# ----------------------------------------------------------------- stages
def _sets(docs: DataFrame) -> DataFrame:
    """One pass: (doc_id, n, node) of every document, and by-batch counts of frequent shingles
    (``h``, ``c``) with a null doc_id."""
    id_type = docs.schema["doc_id"].dataType
    from pyspark.sql.pandas.types import to_arrow_type
    arrow_id = to_arrow_type(id_type)

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            sets = shingles(batch.column("text").to_pylist())
            n = len(sets)
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"), "th": batch.column("th"),
                "n": pa.array([len(s) for s in sets], pa.int64()),
                "node": pa.array([fingerprint(s) for s in sets], pa.int64()),
                "h": pa.nulls(n, pa.int64()), "c": pa.nulls(n, pa.int64())})
            every = np.sort(np.concatenate(sets))
            first = np.flatnonzero(np.concatenate([[True], every[1:] != every[:-1]])) \
                if len(every) else np.zeros(0, np.int64)
            count = np.diff(np.append(first, len(every)))
            often = count >= max(4, n // 500)
            k = int(often.sum())
            yield pa.RecordBatch.from_pydict({
                "doc_id": pa.nulls(k, arrow_id), "th": pa.nulls(k, pa.int64()), "n": pa.nulls(k, pa.int64()),
                "node": pa.nulls(k, pa.int64()),
                "h": pa.array(every[first[often]].view(np.int64), pa.int64()),
                "c": pa.array(count[often].astype(np.int64), pa.int64())})
    return docs.withColumn("th", F.xxhash64("text")).mapInArrow(
        run, f"doc_id {id_type.simpleString()}, th long, n long, node long, h long, c long")


def _tokens(docs: DataFrame, frequent: np.ndarray) -> DataFrame:
    held = docs.sparkSession.sparkContext.broadcast(frequent)  # FREQUENT numbers at most

    def run(batches):
        seen: set[int] = set()
        for batch in batches:
            out = [[], [], []]
            for s in shingles(batch.column("text").to_pylist()):
                node = fingerprint(s) if len(s) else None
                if node is None or node in seen:
                    continue
                seen.add(node)
                token = block_tokens(s, held.value)
                for column, value in zip(out, (token, np.full(len(token), node, np.int64),
                                               np.full(len(token), len(s), np.int64))):
                    column.append(value)
            if out[0]:
                t, f, n = (np.concatenate(c) for c in out)
                yield pa.RecordBatch.from_pydict({"token": pa.array(t.view(np.int64)),
                                                  "node": pa.array(f), "n": pa.array(n)})
    return docs.select("text").mapInArrow(run, "token long, node long, n long")


def _shared(sorted_rows: DataFrame, by: str, keep: list[str]) -> DataFrame:
    """Rows (sorted by token, then ``by``) of tokens with two or more values of ``by``; equal
    neighbours merged; with the row before (``p_``) and the first of the token (``f_``).
    Reads groups of any size as a stream."""
    fields = sorted_rows.schema
    names = fields.names
    with_links = [f"{x}_{c}" for x in "pf" for c in keep]
    schema = ", ".join([f"{f.name} {f.dataType.simpleString()}" for f in fields]
                       + [f"{c} long" for c in with_links])

    def run(batches):
        token, last, first, held = None, None, None, False
        for batch in batches:
            out: list[list] = [[] for _ in range(len(names) + len(with_links))]
            columns = [batch.column(c).to_numpy(zero_copy_only=False) for c in names]
            tokens, values = columns[names.index("token")], columns[names.index(by)]
            # a row matters if its token equals that of a neighbour row
            alone = np.ones(len(tokens), bool)
            same = tokens[1:] == tokens[:-1]
            alone[1:] &= ~same
            alone[:-1] &= ~same
            alone[[0, -1]] = False
            for i in np.flatnonzero(~alone).tolist():
                row = tuple(int(c[i]) for c in columns)
                if tokens[i] != token:
                    token, first, held, last = tokens[i], row, True, row
                    continue
                if values[i] == last[names.index(by)]:
                    continue
                if held:
                    _add(out, first, None, None, names, keep)
                    held = False
                _add(out, row, last, first, names, keep)
                last = row
            if out[0]:
                yield pa.RecordBatch.from_pydict({
                    c: pa.array(v, pa.int64()) for c, v in zip([*names, *with_links], out)})
    return sorted_rows.mapInArrow(run, schema)


def _add(out, row, before, first, names, keep):
    values = list(row)
    for link in (before, first):
        values += [None if link is None else link[names.index(c)] for c in keep]
    for column, value in zip(out, values):
        column.append(value)


def _distance(a: str, b: str):
    """Hamming distance of two parity sketches: at most the symmetric difference.  Of sketches of
    two lengths (sizes that can link differ by a factor of two at most) the longer is folded."""
    def as_long_as(x, y):
        n = F.size(y)
        halves = F.zip_with(F.slice(x, 1, n), F.slice(x, n + 1, n), lambda u, v: u.bitwiseXOR(v))
        return F.when(F.size(x) > n, halves).otherwise(F.col(x))
    any_length = F.aggregate(F.zip_with(as_long_as(a, b), as_long_as(b, a),
                                        lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda acc, v: acc + v)
    shortest = F.bit_count(F.get(a, F.lit(0)).bitwiseXOR(F.get(b, F.lit(0))))
    for i in range(1, SKETCH_LONGS):   # compiled, unlike the functions above
        shortest += F.bit_count(F.get(a, F.lit(i)).bitwiseXOR(F.get(b, F.lit(i))))
    return F.when((F.size(a) == SKETCH_LONGS) & (F.size(b) == SKETCH_LONGS), shortest).otherwise(any_length)


def _verify(pairs: DataFrame, texts: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """The pairs (a, b) that link (with long columns ``keep``); ``texts`` has a text for
    each node (a repeated one repeats its pairs)."""
    names = ["a", "b", *keep]
    left = pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("ta")), "a")
    both = left.join(texts.select(F.col("node").alias("b"), F.col("text").alias("tb")), "b") \
        .select(*names, "ta", "tb")

    def run(batches):
        for batch in batches:
            sets = [shingles(batch.column(c).to_pylist()) for c in ("ta", "tb")]
            yield batch.select(names).filter(pa.array([linked(x, y) for x, y in zip(*sets)], pa.bool_()))
    return both.mapInArrow(run, ", ".join(f"{c} long" for c in names))


def _similar_size(a: str, b: str):
    low, high = F.least(F.col(a), F.col(b)), F.greatest(F.col(a), F.col(b))
    return low * LINK[1] >= high * LINK[0]


def link_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id: the smallest doc_id reachable by links."""
    return materialize(text_components(docs, id_col, text_col)
                       .select("doc_id", "n_shingles", "component_id", "node").distinct().drop("node"), "jaccard")


def text_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, th, n_shingles, node, component_id: a row for each different (id, hash of the text)."""
    work = Workspace(docs.sparkSession)
    try:
        return materialize(_text_components(docs, id_col, text_col, work), "jaccard-texts")
    finally:
        work.close()


def _text_components(docs: DataFrame, id_col: str, text_col: str, work: Workspace) -> DataFrame:
    given = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")) \
        .where("doc_id is not null")
    passed = work.save(_sets(given), "jaccard-sets")
    members = passed.where("doc_id is not null").select("doc_id", "th", "n", "node").distinct()
    frequent = passed.where("doc_id is null").groupBy("h").agg(F.sum("c").alias("c")) \
        .orderBy(F.desc("c"), "h").limit(FREQUENT).select("h").collect()
    frequent = np.sort(np.array([r.h for r in frequent], np.int64).view(np.uint64))

    filed = _tokens(given, frequent).repartition("token").sortWithinPartitions("token", "n", "node")
    shared = work.save(_shared(filed, "node", ["node", "n"]), "jaccard-shared")

    wanted = passed.where("doc_id is not null").select("doc_id", "node") \
        .join(shared.select("node"), "node", "left_semi") \
        .groupBy("node").agg(F.min("doc_id").alias("doc_id"))
    texts = given.join(wanted.hint("shuffle_hash"), "doc_id").select("node", "text")
    texts = work.save(_of_node(texts), "jaccard-texts")
    texts, sketches = texts.select("node", "text"), texts.select("node", "sketch")

    # Of the partners that a node meets as neighbours in its blocks, the two whose sketches are nearest.
    met = _met(shared, ("p", "f")).repartition("node").distinct()
    best = _near(met, sketches).groupBy("node", "kind").agg(F.min(F.struct("distance", "other")).alias("x")) \
        .select(F.greatest("node", "x.other").alias("a"), F.least("node", "x.other").alias("b")).distinct()
    tried = work.save(best, "jaccard-pairs")
    links = work.save(_verify(tried, texts), "jaccard-links")
    labels = work.save(texts.select("node").distinct().join(connected_components(links, work), "node", "left")
                       .select("node", F.coalesce("label", "node").alias("label")), "jaccard-labels")
    found, nodes = links.count(), labels.count()

    rows = shared   # of tokens whose nodes may be in several components
    while found * LAST_ROUND > nodes:   # each round has fewer components: links between two of them were found
        rows = work.save(_open(_labelled(rows, labels, _degrees(links))), "jaccard-open")
        apart = _shared(rows.drop("links").repartition("token").sortWithinPartitions("token", "label", "n", "node"),
                        "label", ["node", "n"])
        apart = work.save(apart, "jaccard-apart")
        pairs = _met(apart, ("p", "f")).unionByName(_hub_pairs(rows)) \
            .select(F.greatest("node", "other").alias("a"), F.least("node", "other").alias("b"),
                    F.when(F.col("node") > F.col("other"), F.col("n")).otherwise(F.col("m")).alias("n"),
                    F.when(F.col("node") > F.col("other"), F.col("m")).otherwise(F.col("n")).alias("m")) \
            .distinct().join(tried, ["a", "b"], "left_anti")
        pairs = work.save(_near(pairs.withColumnsRenamed({"a": "node", "b": "other"}), sketches)
                          .select(F.col("node").alias("a"), F.col("other").alias("b")), "jaccard-pairs")
        fresh = work.save(_verify(pairs, texts), "jaccard-links")
        found = fresh.count()
        tried, links = tried.unionByName(pairs), links.unionByName(fresh)
        if found:
            labels = _merged(labels, fresh, work)

    # Pairs that share a block and are still in different components.
    labelled = _labelled(rows, labels)
    if found:   # links of the last round left some tokens with one component
        several = labelled.groupBy("token").agg(F.min("label").alias("low"), F.max("label").alias("high")) \
            .where("low <> high").select("token")
        labelled = labelled.join(several, "token")
    rest = work.save(labelled.join(sketches, "node"), "jaccard-open")
    x, y = rest.alias("x"), rest.alias("y")
    pairs = x.join(y, (F.col("x.token") == F.col("y.token")) & (F.col("x.node") < F.col("y.node"))
                   & (F.col("x.label") != F.col("y.label")) & _similar_size("x.n", "y.n")
                   & (_distance("x.sketch", "y.sketch") * 9 <= F.col("x.n") + F.col("y.n"))) \
        .select(F.col("y.node").alias("a"), F.col("x.node").alias("b")).distinct()
    tested = work.save(_verify(pairs.join(tried, ["a", "b"], "left_anti"), texts), "jaccard-links")
    labels = _merged(labels, tested, work)

    named = members.where("n > 0").join(labels, "node", "left") \
        .withColumn("label", F.coalesce("label", "node"))
    smallest = named.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    columns = ["doc_id", "th", F.col("n").alias("n_shingles"), "node"]
    return named.join(smallest, "label").select(*columns, "component_id").unionByName(
        members.where("n = 0").select(*columns, F.col("doc_id").alias("component_id")))


def _met(rows: DataFrame, links: Sequence[str]) -> DataFrame:
    """(node, n, other, m, kind) of rows of ``_shared`` and the rows they are linked with."""
    return rows.select("node", "n", F.inline(F.array(*[
        F.struct(F.col(f"{link}_node").alias("other"), F.col(f"{link}_n").alias("m"), F.lit(kind).alias("kind"))
        for kind, link in enumerate(links)]))) \
        .where("other is not null and other <> node").where(_similar_size("n", "m"))


def _near(met: DataFrame, sketches: DataFrame) -> DataFrame:
    """The pairs whose sketches allow a link, with their distance."""
    return met.join(sketches, "node").join(
        sketches.select(F.col("node").alias("other"), F.col("sketch").alias("sketch2")), "other") \
        .withColumn("distance", _distance("sketch", "sketch2")) \
        .where(F.col("distance") * 9 <= F.col("n") + F.col("m")).drop("sketch", "sketch2")


def _labelled(rows: DataFrame, labels: DataFrame, degrees: DataFrame | None = None) -> DataFrame:
    """``rows`` (token, node, n) with the node's label and, by ``degrees``, its number of links."""
    links = []
    if degrees is not None:
        labels, links = labels.join(degrees, "node", "left"), [F.coalesce("links", F.lit(0)).alias("links")]
    return rows.select("token", "node", "n").join(labels, "node", "left") \
        .select("token", F.coalesce("label", "node").alias("label"), "node", "n", *links)


def _degrees(links: DataFrame) -> DataFrame:
    return links.select(F.col("a").alias("node")).unionByName(links.select(F.col("b").alias("node"))) \
        .groupBy("node").agg(F.count("*").alias("links"))


def _open(labelled: DataFrame) -> DataFrame:
    """The rows of tokens whose nodes are in several components; moved once, by token."""
    token = Window.partitionBy("token")
    return labelled.withColumns({"low": F.min("label").over(token), "high": F.max("label").over(token)}) \
        .where("low <> high").drop("low", "high")


def _hub_pairs(rows: DataFrame) -> DataFrame:
    """Each node of a token with the node of another component that has most links (of the
    components' best, the two best are held for a token)."""
    rows = rows.repartition("token")   # moved once for all that follows
    best = rows.groupBy("token", "label").agg(F.max(F.struct("links", "node", "n")).alias("hub"))
    order = Window.partitionBy("token").orderBy(F.desc("hub"), "label")
    two = best.withColumn("place", F.row_number().over(order)).where("place <= 2") \
        .groupBy("token").agg(*[F.max(F.when(F.col("place") == i, F.struct("label", "hub"))).alias(f"hub{i}")
                                for i in (1, 2)])
    own = rows.join(two, "token")
    hub = F.when(F.col("hub1.label") != F.col("label"), F.col("hub1.hub")).otherwise(F.col("hub2.hub"))
    return own.select("node", "n", hub.alias("hub")).where("hub is not null") \
        .select("node", "n", F.col("hub.node").alias("other"), F.col("hub.n").alias("m"), F.lit(2).alias("kind")) \
        .where(_similar_size("n", "m"))


def _merged(labels: DataFrame, links: DataFrame, work: Workspace) -> DataFrame:
    """(node, label) after further links between components; ``labels`` has every node."""
    ends = links.select("a", "b")
    for c in ("a", "b"):
        ends = ends.join(labels.select(F.col("node").alias(c), F.col("label").alias(f"l{c}")), c)
    joined = connected_components(ends.select(F.col("la").alias("a"), F.col("lb").alias("b")), work)
    out = labels.join(joined.select(F.col("node").alias("label"), F.col("label").alias("top")), "label", "left") \
        .select("node", F.coalesce("top", "label").alias("label"))
    return work.save(out, "jaccard-labels")


def _of_node(texts: DataFrame) -> DataFrame:
    """Rows whose text really is that of the node (ids may repeat), one for each node of a
    task, with their sketches."""
    def run(batches):
        seen: set[int] = set()
        for batch in batches:
            kept, sketch = [], []
            sets = shingles(batch.column("text").to_pylist())
            for s, node in zip(sets, batch.column("node").to_pylist()):
                kept.append(len(s) > 0 and node not in seen and fingerprint(s) == node)
                if kept[-1]:
                    seen.add(node)
                    sketch.append(parity_bits(s))
            own = batch.filter(pa.array(kept, pa.bool_()))
            yield pa.RecordBatch.from_pydict({"node": own.column("node"), "text": own.column("text"),
                                              "sketch": pa.array(sketch, pa.list_(pa.int64()))})
    return texts.mapInArrow(run, "node long, text string, sketch array<long>")


def one_of_each_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one document of each component (that of the smallest id); rows with a
    null id stay, and so do rows of one id whose text is in no component with a smaller id;
    columns as they were."""
    gone = text_components(docs, id_col, text_col).where("doc_id <> component_id") \
        .select(F.col("doc_id").alias("_gone_"), F.col("th").alias("_gone_text_")).distinct()
    return docs.join(gone, (docs[f"`{id_col}`"] == gone["_gone_"])
                     & (F.xxhash64(docs[f"`{text_col}`"]) == gone["_gone_text_"]), "left_anti")

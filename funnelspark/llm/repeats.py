"""Removal of byte strings that repeat anywhere in the corpus, with run-length
indexes.

A byte goes if a 200-byte string that covers it also starts at another place
of the corpus (of the same document too).  Whether that is so is read from
run-length indexes (``run_index``); what has to be indexed together is found
first:

1. *Anchors.*  Of the 100-byte grams of every 200-byte string one is chosen by
   its hash alone, so two equal strings choose the same gram at the same
   offset.  About one gram in fifty is chosen.  Every 200-byte string lies in
   the context of its anchor: the gram with up to 100 bytes on either side.
2. *Groups.*  Anchors meet by gram.  A gram met once makes no repeat.  Equal
   contexts are one repeat over their whole length and are indexed once; this
   settles the inside of long repeats without moving text.
3. *Index.*  The differing contexts of a gram, at the ends of repeats, are
   fetched from the texts, and for each shuffle partition a run-compressed
   Burrows-Wheeler transform with sampled run ends is built over them.  The
   matching statistics streamed from it mark the matches of 200 bytes or more.
   A gram with more than ``INDEX_CONTEXTS`` contexts isn't gathered in one
   index: all 200-byte strings of its contexts meet by hash instead, which
   gives the same marks.

Equal texts of different documents are repeats as a whole.  Grams, contexts and
texts are identified by 64-bit hashes.

Defined cases: null and empty texts have no bytes and nothing removed; rows
with a null id are left out; repeated rows count once, an id with several
texts gives a row for each; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from funnelspark.llm.common import RollingHash, Workspace, materialize, mix64, text_bytes
from funnelspark.llm.run_index import RunLengthIndex

REPEAT_BYTES = 200
GRAM_BYTES = REPEAT_BYTES // 2
SIDE_BYTES = REPEAT_BYTES - GRAM_BYTES
#: Largest number of contexts of one gram in an index (300 bytes each).
INDEX_CONTEXTS = 20_000
#: Context bytes that one index is built over (more only for a single gram).
_INDEX_BYTES = 1 << 19
_GROUP_BYTES = 1 << 20
#: Rows of an Arrow batch of single strings.
_STRINGS = 50_000


def text_name(raw: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(raw, digest_size=8).digest(), "little", signed=True)


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours (len(x) - width + 1 values)."""
    n = len(x)
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = x
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n - width + 1], ahead[width - 1:n])


def anchors(raws: list[bytes]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(gram hash, context hash, position) of the chosen grams of every text."""
    out = []
    group, size = [], 0
    for raw in raws:
        group.append(raw)
        size += len(raw)
        if size > _GROUP_BYTES:
            out += _group_anchors(group)
            group, size = [], 0
    return out + _group_anchors(group)


def _group_anchors(raws: list[bytes]):
    none = (np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int64))
    out = [none] * len(raws)
    long = [i for i, r in enumerate(raws) if len(r) >= REPEAT_BYTES]
    if not long:
        return out
    lengths = np.array([len(raws[i]) for i in long], np.int64)
    ends = np.cumsum(lengths)
    starts = ends - lengths
    joined = b"".join(raws[i] for i in long)
    rolling = RollingHash(joined)
    places = np.arange(len(joined) - GRAM_BYTES + 1)
    grams = rolling.spans(places, places + GRAM_BYTES)
    # the smallest upper half of the hash, the last such place of a string
    order = (grams >> np.uint64(32) << np.uint64(32)) | (np.uint64(0xFFFFFFFF) - places.astype(np.uint64))
    least = _sliding_min(order, REPEAT_BYTES - GRAM_BYTES + 1)
    at = np.arange(len(least))
    doc_end = np.repeat(ends, lengths)[:len(least)]
    least = least[at + REPEAT_BYTES <= doc_end]
    least = least[np.concatenate([[True], least[1:] != least[:-1]])]
    chosen = (np.uint64(0xFFFFFFFF) - (least & np.uint64(0xFFFFFFFF))).astype(np.int64)
    chosen = np.unique(chosen)
    doc = np.searchsorted(ends, chosen, "right")
    left = np.maximum(chosen - SIDE_BYTES, starts[doc])
    right = np.minimum(chosen + REPEAT_BYTES, ends[doc])
    context = mix64(rolling.spans(left, right) + (chosen - left).astype(np.uint64) * np.uint64(1009)
                    + (right - chosen).astype(np.uint64))
    cut = np.searchsorted(doc, np.arange(len(long) + 1))
    for k, i in enumerate(long):
        part = slice(cut[k], cut[k + 1])
        out[i] = (grams[chosen[part]], context[part], chosen[part] - starts[k])
    return out


# ----------------------------------------------------------------- stages
def _names(docs: DataFrame) -> DataFrame:
    """(doc_id, node, n_bytes): node names the text."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            raws = [text_bytes(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"),
                "node": pa.array([text_name(r) for r in raws], pa.int64()),
                "n_bytes": pa.array([len(r) for r in raws], pa.int64())})
    return docs.mapInArrow(run, f"doc_id {id_type}, node long, n_bytes long")


def _anchor_rows(docs: DataFrame) -> DataFrame:
    def run(batches):
        seen: set[int] = set()  # names of this task's texts; a copy adds nothing new
        for batch in batches:
            raws, nodes = [], []
            for text in batch.column("text").to_pylist():
                raw = text_bytes(text)
                if len(raw) >= REPEAT_BYTES and (node := text_name(raw)) not in seen:
                    seen.add(node)
                    raws.append(raw)
                    nodes.append(node)
            found = anchors(raws)
            if not found:
                continue
            gram, context, at = (np.concatenate(c) for c in zip(*found))
            node = np.repeat(np.array(nodes, np.int64), [len(f[0]) for f in found])
            # From the third equal context on it is known that it is met twice, so the
            # row needn't go where its gram's rows meet.
            order = np.lexsort((context, gram))
            fresh = np.ones(len(gram), bool)
            fresh[1:] = (gram[order][1:] != gram[order][:-1]) | (context[order][1:] != context[order][:-1])
            nth = np.arange(len(gram)) - np.maximum.accumulate(np.where(fresh, np.arange(len(gram)), 0))
            known = np.zeros(len(gram), bool)
            known[order] = nth >= 2
            spread = mix64(node.view(np.uint64) + at.astype(np.uint64))
            yield pa.RecordBatch.from_pydict({
                "meet": pa.array(np.where(known, spread, gram).view(np.int64)),
                "known": pa.array(known),
                "gram": pa.array(gram.view(np.int64)), "context": pa.array(context.view(np.int64)),
                "node": pa.array(node), "at": pa.array(at)})
    return docs.select("text").mapInArrow(
        run, "meet long, known boolean, gram long, context long, node long, at long")


def _grouped(rows: DataFrame) -> DataFrame:
    """Rows sorted by gram, context and place: those whose context is met twice
    (``equal``), and the first of each context of a gram with several contexts.
    Streams: of the gram at the end of a batch, its first row, two rows of its
    last context and the last row are carried on."""
    names = ("gram", "context", "node", "at")

    def run(batches):
        carried = [np.zeros(0, np.int64)] * 4
        for batch in batches:
            sure = batch.filter(batch.column("known"))
            if sure.num_rows:
                yield pa.RecordBatch.from_pydict({"equal": sure.column("known")} | {
                    n: sure.column(n) for n in ("gram", "node", "at")})
            batch = batch.filter(pc.invert(batch.column("known")))
            if not batch.num_rows:
                continue
            gram, context, node, at = (np.concatenate([c, batch.column(n).to_numpy()])
                                       for n, c in zip(names, carried))
            # a text of several rows gives its anchors once for each task that read it
            own = np.concatenate([[True], (gram[1:] != gram[:-1]) | (context[1:] != context[:-1])
                                  | (node[1:] != node[:-1]) | (at[1:] != at[:-1])])
            gram, context, node, at = (c[own] for c in (gram, context, node, at))
            n = len(gram)
            new_gram = np.concatenate([[True], gram[1:] != gram[:-1]])
            new_run = new_gram | np.concatenate([[True], context[1:] != context[:-1]])
            run_of, gram_of = np.cumsum(new_run) - 1, np.cumsum(new_gram) - 1
            equal = np.bincount(run_of)[run_of] >= 2
            member = new_run & (np.bincount(gram_of, weights=new_run)[gram_of] >= 2)
            keep_equal, keep_member = np.flatnonzero(equal), np.flatnonzero(member)
            take = np.concatenate([keep_equal, keep_member])
            yield pa.RecordBatch.from_pydict({
                "equal": pa.array(np.arange(len(take)) < len(keep_equal)),
                "gram": pa.array(gram[take]), "node": pa.array(node[take]), "at": pa.array(at[take])})
            first = int(np.flatnonzero(new_gram)[-1])
            last = int(np.flatnonzero(new_run)[-1])
            on = sorted({first, last, min(last + 1, n - 1), n - 1})
            carried = [c[on] for c in (gram, context, node, at)]
    return rows.mapInArrow(run, "equal boolean, gram long, node long, at long")


def _contexts(texts: DataFrame) -> DataFrame:
    """Texts with ``wanted`` (gram, at, large): the contexts as byte segments; overlapping
    contexts of one gram in a text are one segment.  Of large grams all 200-byte strings as
    hashes instead."""
    def run(batches):
        for batch in batches:
            gram, node, start, data = [], [], [], []
            hashed = [[], [], []]
            for name, text, wanted in zip(*(batch.column(c).to_pylist()
                                            for c in ("node", "text", "wanted"))):
                raw = text_bytes(text)
                if text_name(raw) != name:  # another text of the same id
                    continue
                spans: dict[tuple[int, bool], list[list[int]]] = {}
                for w in sorted(wanted, key=lambda w: w["at"]):
                    s, e = max(0, w["at"] - SIDE_BYTES), min(len(raw), w["at"] + REPEAT_BYTES)
                    known = spans.setdefault((w["gram"], w["large"]), [])
                    if known and s <= known[-1][1]:
                        known[-1][1] = max(known[-1][1], e)
                    else:
                        known.append([s, e])
                rolling = RollingHash(raw) if any(large for _, large in spans) else None
                for (g, large), parts in spans.items():
                    for s, e in parts:
                        if large:
                            at = np.arange(s, e - REPEAT_BYTES + 1)
                            hashed[0].append(rolling.spans(at, at + REPEAT_BYTES).view(np.int64))
                            hashed[1].append(np.full(len(at), name, np.int64))
                            hashed[2].append(at)
                        else:
                            gram.append(g)
                            node.append(name)
                            start.append(s)
                            data.append(raw[s:e])
            yield pa.RecordBatch.from_pydict({
                "gram": pa.array(gram, pa.int64()), "node": pa.array(node, pa.int64()),
                "start": pa.array(start, pa.int64()), "data": pa.array(data, pa.binary())})
            if hashed[0]:
                h, k, at = (np.concatenate(c) for c in hashed)
                for i in range(0, len(h), _STRINGS):
                    part = slice(i, i + _STRINGS)
                    yield pa.RecordBatch.from_pydict({
                        "gram": pa.array(h[part]), "node": pa.array(k[part]), "start": pa.array(at[part]),
                        "data": pa.nulls(len(h[part]), pa.binary())})
    return texts.mapInArrow(run, "gram long, node long, start long, data binary")


def _indexed(contexts: DataFrame) -> DataFrame:
    """Segments sorted by gram: the stretches that long matches cover, by the index of
    each lot of grams."""
    def marks(lot):
        lot = [x for x in lot if x]
        segments = [s for g in lot for s in g]
        if not segments:
            return None
        groups = [i for i, g in enumerate(lot) for _ in g]
        index = RunLengthIndex([d for _, _, d in segments], groups)
        found = index.long_matches(REPEAT_BYTES)
        return pa.RecordBatch.from_pydict({
            "node": pa.array([segments[i][0] for i, _, _ in found], pa.int64()),
            "start": pa.array([segments[i][1] + s for i, s, _ in found], pa.int64()),
            "end": pa.array([segments[i][1] + e for i, _, e in found], pa.int64())})

    def run(batches):
        lot, size, gram = [], 0, None
        for batch in batches:
            for g, node, start, data in zip(*(batch.column(c).to_pylist()
                                              for c in ("gram", "node", "start", "data"))):
                if g != gram:
                    if size > _INDEX_BYTES:
                        got = marks(lot)
                        if got is not None:
                            yield got
                        lot, size = [], 0
                    gram = g
                    lot.append([])
                if lot[-1] and lot[-1][-1][:2] == (node, start):
                    continue
                lot[-1].append((node, start, data))
                size += len(data)
        got = marks(lot)
        if got is not None:
            yield got
    return contexts.mapInArrow(run, "node long, start long, end long")


def _met_twice(strings: DataFrame) -> DataFrame:
    """Strings (hash in ``gram``) sorted by hash: those met twice, as stretches."""
    def run(batches):
        carried = [np.zeros(0, np.int64)] * 3
        for batch in batches:
            if not batch.num_rows:
                continue
            h, node, start = (np.concatenate([c, batch.column(n).to_numpy()])
                              for n, c in zip(("gram", "node", "start"), carried))
            again = h[1:] == h[:-1]
            twice = np.concatenate([again, [False]]) | np.concatenate([[False], again])
            yield pa.RecordBatch.from_pydict({
                "node": pa.array(node[twice]), "start": pa.array(start[twice]),
                "end": pa.array(start[twice] + REPEAT_BYTES)})
            carried = [h[-1:], node[-1:], start[-1:]]
    return strings.mapInArrow(run, "node long, start long, end long")


def find_repeats(docs: DataFrame, work: Workspace, index_contexts: int = INDEX_CONTEXTS
                 ) -> tuple[DataFrame, DataFrame]:
    """For documents (doc_id, text): (doc_id, node, n_bytes), and (node, starts, ends) of
    the stretches of texts that repeats cover (in any order, may overlap; a text that
    several documents have isn't listed for that).  Both read tables of ``work``."""
    names = work.save(_names(docs), "repeat-names").distinct()
    rows = _anchor_rows(docs).repartition("meet").sortWithinPartitions("gram", "context", "node", "at")
    grouped = work.save(_grouped(rows), "repeat-anchors")

    members = grouped.where("not equal").select("gram", "node", "at").distinct()
    large = members.groupBy("gram").count().where(F.col("count") > index_contexts) \
        .select("gram", F.lit(True).alias("large"))
    wanted = members.join(large, "gram", "left") \
        .select("node", F.struct("gram", "at", F.coalesce("large", F.lit(False)).alias("large")).alias("w")) \
        .groupBy("node").agg(F.collect_list("w").alias("wanted"))
    first = names.groupBy("node").agg(F.min("doc_id").alias("doc_id"))
    texts = docs.join(wanted.join(first, "node").hint("shuffle_hash"), "doc_id") \
        .select("node", "text", "wanted")
    contexts = work.save(_contexts(texts), "repeat-contexts")
    by_index = _indexed(contexts.where("data is not null").repartition("gram")
                        .sortWithinPartitions("gram", "node", "start"))
    strings = contexts.where("data is null").select("gram", "node", "start").distinct() \
        .repartition("gram").sortWithinPartitions("gram")
    by_context = grouped.where("equal").select(
        "node", F.greatest(F.col("at") - SIDE_BYTES, F.lit(0)).alias("start"),
        (F.col("at") + REPEAT_BYTES).alias("end"))
    spans = by_index.unionByName(_met_twice(strings)).unionByName(by_context) \
        .groupBy("node").agg(F.collect_list(F.struct("start", "end")).alias("spans")) \
        .select("node", F.col("spans.start").alias("starts"), F.col("spans.end").alias("ends"))
    return names, spans


def covered(n_bytes: int, starts: list[int], ends: list[int]) -> list[tuple[int, int]]:
    """Merged stretches within the text."""
    if not len(starts):
        return []
    order = np.argsort(starts, kind="stable")
    s = np.asarray(starts, np.int64)[order]
    e = np.minimum(np.maximum.accumulate(np.asarray(ends, np.int64)[order]), n_bytes)
    fresh = np.concatenate([[True], s[1:] > e[:-1]])
    last = np.append(np.flatnonzero(fresh)[1:], len(s)) - 1
    return list(zip(s[fresh].tolist(), e[last].tolist()))


def repeat_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 index_contexts: int = INDEX_CONTEXTS) -> DataFrame:
    """doc_id, text, spans (start, end in bytes of the UTF-8 text) to remove."""
    given = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")) \
        .where("doc_id is not null")
    work = Workspace(docs.sparkSession)
    names, spans = find_repeats(given, work, index_contexts)
    copies = names.groupBy("node").agg((F.count("*") > 1).alias("copied"))
    marks = materialize(names.join(copies, "node").join(spans, "node", "left"), "repeat-marks")
    work.close()
    id_type = given.schema["doc_id"].dataType.simpleString()
    joined = given.join(marks.hint("shuffle_hash"), "doc_id")

    def run(batches):
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            out, own = [], []
            for text, name, copied, starts, ends in zip(*(
                    batch.column(c).to_pylist() for c in ("text", "node", "copied", "starts", "ends"))):
                raw = text_bytes(text)
                own.append(text_name(raw) == name)
                if copied and len(raw) >= REPEAT_BYTES:
                    found = [(0, len(raw))]
                else:
                    found = covered(len(raw), starts or [], ends or [])
                out.append([{"start": s, "end": e} for s, e in found])
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"), "text": batch.column("text"),
                "spans": pa.array(out, kind)}).filter(pa.array(own, pa.bool_()))
    return joined.mapInArrow(run, f"doc_id {id_type}, text string, "
                                  "spans array<struct<start:bigint,end:bigint>>")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   index_contexts: int = INDEX_CONTEXTS) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept (the remaining bytes, which may cut a
    character in two) and kept_sha256."""
    spans = repeat_spans(docs, id_col, text_col, index_contexts)
    id_type = spans.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            rows = [[], [], [], [], []]
            for text, found in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist()):
                raw, kept, at = text_bytes(text), [], 0
                for span in found:
                    kept.append(raw[at:span["start"]])
                    at = span["end"]
                rest = b"".join([*kept, raw[at:]])
                for column, value in zip(rows, (len(raw), len(raw) - len(rest), len(found), rest,
                                                hashlib.sha256(rest).hexdigest())):
                    column.append(value)
            kinds = (("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()),
                     ("kept", pa.binary()), ("kept_sha256", pa.string()))
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id")} | {
                n: pa.array(v, t) for (n, t), v in zip(kinds, rows)})
    return spans.mapInArrow(run, f"doc_id {id_type}, n_bytes long, n_removed long, n_spans long, "
                                 "kept binary, kept_sha256 string")

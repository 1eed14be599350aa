import hashlib
import random
from collections import Counter

import pytest

from funnelspark.llm import queries, repeats
from funnelspark.llm.run_index import RunLengthIndex

from .helpers import DOCS, SF_SMALL


def brute(docs):
    """id -> (bytes, removed, spans, digest of the rest)."""
    raws = {d: (t or "").encode() for d, t in docs}
    met = Counter(r[i:i + 200] for r in raws.values() for i in range(len(r) - 199))
    out = {}
    for d, r in raws.items():
        gone = bytearray(len(r))
        for i in range(len(r) - 199):
            if met[r[i:i + 200]] > 1:
                gone[i:i + 200] = b"\1" * 200
        rest = bytes(x for x, g in zip(r, gone) if not g)
        starts = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out[d] = (len(r), len(r) - len(rest), starts, hashlib.sha256(rest).hexdigest())
    return out


def documents(seed=9):
    rng = random.Random(seed)
    make = lambda n: "".join(rng.choice("abcdeé ") for _ in range(n))
    passages = [make(n) for n in (190, 200, 201, 230, 299, 300, 301, 700)]
    out = [(0, None), (1, ""), (2, "x" * 199), (3, "y" * 200), (4, "z" * 205), (5, "ab" * 400),
           (6, make(90) + "For " * 300 + make(90))]
    for _ in range(40):
        parts = [make(rng.choice([0, 5, 150, 400]))]
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(passages)
            a = rng.randint(0, 30)
            parts += [p[a:] if rng.random() < 0.3 else p, make(rng.choice([0, 1, 60, 300]))]
        out.append((len(out), "".join(parts)))
    for _ in range(4):
        base = make(900)
        at = rng.randrange(900)
        out += [(len(out), base), (len(out) + 1, base[:at] + "#" + base[at + 1:]), (len(out) + 2, base)]
    return out


@pytest.mark.parametrize("index_contexts", [repeats.INDEX_CONTEXTS, 2])
def test_removal_equals_brute_force(spark, index_contexts):
    docs = documents()
    df = spark.createDataFrame(docs, DOCS).repartition(5)
    got = repeats.remove_repeats(df, index_contexts=index_contexts).collect()
    want = brute(docs)
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got} == want
    assert all(hashlib.sha256(bytes(r.kept)).hexdigest() == r.kept_sha256 for r in got)
    assert sum(w[1] > 0 for w in want.values()) > 20


def test_query_equals_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    got = queries.QUERIES["op7_repeats"](spark, SF_SMALL).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got} == brute(docs)


def test_repeated_and_null_rows(spark):
    rng = random.Random(1)
    text = "".join(rng.choice("abcdef") for _ in range(400))
    rows = [(1, text), (1, text), (None, text), (2, text[:250] + "!"), (3, "other"), (3, "more")]
    docs = spark.createDataFrame([(d, t, 1) for d, t in rows], "doc_id long, text string, node int")
    got = sorted((r.doc_id, r.n_bytes, r.n_removed) for r in repeats.remove_repeats(docs).collect())
    assert got == [(1, 400, 250), (1, 400, 250), (2, 251, 250), (3, 4, 0), (3, 5, 0)]
    assert repeats.remove_repeats(docs.limit(0)).count() == 0


def test_matching_statistics_equal_brute_force():
    rng = random.Random(1)
    for _ in range(150):
        base = bytes(rng.choice(b"ab\0") for _ in range(rng.choice([5, 20, 40])))
        segments, n = [], rng.randint(1, 5)
        for _ in range(n):
            s = bytearray(base * rng.choice([1, 1, 3]))
            for _ in range(rng.randint(0, 3)):
                s[rng.randrange(len(s))] = rng.choice(b"abc")
            segments.append(bytes(s[rng.randint(0, len(s)) // 3:]))
        groups = sorted(rng.randint(0, 1) for _ in range(n))
        index = RunLengthIndex(segments, groups)
        stats = index.matching_statistics()
        for i, s in enumerate(segments):
            for p in range(len(s)):
                best = 0
                for j, t in enumerate(segments):
                    for q in range(len(t) if groups[i] == groups[j] else 0):
                        k = 0
                        while (i, p) != (j, q) and p + k < len(s) and q + k < len(t) and s[p + k] == t[q + k]:
                            k += 1
                        best = max(best, k)
                assert stats[index.starts[i] + p] == best

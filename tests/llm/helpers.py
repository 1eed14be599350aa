"""Plain-Python versions of the operators that SQL doesn't cover, and small tables."""

import base64
import re

import public_tokenizers as tokenizers
import tiktoken

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"
RANKS = tokenizers.path("byte_bpe_multi_50k.tiktoken")
DOCS = "doc_id long, text string"


def reference_encoding():
    with open(RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=tokenizers.PATTERN, mergeable_ranks=ranks,
                             special_tokens={})


def rows_by_id(df, key="doc_id"):
    return {r[key]: r.asDict() for r in df.collect()}


def shingle_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute_components(docs):
    """id -> (set size, smallest reachable id), by comparing all pairs."""
    sets = {d: shingle_set(t) for d, t in docs}
    root = {d: d for d in sets}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d
    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            x, y = sets[a], sets[b]
            if x and y and 5 * min(len(x), len(y)) >= 4 * max(len(x), len(y)):
                if 100 * len(x & y) >= 80 * len(x | y):
                    x, y = find(a), find(b)
                    root[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), find(d)) for d in ids}


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+",
                      re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute_contamination(docs, items):
    """id -> (words, hit words, sorted ids of items found)."""
    windows = {}
    for item, text in items:
        w = words_of(text)
        n = min(13, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[i:i + n]), set()).add(str(item))
    lengths = {len(k) for k in windows}
    out = {}
    for d, text in docs:
        w, hit, found = words_of(text), set(), set()
        for n in lengths:
            for i in range(len(w) - n + 1):
                items_here = windows.get(tuple(w[i:i + n]))
                if items_here:
                    hit.update(range(i, i + n))
                    found |= items_here
        out[d] = (len(w), len(hit), sorted(found))
    return out

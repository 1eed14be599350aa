"""A run-length index over byte segments: suffix order, run-compressed
Burrows-Wheeler transform with sampled run ends, and matching statistics.

The transform of repetitive segments has few runs.  The longest common prefix
of a suffix with its neighbour in suffix order is irreducible only where a run
of the transform begins; from one text position to the next inside a run it
falls by one.  So the prefixes are compared at the sampled run ends alone, and
one stream over the text fills in all others.
"""

from __future__ import annotations

import numpy as np

#: Symbols that fit into one 63-bit number (9 bits each).
_PACKED = 7
#: Suffix pairs compared at once.
_COMPARED = 1 << 16


class RunLengthIndex:
    """Index of byte segments; segments of one group are matched with each other.

    ``groups[i]`` is the group of segment i; equal groups must be neighbours.
    """

    def __init__(self, segments: list[bytes], groups: list[int]):
        lengths = np.fromiter(map(len, segments), np.int64, len(segments))
        self.starts = np.concatenate([[0], np.cumsum(lengths + 1)])[:-1]
        self.lengths = lengths
        n = int((lengths + 1).sum())
        self.text = np.zeros(n, np.uint16)  # 0 ends a segment, a byte b is b + 1
        joined = np.frombuffer(b"".join(s + b"\0" for s in segments), np.uint8)
        inside = np.ones(n, bool)
        self.ends = self.starts + lengths
        inside[self.ends] = False
        self.text[inside] = joined[inside].astype(np.uint16) + np.uint16(1)
        segment = np.repeat(np.arange(len(segments), dtype=np.int32), lengths + 1)
        self.group = np.asarray(groups, np.int32)[segment]
        self.to_end = (self.ends[segment] - np.arange(n)).astype(np.int32)
        self.order = self._suffix_order()
        self._sample_runs()

    def _suffix_order(self) -> np.ndarray:
        """Suffixes by group, then by content; ends of segments are distinct."""
        n = len(self.text)
        packed = np.zeros(n, np.uint64)
        for i in range(min(_PACKED, n)):
            symbol = np.where(self.to_end[:n - i] >= i, self.text[i:], np.uint16(0)).astype(np.uint64)
            packed[:n - i] |= symbol << np.uint64(9 * (_PACKED - 1 - i))
        ended = self.to_end < _PACKED
        order = np.lexsort((packed, self.group)).astype(np.int32)  # stable: ties by place
        g, p = self.group[order], packed[order]
        fresh = np.ones(n, bool)
        fresh[1:] = (g[1:] != g[:-1]) | (p[1:] != p[:-1]) | ended[order[1:]] | ended[order[:-1]]
        places = np.arange(n, dtype=np.int32)
        rank = np.empty(n, np.int32)
        rank[order] = np.maximum.accumulate(np.where(fresh, places, 0))
        del g, p, packed, ended
        width = _PACKED
        while True:
            several = ~fresh
            several[:-1] |= ~fresh[1:]
            slots = np.flatnonzero(several)
            if not len(slots):
                return order
            at = order[slots]
            key = rank[at].astype(np.int64) * n + rank[at + width]
            by = np.argsort(key, kind="stable")
            at, key = at[by], key[by]
            order[slots] = at
            new = np.ones(len(at), bool)
            new[1:] = key[1:] != key[:-1]
            fresh[slots] |= new
            rank[at] = np.maximum.accumulate(np.where(fresh[slots], places[slots], 0))
            width *= 2

    def _sample_runs(self) -> None:
        """Run heads of the transform and the common prefix with the suffix before each."""
        order, n = self.order, len(self.order)
        before = np.where(order > 0, self.text[order - 1], np.uint16(0))
        head = np.ones(n, bool)
        head[1:] = (before[1:] != before[:-1]) | (before[1:] == 0) \
            | (self.group[order[1:]] != self.group[order[:-1]])
        self.heads = np.flatnonzero(head)
        self.runs = before[self.heads]
        self.head_prefix = np.zeros(len(self.heads), np.int64)
        inner = np.flatnonzero(self.heads > 0)
        for start in range(0, len(inner), _COMPARED):
            some = inner[start:start + _COMPARED]
            at = self.heads[some]
            self.head_prefix[some] = self._common_prefix(order[at].astype(np.int64),
                                                         order[at - 1].astype(np.int64))

    def _common_prefix(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Lengths of the common prefixes of suffixes, 0 for those of different groups."""
        most = np.where(self.group[a] == self.group[b], np.minimum(self.to_end[a], self.to_end[b]), 0)
        found = np.zeros(len(a), np.int64)
        open_ = np.flatnonzero(most > 0)
        step = 16
        while len(open_):
            x, y = a[open_] + found[open_], b[open_] + found[open_]
            left = np.minimum(most[open_] - found[open_], step)
            col = np.arange(step)
            ok = col[None, :] < left[:, None]
            last = len(self.text) - 1
            equal = (self.text[np.minimum(x[:, None] + col, last)]
                     == self.text[np.minimum(y[:, None] + col, last)]) & ok
            run = np.where(equal.all(1), step, np.argmin(equal, axis=1))
            found[open_] += run
            open_ = open_[(run == step) & (found[open_] < most[open_])]
        return found

    def matching_statistics(self) -> np.ndarray:
        """For each text position the length of its longest match that starts elsewhere
        in its group."""
        n = len(self.order)
        sampled = np.full(n, -1, np.int64)
        at_heads = self.order[self.heads]
        sampled[at_heads] = self.head_prefix
        last = np.maximum.accumulate(np.where(sampled >= 0, np.arange(n), 0))
        with_before = np.maximum(sampled[last] - (np.arange(n) - last), 0)
        by_order = with_before[self.order]
        best = by_order.copy()
        best[:-1] = np.maximum(best[:-1], by_order[1:])
        out = np.empty(n, np.int64)
        out[self.order] = best
        return out

    def long_matches(self, least: int) -> list[tuple[int, int, int]]:
        """(segment, start, end) of the maximal stretches covered by matches of ``least`` bytes."""
        stats = self.matching_statistics()
        at = np.flatnonzero(stats >= least)
        if not len(at):
            return []
        ends = np.maximum.accumulate(at + stats[at])
        segment = np.searchsorted(self.starts, at, "right") - 1
        fresh = np.ones(len(at), bool)
        fresh[1:] = (at[1:] > ends[:-1]) | (segment[1:] != segment[:-1])
        first = np.flatnonzero(fresh)
        final = np.append(first[1:], len(at)) - 1
        seg = segment[first]
        return list(zip(seg.tolist(), (at[first] - self.starts[seg]).tolist(),
                        (ends[final] - self.starts[seg]).tolist()))

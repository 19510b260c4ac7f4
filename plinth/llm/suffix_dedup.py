"""Operator 2: exact substring deduplication by a hash-compared suffix sort.

Blocks hold the passages around anchors (see repeats.py). In a block, the suffixes that start at anchors, and likewise the reversed
prefixes that end there, are merge-sorted. Two suffixes are compared by their common extension, which a binary search over
prefix polynomial hashes finds in a logarithmic number of steps; all comparisons of a merge step are made together. The common
extensions of neighbours are then verified byte by byte, and a block with a collision is sorted by its bytes instead.

The window that starts d bytes before an anchor is repeated if another anchor has the same 400 - d bytes after it and the same d bytes
before it: if the two lie in one interval of common extension >= 400 - d in the suffix order, and in one of >= d in the
prefix order. Every byte of such a window goes.

However many passages share an anchor, no sort has more than BLOCK_ROWS suffixes. All windows that start lo to hi bytes before an
anchor hold the same WINDOW - (hi - lo) bytes around it, so only contexts that agree there are compared for these windows, and one
of those that agree on all that the windows cover stands for the others. Where more remain, each half of lo to hi is taken alone; at
lo = hi the two ranges are the same, and contexts that agree are repeats without a sort, as are those that agree on all of a range.

A text that occurs again as a whole (by SHA-256) goes entirely if it has a window. Null text: an empty text. Null doc_id and repeated rows
are kept; the latter are copies of each other. Very long texts are searched whole, in the memory of one text. An empty table gives no rows.
Columns other than doc_id and text are not read, whatever they are called.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from plinth.llm import repeats
from plinth.llm.common import mix, ragged, table, texts

WINDOW, GRAM = 400, 64
WIDTH = WINDOW - GRAM + 1
LEFT = WIDTH - 1
#: Anchors whose suffixes are sorted together.
BLOCK_ROWS = 4000
#: Ranges of offsets into which a hot anchor's windows are split.
HOT_RANGES = 8
#: Contexts hashed together, so that they stay in a cache.
CACHE_ROWS = 1024


class Bytes:
    """A run's bytes as symbols."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data, self.offsets, self.n = data, offsets, np.diff(offsets)

    def marks(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(hash, text number, place in the text) of each anchor."""
        n = len(self.data)
        if n < WINDOW:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        begin = np.arange(n - GRAM + 1)
        grams = mix(repeats.span_hashes(self.data, begin, begin + GRAM))
        at = repeats.anchors(grams, self.offsets[:-1], self.offsets[1:] - WINDOW + 1, WIDTH)
        doc = np.searchsorted(self.offsets, at, "right") - 1
        return grams[at], doc, at - self.offsets[doc]

    def span(self, text: np.ndarray, place: np.ndarray, before: np.ndarray, after: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = self.offsets[text] + place
        return at - before, at + after


class Suffixes:
    """Suffixes of one buffer: suffix i is data[start[i] : start[i] + size[i]]."""

    def __init__(self, data: np.ndarray, start: np.ndarray, size: np.ndarray):
        self.data, self.start, self.size = data, start, size
        self.power = repeats.powers(len(data) + 1)
        self.prefix = repeats.prefix_hashes(data, self.power)

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Common extensions by binary search over hashes; never too short, too long only by a collision."""
        pa_, pb = self.start[a], self.start[b]
        ha, hb = self.prefix[pa_], self.prefix[pb]
        wa, wb = self.power[len(self.data) - pa_], self.power[len(self.data) - pb]
        lo, hi = np.zeros(len(a), np.int64), np.minimum(self.size[a], self.size[b])
        while (lo < hi).any():
            mid = (lo + hi + 1) >> 1
            same = (self.prefix[pa_ + mid] - ha) * wa == (self.prefix[pb + mid] - hb) * wb
            lo, hi = np.where(same, mid, lo), np.where(same, hi, mid - 1)
        return lo

    def less(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        n = self.common(a, b)
        ends = n == np.minimum(self.size[a], self.size[b])
        top = len(self.data) - 1
        x, y = self.data[np.minimum(self.start[a] + n, top)], self.data[np.minimum(self.start[b] + n, top)]
        return np.where(ends, self.size[a] < self.size[b], x < y)

    def sort(self) -> np.ndarray:
        """Merge sort; in each round all pairs of runs are merged by ranking every element in the other run."""
        n = len(self.start)
        order, run = np.arange(n), 1
        while run < n:
            place = np.arange(n)
            base = place // (2 * run) * (2 * run)
            right = place - base >= run
            lo = np.where(right, base, np.minimum(base + run, n))
            hi = np.where(right, np.minimum(base + run, n), np.minimum(base + 2 * run, n))
            first = lo.copy()
            live = np.flatnonzero(lo < hi)
            while len(live):
                mid = (lo[live] + hi[live]) >> 1
                mine, other = order[live], order[mid]
                # the other run's element comes first if it is less, or equal and on the left
                a, b = np.where(right[live], mine, other), np.where(right[live], other, mine)
                before = self.less(a, b) ^ right[live]
                lo[live] = np.where(before, mid + 1, lo[live])
                hi[live] = np.where(before, hi[live], mid)
                live = live[lo[live] < hi[live]]
            to = base + (place - base - np.where(right, run, 0)) + (lo - first)
            merged = np.empty_like(order)
            merged[to] = order
            order, run = merged, run * 2
        return order

    def ordered(self) -> tuple[np.ndarray, np.ndarray]:
        """(order, common): the sorted suffixes and each one's verified common extension with the one before (0 for the first)."""
        order = self.sort()
        common = np.zeros(len(order), np.int64)
        common[1:] = self.common(order[:-1], order[1:])
        x, y = ragged(self.start[order[:-1]], common[1:]), ragged(self.start[order[1:]], common[1:])
        if not np.array_equal(self.data[x], self.data[y]):
            return self.ordered_by_bytes()
        return order, common

    def ordered_by_bytes(self) -> tuple[np.ndarray, np.ndarray]:
        each = [self.data[s : s + n].tobytes() for s, n in zip(self.start.tolist(), self.size.tolist(), strict=True)]
        order = np.array(sorted(range(len(each)), key=each.__getitem__), np.int64)
        common = np.zeros(len(order), np.int64)
        for k in range(1, len(order)):
            a, b = each[order[k - 1]], each[order[k]]
            m = min(len(a), len(b))
            differ = np.flatnonzero(np.frombuffer(a, np.uint8, m) != np.frombuffer(b, np.uint8, m))
            common[k] = differ[0] if len(differ) else m
        return order, common


def repeated_windows(data: np.ndarray, offsets: np.ndarray, shift: np.ndarray, lo: int = 0, hi: int = LEFT) -> np.ndarray:
    """(contexts, WIDTH): whether the window that starts LEFT - column (lo to hi) bytes before the context's anchor occurs at another anchor too."""
    n, anchor = len(shift), offsets[:-1] + shift
    after, before = offsets[1:] - anchor, shift
    order, common = Suffixes(data, anchor, after).ordered()
    order_back, common_back = Suffixes(np.ascontiguousarray(data[::-1]), len(data) - anchor, before).ordered()
    out = np.zeros((n, WIDTH), bool)
    # an anchor all of whose neighbours differ within the gram has no repeated window
    near = np.maximum(common, np.append(common[1:], 0))
    alive = np.zeros(n, bool)
    alive[order] = near >= GRAM
    for d in range(lo, hi + 1):
        who = np.flatnonzero(alive & (after >= WINDOW - d) & (before >= d))
        if len(who) < 2:
            continue
        left, right = np.empty(n, np.int64), np.empty(n, np.int64)
        right[order] = np.cumsum(common < WINDOW - d)
        left[order_back] = np.cumsum(common_back < d)
        pair = right[who] * (n + 1) + left[who]
        by = np.argsort(pair)
        same = np.zeros(len(who) + 1, bool)
        same[1:-1] = pair[by][1:] == pair[by][:-1]
        out[who[by[same[1:] | same[:-1]]], LEFT - d] = True
    return out


def equal_ranges(data: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Numbers of the byte ranges (of 8 bytes or more), the same for equal ones: by hash, then verified."""
    eights = np.ndarray((len(data) - 7,), "<u8", data, 0, (1,))
    h, same = mix(size.astype(np.uint64)), np.empty(len(size), bool)
    parts = [slice(at, at + CACHE_ROWS) for at in range(0, len(size), CACHE_ROWS)]
    for p in parts:
        last, x = begin[p] + size[p] - 8, h[p]
        for at in range(0, int(size[p].max()), 8):
            x = mix(x ^ eights[np.minimum(begin[p] + at, last)])
        h[p] = x
    _, one, number = np.unique(h, return_index=True, return_inverse=True)
    lead = one[number]
    for p in parts:
        most = np.minimum(size[p], size[lead[p]])
        ok = size[p] == size[lead[p]]
        for at in range(0, int(most.max()), 8):
            place = np.minimum(at, most - 8)
            ok &= eights[begin[p] + place] == eights[begin[lead[p]] + place]
        same[p] = ok
    if not same.all():
        known: dict[bytes, int] = {}
        number = np.array([known.setdefault(data[a : a + n].tobytes(), len(known)) for a, n in zip(begin.tolist(), size.tolist(), strict=True)], np.int64)
    return number


class Contexts:
    """Contexts of anchors, and ``found`` (contexts, WIDTH): which windows occur at another anchor too, as in ``repeated_windows``."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, shift: np.ndarray, block_rows: int = BLOCK_ROWS):
        self.data, self.block_rows = np.ascontiguousarray(data), block_rows
        self.anchor, self.before = offsets[:-1] + shift, shift
        self.after = offsets[1:] - self.anchor
        self.found = np.zeros((len(shift), WIDTH), bool)

    def search(self, rows: np.ndarray, lo: int = 0, hi: int = LEFT) -> None:
        rows = rows[(self.before[rows] >= lo) & (self.after[rows] >= WINDOW - hi)]
        if len(rows) < 2:
            return
        core = equal_ranges(self.data, self.anchor[rows] - lo, np.full(len(rows), lo + WINDOW - hi))
        several = np.bincount(core)[core] > 1
        rows, core = rows[several], core[several]
        if not len(rows):
            return
        b, a = np.minimum(self.before[rows], hi), np.minimum(self.after[rows], WINDOW - lo)
        whole = equal_ranges(self.data, self.anchor[rows] - b, b + a) * (LEFT + 1) + b
        _, one, which, copies = np.unique(whole, return_index=True, return_inverse=True, return_counts=True)
        alike = np.flatnonzero(copies[which] > 1)
        self._mark(rows[alike], np.maximum(lo, WINDOW - a[alike]), np.minimum(hi, b[alike]))
        rows, core = rows[one], core[one]
        order = np.argsort(core, kind="stable")
        rows, core = rows[order], core[order]
        edges = np.append(np.flatnonzero(np.concatenate([[True], core[1:] != core[:-1]])), len(core))
        size = np.diff(edges)
        block: list[np.ndarray] = []
        held = 0
        for start, n in zip(edges[:-1][size > 1].tolist(), size[size > 1].tolist(), strict=True):
            mine = rows[start : start + n]
            if n > self.block_rows:
                middle = (lo + hi) // 2
                self.search(mine, lo, middle)
                self.search(mine, middle + 1, hi)
                continue
            if held + n > self.block_rows:
                self._sort(np.concatenate(block), lo, hi)
                block, held = [], 0
            block.append(mine)
            held += n
        if block:
            self._sort(np.concatenate(block), lo, hi)

    def _mark(self, rows: np.ndarray, least: np.ndarray, most: np.ndarray) -> None:
        d = LEFT - np.arange(WIDTH)
        for at in range(0, len(rows), BLOCK_ROWS):
            part = slice(at, at + BLOCK_ROWS)
            self.found[rows[part]] |= (d >= least[part, None]) & (d <= most[part, None])

    def _sort(self, rows: np.ndarray, lo: int, hi: int) -> None:
        b, a = np.minimum(self.before[rows], hi), np.minimum(self.after[rows], WINDOW - lo)
        data = self.data[ragged(self.anchor[rows] - b, b + a)]
        self.found[rows] |= repeated_windows(data, np.concatenate([[0], np.cumsum(b + a)]), b, lo, hi)


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for t in repeats.gathered(batches, BLOCK_ROWS):
        contexts = Contexts(*texts(t.column("context")), t.column("shift").to_numpy())
        contexts.search(np.arange(t.num_rows))
        for lo in range(0, t.num_rows, BLOCK_ROWS):
            row, column = np.nonzero(contexts.found[lo : lo + BLOCK_ROWS])
            yield from repeats.answered(t, lo + row, column)


METHOD = repeats.Method(WINDOW, LEFT, Bytes, False, HOT_RANGES, _find)


def _cut(text: bytes, which, searched: bool, copies: int) -> tuple:
    n = len(text)
    if copies > 1 and n >= WINDOW:
        kept, gone, spans = b"", n, 1
    elif which:
        out = which(n)
        kept, gone = np.frombuffer(text, np.uint8)[~out].tobytes(), int(out.sum())
        spans = int(out[0]) + int((out[1:] & ~out[:-1]).sum())
    else:
        kept, gone, spans = text, 0, 0
    return n, gone, spans, hashlib.sha256(kept).hexdigest(), kept


MADE = "n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept_bytes binary"


def remove_repeated_bytes(docs: DataFrame, hot_pages: int = repeats.HOT_PAGES) -> DataFrame:
    """Per row of docs: doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept_bytes."""
    return repeats.remove_repeats(docs, METHOD, _cut, MADE, hot_pages=hot_pages)


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeated_bytes(table(spark, sf_dir, "documents")).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")

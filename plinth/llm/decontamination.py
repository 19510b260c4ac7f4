"""Operator 1: benchmark decontamination by q-gram lemma filtering.

Texts are compared as bytes with A-Z lowered and separators as spaces. An occurrence of an item of m bytes with at most
e = floor(RATE * m) edits shares at least m + 1 - q * (e + 1) q-grams with it, on e + 1 neighbouring diagonals (document place
less item place). q is Q, or less for a short item, so that this bound is positive for every item; one of under 10 bytes has no edits
and one of at most Q bytes is its own q-gram. Diagonals are counted in bands of 2 e + 1, each overlapping the next by e, so every such
occurrence lies in one band. Bands that reach the bound are verified by a banded alignment of the whole item with free ends in the document.

Every item with a word is searched; as bytes are compared, a very short one is also found inside of words. The benchmark is read in
blocks of BLOCK_BYTES, each of which is sent to the executors; the documents are read once for each block, whole, and never moved.
Shared grams are counted in slices, so that texts that repeat a gram of an item need memory for their bands only.

Result: a row per document and item found: doc_id, item_id, edits (the fewest), doc_end (byte place after that occurrence; of equally good ones, the
first in the first band that has one). Null text: nothing is found. Null doc_id and repeated rows are kept. Very long texts are searched whole, in
memory that grows with one text. Empty tables give no rows. Items with null text or only separators are not searched; items of one text or one
item_id are found each on its own. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plinth.llm.common import SEPARATOR, ragged, runs, settle, table

Q, RATE = 8, 0.1
BLOCK_BYTES = 4 << 20
#: Shared grams that are expanded at once, and bands whose counts wait to be summed.
SLICE_HITS, HELD_BANDS = 1 << 20, 2 << 20
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[0x41:0x5B] += 0x20
_FOLD[SEPARATOR] = 0x20
_TABLE_BITS = 22


def grams(data: np.ndarray, q: int = Q) -> np.ndarray:
    """The q bytes (8 at most) at each place as a number; len(data) - q + 1 of them."""
    n = max(0, len(data) - q + 1)
    return np.ndarray((n,), "<u8", data.tobytes() + bytes(8), 0, (1,)) & np.uint64((1 << 8 * q) - 1)


def _added(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Counts by key, summed."""
    key, to = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
    return key, np.bincount(to, np.concatenate([n for _, n in parts]), len(key)).astype(np.int64)


class Items:
    """An index of a block of benchmark items."""

    def __init__(self, ids: list, texts: list[bytes], rate: float):
        self.ids = ids
        self.texts = [_FOLD[np.frombuffer(t, np.uint8)] for t in texts]
        self.size = np.array([len(t) for t in self.texts], np.int64)
        self.edits = (self.size * rate).astype(np.int64)
        self.q = np.clip(self.size // (self.edits + 1), 1, Q)
        self.need = np.maximum(1, self.size + 1 - self.q * (self.edits + 1))
        self.index = {q: self._indexed(q) for q in np.unique(self.q).tolist()}

    def _indexed(self, q: int) -> tuple[np.ndarray, ...]:
        """Of the items with grams of q bytes: the different grams, where each one's places begin, item and item place, flags by slot."""
        mine = np.flatnonzero(self.q == q)
        each = [grams(self.texts[i], q) for i in mine]
        code, n = np.concatenate(each), [len(x) for x in each]
        item, place = np.repeat(mine, n), ragged(np.zeros(len(n), np.int64), np.array(n))
        order = np.argsort(code, kind="stable")
        names, first = np.unique(code[order], return_index=True)
        flags = np.zeros(1 << _TABLE_BITS, bool)
        flags[self._slot(names)] = True
        return names, np.append(first, len(code)), item[order], place[order], flags

    @staticmethod
    def _slot(code: np.ndarray) -> np.ndarray:
        return ((code * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - _TABLE_BITS)).astype(np.int64)

    def hits(self, data: np.ndarray, offsets: np.ndarray, q: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """(place, document, item, item place) of each shared gram of q bytes, about SLICE_HITS at a time; of an item that is one gram
        without edits, the first in each document."""
        names, first, items, places, flags = self.index[q]
        code = grams(data, q)
        at = np.flatnonzero(flags[self._slot(code)])
        k = np.minimum(np.searchsorted(names, code[at]), len(names) - 1)
        doc = np.searchsorted(offsets, at, "right") - 1
        same = (names[k] == code[at]) & (at + q <= offsets[doc + 1])
        at, k, doc = at[same], k[same], doc[same]
        del code, same
        n = first[k + 1] - first[k]
        total, lo = np.cumsum(n), 0
        met = np.zeros(0, np.int64)  # documents and items, of those that need one place only
        while lo < len(at):
            hi = max(lo + 1, int(np.searchsorted(total, (total[lo - 1] if lo else 0) + SLICE_HITS, "right")))
            part = slice(lo, hi)
            which = ragged(first[k[part]], n[part])
            here, of, item, place = np.repeat(at[part], n[part]), np.repeat(doc[part], n[part]), items[which], places[which]
            whole = (self.size[item] == q) & (self.edits[item] == 0)
            if whole.any():
                keep, to = ~whole, np.flatnonzero(whole)
                pair, one = np.unique(of[to] * len(self.size) + item[to], return_index=True)
                new = ~np.isin(pair, met)
                keep[to[one[new]]] = True
                met = np.union1d(met, pair)
                here, of, item, place = here[keep], of[keep], item[keep], place[keep]
            yield here, of, item, place
            lo = hi

    def candidates(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(document, item, first diagonal of the band, within the document) of bands that reach their bound."""
        width = int(np.max(offsets)) + int(self.size.max(initial=0)) + 2
        key, count = np.zeros(0, np.int64), np.zeros(0, np.int64)
        waiting: list[tuple[np.ndarray, np.ndarray]] = []
        held = 0
        for q in self.index:
            for at, doc, item, place in self.hits(data, offsets, q):
                step = self.edits[item] + 1
                diagonal = at - offsets[doc] - place + self.size[item]  # never negative
                band, pair = diagonal // step, doc * len(self.size) + item
                also = (diagonal - band * step < self.edits[item]) & (band > 0)  # it lies in the overlap with the band before
                waiting.append(np.unique(np.concatenate([pair * width + band, pair[also] * width + band[also] - 1]), return_counts=True))
                held += len(waiting[-1][0])
                if held > HELD_BANDS:
                    key, count = _added([(key, count), *waiting])
                    waiting, held = [], 0
        key, count = _added([(key, count), *waiting])
        pair, band = np.divmod(key, width)
        doc, item = np.divmod(pair, max(1, len(self.size)))
        full = count >= self.need[item] if len(item) else np.zeros(0, bool)
        doc, item, band = doc[full], item[full], band[full]
        return doc, item, band * (self.edits[item] + 1) - self.size[item]

    def aligned(self, data: np.ndarray, offsets: np.ndarray, doc: np.ndarray, item: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(fewest edits, document place after the occurrence) of each candidate, all aligned in step within their bands."""
        edits, end = np.empty(len(doc), np.int64), np.empty(len(doc), np.int64)
        for lo in range(0, len(doc), 512):
            part = slice(lo, min(lo + 512, len(doc)))
            edits[part], end[part] = self._aligned(data, offsets, doc[part], item[part], first[part])
        return edits, end

    def _aligned(self, data, offsets, doc, item, first):
        m, e = self.size[item], self.edits[item]
        wide, longest, n = int(2 * e.max() + 1), int(m.max()), len(doc)
        text = np.full((n, longest), 256, np.int16)
        for k, i in enumerate(item.tolist()):
            text[k, : m[k]] = self.texts[i]
        lo, hi = offsets[doc], offsets[doc + 1]
        column = np.arange(wide)
        far = np.int32(1 << 20)
        closed = column[None, :] > (2 * e)[:, None]
        at0 = lo[:, None] + first[:, None] + column[None, :]
        row = np.where(closed, far, np.where(at0 > hi[:, None], far, 0)).astype(np.int32)
        best, place = np.full(n, far, np.int32), np.zeros(n, np.int64)
        top = len(data) - 1
        for i in range(longest):
            at = at0 + i
            valid = (at >= lo[:, None]) & (at < hi[:, None])
            letter = np.where(valid, data[np.clip(at, 0, top)], 257)
            cost = row + (letter != text[:, i][:, None])
            cost[~valid] = far
            cost[:, :-1] = np.minimum(cost[:, :-1], row[:, 1:] + 1)  # the item's letter is missing
            cost[closed] = far
            cost = np.minimum.accumulate(cost - column, axis=1) + column  # letters inserted in the document
            row = np.minimum(cost, far).astype(np.int32)
            done = m == i + 1
            if done.any():
                ok = np.where((at + 1 <= hi[:, None]) & ~closed, row, far)
                best[done], place[done] = ok.min(axis=1)[done], (at + 1 - lo[:, None])[np.arange(n), ok.argmin(axis=1)][done]
        return best.astype(np.int64), place

    def find(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(document, item, edits, end), one for each document and item found."""
        data = _FOLD[data]
        doc, item, first = self.candidates(data, offsets)
        edits, end = self.aligned(data, offsets, doc, item, first)
        good = edits <= self.edits[item] if len(item) else np.zeros(0, bool)
        doc, item, edits, end = doc[good], item[good], edits[good], end[good]
        order = np.lexsort((end, edits, item, doc))
        doc, item, edits, end = doc[order], item[order], edits[order], end[order]
        new = np.ones(len(doc), bool)
        new[1:] = (doc[1:] != doc[:-1]) | (item[1:] != item[:-1])
        return doc[new], item[new], edits[new], end[new]


def item_blocks(benchmark: DataFrame, rate: float, limit: int = BLOCK_BYTES) -> Iterator[Items]:
    """The benchmark in blocks of at most ``limit`` bytes; the driver holds one at a time."""
    ids, texts, size = [], [], 0
    for r in benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).toLocalIterator():
        text = (r.text or "").encode()
        if not text.strip(b" \t\n\v\f\r"):
            continue
        if size + len(text) > limit and texts:
            yield Items(ids, texts, rate)
            ids, texts, size = [], [], 0
        ids.append(r.item_id)
        texts.append(text)
        size += len(text)
    if texts:
        yield Items(ids, texts, rate)


def _empty(spark: SparkSession, schema) -> DataFrame:
    return spark.createDataFrame([], schema)


def contaminated(docs: DataFrame, benchmark: DataFrame, rate: float = RATE, limit: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, item_id, edits, doc_end for each document and item found."""
    spark, schema, out = docs.sparkSession, "doc_id long, item_id long, edits long, doc_end long", None
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    for block in item_blocks(benchmark, rate, limit):
        sent = spark.sparkContext.broadcast(block)

        def search(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            items = sent.value
            for batch, data, offsets in runs(batches):
                doc, item, edits, end = items.find(data, offsets)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(doc)), pa.array([items.ids[i] for i in item.tolist()], pa.int64()), pa.array(edits), pa.array(end)], names=["doc_id", "item_id", "edits", "doc_end"])

        found = texts.mapInArrow(search, schema)
        out = found if out is None else out.union(found)
    return _empty(spark, schema) if out is None else out


def without_contaminated(docs: DataFrame, benchmark: DataFrame, rate: float = RATE, limit: int = BLOCK_BYTES) -> DataFrame:
    """The rows of docs, with all their columns, in which no item is found."""
    spark, before = docs.sparkSession, None
    for number, block in enumerate(item_blocks(benchmark, rate, limit)):
        if number:  # the blocks of one stage would stand in memory together
            docs = before = settle(docs, "clean", before)
        sent = spark.sparkContext.broadcast(block)

        def clean(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            for batch, data, offsets in runs(batches):
                keep = np.ones(batch.num_rows, bool)
                keep[sent.value.find(data, offsets)[0]] = False
                yield batch.filter(pa.array(keep))

        docs = docs.mapInArrow(clean, T.StructType([T.StructField(f.name, f.dataType) for f in docs.schema]))
    return docs


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))

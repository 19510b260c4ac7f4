"""Operator 3: packing along a space-filling curve.

Each document's words are hashed, whole, into a signed vector; of a word of over LONG bytes, as texts without separators are, every gram of
GRAM bytes. A fixed projection takes the vector to DIMS numbers, whose Hilbert key orders the documents. They are dealt to ranges of
the curve, whose bounds come from a seeded sample of SAMPLE documents for each range (as Spark's own range exchange does; it would compute all
keys twice), sorted there, and laid one after another into sequences. A document is cut only where a sequence ends, so only the last
sequence of a range has padding.

Equal texts have equal keys; doc_id is the second sort key, so a large group of copies spreads over ranges.
Null text: an empty text, which packs as its end id alone. Null doc_id (sorts first) and repeated rows are kept. Very long texts are packed
whole, over as many sequences as they need. An empty table gives no rows. Columns other than doc_id and text are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plinth.llm.common import mix, partitions, ragged, runs, table, word_spans
from plinth.llm.repeats import span_hashes
from plinth.llm.tokens import PieceEncoder, vocabulary_path

FEATURES, DIMS, BITS = 64, 3, 10
LONG, GRAM = 24, 6
SAMPLE = 60
_NO_ID = -(1 << 63)
SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def document_vectors(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Signed counts of hashed words, scaled to length 1."""
    start, end, first = word_spans(data, offsets)
    n = len(offsets) - 1
    if not len(start):
        return np.zeros((n, FEATURES))
    doc, long = np.repeat(np.arange(n), np.diff(first)), end - start > LONG
    if long.any():
        pieces = (end - start)[long] - GRAM + 1
        at = ragged(start[long], pieces)
        start, end, doc = np.concatenate([start[~long], at]), np.concatenate([end[~long], at + GRAM]), np.concatenate([doc[~long], np.repeat(doc[long], pieces)])
    h = mix(span_hashes(data, start, end))
    sign = np.where(h >> np.uint64(63), 1.0, -1.0)
    v = np.bincount(doc * FEATURES + (h % np.uint64(FEATURES)).astype(np.int64), sign, n * FEATURES).reshape(n, FEATURES)
    norm = np.sqrt((v * v).sum(axis=1, keepdims=True))
    return v / np.maximum(norm, 1e-9)


def hilbert_key(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """The place of integer points (n, dims) on the Hilbert curve, by Skilling's transposition."""
    x = points.astype(np.int64).T.copy()
    dims, q = len(x), 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for i in range(dims):
            high = (x[i] & q) != 0
            t = np.where(high, 0, (x[0] ^ x[i]) & p)
            x[0] ^= np.where(high, p, t)
            x[i] ^= t
        q >>= 1
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    t, q = np.zeros_like(x[0]), 1 << (bits - 1)
    while q > 1:
        t ^= np.where(x[dims - 1] & q, q - 1, 0)
        q >>= 1
    x ^= t
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(dims):
            key = (key << 1) | ((x[i] >> b) & 1)
    return key


def _projection() -> np.ndarray:
    return np.random.default_rng(20240613).standard_normal((FEATURES, DIMS))


def curve_keys(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    at = document_vectors(data, offsets) @ _projection()
    cells = np.clip(((np.tanh(at) + 1) / 2 * (1 << BITS)).astype(np.int64), 0, (1 << BITS) - 1)
    return hilbert_key(cells)


def _keys(text: pa.Array) -> np.ndarray:
    batch = pa.RecordBatch.from_arrays([text], names=["text"])
    return np.concatenate([np.zeros(0, np.int64), *(curve_keys(d, o) for _, d, o in runs(iter([batch])))])


def range_of(key: np.ndarray, doc: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """How many of the bounds, rows of (key, doc) in order, come before or are each (key, doc)."""
    lo, hi = np.searchsorted(bounds[:, 0], key, "left"), np.searchsorted(bounds[:, 0], key, "right")
    for at in np.unique(lo[lo < hi]):  # bounds inside of equal keys
        mine = np.flatnonzero((lo == at) & (lo < hi))
        lo[mine] += np.searchsorted(bounds[at : hi[mine[0]], 1], doc[mine], "right")
    return lo


def range_bounds(docs: DataFrame, ranges: int) -> np.ndarray:
    """ranges - 1 or fewer rows (key, doc) that cut a sample evenly; docs has doc_id and text."""

    @F.arrow_udf("long")
    def key(text: pa.Array) -> pa.Array:
        return pa.array(_keys(text), pa.int64())

    total = docs.count()
    some = docs.sample(min(1.0, SAMPLE * ranges / max(1, total)), seed=20240613)
    rows = some.select(key("text").alias("key"), F.coalesce("doc_id", F.lit(_NO_ID)).alias("doc")).toArrow()  # some SAMPLE rows of 16 bytes for each range
    key_, doc = rows.column(0).to_numpy(), rows.column(1).to_numpy()
    order = np.lexsort((doc, key_))
    cuts = order[np.arange(1, ranges) * len(order) // ranges] if len(order) else order
    return np.unique(np.stack([key_[cuts], doc[cuts]], axis=1), axis=0) if len(cuts) else np.zeros((0, 2), np.int64)


def pack_documents(docs: DataFrame, vocabulary: str, end_id: int, length: int = 2048) -> DataFrame:
    """One row per piece of a document (see SCHEMA); sequences are numbered range << 40 | number."""
    path = vocabulary_path(vocabulary)

    def lay(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, place, sequence = PieceEncoder.of(path), 0, TaskContext.get().partitionId() << 40
        for batch, data, offsets in runs(batches, limit=4 << 20):
            ids, first = encoder.encode(data, offsets)
            ids, n = np.insert(ids, first[1:], end_id).astype("<u4"), np.diff(first) + 1
            begin = np.concatenate([[0], np.cumsum(n)])
            end = int(begin[-1])
            cuts = np.arange(length - place % length, end, length)
            edges = np.unique(np.concatenate([begin, cuts]))
            doc = np.searchsorted(begin, edges[:-1], "right") - 1
            at, size = place + edges[:-1], np.diff(edges)
            marks = edges.tolist()
            rows = [batch.column(0).take(pa.array(doc)), edges[:-1] - begin[doc], size, pa.array([zlib.crc32(ids[a:b]) for a, b in zip(marks, marks[1:], strict=False)], pa.int64()), n[doc], sequence + at // length, at % length]
            made = pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x, pa.int64()) for x in rows], names=[c.split()[0] for c in SCHEMA.split(", ")])
            yield made
            place += end

    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    parts = partitions(docs.sparkSession)
    bounds = range_bounds(plain, parts)

    @F.arrow_udf("struct<curve_key: long, range: int>")
    def place_of(text: pa.Array, doc: pa.Array) -> pa.Array:
        key = _keys(text)
        return pa.StructArray.from_arrays([pa.array(key), pa.array(range_of(key, doc.fill_null(_NO_ID).to_numpy(), bounds).astype(np.int32))], names=["curve_key", "range"])

    keyed = plain.select("doc_id", "text", place_of("text", "doc_id").alias("k")).select("doc_id", "text", "k.curve_key", "k.range")
    ordered = keyed.repartitionById(parts, "range").sortWithinPartitions("curve_key", "doc_id").select("doc_id", "text")
    return ordered.mapInArrow(lay, SCHEMA)


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), "word_bpe_49k.json", 1)

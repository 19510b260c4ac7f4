"""Helpers that every operator of this subpackage shares: tables, shared storage, Arrow text buffers."""

from __future__ import annotations

import contextlib
import ctypes
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Texts are handled in runs of about so many bytes, which bounds a Python worker's temporary arrays.
RUN_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """A new folder below the one the cluster names in ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder of its own.
    """
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if not base:
        base = context.getCheckpointDir()
    if not base:
        if not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="plinth-")
        context.setCheckpointDir(base)
    return f"{base.rstrip('/')}/plinth-{uuid.uuid4().hex}"


#: Folders that ``settle`` has written and nobody has discarded.
_SETTLED: list[str] = []


def settle(df: DataFrame, name: str, instead_of: DataFrame | None = None) -> DataFrame:
    """Write ``df`` to shared storage and read it back: lineage ends there, and lost executors cost nothing.

    ``instead_of``: an earlier result of this function that nothing but ``df`` needs; its folder goes once the new one is written."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}"
    df.write.parquet(path)
    _SETTLED.append(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.settled_path = path
    if instead_of is not None and hasattr(instead_of, "settled_path"):
        discard(spark, [instead_of.settled_path])
    return out


def discard(spark: SparkSession, paths: list[str] | None = None) -> None:
    """Delete settled folders, by default all of this session: for when every result that reads them has been written."""
    for path in list(_SETTLED) if paths is None else paths:
        parent = spark._jvm.org.apache.hadoop.fs.Path(path.rpartition("/")[0])
        parent.getFileSystem(spark._jsc.hadoopConfiguration()).delete(parent, True)
        _SETTLED.remove(path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def texts(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The column's bytes and its int64 offsets (starting at 0); a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("" if not pa.types.is_binary(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def release() -> None:
    """Give freed memory back to the system: Python workers live on between stages."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(AttributeError, OSError):  # only glibc has it
        ctypes.CDLL(None).malloc_trim(0)


def runs(batches: Iterator[pa.RecordBatch], text: str = "text", limit: int = RUN_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Batches cut so that each has at most ``limit`` bytes of text, or one row: (batch, bytes, offsets)."""
    for batch in batches:
        yield from slices(batch, text, limit)
    release()


def slices(batch: pa.RecordBatch, text: str = "text", limit: int = RUN_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    data, offsets = texts(batch.column(batch.schema.get_field_index(text)))
    lo, n = 0, batch.num_rows
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1)
        yield batch.slice(lo, hi - lo), data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        lo = hi


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Concatenated aranges: for each i the positions starts[i] .. starts[i]+lengths[i]-1."""
    total = int(lengths.sum())
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(total, dtype=np.int64)


SEPARATOR = np.zeros(256, bool)
SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, first): each word ``[^\\x20\\x09-\\x0D]+``'s byte range, and each text's first word's number (one more entry at the end)."""
    if len(data) == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    inside = ~SEPARATOR[data]
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    edge = offsets[1:-1]
    edge = edge[(edge > 0) & (edge < len(data))]
    begins[edge] = inside[edge]
    ends[edge - 1] = inside[edge - 1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return start, end, np.searchsorted(start, offsets)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer (Stafford's variant 13)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` consecutive values; len(values)-width+1 results."""
    return _sliding(values, width, np.minimum)


def sliding_max(values: np.ndarray, width: int) -> np.ndarray:
    return _sliding(values, width, np.maximum)


def _sliding(values: np.ndarray, width: int, pick) -> np.ndarray:
    have = 1
    while have * 2 <= width:
        values = pick(values[:-have], values[have:])
        have *= 2
    return pick(values[: len(values) - (width - have)], values[width - have :]) if have < width else values


def null_safe_text(name: str = "text"):
    return F.coalesce(F.col(name).cast("string"), F.lit(""))

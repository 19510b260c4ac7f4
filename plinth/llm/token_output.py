"""Operator 5: token ids in a fixed-width bit-packed file format.

Every id takes the minimum number of bits that the vocabulary needs. 64 ids make ``bits`` little-endian 64-bit words;
a block holds BLOCK ids, the last block of a file is filled up with zeros. A file is

    block* | footer: doc ids int64[d], null flags uint8[d], first ids int64[d+1], block offsets int64[b+1]
           | tail: bits, docs, blocks as int64[3] | magic

Blocks are found by their offsets and unpacked by numpy, so any range of ids can be read without what precedes it.
A file holds one range of doc_id and files are numbered in ascending doc_id order. A task writes under a name of its own
and then renames, so a task that runs twice, or is lost, leaves one whole file.

Null text: an empty text, which still gets its end id. Null doc_id: sorts first. Repeated rows are kept, each with ids of its own.
An empty table gives no rows. Columns other than doc_id and text are not read.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plinth.llm.common import runs, shared_dir, table
from plinth.llm.tokens import PieceEncoder, vocabulary_path

MAGIC = b"PLNTBIT1"
GROUP = 64
BLOCK = 4096


def bits_for(vocabulary: int) -> int:
    return max(1, int(vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> np.ndarray:
    """ids (a multiple of 64) as 64-bit words, ``bits`` words for each 64 ids."""
    lanes = ids.astype(np.uint64).reshape(-1, GROUP)
    words = np.zeros((len(lanes), bits), np.uint64)
    for j in range(GROUP):
        word, shift = divmod(j * bits, 64)
        words[:, word] |= lanes[:, j] << np.uint64(shift)
        if shift + bits > 64:
            words[:, word + 1] |= lanes[:, j] >> np.uint64(64 - shift)
    return words.reshape(-1)


def unpack(words: np.ndarray, bits: int) -> np.ndarray:
    words = words.reshape(-1, bits)
    lanes = np.empty((len(words), GROUP), np.uint32)
    mask = np.uint64((1 << bits) - 1)
    for j in range(GROUP):
        word, shift = divmod(j * bits, 64)
        x = words[:, word] >> np.uint64(shift)
        if shift + bits > 64:
            x = x | (words[:, word + 1] << np.uint64(64 - shift))
        lanes[:, j] = x & mask
    return lanes.reshape(-1)


class BitWriter:
    def __init__(self, uri: str, bits: int):
        self.files, self.path = arrow_fs.FileSystem.from_uri(uri)
        self.temporary = f"{self.path}.{uuid.uuid4().hex}"
        self.files.create_dir(self.path.rpartition("/")[0], recursive=True)
        self.out = self.files.open_output_stream(self.temporary)
        self.bits, self.rest, self.offsets = bits, np.zeros(0, np.uint32), [0]
        self.docs: list[np.ndarray] = []
        self.nulls: list[np.ndarray] = []
        self.lengths: list[np.ndarray] = []

    def add(self, doc_ids: np.ndarray, nulls: np.ndarray, ids: np.ndarray, lengths: np.ndarray) -> None:
        self.docs.append(doc_ids)
        self.nulls.append(nulls)
        self.lengths.append(lengths)
        ids = np.concatenate([self.rest, ids])
        whole = len(ids) // BLOCK * BLOCK
        self._blocks(ids[:whole])
        self.rest = ids[whole:]

    def _blocks(self, ids: np.ndarray) -> None:
        if len(ids):
            self.out.write(pack(ids, self.bits).tobytes())
            size = BLOCK // GROUP * self.bits * 8
            self.offsets.extend(range(self.offsets[-1] + size, self.offsets[-1] + size * (len(ids) // BLOCK) + 1, size))

    def close(self) -> tuple[int, int]:
        if len(self.rest):
            self._blocks(np.concatenate([self.rest, np.zeros(-len(self.rest) % BLOCK, np.uint32)]))
        docs = np.concatenate([np.zeros(0, np.int64), *self.docs])
        first = np.concatenate([[0], np.cumsum(np.concatenate([np.zeros(0, np.int64), *self.lengths]))]).astype("<i8")
        self.out.write(docs.astype("<i8").tobytes() + np.concatenate([np.zeros(0, np.uint8), *self.nulls]).astype(np.uint8).tobytes() + first.tobytes() + np.array(self.offsets, "<i8").tobytes())
        self.out.write(np.array([self.bits, len(docs), len(self.offsets) - 1], "<i8").tobytes() + MAGIC)
        self.out.close()
        self.files.move(self.temporary, self.path)
        return len(docs), int(first[-1])


class BitReader:
    """Random access to one file: ids(lo, hi) gives the ids of that range."""

    def __init__(self, uri: str):
        files, path = arrow_fs.FileSystem.from_uri(uri)
        self.file = files.open_input_file(path)
        size = self.file.size()
        tail = self._at(size - 24 - len(MAGIC), 24 + len(MAGIC))
        if tail[24:] != MAGIC:
            raise ValueError(f"not a bit-packed token file: {uri}")
        self.bits, n, blocks = map(int, np.frombuffer(tail[:24], "<i8"))
        length = n * 8 + n + (n + 1) * 8 + (blocks + 1) * 8
        footer = self._at(size - 24 - len(MAGIC) - length, length)
        self.doc_ids = np.frombuffer(footer, "<i8", n)
        self.nulls = np.frombuffer(footer, np.uint8, n, n * 8).astype(bool)
        self.first = np.frombuffer(footer, "<i8", n + 1, n * 9)
        self.offsets = np.frombuffer(footer, "<i8", blocks + 1, n * 9 + (n + 1) * 8)

    def _at(self, place: int, length: int) -> bytes:
        self.file.seek(place)
        return self.file.read(length)

    def ids(self, lo: int, hi: int) -> np.ndarray:
        if hi <= lo:
            return np.zeros(0, np.uint32)
        a, b = lo // BLOCK, (hi - 1) // BLOCK + 1
        words = np.frombuffer(self._at(int(self.offsets[a]), int(self.offsets[b] - self.offsets[a])), "<u8")
        return unpack(words, self.bits)[lo - a * BLOCK : hi - a * BLOCK]


def write_token_files(docs: DataFrame, directory: str, vocabulary: str, end_id: int, n_ids: int) -> list[tuple[str, int, int]]:
    """Encode every text, append ``end_id``, write files in ascending doc_id order; (file, documents, ids) in that order."""
    path, bits = vocabulary_path(vocabulary), bits_for(n_ids)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, out = TaskContext.get().partitionId(), None
        uri = f"{directory}/part-{part:08d}.ptok"
        encoder = PieceEncoder.of(path)
        for batch, data, offsets in runs(batches, limit=4 << 20):
            out = out or BitWriter(uri, bits)
            ids, first = encoder.encode(data, offsets)
            ids, lengths = np.insert(ids, first[1:], end_id), np.diff(first) + 1
            key = batch.column(0)
            out.add(key.fill_null(0).to_numpy().astype(np.int64), key.is_null().to_numpy(zero_copy_only=False), ids, lengths)
        if out:
            n, total = out.close()
            yield pa.RecordBatch.from_pylist([{"part": part, "uri": uri, "docs": n, "ids": total}])

    ordered = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    made = ordered.mapInArrow(write, "part long, uri string, docs long, ids long").collect()  # a row for each file
    return [(r.uri, r.docs, r.ids) for r in sorted(made, key=lambda r: r.part)]


def read_token_files(spark: SparkSession, files: list[tuple[str, int, int]]) -> DataFrame:
    """Per document of the files: doc_id, start, n_tokens, ids_crc32, file_no."""
    uris = [f[0] for f in files]
    bases = np.concatenate([[0], np.cumsum([f[2] for f in files])]).tolist()
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long, file_no int"
    if not files:
        return spark.createDataFrame([], schema)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in batch.column(0).to_pylist():
                file = BitReader(uris[k])
                first, lo, n = file.first, 0, len(file.doc_ids)
                while lo < n:
                    hi = max(lo + 1, int(np.searchsorted(first, first[lo] + (1 << 20), "right")) - 1)
                    ids = file.ids(int(first[lo]), int(first[hi])).astype("<u4")
                    at = (first[lo : hi + 1] - first[lo]).tolist()
                    crc = [zlib.crc32(ids[a:b]) for a, b in zip(at, at[1:], strict=False)]
                    yield pa.RecordBatch.from_arrays([pa.array(file.doc_ids[lo:hi], mask=file.nulls[lo:hi]), pa.array(first[lo:hi] + bases[k]), pa.array(np.diff(first[lo : hi + 1])), pa.array(crc, pa.int64()), pa.array(np.full(hi - lo, k, np.int32))], names=["doc_id", "start", "n_tokens", "ids_crc32", "file_no"])
                    lo = hi

    return spark.range(0, len(files), 1, len(files)).mapInArrow(read, schema)


def op5_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = write_token_files(table(spark, sf_dir, "documents"), shared_dir(spark), "byte_bpe_50k.json", 2, 50257)
    return read_token_files(spark, files)

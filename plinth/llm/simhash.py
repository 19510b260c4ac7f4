"""Operator 8: SimHash near-duplicates by tiled exact comparison.

Fingerprints are compared in tiles with exclusive-or and bit counts; pairs of tiles whose population counts differ by more than
the radius are skipped. Distinct fingerprints only are compared. Of r + 2 bit blocks, two that differ in at most r bits agree in
two, so tiles are laid out by the values of every two blocks, about 26 bits, and only tiles with common values meet: no link is lost.
Of n fingerprints with no structure, about 10 n^2 / 2^26 / 2 pairs are compared, so 10^9 take what 2.7 * 10^5 would if all tiles
met. Values with more than HOT fingerprints are cut into chunks whose pairs go to different tasks.
Each task returns a spanning forest of its links; components are the fixed point of large-star and small-star steps.

Null text: no words, fingerprint zero. Null doc_id never becomes a component's id unless it has no other. Rows with equal
doc_id are one node for each fingerprint. Very long texts are fingerprinted whole. An empty table gives no rows. Columns other than doc_id and
text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plinth.llm.common import partitions, runs, settle, table

SHINGLE, RADIUS, SEED = 3, 3, 42
TILE = 256
#: Fingerprints of one block value that a task compares with each other; more are dealt as pairs of chunks.
HOT = 16_384
CHUNK_BITS = 1 << 14


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    import xxhash

    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = min(shingle, len(words))
    digest = xxhash.xxh64_intdigest
    pairs = zip(starts[: len(words) - n + 1].tolist(), ends[n - 1 :].tolist(), strict=True)
    h = np.fromiter((digest(joined[a:b], SEED) for a, b in pairs), np.uint64, len(words) - n + 1)
    counts = np.zeros(64, np.int64)
    for lo in range(0, len(h), CHUNK_BITS):
        counts += np.unpackbits(h[lo : lo + CHUNK_BITS].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * counts > len(h)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprints(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    raw, at = data.tobytes(), offsets.tolist()
    return np.fromiter((fingerprint(raw[a:b]) for a, b in zip(at, at[1:], strict=False)), np.uint64, len(at) - 1)


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, data, offsets in runs(batches):
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fingerprints(data, offsets).view(np.int64))], names=["doc_id", "fp"])


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links, as stars: (member, least of its component)."""
    nodes, place = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = place[: len(a)], place[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[x], label[y])
        new = label.copy()
        np.minimum.at(new, label[x], low)
        np.minimum.at(new, label[y], low)
        new = new[new]
        if np.array_equal(new, label):
            break
        label = new
    other = label != np.arange(len(nodes))
    return nodes[other], nodes[label[other]]


def tile_links(fp: np.ndarray, key: np.ndarray, radius: int, tile: int = TILE) -> tuple[np.ndarray, np.ndarray]:
    """Links among rows of equal key; rows are in order of key and population count."""
    ones = np.bitwise_count(fp).astype(np.int16)
    found_a, found_b, held = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)], 0
    marks = range(0, len(fp), tile)
    low, high = np.array([ones[m : m + tile].min() for m in marks]), np.array([ones[m : m + tile].max() for m in marks])
    first, last = key[::tile], np.array([key[min(m + tile, len(fp)) - 1] for m in marks])
    for i in range(len(first)):
        x = slice(i * tile, (i + 1) * tile)
        for j in range(i, len(first)):
            if first[j] > last[i]:
                break
            if low[j] > high[i] + radius or low[i] > high[j] + radius:
                continue
            y = slice(j * tile, (j + 1) * tile)
            differ = fp[x][:, None] ^ fp[y][None, :]
            near = (np.bitwise_count(differ) <= radius) & (key[x][:, None] == key[y][None, :])
            if i == j:
                near = np.triu(near, 1)
            r, c = np.nonzero(near)
            if len(r):
                found_a.append(fp[x][r])
                found_b.append(fp[y][c])
                held += len(r)
                if held > 500_000:
                    a, b = forest(np.concatenate(found_a), np.concatenate(found_b))
                    found_a, found_b, held = [a], [b], 0
    return forest(np.concatenate(found_a), np.concatenate(found_b))


def bit_blocks(radius: int) -> list[int]:
    """Masks of every two of radius + 2 blocks of 64 bits: fingerprints that differ in at most ``radius`` bits are equal under one of them."""
    edges = [round(64 * k / (radius + 2)) for k in range(radius + 3)]
    blocks = [(1 << b) - (1 << a) for a, b in zip(edges, edges[1:], strict=False)]
    return [x | y for k, x in enumerate(blocks) for y in blocks[k + 1 :]]


def links(fingerprints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(a, b) with a > b: a forest, from each task, of the links among distinct fingerprints ``fp``."""
    parts = partitions(fingerprints.sparkSession)
    signed = lambda mask: mask - (1 << 64) if mask >> 63 else mask
    keys = F.array(*(F.struct(F.lit(k).cast("long").alias("block"), F.col("fp").bitwiseAND(F.lit(signed(m))).alias("value")) for k, m in enumerate(bit_blocks(radius))))
    rows = fingerprints.select("fp", F.explode(keys).alias("k")).select("fp", "k.block", "k.value")
    hot = rows.groupBy("block", "value").count().filter(F.col("count") > HOT).select("block", "value", F.ceil(F.col("count") / HOT).cast("int").alias("chunks"))
    dealt = rows.join(hot, ["block", "value"], "left").withColumn("chunks", F.coalesce("chunks", F.lit(1))).withColumn("mine", F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int"))
    pairs = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).select("fp", "block", "value", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        have = [b for b in batches if b.num_rows]
        if not have:
            return
        t = pa.Table.from_batches(have)
        fp = t.column("fp").to_numpy().view(np.uint64)
        cols = [t.column(c).to_numpy().astype(np.int64) for c in ("block", "value", "i", "j")]
        order = np.lexsort((fp, np.bitwise_count(fp), *cols[::-1]))
        cols = [c[order] for c in cols]
        group = np.cumsum(np.concatenate([[False], np.any([c[1:] != c[:-1] for c in cols], axis=0)]))
        a, b = tile_links(fp[order], group, radius)
        yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

    return pairs.repartition(parts, "block", "value", "i", "j").mapInArrow(compare, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node but the roots: large-star and small-star steps until nothing changes."""

    def seen(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first())

    now = settle(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    state = seen(now)
    while state[0]:
        both = now.union(now.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        small = large.groupBy("a").agg(F.min("b").alias("m"))
        moved = large.join(small, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = settle(moved.union(small.select("a", "m")).distinct(), "links", now)
        after = seen(now)
        if after == state:
            break
        state = after
    return now.select(F.col("a").alias("node"), F.col("b").alias("root"))


def near_duplicates(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Per row of docs: doc_id, fingerprint, component_id."""
    made = settle(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(_fingerprints, "doc_id long, fp long"), "fingerprints")
    distinct = settle(made.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    roots = components(links(distinct.select("fp"), radius))
    member = distinct.join(roots, distinct.fp == roots.node, "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    least = member.groupBy("root").agg(F.min("least").alias("component_id"))
    named = member.join(least, "root").select("fp", "component_id")
    return made.join(named, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))

"""Operator 10: shards of nearly equal bytes, by Karmarkar-Karp differencing.

Equal texts form an indivisible group, so all copies of a text share a shard. Each task combines its groups' partial
partitions (k sorted sums): again and again the two with the largest spread, laid oppositely; in batches of BATCH groups, and then
those of the batches. What the tasks are left with, k sums each, is combined in the same way on the driver: k numbers for each
task, whatever the row count. A shard exceeds the others only if one group alone is larger than a fair share.

Null text counts as an empty text (16 bytes). Null doc_id and repeated rows are kept, each with a slot of its own. Very long texts
count whole. An empty table gives no rows. Columns other than doc_id and text are not read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plinth.llm.common import null_safe_text, partitions, settle, table

ROW_BYTES = 16
#: Groups whose partial partitions are combined together.
BATCH = 20_000


def differencing(parts: list[np.ndarray]) -> tuple[list[np.ndarray], np.ndarray]:
    """Combine partial partitions of k sums each: for every one, the final bin of each of its bins; and the final sums."""
    k = len(parts[0])
    sums: list[np.ndarray] = []
    made: list[tuple] = []  # of each node: the two nodes it combines and which of their bins meet
    heap: list[tuple[int, int]] = []

    def push(x: np.ndarray, how: tuple) -> None:
        sums.append(x)
        made.append(how)
        heapq.heappush(heap, (int(x.min()) - int(x.max()), len(sums) - 1))

    for x in parts:
        push(x, ())
    while len(heap) > 1:
        a, b = heapq.heappop(heap)[1], heapq.heappop(heap)[1]
        up, down = np.argsort(sums[a], kind="stable"), np.argsort(-sums[b], kind="stable")
        push(sums[a][up] + sums[b][down], (a, b, up, down))
        sums[a] = sums[b] = None
    root = len(sums) - 1
    total, finals = sums[root], {root: np.arange(k)}
    for node in range(root, len(parts) - 1, -1):
        a, b, up, down = made[node]
        to = finals.pop(node)
        finals[a], finals[b] = np.empty(k, np.int64), np.empty(k, np.int64)
        finals[a][up], finals[b][down] = to, to
    return [finals[i] for i in range(len(parts))], total


def bins_of(sizes: np.ndarray, shards: int, batch: int = BATCH) -> np.ndarray:
    """The bin of each group. Groups are dealt in batches, whose partitions are then combined: the partial partitions of one batch stand in memory."""
    out, sums = np.empty(len(sizes), np.int32), []
    for lo in range(0, len(sizes), batch):
        part = sizes[lo : lo + batch]
        single = np.zeros((len(part), shards), np.int64)
        single[:, 0] = part
        bins, total = differencing(list(single))
        out[lo : lo + batch] = [b[0] for b in bins]
        sums.append(total)
    if len(sums) > 1:
        for number, to in enumerate(differencing(sums)[0]):
            part = slice(number * batch, (number + 1) * batch)
            out[part] = to[out[part]]
    return out


def shard_groups(groups: DataFrame, shards: int) -> DataFrame:
    """groups (key, n, bytes) -> the same with the task that dealt each and its bin there."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [b for b in batches if b.num_rows]
        if not rows:
            return
        t = pa.Table.from_batches(rows)
        sizes = t.column("bytes").to_numpy()
        t = t.append_column("task", pa.array(np.full(len(sizes), TaskContext.get().partitionId(), np.int64)))
        t = t.append_column("bin", pa.array(bins_of(sizes, shards).astype(np.int64)))
        yield from t.combine_chunks().to_batches()

    return groups.mapInArrow(deal, "key binary, n long, bytes long, task long, bin long")


def shard_by_bytes(docs: DataFrame, shards: int = 40) -> DataFrame:
    """Per row of docs: doc_id, size, text_crc32, law, shard, slot, grown_shard."""
    spark = docs.sparkSession
    text = null_safe_text()
    rows = settle(docs.select(F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + F.lit(ROW_BYTES)).cast("long").alias("size"), F.crc32(text).alias("text_crc32"), F.unhex(F.sha2(text, 256)).alias("key")), "rows")
    groups = rows.groupBy("key").agg(F.count("*").alias("n"), F.sum("size").alias("bytes"))
    dealt = settle(shard_groups(groups, shards), "groups")
    sums: dict[int, np.ndarray] = {}
    for r in dealt.groupBy("task", "bin").agg(F.sum("bytes").alias("bytes")).collect():  # at most tasks x shards rows
        sums.setdefault(r.task, np.zeros(shards, np.int64))[r.bin] = r.bytes
    tasks = sorted(sums)
    finals = differencing([sums[t] for t in tasks])[0] if tasks else []
    places = spark.createDataFrame([(t, b, int(s)) for t, to in zip(tasks, finals, strict=True) for b, s in enumerate(to)], "task long, bin long, shard int")
    parts = partitions(spark)
    placed = rows.join(dealt.select("key", "task", "bin"), "key").join(places, ["task", "bin"]).select("doc_id", "size", "text_crc32", "shard", F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(parts)).cast("int").alias("block"))
    before = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    bases = placed.groupBy("block", "shard").count().select("block", "shard", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("base"))
    within = Window.partitionBy("block", "shard").orderBy("doc_id", "text_crc32")
    numbered = placed.withColumn("number", F.row_number().over(within).cast("long") - 1)
    return numbered.join(bases, ["block", "shard"]).select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("base") + F.col("number")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_by_bytes(table(spark, sf_dir, "documents"), 40)

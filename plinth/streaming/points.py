"""Structure points that arrive as a stream, matched with static footprints: each micro-batch is bridged as a batch would be."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from plinth.operators.bridges import CELL, nsi_bridge


def bridge_stream(points: DataFrame, footprints: DataFrame, path: str, checkpoint: str, reach: float, cell: float = CELL) -> StreamingQuery:
    """Writes each batch's bridge to path/batch=N; a repeated batch replaces its own folder, so rows come exactly once."""

    def write(batch: DataFrame, number: int) -> None:
        nsi_bridge(batch, footprints, reach, cell).write.mode("overwrite").parquet(f"{path}/batch={number}")

    return points.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()

"""The best row of each group, with explicit null order and tie-breaks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def best_per(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each group; Spark prunes each partition to group limits before the shuffle."""
    return df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter("_rank = 1").drop("_rank")


def surrogate_id(df: DataFrame, name: str, order: list[str], parts: int | None = None) -> DataFrame:
    """Dense ids from 0 in the given order, by counting range partitions instead of one window over all rows."""
    parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(parts, *order).withColumn("_part", F.spark_partition_id())
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each partition
    bases = ranged.groupBy("_part").count().select("_part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_base"))
    local = F.row_number().over(Window.partitionBy("_part").orderBy(*order)) - 1
    return ranged.withColumn("_local", local).join(bases, "_part").withColumn(name, (F.col("_base") + F.col("_local")).cast("long")).drop("_part", "_base", "_local")

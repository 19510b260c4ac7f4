"""Counts and rates of each layer, as DataFrames of one row or one row for each kind."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def percent(part: Column, whole: Column, digits: int = 1) -> Column:
    """Half up, 0.0 of nothing."""
    scale = 10.0**digits
    return F.when(whole > 0, F.floor(part * 100.0 * scale / whole + 0.5) / scale).otherwise(0.0)


def total(df: DataFrame) -> Column:
    """The number of rows as a scalar subquery."""
    return df.agg(F.count("*").alias("total")).scalar()


def fema_rates(bridge: DataFrame, fema: DataFrame) -> DataFrame:
    """total, matched (different second-source ids), overture_matched (different first-source ids), pct."""
    counts = bridge.agg(F.count_distinct("fema_id").alias("matched"), F.count_distinct("overture_id").alias("overture_matched"))
    return counts.withColumn("total", total(fema)).select("total", "matched", "overture_matched", percent(F.col("matched"), F.col("total")).alias("pct"))


def nsi_rates(bridge: DataFrame, points: DataFrame) -> DataFrame:
    """total, matched, one count for each way of matching, pct."""
    ways = {"pip": "point_in_polygon", "hull": "convex_hull", "nearest": "nearest_neighbor"}
    counts = bridge.agg(F.count("*").alias("matched"), *(F.count_if(F.col("match_method") == v).alias(k) for k, v in ways.items()))
    return counts.withColumn("total", total(points)).select("total", "matched", *ways, percent(F.col("matched"), F.col("total")).alias("pct"))


def rates_by_method(bridge: DataFrame, points: DataFrame) -> DataFrame:
    """match_method, n, pct of all points."""
    return bridge.groupBy("match_method").agg(F.count("*").alias("n")).withColumn("total", total(points)).select("match_method", "n", (F.col("n") / F.col("total") * 100).alias("pct"))


def gold_counts(gold: DataFrame) -> DataFrame:
    """Rows, by source, with a second-source match, with a point, with geometry and with an occupancy: one pass."""
    held = lambda c: F.count(c)
    return gold.agg(
        F.count("*").alias("total"), F.count_if(F.col("source") == "overture").alias("overture"), F.count_if(F.col("source") == "fema_only").alias("fema_only"),
        F.count_if(F.col("overture_id").isNotNull() & F.col("fema_id").isNotNull()).alias("matched"), F.count_if("has_nsi_match").alias("with_nsi"),
        held("geometry").alias("with_geometry"), held("general_occupancy").alias("with_occupancy"),
    )


def lost_rows(fema: DataFrame) -> DataFrame:
    """Second-source rows without an id, which no part of the gold table holds."""
    return fema.agg(F.count("*").alias("total"), F.count_if(F.col("fema_id").isNull()).alias("without_id"))

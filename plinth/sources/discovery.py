"""Finding what to read: release listings and index pages, as DataFrame expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def release_names(xml: Column) -> Column:
    """Names in a bucket listing's CommonPrefixes, without 'release/' and the closing slash."""
    return F.transform(F.xpath(xml, F.lit("ListBucketResult/CommonPrefixes/Prefix/text()")), lambda p: F.regexp_replace(F.regexp_replace(p, "^release/", ""), "/+$", ""))


def latest_release(listing: DataFrame, column: str = "xml") -> DataFrame:
    """The greatest release name in text order."""
    return listing.select(F.explode(release_names(F.col(column))).alias("release")).agg(F.max("release").alias("release"))


def index_links(pages: DataFrame, html: str, pattern: str, order: str) -> DataFrame:
    """key, url: links whose target has ``pattern``'s first group, in order of pages (by the column ``order``) and of appearance; of one key the last link wins."""
    links = pages.select(F.col(order).alias("page"), F.posexplode(F.regexp_extract_all(html, F.lit(r'href="([^"]*)"'), F.lit(1))).alias("place", "url"))
    keyed = links.withColumn("key", F.regexp_extract("url", pattern, 1)).filter("key <> ''")
    return keyed.groupBy("key").agg(F.max_by("url", F.struct("page", "place")).alias("url"))

"""Corpus preparation as stages, each of which applies one operator of plinth.llm to all that the stage before kept.

Every stage but the last returns the columns of documents; n_chars follows a changed text. Rows of one doc_id with different texts
are told apart by their texts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plinth.llm.common import settle, table
from plinth.llm.decontamination import without_contaminated
from plinth.llm.near_copies import near_copies, with_keys
from plinth.llm.packing import pack_documents
from plinth.llm.quality import quality_rules
from plinth.llm.substring_dedup import remove_repeated_words


def _counted(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else docs


#: Boilerplate lines may hold up to this share of a kept document's words.
DEPLETED_PERCENT = 50


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go, and the others lose their host's boilerplate lines."""
    more = [c for c in docs.columns if c != "text"]
    kept = quality_rules(docs, more, depleted_percent=DEPLETED_PERCENT).filter("kept")
    return _counted(kept.select(*((F.col("clean_text") if c == "text" else F.col(f"carried.`{c}`")).alias(c) for c in docs.columns)))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near copies (five-word shingles, similarity 0.8 or more; by operator 8 with an exact check, and the sets of what it
    leaves apart) one row stays: that of the smallest doc_id, null last. Of rows that have it and different texts, the one with the least hash
    stays, and one of those with equal words."""
    found = near_copies(docs)
    stays = found.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "key", "n")).alias("s")).select("s.doc_id", "s.key", "s.n")
    stays = settle(stays, "stays")
    key = "".join(["key", *docs.columns])  # no column has this name
    chosen = stays.select(F.col("doc_id").alias(f"{key}_d"), F.col("key").alias(f"{key}_k"))
    rows = with_keys(docs, key)
    left = rows.join(chosen, F.col("doc_id").eqNullSafe(F.col(f"{key}_d")) & (F.col(key) == F.col(f"{key}_k")), "left_semi")
    if stays.filter("n > 1").take(1):  # repeated rows
        left = left.dropDuplicates(["doc_id", key])
    return left.drop(key)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated words go, and documents of which nothing is left. Texts that lose nothing keep their white space."""
    more = [c for c in docs.columns if c not in ("doc_id", "text")]
    cut = remove_repeated_words(docs, carry=more).filter("n_removed < n_words")
    own = {"doc_id": F.col("doc_id").cast(docs.schema["doc_id"].dataType), "text": F.col("kept_text")}
    return _counted(cut.select(*(own.get(c, F.col(f"carried.`{c}`")).alias(c) for c in docs.columns)))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a benchmark item go."""
    return without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack_documents(docs, "word_bpe_49k.json", 1)


STAGES = [("quality rules", rules), ("near dedup", near_dedup), ("substring dedup", substring_dedup), ("decontamination", decontaminate), ("packing", pack)]

#: SQL can express neither the near-duplicate components, nor the banded alignment, nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return STAGES[-1][1](spark, docs, sf_dir)

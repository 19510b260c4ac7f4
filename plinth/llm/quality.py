"""Operator 6: quality rules, with DataFrame functions only.

Base rules need the document alone. Beyond them, each line is normalised (A-Z lowered, separators collapsed) and hashed, and the distinct
documents of a host that contain it are counted. A line that more than LINE_DOCS of them contain, and more than the square root of
their number, is boilerplate of that host and goes: the limit grows with the host, but slower, so that no host is too large for it.
A document is rejected when such lines hold more than DEPLETED_PERCENT of its words. Documents are distinct by their text, so that copying a
document, however often, does not make its lines boilerplate. Texts and lines are told apart by 128 bits of hash.

Null source: the host ''. Null text: no words, which fails the base rules. Null doc_id and repeated rows are kept, the latter counting as one
document of their host. Very long texts are measured whole. An empty table gives no rows. Columns of the input come out only as members of the
struct ``carried``, so none clashes with what is made.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plinth.llm.common import null_safe_text, table

SEPARATORS = r"[\x20\x09-\x0D]+"
SPACES = " \t\n\u000b\f\r"
SYMBOLS = "#*$%&|<>"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LINE_DOCS, DEPLETED_PERCENT = 3, 30
WINDOW = 8
MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, SEPARATORS), lambda w: w != "")


def _repeat_words(windows: str) -> Column:
    """Words in windows of WINDOW words that the text has twice or more. windows: their hashes in order."""
    pairs = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0)).otherwise(_covered(pairs))


def _covered(pairs: Column) -> Column:
    # in hash order, a start is repeated if its neighbour before or after has its hash
    left = F.transform(pairs, lambda p: p["h"])
    marked = F.zip_with(F.zip_with(pairs, F.concat(F.array(F.lit(None).cast("long")), left), lambda p, h: F.struct(p["h"].alias("h"), p["i"].alias("i"), (p["h"] == h).alias("before"))), F.slice(F.concat(left, F.array(F.lit(None).cast("long"))), F.lit(2), F.size(left)), lambda p, h: F.when(F.coalesce(p["before"], F.lit(False)) | F.coalesce(p["h"] == h, F.lit(False)), p["i"]))
    starts = F.sort_array(F.filter(marked, lambda i: i.isNotNull()))
    none = F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("total"))
    return F.aggregate(starts, none, lambda a, i: F.struct(i.alias("last"), (a["total"] + F.least(F.lit(WINDOW), i - a["last"])).alias("total")), lambda a: a["total"])


def base_measures(docs: DataFrame) -> DataFrame:
    """docs, which has the columns text, host and perhaps carried, with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and base_failed."""
    text = F.col("text")
    # exploding an array of one keeps the optimizer from moving filters below, and so repeating, what they are made from
    words = docs.select("*", F.explode(F.array(F.transform(words_of(text), lambda w: F.xxhash64(w)))).alias("hashes"))
    windows = (F.when(F.size("hashes") >= WINDOW, F.transform(F.sequence(F.lit(1), F.size("hashes") - (WINDOW - 1)), lambda i: F.xxhash64(F.slice("hashes", i, F.lit(WINDOW))))).otherwise(F.array().cast("array<bigint>")))
    grams = words.select("*", F.explode(F.array(windows)).alias("windows"))
    lines = F.filter(F.split(text, "\n"), lambda x: F.length(F.translate(x, SPACES, "")) > 0)
    out = (
        grams.withColumn("n_words", F.size("hashes").cast("long"))
        .withColumn("word_chars", F.length(F.translate(text, SPACES, "")).cast("long"))
        .withColumn("n_symbols", (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long"))
        .withColumn("n_dup_lines", F.aggregate(F.array(lines), F.lit(0), lambda a, x: a + F.size(x) - F.size(F.array_distinct(x))).cast("long"))
        .select("*", F.explode(F.array(_repeat_words("windows").cast("long"))).alias("n_repeat_words"))
    )
    failed = (F.col("n_words") < 20) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 30)
    return out.withColumn("base_failed", failed).drop("hashes", "windows")


def normalised(line: Column) -> Column:
    return F.translate(F.trim(F.regexp_replace(line, SEPARATORS, " ")), UPPER, LOWER)


def _hashes(text: Column) -> list[Column]:
    """Two 64-bit hashes with different seeds."""
    return [F.xxhash64(text), F.xxhash64(F.lit(1), text)]


def boilerplate(docs: DataFrame, line_docs: int = LINE_DOCS) -> DataFrame:
    """(host, text_a, text_b, removed_words, lines): for each text (by its hashes) that has boilerplate lines of its host, their words and hashes."""
    a, b = _hashes(F.col("text"))
    named = docs.select("host", a.alias("text_a"), b.alias("text_b"), "text")
    each = named.select("host", "text_a", "text_b", F.posexplode(F.split("text", "\n")).alias("place", "line"))
    normal = each.filter(F.length(F.translate("line", SPACES, "")) > 0).withColumn("line", normalised(F.col("line")))
    a, b = _hashes(F.col("line"))
    hashed = normal.select("host", "text_a", "text_b", "place", a.alias("line_a"), b.alias("line_b"), F.size(F.split("line", " ")).alias("words"))
    # copies of a text meet here, so that neither a large group of copies nor a common line gathers in one task
    text, line = ["host", "text_a", "text_b"], ["host", "line_a", "line_b"]
    once = hashed.groupBy(*text, "line_a", "line_b", "place").agg(F.first("words").alias("words")).groupBy(*text, "line_a", "line_b").agg(F.sum("words").alias("words"))
    # words is counted, and not rows, so that both uses of ``once`` need the same columns and share its exchange
    counts = once.groupBy(*line).agg(F.count("words").alias("texts")).filter(F.col("texts") > line_docs)
    hosts = named.select(*text).distinct().groupBy("host").agg(F.count("*").alias("host_texts"))
    common = counts.join(hosts, "host").filter(F.col("texts") * F.col("texts") > F.col("host_texts")).select(*line)
    return once.join(common, line).groupBy(*text).agg(F.sum("words").alias("removed_words"), F.collect_set(F.struct("line_a", "line_b")).alias("lines"))


def quality_rules(docs: DataFrame, carry: list[str], line_docs: int = LINE_DOCS, depleted_percent: int = DEPLETED_PERCENT) -> DataFrame:
    """carried (a struct of docs' columns ``carry``), MEASURES and clean_text: the text without its host's boilerplate lines."""
    plain = docs.select(F.struct(*carry).alias("carried"), null_safe_text().alias("text"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("host"))
    a, b = _hashes(F.col("text"))
    keyed = base_measures(plain).withColumns({"text_a": a, "text_b": b})
    both = keyed.join(boilerplate(plain, line_docs), ["host", "text_a", "text_b"], "left")
    left = F.filter(F.split("text", "\n"), lambda x: ~F.array_contains("lines", F.struct(*(h.alias(n) for h, n in zip(_hashes(normalised(x)), ("line_a", "line_b"), strict=True)))))
    kept = ~F.col("base_failed") & (F.coalesce("removed_words", F.lit(0)) * 100 <= F.col("n_words") * depleted_percent)
    clean = F.when(F.col("lines").isNull(), F.col("text")).otherwise(F.array_join(left, "\n"))
    return both.withColumns({"kept": kept, "clean_text": clean}).select("carried", *MEASURES, "clean_text")


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"), ["doc_id"]).select("carried.doc_id", *MEASURES)


OP6_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(source, '') AS host, coalesce(text, '') AS text FROM documents),
w AS (SELECT r, doc_id, host, text, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
  list_filter(string_split(text, chr(10)), lambda x: length(regexp_replace(x, '[\x20\x09-\x0D]', '', 'g')) > 0) AS lines FROM d),
g AS (SELECT r, i, array_to_string(words[i:i+7], ' ') AS gram FROM (SELECT r, words, unnest(range(1, len(words) - 6)) AS i FROM w WHERE len(words) >= 8)),
m AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, gram) AS n FROM g) WHERE n > 1),
c AS (SELECT r, count(DISTINCT p) AS n_repeat_words FROM (SELECT r, unnest(range(i, i + 8)) AS p FROM m) GROUP BY r),
t AS (SELECT DISTINCT host, text FROM d),
l AS (SELECT host, text, translate(trim(regexp_replace(line, '[\x20\x09-\x0D]+', ' ', 'g')), '{UPPER}', '{LOWER}') AS line FROM (SELECT host, text, unnest(string_split(text, chr(10))) AS line FROM t)),
o AS (SELECT host, text, line, sum(len(string_split(line, ' '))) AS words FROM l WHERE line <> '' GROUP BY host, text, line),
h AS (SELECT host, count(*) AS host_texts FROM t GROUP BY host),
b AS (SELECT o.host, line FROM o JOIN h USING (host) GROUP BY o.host, line, host_texts HAVING count(*) > {LINE_DOCS} AND count(*) * count(*) > host_texts),
x AS (SELECT host, text, sum(words) AS removed FROM o JOIN b USING (host, line) GROUP BY host, text),
s AS (SELECT doc_id, host, text, len(words)::BIGINT AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
  (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
  (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words FROM w LEFT JOIN c USING (r)),
f AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM s)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND coalesce(removed, 0) * 100 <= n_words * {DEPLETED_PERCENT} AS kept
FROM f LEFT JOIN x USING (host, text)
"""

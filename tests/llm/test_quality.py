"""The quality rules' boilerplate against brute force, and columns with any name."""

import random
import re

import duckdb

import corpus_pipeline
from plinth.llm import quality

CLASHES = ["_hashes", "_lines", "_host", "host", "lines", "hashes", "windows", "text_a", "carried", "kept", "n_words", "clean_text", "removed_words"]


def words(text):
    return [w for w in re.split("[\x20\x09-\x0d]+", text or "") if w]


def normal(line):
    return re.sub("[A-Z]", lambda m: m[0].lower(), " ".join(words(line)))


def brute(rows, line_docs, percent):
    texts = {}
    for _, t, h in rows:
        texts.setdefault(h or "", set()).add(t or "")
    gone = {}
    for h, some in texts.items():
        held = {}
        for t in some:
            for line in {normal(x) for x in t.split("\n")} - {""}:
                held[line] = held.get(line, 0) + 1
        gone[h] = {x for x, n in held.items() if n > line_docs and n * n > len(some)}
    out = []
    for i, t, h in rows:
        lines = (t or "").split("\n")
        removed = sum(len(words(x)) for x in lines if normal(x) in gone[h or ""])
        w = words(t)
        seen, cover = {}, set()
        for k in range(len(w) - 7):
            seen.setdefault(tuple(w[k : k + 8]), []).append(k)
        for at in seen.values():
            if len(at) > 1:
                for k in at:
                    cover |= set(range(k, k + 8))
        failed = len(w) < 20 or 100 * len(cover) > 30 * len(w)
        out.append((i, failed, not failed and removed * 100 <= len(w) * percent, "\n".join(x for x in lines if normal(x) not in gone[h or ""])))
    return out


def table():
    r = random.Random(2)
    prose = lambda n: " ".join(r.choice("abcdefghijklmnop") + str(r.randrange(99)) for _ in range(n))
    common = [prose(12), prose(3), "Read  MORE"]
    rows = [(i, "\n".join([prose(25), *(c.upper() if i % 2 else c for c in common if r.random() < 0.4), prose(r.randint(0, 30))]), r.choice(["x", "y", "z", None])) for i in range(120)]
    rows += [(500 + i, rows[3][1], "x") for i in range(40)]  # copies count once
    rows += [(700, None, "x"), (701, "", None), (702, " \n\t", "y"), (None, prose(30), "z"), rows[5], rows[5], (703, "\n".join([prose(25)] * 3), "x"), (704, "Ünï " * 30, "w")]
    rows += [(800 + i, "\n".join([" ".join(f"b{k}" for k in range(24)), "id%d" % i]), "v") for i in range(6)]
    return rows


def test_boilerplate_is_brute_force(spark):
    rows = table()
    docs = spark.createDataFrame([(*row, *range(len(CLASHES))) for row in rows], f"doc_id long, text string, source string, {', '.join(f'{c} int' for c in CLASHES)}").repartition(5)
    made = quality.quality_rules(docs, ["doc_id", *CLASHES], 3, 40).collect()
    got = [(r.carried.doc_id, r.base_failed, r.kept, r.clean_text) for r in made]
    want = brute(rows, 3, 40)
    assert sorted(got, key=str) == sorted(want, key=str)
    assert all(tuple(r.carried[1:]) == tuple(range(len(CLASHES))) for r in made)
    assert any(not f and not k for _, f, k, _ in want)


def test_stage_keeps_columns(spark):
    rows = table()
    docs = spark.createDataFrame([(*row, *range(len(CLASHES))) for row in rows], f"doc_id long, text string, source string, {', '.join(f'{c} int' for c in CLASHES)}").withColumnRenamed("lines", "n_chars")
    made = corpus_pipeline.rules(spark, docs, "")
    assert made.columns == docs.columns
    want = [(i, t, len(t)) for i, _, k, t in brute(rows, quality.LINE_DOCS, corpus_pipeline.DEPLETED_PERCENT) if k]
    assert sorted(map(tuple, made.select("doc_id", "text", "n_chars").collect()), key=str) == sorted(want, key=str)


def test_rule_fires_on_the_fixture():
    con = duckdb.connect()
    con.execute("CREATE VIEW documents AS SELECT * FROM '/root/testdata/sf0.01/documents.parquet'")
    assert con.execute(f"SELECT count(*) FROM ({quality.OP6_SQL}) WHERE NOT base_failed AND NOT kept").fetchone()[0] > 0

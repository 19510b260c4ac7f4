"""The whole pipeline and its stages against their plain versions, one after another."""

import random

import corpus_pipeline
import test_near_copies
import test_quality
import test_repeats

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def corpus():
    r = random.Random(17)
    vocabulary = ["".join(r.choice("abcdefghij") for _ in range(r.randint(2, 8))) for _ in range(900)]
    prose = lambda n: " ".join(r.choice(vocabulary) for _ in range(n))
    item, passage, line = prose(16), prose(60), prose(9)
    rows = [prose(r.randint(25, 200)) for _ in range(120)]
    rows += [rows[3]] * 6 + [" ".join([*rows[k].split()[:-2], "other", "end"]) for k in range(10, 20)]  # copies and near copies
    rows += [f"{prose(40)} {passage} {prose(30)}" for _ in range(5)] + [f"{prose(30)} {item} {prose(30)}" for _ in range(3)] + [f"{prose(40)}\n{line}\n{prose(20)}" for _ in range(40)]
    rows += [f"{line}\n{line.upper()}\n{prose(5)}", None, "", " \n ", prose(5), "same words " * 60, f"{passage} {item[:30]}"]
    made = [(i, t, "en", r.choice(["x", "y"]), len(t or "")) for i, t in enumerate(rows)]
    return [*made, made[4], made[4]], [(1, item), (2, None), (3, "")], item


def fewest(item, doc):
    row = [0] * (len(doc) + 1)
    for a, c in enumerate(item, 1):
        last, row = row, [a]
        for b, e in enumerate(doc, 1):
            row.append(min(last[b - 1] + (c != e), last[b] + 1, row[b - 1] + 1))
    return min(row)


def plain(rows, item):
    kept = [(i, t) for i, failed, k, t in test_quality.brute([(i, t, s) for i, t, _, s, _ in rows], 3, corpus_pipeline.DEPLETED_PERCENT) if k]
    kept = list(dict.fromkeys(kept))  # of repeated rows one stays
    stay = test_near_copies.brute(kept)
    kept = [(i, t) for i, t in kept if stay[i] == i]
    out = []
    for (i, n, gone, _), (_, t) in zip(test_repeats.brute(kept), kept, strict=True):
        if gone < n:
            out.append((i, t if not gone else None, n - gone))
    return kept, out


def test_whole_pipeline(spark, tmp_path):
    rows, items, item = corpus()
    spark.createDataFrame(rows, SCHEMA).repartition(4).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    near, cut = plain(rows, item)
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    after = {}
    for name, stage in corpus_pipeline.STAGES:
        made = stage(spark, docs, str(tmp_path))
        if name != "packing":
            assert made.schema.names == docs.schema.names and [f.dataType for f in made.schema] == [f.dataType for f in docs.schema]
            made.write.parquet(str(tmp_path / name))
            docs = spark.read.parquet(str(tmp_path / name))
            after[name] = docs.collect()
            assert all(r.n_chars == len(r.text) for r in after[name])
    assert sorted((r.doc_id, r.text) for r in after["near dedup"]) == sorted(near)
    assert sorted((r.doc_id, len(r.text.split())) for r in after["substring dedup"]) == sorted((i, n) for i, _, n in cut)
    assert all(r.text == t for r in after["substring dedup"] for i, t, _ in cut if i == r.doc_id and t is not None)
    want = {r.doc_id for r in after["substring dedup"] if fewest(item.encode(), r.text.lower().replace("\n", " ").encode()) > len(item) // 10}
    assert {r.doc_id for r in after["decontamination"]} == want and len(want) < len(cut)
    packed = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {p.doc_id for p in packed} == want
    assert sorted(map(tuple, packed)) == sorted(map(tuple, made.collect()))


def test_empty(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0

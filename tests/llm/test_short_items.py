"""Benchmark items of every short length against an alignment with all of a document."""

import random

import pyarrow as pa

from plinth.llm import decontamination
from plinth.llm.common import texts


def fewest(item, doc):
    """(edits, end) of the item's best occurrence."""
    row = [0] * (len(doc) + 1)
    for i, c in enumerate(item, 1):
        last, row = row, [i]
        for j, d in enumerate(doc, 1):
            row.append(min(last[j - 1] + (c != d), last[j] + 1, row[j - 1] + 1))
    return min(row), row.index(min(row))


def test_short_question_is_found(spark):
    docs = spark.createDataFrame([(1, "Quiz: what is the capital\nof Australia? Canberra."), (2, "What is the capital?"), (3, None)], "doc_id long, text string")
    bench = spark.createDataFrame([(7, "What is the capital of Australia?"), (8, "Canberra"), (9, "Oslo"), (10, ""), (11, " \n")], "item_id long, text string")
    assert {(r.doc_id, r.item_id, r.edits) for r in decontamination.contaminated(docs, bench).collect()} == {(1, 7, 0), (1, 8, 0)}
    assert {r.doc_id for r in decontamination.without_contaminated(docs, bench).collect()} == {2, 3}


def test_every_length_is_searched_exactly():
    r = random.Random(9)
    items = [bytes(r.choice(b"abcde") for _ in range(m)) for m in range(1, 64) for _ in range(2)]
    made = []
    for item in items * 2:
        near = bytearray(item)
        for _ in range(r.randint(0, len(item) // 10 + 1)):
            k = r.randrange(len(near) + 1)
            r.choice([lambda k=k, n=near: n.insert(k, 122), lambda k=k, n=near: n.__delitem__(slice(k, k + 1)), lambda k=k, n=near: n.__setitem__(slice(k, k + 1), b"y")])()
        made.append(b"xx " + bytes(near) + b" xxx")
    made += [b"", b"a", items[-1][:20], items[30]]
    doc, item, edits, end = decontamination.Items(list(range(len(items))), items, 0.1).find(*texts(pa.array([d.decode() for d in made])))
    found = {(d, i): (e, p) for d, i, e, p in zip(doc.tolist(), item.tolist(), edits.tolist(), end.tolist(), strict=True)}
    expected = {(d, i): best for d, text in enumerate(made) for i, x in enumerate(items) if (best := fewest(x, text))[0] <= len(x) // 10}
    assert {k: v[0] for k, v in found.items()} == {k: v[0] for k, v in expected.items()} and len({len(items[i]) for _, i in found}) == 63
    assert all(found[k][1] == expected[k][1] for k in found if expected[k][0] == 0 and len(items[k[1]]) <= 8)

"""The pipeline's near copies against brute force over all pairs of shingle sets."""

import random

import pytest

import corpus_pipeline
from plinth.llm import near_copies


def shingle_set(text, n=5):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


@pytest.fixture(scope="module")
def rows():
    r = random.Random(8)
    vocabulary = ["".join(r.choice("abcdefgh") for _ in range(r.randint(2, 6))) for _ in range(400)]
    prose = lambda n: [r.choice(vocabulary) for _ in range(n)]
    passage, made = prose(40), [None, "", " \n", "One  two", "one two", "one two three", "a b c d e", "A b c d e"]
    for n in (6, 9, 25, 60, 150, 400):
        for _ in range(5):
            base = prose(n)
            made.append(" ".join(base))
            for _ in range(6):
                w = list(base)
                for _ in range(r.randint(0, max(1, n // 30))):
                    k = r.randrange(len(w))
                    r.choice([lambda k=k, w=w: w.insert(k, "new"), lambda k=k, w=w: w.pop(k), lambda k=k, w=w: w.__setitem__(k, "other")])()
                made.append(" ".join(w))
    made += [" ".join([*prose(12), *passage, *prose(12)]) for _ in range(30)]  # a common passage, no near copies
    ids = list(range(len(made)))
    r.shuffle(ids)
    return list(zip(ids, made, strict=True))


def brute(rows):
    sets = [(i, shingle_set(t)) for i, t in rows]
    label = [i for i, _ in rows]
    near = [[k for k, (_, b) in enumerate(sets) if a == b or 5 * len(a & b) >= 4 * len(a | b)] for _, a in sets]
    while (new := [min(label[k] for k in n) for n in near]) != label:
        label = new
    return {i: c for (i, _), c in zip(rows, label, strict=True)}


@pytest.mark.parametrize("chunk", [4096, 7])
def test_every_near_copy_is_found(spark, rows, monkeypatch, chunk):
    monkeypatch.setattr(near_copies, "CHUNK_TEXTS", chunk)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert {r.doc_id: r.component_id for r in near_copies.near_copies(docs).collect()} == brute(rows)


def test_one_of_each_group_stays(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    stay = sorted(r.doc_id for r in corpus_pipeline.near_dedup(spark, docs, "").collect())
    assert stay == sorted(i for i, c in brute(rows).items() if i == c)


def test_empty_and_null_ids(spark):
    schema = "doc_id long, text string"
    assert near_copies.near_copies(spark.createDataFrame([], schema)).count() == 0
    docs = spark.createDataFrame([(None, "x y z"), (4, "x y z"), (None, "alone")], schema)
    assert sorted(map(str, ((r.doc_id, r.component_id) for r in near_copies.near_copies(docs).collect()))) == ["(4, 4)", "(None, 4)", "(None, None)"]


def test_rows_of_one_id_are_told_apart(spark):
    """Rows (1, A), (1, A), (2, B), (2, A): one A and B stay, with all their columns, whatever these are called."""
    a, b = "one two three four five six seven", "eight nine ten eleven twelve thirteen"
    rows = [(1, a, 5, "k"), (1, a, 5, "k"), (2, b, 6, "k"), (2, a, 7, "k"), (None, "x y", 8, "k"), (None, "x y", 8, "k"), (None, "z w", 9, "k"), (3, None, 1, "k"), (4, " ", 1, "k")]
    docs = spark.createDataFrame(rows, "doc_id int, text string, key long, component string")
    made = corpus_pipeline.near_dedup(spark, docs, "")
    assert made.schema == docs.schema
    assert sorted(map(tuple, made.collect()), key=str) == sorted([rows[0], rows[2], rows[4], rows[6], rows[7]], key=str)
    assert corpus_pipeline.near_dedup(spark, docs.limit(0), "").count() == 0


def test_shared_hashes_take_little_memory():
    """Which of a bucket's hashes two pages have, or one page twice, in less than four times the bucket's size."""
    import tracemalloc

    import numpy as np
    import pyarrow as pa

    rng = np.random.default_rng(3)
    pages = [np.unique(rng.integers(0, 1 << 22, 150_000, np.uint32)) for _ in range(8)]
    several = [rng.random(len(p)) < 0.1 for p in pages]
    hashes = [(p << np.uint32(1) | s).astype(np.uint32).tobytes() for p, s in zip(pages, several, strict=True)]
    batch = pa.RecordBatch.from_arrays([pa.array([7] * 8), pa.array(range(8)), pa.array(hashes, pa.binary())], names=["bucket", "page", "hashes"])
    tracemalloc.start()
    found, peak = {}, 0
    for b in near_copies._shared(iter([batch])):
        peak = max(peak, tracemalloc.get_traced_memory()[1])
        assert b.column("n").to_pylist() == [7] and b.column("kind").to_pylist() == [near_copies.repeats.SHARED]
        found[b.column("page")[0].as_py()] = np.frombuffer(b.column("payload")[0].as_py(), np.uint32)
    tracemalloc.stop()
    value, held = np.unique(np.concatenate(pages), return_counts=True)
    twice = np.union1d(value[held > 1], np.concatenate([p[s] for p, s in zip(pages, several, strict=True)]))
    assert all(np.array_equal(found[k], p[np.isin(p, twice)]) for k, p in enumerate(pages))
    assert peak < 4 * sum(map(len, hashes))


def test_operator_8_links_the_nearest(spark, monkeypatch):
    """Without the comparison of sets, operator 8's links of near copies are there, those of texts less similar are not; with it, all near copies."""
    import numpy as np

    from plinth.llm.simhash import fingerprint

    r = random.Random(5)
    prose = lambda n: ["".join(r.choice("abcdefgh") for _ in range(5)) for _ in range(n)]
    refrain, made = prose(21) * 30, []
    made += [" ".join([*refrain, *prose(40)]) for _ in range(3)]  # equal fingerprints, but few shingles in common
    for n in (40, 150, 300, 300, 300, 300):
        base = prose(n)
        made += [" ".join(base), " ".join(base).upper() + " END"]
        for _ in range(4):
            w = list(base)
            w[r.randrange(n)] = "other"
            made.append(" ".join(w))
    sets, prints = [shingle_set(t) for t in made], [fingerprint(t.encode()) for t in made]
    near = lambda a, b: 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])
    linked = [[b for b in range(len(made)) if (prints[a] ^ prints[b]).bit_count() <= 3] for a in range(len(made))]
    label = list(range(len(made)))
    while (new := [min(label[b] for b in linked[a] if near(a, b)) for a in range(len(made))]) != label:
        label = new
    assert linked[0][:3] == [0, 1, 2] and label[:3] == [0, 1, 2] and len(set(label)) < len(made) - 5
    docs = spark.createDataFrame(list(enumerate(made)), "doc_id long, text string").repartition(3)
    whole = {x.doc_id: x.component_id for x in near_copies.near_copies(docs).collect()}
    assert whole == brute(list(enumerate(made))) and list(whole.values()) != label
    monkeypatch.setattr(near_copies, "group_links", lambda *a: (np.zeros(0, np.int64), np.zeros(0, np.int64)))
    assert {x.doc_id: x.component_id for x in near_copies.near_copies(docs).collect()} == dict(enumerate(label))


def test_known_links_are_not_compared_again():
    """Sets that are connected before count as one: what is similar to one of them is linked once."""
    import numpy as np

    each = [np.arange(k, k + 40, dtype=np.uint64) for k in (0, 2, 4, 100, 6)]
    lead, apart = np.zeros(5, np.int64), np.arange(5)
    links = lambda known: sorted(zip(*(x.tolist() for x in near_copies.group_links(each, lead, (4, 5), np.array(known))), strict=True))
    assert links(apart) == [(0, 1), (0, 2), (2, 4)]
    assert links([0, 0, 0, 3, 0]) == []
    assert links([0, 1, 2, 0, 1]) == [(0, 1), (0, 2)]


def test_repeated_rows_are_searched_once():
    import pyarrow as pa

    key, other = b"k" * 16, b"o" * 16
    rows = pa.table({"doc_id": [1, 1, 2, 3, 3, 3], "page": [0] * 6, "key": pa.array([key, key, key, other, other, other], pa.binary()), "text": ["a"] * 6})
    first = pa.RecordBatch.from_pylist([{"page": 0, "kind": near_copies.repeats.FIRST, "doc_id": d, "n": 3, "payload": k} for d, k in ((1, key), (3, other))], schema=near_copies.ANSWER)
    assert near_copies._page(rows, pa.Table.from_batches([first])).first.tolist() == [True, False, False, True, False, False]

"""What the two passage deduplicators share, and the factors of the substring one, against brute force."""

import hashlib
import random

import numpy as np
import pytest

from plinth.llm import repeats, substring_dedup

WINDOW, LEFT, COLUMNS, WIDTH = substring_dedup.WINDOW, substring_dedup.LEFT, substring_dedup.COLUMNS, substring_dedup.WIDTH


def passages(seed, n=300):
    """Passages that share words around their anchor, some cut at their ends."""
    r = np.random.default_rng(seed)
    group = np.sort(r.integers(0, 12, n))
    words = np.empty((n, COLUMNS), np.int32)
    for k in range(n):
        words[k] = np.arange(COLUMNS) + 100 * group[k]
        for c in r.choice(COLUMNS, r.integers(0, 4), replace=False):
            words[k, c] = r.integers(5000, 5003)
        words[k, : max(0, r.integers(-12, LEFT))] = -1
        words[k, COLUMNS - max(0, r.integers(-10, 8)) :] = -1
    doc = np.empty(n, np.int64)
    for g in np.unique(group):
        doc[group == g] = np.sort(r.integers(0, 40, int((group == g).sum())))
    return words, group, doc


@pytest.mark.parametrize("seed", range(6))
def test_factors_are_the_repeated_windows(seed):
    words, group, doc = passages(seed)
    first = {}
    for k in range(len(words)):
        for c in range(WIDTH):
            w = (group[k], c, tuple(words[k, c : c + WINDOW]))
            first[w] = min(first.get(w, doc[k]), doc[k])
    want = np.array([[words[k, c : c + WINDOW].min() >= 0 and first[group[k], c, tuple(words[k, c : c + WINDOW])] < doc[k] for c in range(WIDTH)] for k in range(len(words))])
    assert (substring_dedup.duplicate_windows(words, group, doc) == want).all() and want.any()


def test_without_factors_nothing_is_found(monkeypatch):
    words, group, doc = passages(1)
    monkeypatch.setattr(substring_dedup.Block, "longest", lambda self, mine, column: np.zeros(len(mine), np.int64))
    assert not substring_dedup.duplicate_windows(words, group, doc).any()


def test_factors_are_longest():
    words, group, doc = passages(2)
    block = substring_dedup.Block(words, group, doc)
    for column in range(WIDTH):
        mine = np.flatnonzero(block.whole(column, WINDOW))
        for k, length in zip(mine, block.longest(mine, column), strict=True):
            best = 0
            for j in np.flatnonzero((group == group[k]) & (doc < doc[k])):
                same = (words[k, column:] == words[j, column:]) & (words[k, column:] >= 0)
                best = max(best, int(np.cumprod(same).sum()))
            assert length == (best if best >= WINDOW else 0)


def brute(rows):
    low = lambda i: repeats.NO_ID if i is None else i
    first, out = {}, []
    for i, t in rows:
        w = t.split()
        for k in range(len(w) - 12):
            g = tuple(w[k : k + 13])
            first[g] = min(first.get(g, low(i)), low(i))
    for i, t in rows:
        w, gone = t.split(), set()
        for k in range(len(w) - 12):
            if first[tuple(w[k : k + 13])] < low(i):
                gone |= set(range(k, k + 13))
        out.append((i, len(w), len(gone), hashlib.sha256(" ".join(x for k, x in enumerate(w) if k not in gone).encode()).hexdigest()))
    return out


def test_one_anchor_in_many_passages(spark):
    """A core in every text, mostly with different words around it; a group of copies; repeated rows; a null doc_id that is the first of its text."""
    r = random.Random(4)
    some = [f"w{k}" for k in range(4)]
    rows = [(i, " ".join([*(r.choice(some) if i % 50 == 0 else f"u{r.randrange(10**6)}" for _ in range(9)), "aa bb cc dd ee", *(r.choice(some) if i % 50 == 0 else f"v{r.randrange(10**6)}" for _ in range(9))])) for i in range(100_000)]
    rows += [(200_000 + k, rows[7][1]) for k in range(3_000)] + [(9, rows[9][1])] * 3 + [(None, rows[11][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    for hot_pages in (3, 1000):
        made = substring_dedup.remove_repeated_words(docs, hot_pages=hot_pages).select("doc_id", "n_words", "n_removed", "kept_sha256").collect()
        assert sorted(map(tuple, made), key=str) == sorted(brute(rows), key=str)


def test_colliding_hashes_are_compared(monkeypatch):
    """Passages of one hash stay apart."""
    import pyarrow as pa

    text = ["a b c d e f g h i j k l m n o p q", "r s t u v w x y z a b c d e f g h", "a b c d e f g h i j k l m n o p z"]
    rows = pa.table({"doc_id": pa.array([1, 2, 3]), "text": text, "key": pa.array([b"1", b"2", b"3"]), "page": pa.array([0, 0, 0])})
    firsts = pa.table({"page": pa.array([0] * 3), "kind": pa.array([0] * 3, pa.int32()), "doc_id": pa.array([1, 2, 3]), "n": pa.array([1, 1, 1]), "payload": pa.array([b"1", b"2", b"3"])})
    hashes = np.concatenate([substring_dedup.Words(d, o).marks()[0] for _, d, o in repeats.Page(rows, firsts).searched()])
    told = pa.concat_tables([firsts, pa.table({"page": pa.array([0]), "kind": pa.array([repeats.SHARED], pa.int32()), "doc_id": pa.array([0]), "n": pa.array([0]), "payload": pa.array([hashes.tobytes()])})])
    plain = [(p.hash.tolist(), p.row.tolist()) for p in repeats.passages(substring_dedup.METHOD, repeats.Page(rows, told))]
    monkeypatch.setattr(repeats, "mix", lambda x: x & np.uint64(0))
    for (_, want), p in zip(plain, repeats.passages(substring_dedup.METHOD, repeats.Page(rows, told)), strict=True):
        pairs = lambda row: {(i, j) for i, a in enumerate(row) for j, b in enumerate(row) if a == b}
        assert pairs(p.row.tolist()) == pairs(want)

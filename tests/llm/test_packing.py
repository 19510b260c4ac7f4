"""The packing's layout, order and curve, and the token files, against plain versions."""

import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from plinth.llm import packing, token_output
from plinth.llm.common import shared_dir, texts

LENGTH = 64


@pytest.fixture(scope="module")
def rows():
    r = random.Random(5)
    prose = lambda n: " ".join("".join(r.choice("abcdefgh") for _ in range(r.randint(1, 9))) for _ in range(n))
    out = [(i, prose(r.randint(0, 120))) for i in range(150)]
    out += [(200 + i, out[3][1]) for i in range(80)] + [(400, None), (401, ""), (402, "日本語" * 200), (403, "x" * 4000), (404, "w " * 64), (None, "no id"), out[5], out[5]]
    return out


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, curve_key string").repartition(5).persist()


def test_layout(spark, docs, rows):
    made = packing.pack_documents(docs, "word_bpe_49k.json", 1, LENGTH).collect()
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    ids = {(i, t): np.array([*library.encode(t or "", add_special_tokens=False).ids, 1], "<u4") for i, t in rows}
    # sequences: no gap, no overlap, nothing over the length; padding only in the last one of a range
    by_sequence = {}
    for p in made:
        by_sequence.setdefault(p.sequence_id, []).append(p)
    used = {}
    for s, some in by_sequence.items():
        some.sort(key=lambda p: p.offset)
        at = 0
        for p in some:
            assert p.offset == at and p.length > 0
            at += p.length
        assert at <= LENGTH
        used[s] = at
    for part in {s >> 40 for s in used}:
        mine = sorted(s for s in used if s >> 40 == part)
        assert [s & (1 << 40) - 1 for s in mine] == list(range(len(mine))) and all(used[s] == LENGTH for s in mine[:-1])
    # each id of each row in exactly one piece
    total = {}
    for (i, t), x in ids.items():
        total[i] = (x, sum(1 for r in rows if r == (i, t)))
    for i, (x, times) in total.items():
        pieces = sorted((p for p in made if p.doc_id == i), key=lambda p: p.start)
        assert all(p.doc_tokens == len(x) and p.ids_crc32 == zlib.crc32(x[p.start : p.start + p.length].tobytes()) for p in pieces)
        cover = np.zeros(len(x), int)
        for p in pieces:
            cover[p.start : p.start + p.length] += 1
        assert (cover == times).all()
    # along the curve, copies by doc_id
    keys = dict(zip(ids, packing.curve_keys(*texts(pa.array([t for _, t in ids]))).tolist(), strict=True))
    key_of = {i: k for (i, _), k in keys.items()}
    low = lambda i: -(1 << 63) if i is None else i
    laid = [(key_of[p.doc_id], low(p.doc_id)) for p in sorted(made, key=lambda p: (p.sequence_id, p.offset))]
    assert laid == sorted(laid)
    assert len({p.sequence_id >> 40 for p in made if p.doc_id is not None and 200 <= p.doc_id < 280}) > 1  # a group of copies is cut
    padding = sum(LENGTH - n for n in used.values())
    assert padding < LENGTH * len({s >> 40 for s in used})


def test_curve_visits_neighbours():
    cells = np.stack(np.meshgrid(*[np.arange(8)] * 3, indexing="ij"), axis=-1).reshape(-1, 3)
    key = packing.hilbert_key(cells, 3)
    order = np.argsort(key)
    assert sorted(key.tolist()) == list(range(512)) and (np.abs(np.diff(cells[order], axis=0)).sum(axis=1) == 1).all()


def test_vectors_see_whole_words():
    a = packing.document_vectors(*texts(pa.array(["internationalisation", "internationalisations", "internationalised", "日本語" * 50, "日本語" * 49 + "中文字", "a b", "b a", "", " \n"])))
    assert not np.allclose(a[0], a[2]) and not np.allclose(a[3], a[4]) and a[3] @ a[4] > 0.9 and np.allclose(a[5], a[6]) and not a[7:].any()


def test_ranges():
    r = np.random.default_rng(3)
    bounds = np.unique(np.stack([r.integers(0, 6, 20), r.integers(0, 50, 20)], axis=1), axis=0)
    key, doc = r.integers(-1, 8, 400), r.integers(-2, 52, 400)
    want = [sum((b[0], b[1]) <= (k, d) for b in bounds.tolist()) for k, d in zip(key.tolist(), doc.tolist(), strict=True)]
    found = packing.range_of(key, doc, bounds)
    # equal keys without a bound inside of them lie on one side
    assert all(f == w for f, w in zip(found.tolist(), want, strict=True))
    assert packing.range_of(key, doc, np.zeros((0, 2), np.int64)).tolist() == [0] * 400


def test_token_files(spark, docs, rows):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    files = token_output.write_token_files(docs, shared_dir(spark), "byte_bpe_50k.json", 2, 50257)
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(files) > 1
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    low = lambda r: (-(1 << 63) if r[0] is None else r[0], r[1] or "")
    each = [np.array([*library.encode(t or "", add_special_tokens=False).ids, 2], "<u4") for _, t in sorted(rows, key=low)]
    start = np.cumsum([0, *(len(x) for x in each)])
    found = sorted(token_output.read_token_files(spark, files).collect(), key=lambda r: r.start)
    assert [(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in found] == [(i, a, len(x), zlib.crc32(x.tobytes())) for (i, _), a, x in zip(sorted(rows, key=low), start.tolist(), each, strict=False)]
    # any range of ids without what precedes it
    every, base = np.concatenate(each), 0
    r = random.Random(2)
    for uri, n, ids in files:
        reader = token_output.BitReader(uri)
        assert len(reader.doc_ids) == n and reader.bits == 16
        for _ in range(40):
            a = r.randint(0, ids)
            b = r.randint(a, ids)
            assert (reader.ids(a, b) == every[base + a : base + b]).all()
        base += ids
    assert base == len(every)

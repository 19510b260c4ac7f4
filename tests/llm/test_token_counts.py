"""Token counts against the library on texts without spaces, in small chunks and groups, and with tables that are forgotten."""

import random

import public_tokenizers
import pyarrow as pa
import pytest
from sentencepiece import SentencePieceProcessor

from plinth.llm import token_counts
from plinth.llm.common import texts

PATH = public_tokenizers.path("piece_bpe_32k.model")


def made(seed):
    r = random.Random(seed)
    pool = ["a", "b", "the", "ing", "\u2581", " ", "  ", "\u00e9", "\u65e5\u672c", "e\u0301", "\n", "x" * 9, "1", "999", "<s>", "</s>", "<unk>", "<0x41>", "\U0001f600", "\x00", "\ufeff"]
    out = ["".join(r.choice(pool) for _ in range(r.randint(0, 400))) for _ in range(60)]
    out += ["".join(r.choice(pool[:4]) for _ in range(3000)), "x" * 2000, "\u65e5" * 1500, bytes(r.randrange(256) for _ in range(900)).hex(), "", " ", "a" * 513, " " * 700, "ab " * 400]
    return out


@pytest.mark.parametrize("chunk,look,together,transitions", [(512, 32, 2048, 500_000), (7, 0, 3, 50), (5, 3, 1000, 500_000), (64, 1, 4, 2000)])
def test_maps_compose_to_the_library(monkeypatch, chunk, look, together, transitions):
    for name, value in (("CHUNK", chunk), ("LOOK", look), ("TOGETHER", together), ("TRANSITIONS", transitions)):
        monkeypatch.setattr(token_counts, name, value)
    model, some = SentencePieceProcessor(model_file=PATH), made(chunk)
    assert token_counts.Transducer(PATH).counts(*texts(pa.array(some))).tolist() == [len(model.encode(t)) for t in some]


def test_long_texts_without_spaces():
    r = random.Random(3)
    some = ["".join(r.choice(["a", "b", "the", "ing", "tion"]) for _ in range(2_400_000)), "".join(chr(r.randrange(0x4E00, 0x4E00 + 500)) for _ in range(1_700_000))]
    assert all(len(t.encode()) > 5_000_000 for t in some)
    model = SentencePieceProcessor(model_file=PATH)
    assert token_counts.Transducer(PATH).counts(*texts(pa.array(some))).tolist() == [len(model.encode(t)) for t in some]


def test_rows(spark):
    model, some = SentencePieceProcessor(model_file=PATH), [None, "", "\u00e9 x", "word " * 5000, "word " * 4095, "word " * 4096]
    docs = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(some)], "doc_id long, text string, n_tokens string")
    n = [len(model.encode(t or "")) for t in some]
    assert sorted(map(tuple, token_counts.count_tokens(docs, "piece_bpe_32k.model").collect())) == [(i, len((t or "").encode()), k, k > 4096) for i, (t, k) in enumerate(zip(some, n, strict=True))]
    assert {k > 4096 for k in n} == {True, False}

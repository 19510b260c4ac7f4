"""Each operator against a brute-force version, on a small table with nulls, empty and long texts, ties, repeats and extra columns."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from plinth.llm import decontamination, licences, packing, quality, sharding, simhash, substring_dedup, suffix_dedup, token_counts, token_output
from plinth.llm.common import shared_dir, texts
from plinth.llm.tokens import PieceEncoder, vocabulary_path

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n_words string, key string"


def words(text):
    return [w for w in re.split("[\x20\x09-\x0d]+", text or "") if w]


@pytest.fixture(scope="module")
def rows():
    r = random.Random(3)
    vocabulary = ["".join(r.choice(["the", "ou", "né", "X", "ing", "er"]) for _ in range(r.randint(1, 3))) for _ in range(300)]
    prose = lambda n: " ".join(r.choice(vocabulary) for _ in range(n))
    passage, item = prose(110), prose(14)
    made = [None, "", " \n\t ", "one", passage, passage, f"{prose(30)} {passage} {prose(30)}", f"{prose(9)}\n{passage[:420]}\n{prose(12)}", prose(3000), f"a  b {item} c", item[:20] + "z" + item[21:] + " end", "a b " * 300, "Released under the MIT License.", f"{prose(25)}\nLicensed under CC BY-NC 4.0.", "x" * 3000, " ".join(passage.split()[5:40]) + " tail", "<|endoftext|> <s>  ▁ 日本", prose(40), prose(41)]
    made += [f"Same line for all of them.\n{prose(30 + k)}" for k in range(30)]
    out = [(i, t, "en", None if i % 7 == 3 else "h", 1, "clash", "clash") for i, t in enumerate(made)]
    return [*out, out[4], (None, "no id", None, None, None, None, None)], item


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows[0], SCHEMA).repartition(3).persist()


def by_id(df):
    return {r.doc_id: r for r in df.collect()}


@pytest.mark.parametrize("hot_pages", [500, 0])
def test_suffix_dedup(docs, rows, hot_pages):
    seen, data = Counter(), [(t or "").encode() for _, t, *_ in rows[0]]
    for b in data:
        seen.update(b[i : i + 400] for i in range(len(b) - 399))
    made = suffix_dedup.remove_repeated_bytes(docs, hot_pages).collect()
    found = {r.doc_id: r for r in made}
    assert len(data) == len(made)
    for (i, *_), b in zip(rows[0], data, strict=True):
        gone = np.zeros(len(b), bool)
        for k in range(len(b) - 399):
            if seen[b[k : k + 400]] > 1:
                gone[k : k + 400] = True
        left = np.frombuffer(b, np.uint8)[~gone].tobytes()
        assert (found[i].n_removed, found[i].kept_sha256) == (int(gone.sum()), hashlib.sha256(left).hexdigest())


def test_suffix_sort_is_exact():
    r = np.random.default_rng(1)
    data = r.integers(97, 99, 3000).astype(np.uint8)
    start = np.sort(r.choice(2500, 300, replace=False))
    s = suffix_dedup.Suffixes(data, start, np.minimum(400, 3000 - start))
    order, common = s.ordered()
    plain, exact = s.ordered_by_bytes()
    assert (order == plain).all() and (common == exact).all()


@pytest.mark.parametrize("block_rows", [2, 7, 4000])
def test_common_anchor_in_small_sorts(block_rows):
    r = np.random.default_rng(block_rows)
    left, right = suffix_dedup.LEFT, suffix_dedup.WINDOW
    core = r.integers(97, 123, left + right).astype(np.uint8)
    made, shift = [], []
    for _ in range(60):
        x = core.copy()
        a, b = r.integers(0, left), r.integers(left + 64, left + right)
        x[:a], x[b:] = r.integers(97, 99, a), r.integers(97, 99, left + right - b)
        lo, hi = r.choice([0, 0, r.integers(0, left)]), r.choice([left + right, left + right, r.integers(left + 64, left + right)])
        made.append(x[lo:hi])
        shift.append(left - lo)
    made += made[:3] + [core, core, core[:left + 90]]
    shift += shift[:3] + [left, left, left]
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in made])])
    contexts = suffix_dedup.Contexts(np.concatenate(made), offsets, np.array(shift), block_rows)
    contexts.search(np.arange(len(made)))
    windows = {(i, s - d): x[s - d : s - d + right].tobytes() for i, (x, s) in enumerate(zip(made, shift, strict=True)) for d in range(suffix_dedup.WIDTH) if s >= d and len(x) >= s - d + right}
    times = Counter((shift[i] - at, w) for (i, at), w in windows.items())
    assert {(i, int(c) - left + shift[i]) for i, c in zip(*np.nonzero(contexts.found), strict=True)} == {(i, at) for (i, at), w in windows.items() if times[shift[i] - at, w] > 1}


@pytest.mark.parametrize("hot_pages", [500, 0])
def test_substring_dedup(docs, rows, hot_pages):
    first = {}
    low = lambda i: -1 if i is None else i
    for i, t, *_ in rows[0]:
        w = words(t)
        for k in range(len(w) - 12):
            g = tuple(w[k : k + 13])
            first[g] = min(first.get(g, low(i)), low(i))
    found = by_id(substring_dedup.remove_repeated_words(docs, hot_pages=hot_pages))
    for i, t, *_ in rows[0]:
        w = words(t)
        gone = np.zeros(len(w), bool)
        for k in range(len(w) - 12):
            if first[tuple(w[k : k + 13])] < low(i):
                gone[k : k + 13] = True
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        assert (found[i].n_words, found[i].n_removed, found[i].kept_sha256) == (len(w), int(gone.sum()), hashlib.sha256(kept.encode()).hexdigest())


def test_simhash(docs, rows):
    import xxhash

    def fingerprint(t):
        w = words(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        if not w:
            return 0
        h = [xxhash.xxh64_intdigest(" ".join(w[i : i + 3]), 42) for i in range(max(1, len(w) - 2))]
        return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))

    fp = [fingerprint(t) for _, t, *_ in rows[0]]
    big = 1 << 40
    label = [big if i is None else i for i, *_ in rows[0]]
    for _ in fp:
        label = [min(m for m, g in zip(label, fp, strict=True) if (f ^ g).bit_count() <= 3) for f in fp]
    found = by_id(simhash.near_duplicates(docs))
    for (i, *_), f, c in zip(rows[0], fp, label, strict=True):
        assert (found[i].fingerprint, found[i].component_id) == (f"{f:016x}", None if c == big else c)


def test_tiles_lose_no_link():
    r = np.random.default_rng(2)
    fp = np.unique(r.integers(0, 1 << 9, 300).astype(np.uint64) << np.uint64(20))
    fp = fp[np.lexsort((fp, np.bitwise_count(fp)))]
    a, b = simhash.tile_links(fp, np.zeros(len(fp), np.int64), 1, tile=16)
    near = np.bitwise_count(fp[:, None] ^ fp[None, :]) <= 1
    label = np.arange(len(fp))
    for _ in fp:
        label = np.array([label[n].min() for n in near])
    assert len(a) == len(fp) - len(set(label)) and len(a) == len(b)


def test_tokens(spark, docs, rows):
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    got = by_id(token_output.read_token_files(spark, token_output.write_token_files(docs, shared_dir(spark), "byte_bpe_50k.json", 2, 50257)))
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    pieces = {}
    for r in packing.pack_documents(docs, "word_bpe_49k.json", 1, 64).collect():
        pieces.setdefault(r.doc_id, []).append(r)
    other = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    counted = by_id(token_counts.count_tokens(docs, "piece_bpe_32k.model"))
    model = SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    for i, t, *_ in rows[0]:
        ids = np.array([*library.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        assert (got[i].n_tokens, got[i].ids_crc32) == (len(ids), zlib.crc32(ids.tobytes()))
        ids = np.array([*other.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        assert all(zlib.crc32(ids[p.start : p.start + p.length].tobytes()) == p.ids_crc32 and p.doc_tokens == len(ids) for p in pieces[i])
        assert sum(p.length for p in pieces[i]) == len(ids) * (2 if i == 4 else 1)
        assert counted[i].n_tokens == len(model.encode(t or ""))


@pytest.mark.parametrize("bits", [1, 7, 16, 17, 31])
def test_bit_packing_round_trip(bits):
    ids = np.random.default_rng(bits).integers(0, 1 << bits, 640).astype(np.uint32)
    assert (token_output.unpack(token_output.pack(ids, bits), bits) == ids).all()


def test_sharding(docs, rows):
    found = sharding.shard_by_bytes(docs, 5).collect()
    assert len(found) == len(rows[0])
    place = {}
    for r in found:
        place.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in place.values())
    text = {i: t or "" for i, t, *_ in rows[0]}
    assert len({(text[r.doc_id], r.shard) for r in found}) == len({text[r.doc_id] for r in found})
    assert all(r.size == len(text[r.doc_id].encode()) + 16 and r.text_crc32 == zlib.crc32(text[r.doc_id].encode()) for r in found)


def test_differencing_balances():
    parts = [np.array([s, 0, 0, 0]) for s in np.random.default_rng(4).integers(1, 10_000, 500)]
    bins, total = sharding.differencing(parts)
    again = np.zeros(4, np.int64)
    for p, to in zip(parts, bins, strict=True):
        again[to] += p
    assert (np.sort(again) == np.sort(total)).all() and total.max() - total.min() <= 5


def test_quality(docs, rows):
    found = {r.carried.doc_id: r for r in quality.quality_rules(docs, ["doc_id", "n_words"], line_docs=5).collect()}
    for i, t, *_ in rows[0]:
        w = words(t)
        g = [tuple(w[k : k + 8]) for k in range(len(w) - 7)]
        n, cover = Counter(g), set()
        for k, x in enumerate(g):
            if n[x] > 1:
                cover |= set(range(k, k + 8))
        assert (found[i].n_words, found[i].n_repeat_words) == (len(w), len(cover))
        assert found[i].base_failed == (len(w) < 20 or 100 * len(cover) > 30 * len(w))
    assert "Same line" not in found[20].clean_text and found[20].kept and not found[3].kept


def test_decontamination(spark, docs, rows):
    bench = spark.createDataFrame([(1, rows[1]), (2, None), (3, "short")], "item_id long, text string")
    hits = {(r.doc_id, r.item_id): r.edits for r in decontamination.contaminated(docs, bench).collect()}
    assert hits == {(9, 1): 0, (10, 1): 1}
    assert docs.count() - decontamination.without_contaminated(docs, bench).count() == 2


def test_alignment_is_exact():
    r = random.Random(6)
    for _ in range(20):
        item = bytes(r.choice(b"abc ") for _ in range(90))
        near = bytearray(item)
        for _ in range(r.randint(0, 9)):
            k = r.randrange(len(near))
            r.choice([lambda k=k: near.insert(k, 97), lambda k=k: near.pop(k), lambda k=k: near.__setitem__(k, 120)])()
        doc = b"zzzz" + bytes(near) + b"zz"
        row = [0] * (len(doc) + 1)
        for i, c in enumerate(item, 1):
            last, row = row, [i]
            for j, d in enumerate(doc, 1):
                row.append(min(last[j - 1] + (c != d), last[j] + 1, row[j - 1] + 1))
        data, offsets = texts(__import__("pyarrow").array([doc.decode()]))
        found = decontamination.Items([0], [item], 0.1).find(data, offsets)[2]
        assert list(found) == ([min(row)] if min(row) <= 9 else [])


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    for made in (suffix_dedup.remove_repeated_bytes(none), substring_dedup.remove_repeated_words(none), simhash.near_duplicates(none), packing.pack_documents(none, "word_bpe_49k.json", 1), token_counts.count_tokens(none, "piece_bpe_32k.model"), sharding.shard_by_bytes(none), quality.quality_rules(none, ["doc_id"]), licences.find_licences(none), decontamination.contaminated(none, spark.createDataFrame([], "item_id long, text string")), token_output.read_token_files(spark, token_output.write_token_files(none, shared_dir(spark), "byte_bpe_50k.json", 2, 50257))):
        assert made.count() == 0


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_pieces_joined_are_the_text(name):
    r = random.Random(4)
    pool = ["<|endoftext|>", "<|startoftext|>", "<", "|", "t|", "|e", "<|", "|>", ".", "!", "A.", "x-", "=", "~", "it's", "'S", "don't!", " ", "\n", "\n\n", "\r\n", "é", "e\u0301", "\u0338", "İ", "Ω", "日本", "a", "The", " the", "12", "\0", "\x85", "\u200b", "\u00a0", "\U0001f600"]
    made = ["".join(r.choice(pool) for _ in range(r.randint(0, 40))) for _ in range(3000)]
    encoder = PieceEncoder(vocabulary_path(name))
    ids, first = encoder.encode(*texts(pa.array(made)))
    assert all(encoder.library.encode(t, add_special_tokens=False).ids == ids[a:b].tolist() for t, a, b in zip(made, first, first[1:], strict=False))


def test_sharding_is_balanced(spark):
    r = random.Random(9)
    rows = [(i, "x" * min(4000, int(r.paretovariate(0.8) * 20)) + str(i)) for i in range(3000)] + [(5000 + i, "same text") for i in range(300)]
    made = sharding.shard_by_bytes(spark.createDataFrame(rows, "doc_id long, text string").repartition(7), 11).collect()
    total = [0] * 11
    for x in made:
        total[x.shard] += x.size
    assert len({x.shard for x in made if x.doc_id >= 5000}) == 1
    # no shard is further from the others than the smallest differences of group sizes allow
    assert max(total) - min(total) <= 40


@pytest.mark.parametrize("batch", [7, 100, 20_000])
def test_batches_of_groups_balance(batch):
    sizes = np.random.default_rng(batch).integers(16, 5000, 2500)
    bins = sharding.bins_of(sizes, 8, batch)
    total = np.bincount(bins, sizes, 8)
    assert total.sum() == sizes.sum() and total.max() - total.min() <= (20 if batch > 50 else 200)


def test_bit_blocks_lose_no_link():
    masks = simhash.bit_blocks(3)
    r = random.Random(1)
    assert len(masks) == 10 and all(bin(m).count("1") in (25, 26) for m in masks)
    for _ in range(3000):
        differ = sum(1 << b for b in r.sample(range(64), 3))
        assert any(differ & m == 0 for m in masks)


def test_long_repetitive_text_is_bounded():
    import tracemalloc

    item, text = b"a" * 100, b"a" * 2_000_000
    items = decontamination.Items([0], [item], 0.1)
    tracemalloc.start()
    found = items.find(np.frombuffer(text, np.uint8), np.array([0, len(text)]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert [x.tolist() for x in found] == [[0], [0], [0], [100]] and peak < 500 << 20


def test_blocks_of_the_benchmark_are_searched_one_by_one(spark, docs, rows):
    bench = spark.createDataFrame([(k, rows[0][7][1][k * 5 : k * 5 + 60]) for k in range(6)], "item_id long, text string")
    whole = sorted(map(tuple, decontamination.contaminated(docs, bench).collect()))
    assert sorted(map(tuple, decontamination.contaminated(docs, bench, limit=100).collect())) == whole and whole
    left = {r.doc_id for r in decontamination.without_contaminated(docs, bench, limit=100).collect()}
    assert left == {i for i, *_ in rows[0]} - {d for d, *_ in whole}


def test_contaminated_is_brute_force(spark):
    """Every document and item within the edit budget, by alignment with all of the document."""
    r = random.Random(12)
    prose = lambda n: " ".join("".join(r.choice("abcdefg") for _ in range(r.randint(2, 7))) for _ in range(n))
    items = [(k, prose(r.randint(3, 20))) for k in range(12)] + [(12, "A  b"), (13, "a\tb")]
    made = []
    for k in range(60):
        item = bytearray(items[k % 12][1].encode())
        for _ in range(r.randint(0, len(item) // 8)):
            at = r.randrange(len(item))
            r.choice([lambda at=at, x=item: x.insert(at, 122), lambda at=at, x=item: x.pop(at), lambda at=at, x=item: x.__setitem__(at, 121)])()
        made.append((k, f"{prose(r.randint(0, 9))} {item.decode().upper() if k % 3 else item.decode()}\n{prose(r.randint(0, 9))}"))
    made += [(100, None), (101, ""), (102, "x a b y"), (103, made[0][1]), (None, made[1][1]), made[2]]
    fold = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), re.sub("[\x20\x09-\x0d]", " ", t or "")).encode()
    want = Counter()
    for d, t in made:
        for i, x in items:
            item, doc = fold(x), fold(t)
            row = [0] * (len(doc) + 1)
            for a, c in enumerate(item, 1):
                last, row = row, [a]
                for b, e in enumerate(doc, 1):
                    row.append(min(last[b - 1] + (c != e), last[b] + 1, row[b - 1] + 1))
            if min(row) <= len(item) // 10:
                want[d, i, min(row)] += 1
    found = decontamination.contaminated(spark.createDataFrame(made, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert Counter((x.doc_id, x.item_id, x.edits) for x in found) == want and len(want) > 20

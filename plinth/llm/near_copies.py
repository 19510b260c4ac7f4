"""The pipeline's near copies: texts whose sets of five-word shingles have a Jaccard similarity of LEAST or more, all of them.

Operator 8 finds the nearest of them, and an exact check of the sets follows. Its fingerprints cannot find all: at 0.8 two SimHash values differ
in about 10 of 64 bits, with a spread of 3, and no radius that bit blocks can serve holds all such pairs. The sets of texts that it leaves
apart are compared, and what is left out before cannot have a near copy. Texts lie in pages, which speak for them as in repeats.py:

1. each page asks which of its shingles another text has too, by 31 bits of hash within a bucket, which may say yes too often but never
   no; a text of whose shingles less than LEAST are shared has no near copy;
2. of the others' shared shingles each page asks how many of these texts have them. In the order of that number, two near copies
   share one of their first n - ceil(LEAST n) + 1 shingles (prefix filter). Texts so connected make groups;
3. operator 8 links the fingerprints of the texts that are left. Of its links those stay whose sets are similar enough;
4. the sets of a group meet in one task (those of a large group as pairs of chunks, in different tasks), where texts that share such a
   shingle and are not connected by 3 are compared exactly. Each task returns a spanning forest of its links, components are made as in operator 8.

Words are separated and lowered as in operator 8; a text of fewer words than a shingle is one shingle. Texts of equal words are told apart from
others by 128 bits of hash, shingles by 64. Texts without words, null ones too, are copies of each other. Null doc_id sorts first, and never
becomes a component's id unless it has no other. Very long texts are compared whole. An empty table gives no rows. Columns other than doc_id
and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plinth.llm import repeats
from plinth.llm.common import SEPARATOR, mix, partitions, ragged, release, runs, settle, texts, word_spans
from plinth.llm.repeats import powers, span_hashes
from plinth.llm.simhash import RADIUS, components, fingerprints, links

SHINGLE = 5
#: Least similarity, as a fraction.
LEAST = (4, 5)
#: A task compares the sets of a group up to so many texts or shingles; those of a larger one are dealt as pairs of chunks.
CHUNK_TEXTS, CHUNK_SHINGLES = 4096, 2 << 20
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[0x41:0x5B] += 0x20
_FOLD[SEPARATOR] = 0x20
_PLACES = np.random.default_rng(11).integers(1, 1 << 63, 64, np.uint64) * np.uint64(2) + np.uint64(1)


def _words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    data = _FOLD[data]
    start, end, first = word_spans(data, offsets)
    return mix(span_hashes(data, start, end)), first


def text_keys(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """128 bits of hash, as 16 bytes, of each text's words."""
    word, first = _words(data, offsets)
    n = np.diff(first)
    at, out = ragged(np.zeros(len(n), np.int64), n), np.empty((len(n), 2), np.uint64)
    for k, base in enumerate((repeats.BASE, 0xD1342543DE82EF95)):
        w = word if k == 0 else mix(word + np.uint64(1))
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(w * powers(int(n.max(initial=0)) + 1, base)[at], dtype=np.uint64)])
        out[:, k] = mix(total[first[1:]] - total[first[:-1]] + n.astype(np.uint64))
    return out


def _packed(keys: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(pa.binary(), len(keys), [None, pa.py_buffer((np.arange(len(keys) + 1) * 16).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(keys))])


def shingles(data: np.ndarray, offsets: np.ndarray, shingle: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, text, first word) of every shingle."""
    word, first = _words(data, offsets)
    n = np.diff(first)
    count = np.where(n > 0, np.maximum(n - shingle + 1, 1), 0)
    at, doc = ragged(first[:-1], count), np.repeat(np.arange(len(n)), count)
    stop, word = first[1:][doc], np.concatenate([word, np.zeros(shingle, np.uint64)])
    h = np.zeros(len(at), np.uint64)
    for k in range(shingle):
        h += np.where(at + k < stop, word[at + k], np.uint64(0)) * _PLACES[k]
    return mix(h), doc, at


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, page, text) -> (doc_id, page, key, text)"""
    for batch, data, offsets in runs(batches):
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), _packed(text_keys(data, offsets)), batch.column(2)], names=["doc_id", "page", "key", "text"])


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in _keyed(batches):
        yield batch.select(["doc_id", "page", "key"])


def _starts(key: np.ndarray) -> np.ndarray:
    return np.append(np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])), len(key))


def prefix_size(n: int, least: tuple[int, int]) -> int:
    return n - -(-n * least[0] // least[1]) + 1


def group_links(sets: list[np.ndarray], lead: np.ndarray, least: tuple[int, int], known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest (places a, b) of the pairs of sets at ``least`` or above, but for what connects sets of equal ``known``; each set
    is in the order of its shingles' numbers of texts, and the first ``lead`` of it are in no other set."""
    size = np.array([len(s) for s in sets])
    first = np.concatenate([[0], np.cumsum(size)])
    names, code = np.unique(np.concatenate(sets), return_inverse=True)
    prefix = size - -(-size * least[0] // least[1]) + 1
    at = ragged(first[:-1] + lead, np.maximum(prefix - lead, 0))
    owner = np.searchsorted(first, at, "right") - 1
    order = np.argsort(code[at], kind="stable")
    holders = owner[order]
    post = np.searchsorted(code[at][order], np.arange(len(names) + 1))
    mates, of = np.unique(known, return_inverse=True)[1], np.argsort(known, kind="stable")
    since = np.searchsorted(mates[of], np.arange(mates.max() + 2))
    fresh, left, mark = np.ones(len(sets), bool), len(sets), np.zeros(len(names), bool)
    a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for seed in range(len(sets)):
        if not fresh[seed]:
            continue
        stack = of[since[mates[seed]] : since[mates[seed] + 1]].tolist()
        fresh[stack] = False
        left -= len(stack)
        while stack and left:
            x = stack.pop()
            mine = code[first[x] + lead[x] : first[x] + prefix[x]]
            met = np.unique(holders[ragged(post[mine], post[mine + 1] - post[mine])])
            met = met[fresh[met] & (size[met] * least[1] >= size[x] * least[0]) & (size[x] * least[1] >= size[met] * least[0])]
            if not len(met):
                continue
            mark[code[first[x] : first[x + 1]]] = True
            held = np.add.reduceat(mark[code[ragged(first[met], size[met])]], np.cumsum(size[met]) - size[met], dtype=np.int64)
            mark[code[first[x] : first[x + 1]]] = False
            near = met[held * (least[0] + least[1]) >= least[0] * (size[met] + size[x])]
            more = np.unique(mates[near])
            more = of[ragged(since[more], since[more + 1] - since[more])]
            fresh[more] = False
            left -= len(more)
            stack.extend(more.tolist())
            a.append(np.full(len(near), x))
            b.append(near)
    return np.concatenate(a), np.concatenate(b)


COUNTED = 4
LOW = (1 << 31) - 1
ANSWER = pa.schema([("page", pa.int64()), ("kind", pa.int32()), ("doc_id", pa.int64()), ("n", pa.int64()), ("payload", pa.binary())])


def _page(rows: pa.Table, answers: pa.Table) -> repeats.Page:
    """A page that searches one of repeated rows."""
    page, before = repeats.Page(rows, answers), None
    for k, key in enumerate(page.rows.column("key").to_pylist()):
        if page.first[k]:
            page.first[k], before = key != before, key
    return page


def _sets(page: repeats.Page, shingle: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row number, hash) of the different shingles of a page's searched texts, in order, in runs."""
    for at, data, offsets in page.searched():
        h, text, _ = shingles(data, offsets, shingle)
        order = np.lexsort((h, text))
        h, text = h[order], text[order]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (text[1:] != text[:-1])
        yield at[text[new]], h[new]


def _codes(h: np.ndarray, parts: int) -> np.ndarray:
    """Bucket and 31 bits within it."""
    return ((h >> np.uint64(33)) % np.uint64(parts)) << np.uint64(31) | h & np.uint64(LOW)


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of a bucket's hashes, those that occur twice, by page."""
    pages, each = [], []
    for batch in batches:
        pages += zip(batch.column("bucket").to_pylist(), batch.column("page").to_pylist(), strict=True)
        each += [np.frombuffer(x, np.uint32) for x in batch.column("hashes").to_pylist()]
    if not each:
        return
    # sorted in place, and each page looks its hashes up: a task holds little more than its bucket twice
    value = np.concatenate(each)
    value.sort()
    again = value & np.uint32(1) == 1
    value >>= np.uint32(1)
    again[1:] |= value[1:] == value[:-1]
    value = value[again]
    value = value[_starts(value)[:-1]] if len(value) else value
    for k, (bucket, page) in enumerate(pages):
        low, each[k] = each[k] >> np.uint32(1), None
        mine = low[value[np.minimum(np.searchsorted(value, low), len(value) - 1)] == low] if len(value) else value
        if len(mine):
            yield pa.RecordBatch.from_pylist([{"page": page, "kind": repeats.SHARED, "doc_id": 0, "n": bucket, "payload": mine.tobytes()}], schema=ANSWER)
    release()


def _able(page: repeats.Page, parts: int, shingle: int, least: tuple[int, int]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(row number, hash, whether it is shared) for the texts of whose shingles enough are shared."""
    told = page.answers.filter(pc.equal(page.answers.column("kind"), repeats.SHARED))
    known = [np.frombuffer(x, np.uint32).astype(np.uint64) | np.uint64(n << 31) for n, x in zip(told.column("n").to_pylist(), told.column("payload").to_pylist(), strict=True)]
    shared = np.sort(np.concatenate([np.zeros(0, np.uint64), *known]))
    for row, h in _sets(page, shingle):
        code = _codes(h, parts)
        also = shared[np.minimum(np.searchsorted(shared, code), len(shared) - 1)] == code if len(shared) else np.zeros(len(h), bool)
        n, s = np.bincount(row, minlength=len(page.ids)), np.bincount(row[also], minlength=len(page.ids))
        keep = (s * least[1] >= n * least[0])[row]
        yield row[keep], h[keep], also[keep]


def near_prints(sets: DataFrame, least: tuple[int, int] = LEAST, radius: int = RADIUS) -> DataFrame:
    """(a, b): keys of those texts of ``sets`` (key, fp, shingles) that operator 8 links, by a forest from each task, and of which
    ``least`` of the shingles are in common."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = []
            for x, y in zip(batch.column("mine").to_pylist(), batch.column("other").to_pylist(), strict=True):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                held = len(np.intersect1d(x, y, assume_unique=True))
                near.append(held * (least[0] + least[1]) >= least[0] * (len(x) + len(y)))
            yield batch.select(["a", "b"]).filter(pa.array(near, pa.bool_()))

    stands = settle(sets.groupBy("fp").agg(F.min("key").alias("key")), "fingerprints")
    equal = sets.join(stands.withColumnRenamed("key", "b"), "fp").filter("key <> b").select(F.col("key").alias("a"), "b")
    near = links(stands.select("fp"), radius).withColumnsRenamed({"a": "x", "b": "y"})
    for fp, key in (("x", "a"), ("y", "b")):
        near = near.join(stands.select(F.col("fp").alias(fp), F.col("key").alias(key)), fp)
    pairs = near.select("a", "b").union(equal)
    for key, held in (("a", "mine"), ("b", "other")):
        pairs = pairs.join(sets.select(F.col("key").alias(key), F.col("shingles").alias(held)), key)
    return pairs.select("a", "b", "mine", "other").mapInArrow(check, "a binary, b binary")


def similar(keyed: DataFrame, firsts: DataFrame, least: tuple[int, int] = LEAST, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """(a, b): keys of different texts; a forest, from each task, of all pairs with ``least`` of their shingles in common.

    keyed: (doc_id, page, key, text); firsts: which row of each key is searched, as answers to its page."""
    parts = partitions(keyed.sparkSession)
    none = np.zeros(0, np.uint64)

    def ask(key: tuple, rows: pa.Table, answers: pa.Table) -> pa.Table:
        page = _page(rows, answers)
        code, n = np.unique(np.concatenate([none, *(_codes(h, parts) for _, h in _sets(page, shingle))]), return_counts=True)
        value = ((code & np.uint64(LOW)).astype(np.uint32) << np.uint32(1)) | (n > 1).astype(np.uint32)
        bucket = (code >> np.uint64(31)).astype(np.int64)
        edges = _starts(bucket) if len(bucket) else np.zeros(1, np.int64)
        made = [value[a:b].tobytes() for a, b in zip(edges.tolist(), edges[1:].tolist(), strict=False)]
        release()
        return pa.table({"bucket": pa.array(bucket[edges[:-1]]), "page": pa.array([key[0].as_py()] * len(made), pa.int64()), "hashes": pa.array(made, pa.binary())})

    def count(key: tuple, rows: pa.Table, answers: pa.Table) -> pa.Table:
        page = _page(rows, answers)
        h, n = np.unique(np.concatenate([none, *(h[also] for _, h, also in _able(page, parts, shingle, least))]), return_counts=True)
        release()
        return repeats.by_bucket(key[0].as_py(), h, n.astype("<i8"), parts)

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A bucket's hashes with the number of texts that have them, back to each page."""
        pages, hashes, counts = [], [none], [np.zeros(0, np.int64)]
        for batch in batches:
            pages += batch.column("page").to_pylist()
            hashes += [np.frombuffer(x, np.uint64) for x in batch.column("hashes").to_pylist()]
            counts += [np.frombuffer(x, "<i8") for x in batch.column("several").to_pylist()]
        sizes = [len(x) for x in hashes[1:]]
        names, to = np.unique(np.concatenate(hashes), return_inverse=True)
        total = np.bincount(to, np.concatenate(counts), len(names)).astype(np.uint64)
        del hashes, counts
        lo = 0
        for page, n in zip(pages, sizes, strict=True):
            mine = to[lo : lo + n]
            pair = np.stack([names[mine], total[mine]], axis=1)
            yield pa.RecordBatch.from_pylist([{"page": page, "kind": COUNTED, "doc_id": 0, "n": 0, "payload": pair.tobytes()}], schema=ANSWER)
            lo += n
        release()

    def assemble(key: tuple, rows: pa.Table, answers: pa.Table) -> pa.Table:
        page = _page(rows, answers)
        told = np.frombuffer(page.payload(COUNTED), np.uint64).reshape(-1, 2)
        told = told[np.argsort(told[:, 0])]
        keys, made, kept = page.rows.column("key").to_pylist(), [], []
        for row, h, also in _able(page, parts, shingle, least):
            held = np.ones(len(h), np.uint64)
            held[also] = told[np.searchsorted(told[:, 0], h[also]), 1]
            order = np.lexsort((h, held, row))
            row, h, held = row[order], h[order], held[order]
            edges = _starts(row) if len(row) else np.zeros(1, np.int64)
            for x, y in zip(edges.tolist(), edges[1:].tolist(), strict=False):
                lead = int((held[x:y] == 1).sum())
                if lead < prefix_size(y - x, least):
                    kept.append(row[x])
                    made.append({"key": keys[row[x]], "n": y - x, "lead": lead, "shingles": h[x:y].tobytes()})
        fp = fingerprints(*texts(page.rows.column("text").take(pa.array(kept, pa.int64())))).view(np.int64)
        release()
        found = pa.Table.from_pylist(made, schema=pa.schema([("key", pa.binary()), ("n", pa.int64()), ("lead", pa.int64()), ("shingles", pa.binary())]))
        return found.append_column("fp", pa.array(fp))

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, lead = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            of = [np.frombuffer(s, np.int64)[u : prefix_size(k, least)] for s, k, u in zip(batch.column(3).to_pylist(), n, lead, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(np.repeat(np.arange(len(of)), [len(x) for x in of]))), pa.array(np.concatenate([np.zeros(0, np.int64), *of]))], names=["key", "shingle"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        have = [b for b in batches if b.num_rows]
        if not have:
            return
        t = pa.Table.from_batches(have)
        cols = [t.column(c).to_numpy() for c in ("grp", "i", "j")]
        key, lead, sets = t.column("key").combine_chunks(), t.column("lead").to_numpy(), t.column("shingles")
        known = t.column("known").combine_chunks().dictionary_encode().indices.to_numpy()
        order = np.lexsort((*np.frombuffer(b"".join(key.to_pylist()), ">u8").reshape(-1, 2).T, *cols[::-1]))
        edges = np.append(np.flatnonzero(np.concatenate([[True], np.any([c[order][1:] != c[order][:-1] for c in cols], axis=0)])), len(order))
        for x, y in zip(edges, edges[1:], strict=False):
            if y - x > 1:
                rows = order[x:y]
                a, b = group_links([np.frombuffer(s.as_py(), np.uint64) for s in sets.take(pa.array(rows))], lead[rows], least, known[rows])
                yield pa.RecordBatch.from_arrays([key.take(pa.array(rows[a])), key.take(pa.array(rows[b]))], names=["a", "b"])
        release()

    def each_page(answers: DataFrame, f, schema) -> DataFrame:
        return paged.groupBy("page").cogroup(answers.groupBy("page")).applyInArrow(f, schema)

    paged = keyed.repartition(parts, "page")
    asked = each_page(firsts, ask, "bucket long, page long, hashes binary").repartition(parts, "bucket")
    found = firsts.union(asked.mapInArrow(_shared, repeats.ANSWER))
    counted = each_page(found, count, repeats.ASKED).repartition(parts, "bucket").mapInArrow(summed, repeats.ANSWER)
    sets = settle(each_page(found.union(counted), assemble, "key binary, n long, lead long, shingles binary, fp long"), "sets")
    known = components(near_prints(sets, least, radius)).withColumnsRenamed({"node": "key", "root": "known"})
    shared = sets.mapInArrow(prefixes, "key binary, shingle long")
    stars = shared.join(shared.groupBy("shingle").agg(F.min("key").alias("least")), "shingle").select(F.col("key").alias("a"), F.col("least").alias("b"))
    groups = sets.select("key", "n").join(components(stars).withColumnRenamed("node", "key"), "key", "left").select("key", "n", F.coalesce("root", "key").alias("grp"))
    chunks = groups.groupBy("grp").agg(F.count("*").alias("texts"), F.sum("n").alias("total")).filter("texts > 1").select("grp", F.ceil(F.greatest(F.col("texts") / CHUNK_TEXTS, F.col("total") / CHUNK_SHINGLES)).cast("int").alias("chunks"))
    dealt = groups.select("key", "grp").join(chunks, "grp").withColumn("mine", F.pmod(F.xxhash64("key"), F.col("chunks")).cast("int"))
    pairs = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).select("key", "grp", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"))
    met = pairs.join(sets, "key").join(known, "key", "left").select("grp", "i", "j", "key", F.coalesce("known", "key").alias("known"), "lead", "shingles")
    rest = met.repartition(parts, "grp", "i", "j").mapInArrow(compare, "a binary, b binary")
    return known.select(F.col("key").alias("a"), F.col("known").alias("b")).union(rest)


def near_copies(docs: DataFrame, least: tuple[int, int] = LEAST, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """(doc_id, key, n, component, component_id): for each doc_id and text (by its words) how many rows have them and which component they are of."""
    text, doc = F.coalesce(F.col("text").cast("string"), F.lit("")), F.coalesce(F.col("doc_id").cast("long"), F.lit(repeats.NO_ID))
    pages = repeats.PAGES * partitions(docs.sparkSession)
    plain = docs.select(doc.alias("doc_id"), F.pmod(F.xxhash64(text, doc), F.lit(pages)).alias("page"), text.alias("text"))
    made = settle(plain.mapInArrow(_keys, "doc_id long, page long, key binary"), "keys")
    distinct = settle(made.groupBy("key").agg(F.min(F.struct("doc_id", "page")).alias("f"), F.count("*").alias("n"), F.min(F.when(F.col("doc_id") != repeats.NO_ID, F.col("doc_id"))).alias("least")), "distinct")
    firsts = distinct.select("f.page", F.lit(repeats.FIRST).alias("kind"), "f.doc_id", "n", F.col("key").alias("payload"))
    roots = components(similar(plain.mapInArrow(_keyed, "doc_id long, page long, key binary, text string"), firsts, least, shingle, radius))
    member = distinct.join(roots, distinct.key == roots.node, "left").select("key", "least", F.coalesce("root", "key").alias("root"))
    ids = member.groupBy("root").agg(F.min("least").alias("component_id"))
    rows = made.groupBy(F.nullif("doc_id", F.lit(repeats.NO_ID)).alias("doc_id"), "key").agg(F.count("*").alias("n"))
    return rows.join(member.join(ids, "root").select("key", F.col("root").alias("component"), "component_id"), "key").select("doc_id", "key", "n", "component", "component_id")


def with_keys(docs: DataFrame, name: str) -> DataFrame:
    """docs with the key of each row's text as the last column ``name``."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in runs(batches):
            yield pa.RecordBatch.from_arrays([*batch.columns, _packed(text_keys(data, offsets))], names=[*batch.schema.names, name])

    return docs.mapInArrow(add, T.StructType([*(T.StructField(f.name, f.dataType) for f in docs.schema), T.StructField(name, T.BinaryType())]))

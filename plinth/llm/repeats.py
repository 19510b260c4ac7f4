"""What the two passage deduplicators share: finding, moving together and removing passages that occur more than once.

A window is a run of ``window`` symbols. Among the hashes of its grams the smallest marks an anchor, so equal windows have equal anchors
at equal offsets. Texts are dealt to pages by a hash of the text and its doc_id, so copies of a text lie in many pages and no page
holds a hot group. A page speaks for all its texts, so what it sends is aggregated before it is shuffled:

1. of equal texts (by SHA-256) the one with the smallest doc_id is searched; the others are copies;
2. each page sends its different anchor hashes, dealt by hash; those that occur elsewhere too come back to the page;
3. the page sends each different passage around such an anchor once (all windows that contain it) with its smallest doc_id, dealt by
   anchor; the operator's own method finds which windows there are repeated, by comparing symbols, and answers each page;
4. the page makes the same passages again, spreads the answers over their places, cuts its texts and digests them.

An anchor that over HOT_PAGES pages have is hot. Its windows are split into ranges of offsets; all windows of a range share a core around the
anchor, which becomes part of the key. Windows that are equal share the core, so none is lost, and passages that only have the anchor
in common go to different tasks. All of it is one lazy plan; the text is shuffled once, as the steps read the same exchange.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plinth.llm.common import mix, null_safe_text, partitions, ragged, release, slices, sliding_max, sliding_min

_TABLE = np.random.default_rng(7).integers(1, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
BASE = 0x9E3779B97F4A7C15 | 1
#: Pages for each shuffle partition. Each page writes to each bucket, so more pages mean more and smaller messages.
PAGES = 2
#: A task holds all contexts of its bucket, which are several times the text around them, so they are dealt to so many times as many tasks.
CONTEXT_SPLIT = 4
HOT_PAGES = 500
#: What a null doc_id counts as: it sorts before all others.
NO_ID = -(1 << 63)
#: Longer tables of powers are made anew instead of being kept.
KEPT_POWERS = 2 << 20
_POWERS = {1: np.ones(1, np.uint64)}


def powers(n: int, base: int = BASE) -> np.ndarray:
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        size = (int(n) + 0xFFFF) // 0x10000 * 0x10000
        have = np.full(size, base, np.uint64)
        have[0] = 1
        np.cumprod(have, out=have)
        if size <= KEPT_POWERS:
            _POWERS[base] = have
    return have[:n]


def prefix_hashes(data: np.ndarray, power: np.ndarray, step: int = 1 << 18) -> np.ndarray:
    """len(data) + 1 polynomial hashes of prefixes, made in steps so that little stands beside the result."""
    out = np.zeros(len(data) + 1, np.uint64)
    for lo in range(0, len(data), step):
        part = slice(lo + 1, min(lo + step, len(data)) + 1)
        np.cumsum(_TABLE[data[lo : lo + step]] * power[lo : lo + step][: len(data) - lo], out=out[part])
        out[part] += out[lo]
    return out


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Polynomial hashes (mod 2^64, bytes through a random table) of the byte ranges."""
    inverse = pow(BASE, -1, 1 << 64)
    prefix = prefix_hashes(data, powers(len(data)))
    return (prefix[end] - prefix[start]) * powers(len(data) + 1, inverse)[start]


def anchors(grams: np.ndarray, first: np.ndarray, last: np.ndarray, width: int) -> np.ndarray:
    """Places of grams that are the smallest of some window: grams[s : s+width] for s in the ranges first..last-1 (one for each text)."""
    if len(grams) < width:
        return np.zeros(0, np.int64)
    least = sliding_min(grams, width)
    whole = np.zeros(len(least) + 1, np.int32)
    ok = last > first
    np.add.at(whole, first[ok], 1)
    np.add.at(whole, last[ok], -1)
    least[np.cumsum(whole[:-1]) == 0] = 0
    fence = np.zeros(width - 1, np.uint64)
    return np.flatnonzero(sliding_max(np.concatenate([fence, least, fence]), width) == grams)


@dataclass(frozen=True)
class Method:
    """A deduplicator: symbols(data, offsets) has n (symbols of each text), marks() -> (hash, text, place) of its anchors, and span(text, place,
    before, after) -> the bytes of so many symbols around a place. find: contexts of a bucket -> answers. ranges: of a hot anchor's windows."""

    window: int
    left: int
    symbols: type
    once_per_text: bool
    ranges: int
    find: Callable


ANSWER = "page long, kind int, doc_id long, n long, payload binary"
FIRST, SHARED, HOT, FOUND = range(4)
CONTEXT = "bucket long, page long, no long, hash long, doc_id long, n long, shift long, context binary"


def _table(schema: str, *columns) -> pa.Table:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    fields = [f.split() for f in schema.split(", ")]
    return pa.table([c if isinstance(c, pa.Array) else pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields, strict=True)], names=[f for f, _ in fields])


class Page:
    """A page's rows in order of text and doc_id; which of them are searched, and how many copies their texts have."""

    def __init__(self, rows: pa.Table, answers: pa.Table):
        self.rows = rows.append_column("_id", rows.column("doc_id").fill_null(NO_ID)).sort_by([("key", "ascending"), ("_id", "ascending")]).combine_chunks()
        self.answers = answers
        firsts = answers.filter(pc.equal(answers.column("kind"), FIRST))
        known = {k: (d, n) for k, d, n in zip(firsts.column("payload").to_pylist(), firsts.column("doc_id").to_pylist(), firsts.column("n").to_pylist(), strict=True)}
        self.ids = self.rows.column("_id").to_numpy()
        told = [known.get(k, (None, 2)) for k in self.rows.column("key").to_pylist()]
        self.first = np.array([d == i for (d, _), i in zip(told, self.ids.tolist(), strict=True)], bool)
        self.copies = np.array([n for _, n in told], np.int64)

    def payload(self, kind: int) -> bytes:
        chosen = self.answers.filter(pc.equal(self.answers.column("kind"), kind))
        return b"".join(chosen.column("payload").to_pylist())

    def searched(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(row numbers, bytes, offsets) of texts to search, in runs."""
        at = np.flatnonzero(self.first)
        lo = 0
        for batch in self.rows.select(["text"]).take(pa.array(at)).combine_chunks().to_batches():
            for part, data, offsets in slices(batch, "text"):
                yield at[lo : lo + part.num_rows], data, offsets
                lo += part.num_rows


ASKED = "bucket long, page long, hashes binary, several binary"


def by_bucket(page: int, h: np.ndarray, held: np.ndarray, parts: int) -> pa.Table:
    """A page's hashes, each with a number or a flag, packed by the bucket they are dealt to."""
    bucket = ((h >> np.uint64(33)) % np.uint64(parts)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    h, held, bucket = h[order], held[order], bucket[order]
    edges = np.append(np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])), len(bucket)) if len(bucket) else np.zeros(1, np.int64)
    ends = list(zip(edges.tolist(), edges[1:].tolist(), strict=False))
    return _table(ASKED, bucket[edges[:-1]], np.full(len(ends), page), [h[a:b].tobytes() for a, b in ends], [held[a:b].tobytes() for a, b in ends])


def _asks(method: Method, parts: int):
    def ask(key: tuple, rows: pa.Table, answers: pa.Table) -> pa.Table:
        page, each = Page(rows, answers), [(np.zeros(0, np.uint64), np.zeros(0, np.int64))]
        for at, data, offsets in page.searched():
            hashes, text, _ = method.symbols(data, offsets).marks()
            each.append((hashes, at[text]))
        h, text = (np.concatenate(x) for x in zip(*each, strict=True))
        order = np.lexsort((text, h))
        h, text = h[order], text[order]
        new = np.ones(len(h), bool)
        new[1:] = h[1:] != h[:-1]
        again = ~new
        if method.once_per_text:
            again[1:] &= text[1:] != text[:-1]
        head = np.flatnonzero(new)
        several = np.add.reduceat(again, head).astype(bool) if len(head) else np.zeros(0, bool)
        h = h[head]
        made = by_bucket(key[0].as_py(), h, several, parts)
        release()
        return made

    return ask


def shared_hashes(hot_pages: float):
    """Of a bucket's hashes, those that occur twice, by page; HOT if over so many pages have them."""

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pages, hashes, several = [], [], []
        for batch in batches:
            pages.extend(batch.column("page").to_pylist())
            hashes.extend(np.frombuffer(x, np.uint64) for x in batch.column("hashes").to_pylist())
            several.extend(np.frombuffer(x, bool) for x in batch.column("several").to_pylist())
        if not hashes:
            return
        page, h, twice = np.repeat(np.array(pages, np.int64), [len(x) for x in hashes]), np.concatenate(hashes), np.concatenate(several)
        del pages, hashes, several
        order = np.argsort(h)
        head = np.flatnonzero(np.concatenate([[True], h[order][1:] != h[order][:-1]]))
        held = np.diff(np.append(head, len(h)))
        shared = (held > 1) | np.logical_or.reduceat(twice[order], head)
        kind = np.repeat(np.where(shared, np.where(held > hot_pages, HOT, SHARED), FIRST), held)
        keep = kind != FIRST
        order, kind = order[keep], kind[keep]
        page, h = page[order], h[order]
        order = np.lexsort((kind, page))
        page, h, kind = page[order], h[order], kind[order]
        edges = np.append(np.flatnonzero(np.concatenate([[True], (page[1:] != page[:-1]) | (kind[1:] != kind[:-1])])), len(page)) if len(page) else np.zeros(1, np.int64)
        for lo in range(0, len(edges) - 1, 10_000):
            part = edges[lo : lo + 10_001]
            n = len(part) - 1
            yield from _table(ANSWER, page[part[:-1]], kind[part[:-1]], np.zeros(n, np.int64), np.zeros(n, np.int64), [h[a:b].tobytes() for a, b in zip(part.tolist(), part[1:].tolist(), strict=False)]).to_batches()
        release()

    return answer


@dataclass
class Passages:
    """Occurrences of passages around shared anchors in a run of a page, and which passage (``row``, numbered in the page) each is."""

    text: np.ndarray  # row number in the page
    place: np.ndarray
    before: np.ndarray
    after: np.ndarray
    hash: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    row: np.ndarray
    data: np.ndarray


def _same_bytes(data: np.ndarray, a: np.ndarray, b: np.ndarray, size: np.ndarray, limit: int = 1 << 21) -> np.ndarray:
    """Whether the byte ranges of ``size`` at a and at b are equal."""
    out, total, lo = np.ones(len(a), bool), np.cumsum(size), 0
    while lo < len(a):
        hi = max(lo + 1, int(np.searchsorted(total, (total[lo - 1] if lo else 0) + limit, "right")))
        n = size[lo:hi]
        differ = data[ragged(a[lo:hi], n)] != data[ragged(b[lo:hi], n)]
        out[lo:hi] = np.add.reduceat(differ, np.cumsum(n) - n) == 0
        lo = hi
    return out


def passages(method: Method, page: Page) -> Iterator[Passages]:
    """The page's passages, the same whenever they are made."""
    shared, hot = np.unique(np.frombuffer(page.payload(SHARED), np.uint64)), np.unique(np.frombuffer(page.payload(HOT), np.uint64))
    wanted = np.union1d(shared, hot)
    made = 0
    for rows, data, offsets in page.searched() if len(wanted) else ():
        symbols = method.symbols(data, offsets)
        h, text, place = symbols.marks()
        keep = wanted[np.minimum(np.searchsorted(wanted, h), len(wanted) - 1)] == h
        h, text, place = h[keep], text[keep], place[keep]
        if not len(h):
            continue
        before, after = np.minimum(place, method.left), np.minimum(symbols.n[text] - place, method.window)
        prefix, inverse = prefix_hashes(data, powers(len(data))), powers(len(data) + 1, pow(BASE, -1, 1 << 64))
        hashed = lambda a, b, prefix=prefix, inverse=inverse: (prefix[b] - prefix[a]) * inverse[a]
        if len(hot):
            split = hot[np.minimum(np.searchsorted(hot, h), len(hot) - 1)] == h
            each = [[x[~split] for x in (h, text, place, before, after)]]
            h, text, place, before, after = (x[split] for x in (h, text, place, before, after))
            edges = np.linspace(0, method.left + 1, method.ranges + 1).astype(np.int64).tolist()
            for lo, hi in zip(edges, (e - 1 for e in edges[1:]), strict=False):
                ok = np.flatnonzero((before >= lo) & (after >= method.window - hi))
                core = hashed(*symbols.span(text[ok], place[ok], np.full(len(ok), lo), np.full(len(ok), method.window - hi)))
                each.append([mix(h[ok] ^ mix(core + np.uint64(lo + 1))), text[ok], place[ok], np.minimum(before[ok], hi), np.minimum(after[ok], method.window - lo)])
            h, text, place, before, after = (np.concatenate(x) for x in zip(*each, strict=True))
        begin, end = symbols.span(text, place, before, after)
        ident = mix(hashed(begin, end) ^ mix(h + before.astype(np.uint64)))
        order = np.argsort(ident, kind="stable")
        new = np.ones(len(order), bool)
        new[1:] = ident[order][1:] != ident[order][:-1]
        lead = order[np.flatnonzero(new)][np.cumsum(new) - 1]
        row = np.empty(len(order), np.int64)
        row[order] = np.cumsum(new) - 1
        other, of = order[~new], lead[~new]
        size = end[other] - begin[other]
        same = (size == end[of] - begin[of]) & (h[other] == h[of]) & (before[other] == before[of])
        same[same] = _same_bytes(data, begin[other][same], begin[of][same], size[same])
        count = int(new.sum())
        row[other[~same]] = count + np.arange(int((~same).sum()))  # two passages of one hash
        count += int((~same).sum())
        yield Passages(rows[text], place, before, after, h, begin, end, row + made, data)
        made += count


def _contexts(method: Method, parts: int):
    def send(key: tuple, rows: pa.Table, answers: pa.Table) -> pa.Table:
        page, out = Page(rows, answers), []
        for p in passages(method, page):
            order = np.lexsort((page.ids[p.text], p.row))
            head = np.flatnonzero(np.concatenate([[True], p.row[order][1:] != p.row[order][:-1]]))
            one, n = order[head], np.diff(np.append(head, len(order)))
            size = p.end[one] - p.begin[one]
            context = pa.Array.from_buffers(pa.binary(), len(one), [None, pa.py_buffer(np.concatenate([[0], np.cumsum(size)]).astype(np.int32)), pa.py_buffer(p.data[ragged(p.begin[one], size)])])
            h = p.hash[one]
            out.append(_table(CONTEXT, ((h >> np.uint64(33)) % np.uint64(parts)).astype(np.int64), np.full(len(one), key[0].as_py()), p.row[one], h.view(np.int64), page.ids[p.text[one]], n, p.before[one], context))
        release()
        return pa.concat_tables(out) if out else _table(CONTEXT, *[[] for _ in range(8)])

    return send


def gathered(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.Table]:
    """A bucket's contexts in order of hash and doc_id, cut between hashes into tables of about so many rows."""
    have = [b for b in batches if b.num_rows]
    if not have:
        return
    t = pa.Table.from_batches(have).combine_chunks()
    del have
    order = np.lexsort((t.column("no").to_numpy(), t.column("page").to_numpy(), t.column("doc_id").to_numpy(), t.column("hash").to_numpy()))
    h = t.column("hash").to_numpy()[order]
    starts = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
    lo = 0
    while lo < len(h):
        i = int(np.searchsorted(starts, lo + rows, "left"))
        hi = int(starts[i]) if i < len(starts) else len(h)
        yield t.take(pa.array(order[lo:hi]))
        lo = hi
    release()


def answered(t: pa.Table, row: np.ndarray, column: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Found windows (context, column), in order, as answers to the contexts' pages: [number, first column, last column] for each run."""
    if not len(row):
        return
    head = np.flatnonzero(np.concatenate([[True], (row[1:] != row[:-1]) | (column[1:] != column[:-1] + 1)]))
    tail = np.append(head[1:], len(row)) - 1
    page, no = t.column("page").to_numpy()[row[head]], t.column("no").to_numpy()[row[head]]
    order = np.argsort(page, kind="stable")
    page, made = page[order], np.stack([no, column[head], column[tail]], axis=1)[order].astype("<i8")
    edges = np.append(np.flatnonzero(np.concatenate([[True], page[1:] != page[:-1]])), len(page))
    n = len(edges) - 1
    yield from _table(ANSWER, page[edges[:-1]], np.full(n, FOUND), np.zeros(n, np.int64), np.zeros(n, np.int64), [made[a:b].tobytes() for a, b in zip(edges.tolist(), edges[1:].tolist(), strict=False)]).to_batches()


def spans(method: Method, page: Page) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row number, first window's start, last window's start) of the page's repeated windows, in order of row number."""
    found = np.frombuffer(page.payload(FOUND), "<i8").reshape(-1, 3)
    found = found[np.argsort(found[:, 0], kind="stable")]
    each = [(np.zeros(0, np.int64),) * 3]
    for p in passages(method, page):
        # answered windows
        a, b = np.searchsorted(found[:, 0], p.row), np.searchsorted(found[:, 0], p.row, "right")
        of, which = np.repeat(np.arange(len(p.row)), b - a), ragged(a, b - a)
        order = np.lexsort((page.ids[p.text], p.row))
        least = np.empty(len(order), np.int64)
        head = np.flatnonzero(np.concatenate([[True], p.row[order][1:] != p.row[order][:-1]]))
        size = np.diff(np.append(head, len(order)))
        least[order] = np.repeat(page.ids[p.text[order[head]]], size)
        several = np.empty(len(order), np.int64)
        several[order] = np.repeat(size, size)
        each.append((p.text[of], p.place[of] + found[which, 1] - method.left, p.place[of] + found[which, 2] - method.left))
        # what else the page has of a passage is a copy of all of it
        again = (page.ids[p.text] > least) if method.once_per_text else several > 1
        again &= p.before + p.after >= method.window
        each.append((p.text[again], (p.place - p.before)[again], (p.place + p.after)[again] - method.window))
    text, first, last = (np.concatenate(x) for x in zip(*each, strict=True))
    order = np.argsort(text, kind="stable")
    return text[order], first[order], last[order]


def covered(first: np.ndarray, last: np.ndarray, window: int, n: int) -> np.ndarray:
    """Which of n symbols lie in a window that starts at first..last of some span."""
    mark = np.zeros(n + 1, np.int32)
    np.add.at(mark, first, 1)
    np.add.at(mark, last + window, -1)
    return np.cumsum(mark[:-1]) > 0


Cut = Callable[[bytes, np.ndarray | None, bool, int], tuple]


def _cuts(method: Method, cut: Cut, made: T.StructType, carry: bool):
    """cut(text, covered symbols(n) -> which or None, searched, copies) -> the values of ``made``."""
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = to_arrow_schema(made)

    def finish(key: tuple, rows: pa.Table, answers: pa.Table) -> pa.Table:
        page = Page(rows, answers)
        text, first, last = spans(method, page)
        edges = np.searchsorted(text, np.arange(len(page.ids) + 1))
        out, k = [], 0
        for batch in page.rows.to_batches():
            for part, data, offsets in slices(batch, "text"):
                each = []
                for i in range(part.num_rows):
                    a, b = edges[k], edges[k + 1]
                    which = (lambda n, a=a, b=b: covered(first[a:b], last[a:b], method.window, n)) if b > a else None
                    each.append(cut(data[offsets[i] : offsets[i + 1]].tobytes(), which, bool(page.first[k]), int(page.copies[k])))
                    k += 1
                columns = [pa.array(c, f.type) for c, f in zip(zip(*each, strict=True), schema, strict=True)]
                kept = ["carried", "doc_id"] if carry else ["doc_id"]
                out.append(pa.table([*(part.column(c) for c in kept), *columns], names=[*kept, *schema.names]))
        release()
        return pa.concat_tables(out)

    return finish


def remove_repeats(docs: DataFrame, method: Method, cut: Cut, made: str, carry: list[str] = (), hot_pages: int = HOT_PAGES) -> DataFrame:
    """Per row of docs: what is carried as a struct, doc_id and what cut makes."""
    parts = partitions(docs.sparkSession)
    text = null_safe_text()
    doc, key = F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)), F.unhex(F.sha2(text, 256))
    page = lambda k, d: F.pmod(F.xxhash64(k, d), F.lit(PAGES * parts))
    more = [F.struct(*carry).alias("carried")] if carry else []
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), *more).withColumn("key", F.unhex(F.sha2("text", 256)))
    texts = texts.withColumn("page", page(F.col("key"), F.coalesce("doc_id", F.lit(NO_ID)))).repartition(parts, "page")
    groups = docs.select(doc.alias("doc"), key.alias("key")).groupBy("key").agg(F.min("doc").alias("doc"), F.count("*").alias("n"))
    firsts = groups.select(page(F.col("key"), F.col("doc")).alias("page"), F.lit(FIRST).alias("kind"), F.col("doc").alias("doc_id"), "n", F.col("key").alias("payload"))

    def each_page(answers: DataFrame, f, schema) -> DataFrame:
        return texts.groupBy("page").cogroup(answers.groupBy("page")).applyInArrow(f, schema)

    asked = each_page(firsts, _asks(method, parts), ASKED).repartition(parts, "bucket")
    shared = firsts.union(asked.mapInArrow(shared_hashes(hot_pages), ANSWER))
    fine = CONTEXT_SPLIT * parts
    contexts = each_page(shared, _contexts(method, fine), CONTEXT).repartition(fine, "bucket")
    found = contexts.mapInArrow(method.find, ANSWER)
    kinds = T.StructType.fromDDL(made)
    kept = [T.StructField("doc_id", T.LongType())]
    if carry:
        kept = [texts.schema["carried"], *kept]
    return each_page(shared.union(found), _cuts(method, cut, kinds, bool(carry)), T.StructType(kept + kinds.fields))

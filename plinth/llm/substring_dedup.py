"""Operator 4: substring deduplication by relative Lempel-Ziv parsing.

A reference block holds the corpus' passages around the anchors dealt to it (see repeats.py), in order of doc_id, with an index of the
runs of words at each column. Every document's passages are factored greedily against every block that has one of their anchors:
from a place on, the longest run of words that an earlier document's passage has there too is a factor. A factor of WINDOW words or more
is a duplicate span, and nothing else is. The next factor begins WINDOW - 1 words before the end of a long one, so that windows across
factor boundaries are parsed as well, and one word after the start of a shorter one. Words are compared, not hashes.

A word goes if a window of WINDOW words that covers it also starts in a document with a smaller doc_id. Of equal texts all but those of
the smallest doc_id go whole. Null text: no words. Null doc_id sorts before all others. Rows with equal doc_id don't reduce each other.
Very long texts are searched whole, in the memory of one text. An empty table gives no rows. Columns other than doc_id, text and those to be
carried are not read, whatever they are called.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from plinth.llm import repeats
from plinth.llm.common import mix, ragged, table, word_spans

WINDOW, GRAM = 13, 5
WIDTH = WINDOW - GRAM + 1  # grams in a window
LEFT, RIGHT = WIDTH - 1, WINDOW  # words around an anchor's start
COLUMNS = LEFT + RIGHT


class Words:
    """A run's words as symbols."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data = data
        self.start, self.end, self.first = word_spans(data, offsets)
        self.n = np.diff(self.first)

    def marks(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(hash, text number, word number in the text) of each anchor."""
        n = len(self.start)
        if n < WINDOW:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        words = mix(repeats.span_hashes(self.data, self.start, self.end))
        grams = np.zeros(n - GRAM + 1, np.uint64)
        for j in range(GRAM):
            grams += words[j : n - GRAM + 1 + j] * np.uint64((0xD6E8FEB86659FD93 * (2 * j + 3)) & (2**64 - 1))
        grams = mix(grams)
        at = repeats.anchors(grams, self.first[:-1], self.first[1:] - WINDOW + 1, WIDTH)
        doc = np.searchsorted(self.first, at, "right") - 1
        return grams[at], doc, at - self.first[doc]

    def span(self, text: np.ndarray, place: np.ndarray, before: np.ndarray, after: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = self.first[text] + place
        return self.start[at - before], self.end[at + after - 1]


def _word_table(context: pa.Array, shift: np.ndarray) -> np.ndarray:
    """A row of word numbers for each context, its anchor at column LEFT; -1 where it has no word."""
    buffers = context.buffers()
    offsets = np.frombuffer(buffers[1], np.int32)[context.offset : context.offset + len(context) + 1].astype(np.int64)
    data = np.frombuffer(buffers[2], np.uint8)[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    start, end, first = word_spans(data, offsets)
    size = end - start
    packed = data[ragged(start, size)]
    words = pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(np.concatenate([[0], np.cumsum(size)]).astype(np.int32)), pa.py_buffer(packed)])
    number = words.dictionary_encode().indices.to_numpy()
    row = np.repeat(np.arange(len(context)), np.diff(first))
    out = np.full((len(context), LEFT + RIGHT), -1, np.int32)
    out[row, np.arange(len(number)) - first[row] + LEFT - shift[row]] = number
    return out


class Block:
    """Passages of words in order of group and doc, indexed by the runs of words at each column."""

    def __init__(self, words: np.ndarray, group: np.ndarray, doc: np.ndarray):
        self.words, self.group, self.doc = words, group, doc
        scale = (np.random.default_rng(11).integers(1, 1 << 62, COLUMNS, np.int64).astype(np.uint64) << np.uint64(1)) | np.uint64(1)
        self.prefix = np.zeros((len(words), COLUMNS + 1), np.uint64)
        np.cumsum((words + 1).astype(np.uint64) * scale, axis=1, out=self.prefix[:, 1:])

    def whole(self, column: int, length: int) -> np.ndarray:
        """Which passages have all words of the run."""
        return (self.words[:, column] >= 0) & (self.words[:, column + length - 1] >= 0)

    def runs(self, rows: np.ndarray, column: int, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(rows, number of each one's run, the run's smallest doc): rows that have equal words there, and group, have one number."""
        value = mix(self.prefix[rows, column + length] - self.prefix[rows, column] + mix(self.group[rows].astype(np.uint64)))
        order = np.argsort(value, kind="stable")
        rows, value = rows[order], value[order]
        have, group = self.words[rows, column : column + length], self.group[rows]
        new = np.concatenate([[True], (have[1:] != have[:-1]).any(axis=1) | (group[1:] != group[:-1])])
        if (new[1:] & (value[1:] == value[:-1])).any():  # two runs of one hash: order by the words instead
            order = np.lexsort((*have.T, group))
            rows, have, group = rows[order], have[order], group[order]
            new = np.concatenate([[True], (have[1:] != have[:-1]).any(axis=1) | (group[1:] != group[:-1])])
        head, number = np.flatnonzero(new), np.cumsum(new) - 1
        return rows, number, np.minimum.reduceat(self.doc[rows], head)[number]

    def longest(self, mine: np.ndarray, column: int) -> np.ndarray:
        """Length of each passage's factor from a column on: its longest run there in a passage of a smaller doc; 0 if under WINDOW words."""
        wanted = np.zeros(int(self.group[-1]) + 1, bool)
        wanted[self.group[mine]] = True
        out, left = np.zeros(len(self.words), np.int64), np.zeros(len(self.words), bool)
        left[mine] = True
        rows = np.flatnonzero(wanted[self.group] & self.whole(column, WINDOW))
        rows, number, least = self.runs(rows, column, WINDOW)
        left[rows] &= least < self.doc[rows]
        out[rows[left[rows]]] = WINDOW
        for length in range(COLUMNS - column, WINDOW, -1):
            live = np.zeros(int(number.max()) + 1, bool)  # runs of WINDOW words that still have a passage without its factor
            live[number[left[rows]]] = True
            rows, number = rows[live[number]], number[live[number]]
            if not len(rows):
                break
            able = rows[self.whole(column, length)[rows]]
            if len(able) > 1:
                able, _, least = self.runs(able, column, length)
                done = able[left[able] & (least < self.doc[able])]
                out[done], left[done] = length, False
        return out[mine]


def duplicate_windows(words: np.ndarray, group: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """(rows, WIDTH): which windows (by their first column) lie in a factor of WINDOW words or more of their row. Rows are in order of group and doc."""
    n, block = len(words), Block(words, group, doc)
    out = np.zeros((n, WIDTH), bool)
    lead = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
    later = np.repeat(doc[lead], np.diff(np.append(lead, n))) < doc  # a group's smallest doc has nothing before it
    at = np.zeros(n, np.int64)  # where the next factor begins
    for column in range(WIDTH):
        here = at == column
        mine = np.flatnonzero(here & later & block.whole(column, WINDOW))
        at[here] += 1
        if len(mine):
            length = block.longest(mine, column)
            long = np.flatnonzero(length >= WINDOW)
            ends = column + length[long] - WINDOW  # the last window inside
            out[mine[long]] |= (np.arange(WIDTH) >= column) & (np.arange(WIDTH) <= ends[:, None])
            at[mine[long]] = ends + 1
    return out


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for t in repeats.gathered(batches, 60_000):
        words = _word_table(t.column("context").combine_chunks() if t.column("context").num_chunks != 1 else t.column("context").chunk(0), t.column("shift").to_numpy())
        h = t.column("hash").to_numpy()
        group = np.cumsum(np.concatenate([[False], h[1:] != h[:-1]]))
        yield from repeats.answered(t, *np.nonzero(duplicate_windows(words, group, t.column("doc_id").to_numpy())))


METHOD = repeats.Method(WINDOW, LEFT, Words, True, WIDTH, _find)


def _cut(text: bytes, which, searched: bool, copies: int) -> tuple:
    words = text.split()
    kept, gone = words, 0
    if not searched and len(words) >= WINDOW:
        kept, gone = [], len(words)
    elif which:
        out = which(len(words))
        kept, gone = [w for w, x in zip(words, out.tolist(), strict=True) if not x], int(out.sum())
    joined = b" ".join(kept)
    return len(words), gone, hashlib.sha256(joined).hexdigest(), (joined if gone else text).decode("utf-8", "replace")


MADE = "n_words long, n_removed long, kept_sha256 string, kept_text string"


def remove_repeated_words(docs: DataFrame, carry: list[str] = (), hot_pages: int = repeats.HOT_PAGES) -> DataFrame:
    """Per row of docs: doc_id, n_words, n_removed, kept_sha256, kept_text (the text as it is if nothing goes); with docs' columns ``carry`` as
    the struct ``carried``."""
    return repeats.remove_repeats(docs, METHOD, _cut, MADE, carry, hot_pages)


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeated_words(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", "kept_sha256")


OP4_SQL = r"""
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM documents),
g AS (SELECT doc_id, i, array_to_string(words[i:i+12], ' ') AS gram FROM (SELECT doc_id, words, unnest(range(1, len(words) - 11)) AS i FROM d WHERE len(words) >= 13)),
m AS (SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY gram) AS least FROM g) WHERE least < doc_id),
c AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS p FROM m),
w AS (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS p FROM d),
k AS (SELECT w.doc_id, string_agg(word, ' ' ORDER BY w.p) AS kept, count(*) AS n FROM w ANTI JOIN c ON w.doc_id = c.doc_id AND w.p = c.p GROUP BY w.doc_id)
SELECT d.doc_id, len(words)::BIGINT AS n_words, (len(words) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN k USING (doc_id)
"""

"""Operator 7: token counts by a finite-state transducer compiled from a sentencepiece BPE vocabulary.

The last token of a prefix's encoding is unique: it is the only piece that ends there and whose pair with the token before it
encodes to just these two. So reading left to right needs the last tokens at the places where a piece that is still
open may have begun. Those, with their counts relative to now, are a state; a transition reads a character and has the number of tokens
that it adds. States and transitions are compiled when first met and kept in a hash table; there are finitely many.

Texts are cut into chunks of CHUNK characters, which are all read in step. What precedes a chunk is only known to the chunks before it, so
each chunk gets a map from entry states to (exit state, tokens). It begins with the state that the LOOK characters before the chunk lead to
from the start, which nearly always is the right one, as states forget; then every exit of a chunk that its successor's map lacks becomes an
entry there, until the maps are closed. Maps compose by a parallel prefix scan: in each round every entry takes over what the chunks twice as
far on add, so n chunks take log2 n rounds, whatever the text has for spaces.

Null text: an empty text. Null doc_id and repeated rows are kept. Very long texts are counted whole, in chunks. An empty table gives no rows.
Columns other than doc_id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plinth.llm.common import runs, table
from plinth.llm.tokens import vocabulary_path

CHUNK, LOOK = 512, 32
SPACE = "▁"
#: Chunks that are read in step; the exit state of a text that goes on is where the next ones start.
TOGETHER = 8192
#: A worker forgets all it has compiled beyond so many transitions.
TRANSITIONS = 500_000
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


class Transducer:
    _made: dict[str, Transducer] = {}

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        ordinary = [i for i in range(n) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
        self.score = {model.id_to_piece(i): (model.get_score(i), -i) for i in ordinary}
        self.prefixes = {p[:k] for p in self.score for k in range(1, len(p) + 1)}
        #: no piece has a space after something else, so where a space begins a word every state leads to the start
        self.resets = not any(SPACE in p.lstrip(SPACE) for p in self.score)
        self.alphabet = {c: k for k, c in enumerate(sorted({c for p in self.score for c in p}))}
        if not any(model.is_byte(i) for i in range(n)):
            raise ValueError("the vocabulary must have byte pieces")
        known = len(self.alphabet)
        self.classes = np.empty(0x110000, np.int32)  # characters in no piece differ by their length in bytes only
        for k, (lo, hi) in enumerate(((0, 0x80), (0x80, 0x800), (0x800, 0x10000), (0x10000, 0x110000))):
            self.classes[lo:hi] = known + k
        for c, k in self.alphabet.items():
            self.classes[ord(c)] = k
        self.letters = [*self.alphabet, "\x00", "\x80", "ࠀ", "\U00010000"]
        self.stride = len(self.letters)
        self.pairs: dict[tuple[str, str], bool] = {}
        self.wholes: dict[str, bool] = {}
        self.clear()

    @classmethod
    def of(cls, path: str) -> Transducer:
        if path not in cls._made:
            cls._made[path] = cls(path)
        return cls._made[path]

    def clear(self) -> None:
        self.states: list[tuple] = []
        self.numbers: dict[tuple, int] = {}
        self.bits, self.used = 16, 0
        self.keys, self.values = np.full(1 << self.bits, -1, np.int64), np.zeros(1 << self.bits, np.int64)
        self.start = self._number(("", (None,), (0,)))

    def _number(self, state: tuple) -> int:
        if state not in self.numbers:
            self.numbers[state] = len(self.states)
            self.states.append(state)
        return self.numbers[state]

    def encoded(self, text: str) -> list[str]:
        """BPE of a short string: the best-scored pair merges first, of equal ones the leftmost."""
        parts = list(text)
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = self.score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s[0] > best[0]):
                    best, at = s, i
            if at < 0:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def fits(self, before: str | None, token: str) -> bool:
        if before is None:
            if token not in self.wholes:
                self.wholes[token] = self.encoded(token) == [token]
            return self.wholes[token]
        pair = (before, token)
        if pair not in self.pairs:
            if len(self.pairs) > 400_000:
                self.pairs.clear()
            self.pairs[pair] = self.encoded(before + token) == [before, token]
        return self.pairs[pair]

    def step(self, state: int, letter: int) -> tuple[int, int]:
        """(next state, tokens added). A state is (open characters, last token at each of their edges, counts less the newest)."""
        open_, last, count = self.states[state]
        c = self.letters[letter]
        if c == SPACE and self.resets and open_[-1:] != SPACE:
            open_, last, count = "", (None,), (0,)
        text = open_ + c
        n = len(text)
        for k in range(n):
            token = text[k:]
            if (k == n - 1 or token in self.score) and self.fits(last[k], token):
                break
        else:
            raise AssertionError("no encoding")
        added = count[k] + (1 if token in self.score else len(c.encode("utf-8", "surrogatepass")))
        last, count = (*last, token), (*(x - added for x in count), 0)
        keep = next((n - k for k in range(n) if text[k:] in self.prefixes), 0)
        return self._number((text[n - keep :], last[-keep - 1 :], count[-keep - 1 :])), added

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * _MULTIPLIER) >> np.uint64(64 - self.bits)).astype(np.int64)

    def _insert(self, keys: np.ndarray, values: np.ndarray) -> None:
        if 2 * (self.used + len(keys)) > len(self.keys):
            old = self.keys >= 0
            keys, values = np.concatenate([self.keys[old], keys]), np.concatenate([self.values[old], values])
            while 2 * len(keys) > 1 << self.bits:
                self.bits += 1
            self.keys, self.values, self.used = np.full(1 << self.bits, -1, np.int64), np.zeros(1 << self.bits, np.int64), 0
        slot, mask = self._slot(keys), len(self.keys) - 1
        left = np.arange(len(keys))
        while len(left):
            free = self.keys[slot[left]] < 0
            at = left[free]
            self.keys[slot[at]] = keys[at]
            won = self.keys[slot[left]] == keys[left]
            self.values[slot[left[won]]] = values[left[won]]
            left = left[~won]
            slot[left] = (slot[left] + 1) & mask
        self.used += len(keys)

    def _find(self, key: np.ndarray) -> np.ndarray:
        slot, mask = self._slot(key), len(self.keys) - 1
        have = self.keys[slot]
        out = self.values[slot]
        left = np.flatnonzero(have != key)
        if len(left):
            while len(left):
                gone = have[left] < 0
                out[left[gone]] = -1
                left = left[~gone]
                slot[left] = (slot[left] + 1) & mask
                have[left] = self.keys[slot[left]]
                out[left] = self.values[slot[left]]
                left = left[have[left] != key[left]]
        return out

    def read(self, letters: np.ndarray, start: np.ndarray, stop: np.ndarray, state: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Read letters[start:stop] of each lane from its state, all lanes in step: (exit states, tokens added)."""
        order = np.argsort(start - stop, kind="stable")
        begin, length = start[order], (stop - start)[order]
        now, count = state[order].copy(), np.zeros(len(order), np.int64)
        live = len(order)
        for k in range(int(length[0]) if len(length) else 0):
            live = int(np.searchsorted(-length[:live], -k, "left"))
            key = now[:live] * self.stride + letters[begin[:live] + k]
            value = self._find(key)
            if (value < 0).any():
                new = np.unique(key[value < 0])
                made = [self.step(*divmod(x, self.stride)) for x in new.tolist()]
                self._insert(new, np.array([(s << 8) | (e + 128) for s, e in made], np.int64))
                value = self._find(key)
            now[:live] = value >> 8
            count[:live] += (value & 255) - 128
        out, total = np.empty_like(now), np.empty_like(count)
        out[order], total[order] = now, count
        return out, total

    def counts(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Tokens of each text, as the library counts them: a space goes before a text that isn't empty."""
        n = len(offsets) - 1
        if len(data) == 0:
            return np.zeros(n, np.int64)
        codes = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le", "surrogatepass"), np.uint32)
        chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[offsets]
        codes = np.where(codes == 0x20, np.uint32(ord(SPACE)), codes)
        full = np.diff(chars) > 0
        codes = np.insert(codes, chars[:-1][full], ord(SPACE))
        begin = (chars[:-1] + np.cumsum(full) - full)[full]
        end = np.append(begin[1:], len(codes))
        letters = self.classes[codes].astype(np.int64)
        chunks = -(-(end - begin) // CHUNK)
        doc, lead = np.repeat(np.arange(len(begin)), chunks), np.cumsum(chunks) - chunks
        lo = begin[doc] + (np.arange(len(doc)) - lead[doc]) * CHUNK
        hi, total, state = np.minimum(lo + CHUNK, end[doc]), np.zeros(len(begin), np.int64), self.start
        for at in range(0, len(lo), TOGETHER):
            part = slice(at, at + TOGETHER)
            if self.used > TRANSITIONS:
                known = self.states[state]
                self.clear()
                state = self._number(known)
            mine = doc[part]
            first = np.flatnonzero(np.concatenate([[True], mine[1:] != mine[:-1]]))
            entry = np.full(len(first), self.start)
            if lead[mine[0]] < at:
                entry[0] = state
            tokens, exits = self._composed(letters, lo[part], hi[part], first, np.append(first[1:], len(mine)) - 1, entry)
            total[mine[first]] += tokens
            state = int(exits[-1])
        out = np.zeros(n, np.int64)
        out[full] = total
        return out

    def _composed(self, letters: np.ndarray, lo: np.ndarray, hi: np.ndarray, first: np.ndarray, last: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(tokens, exit state) of texts, or parts of texts, whose chunks letters[lo:hi] are numbered first..last, from the states ``begin``."""
        inner, guess = np.ones(len(lo), bool), np.empty(len(lo), np.int64)
        inner[first] = False
        guess[first] = begin
        guess[inner], _ = self.read(letters, lo[inner] - LOOK, lo[inner], np.full(int(inner.sum()), self.start))
        ends = np.zeros(len(lo), bool)
        ends[last] = True
        # maps as rows (chunk, entry, exit, tokens); of the newest rows, exits that the next chunk's map lacks are entries there
        new = (np.arange(len(lo)), guess, *self.read(letters, lo, hi, guess))
        rows = [new]
        known = new[0] << 32 | new[1]
        while True:
            on = ~ends[new[0]]
            wanted = np.setdiff1d((new[0][on] + 1) << 32 | new[2][on], known)
            if not len(wanted):
                break
            chunk, entry = wanted >> 32, wanted & 0xFFFFFFFF
            new = (chunk, entry, *self.read(letters, lo[chunk], hi[chunk], entry))
            rows.append(new)
            known = np.concatenate([known, wanted])
        chunk, entry, exit_, tokens = (np.concatenate(x) for x in zip(*rows, strict=True))
        order = np.argsort(known)
        known, chunk, exit_, tokens = known[order], chunk[order], exit_[order], tokens[order]
        over = len(known)  # after a text's last chunk
        follow = np.where(ends[chunk], over, np.searchsorted(known, (chunk + 1) << 32 | exit_))
        tail = np.where(ends[chunk], np.arange(over), follow)
        follow, tokens = np.append(follow, over), np.append(tokens, 0)
        while (follow != over).any():
            tokens, follow, tail = tokens + tokens[follow], follow[follow], tail[tail]
        at = np.searchsorted(known, first << 32 | begin)
        return tokens[at], exit_[tail[at]]


def count_tokens(docs: DataFrame, vocabulary: str, limit: int = 4096) -> DataFrame:
    """Per row of docs: doc_id, n_bytes, n_tokens, over_limit."""
    path = vocabulary_path(vocabulary)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = Transducer.of(path)
        for batch, data, offsets in runs(batches, limit=4 << 20):
            n = made.counts(data, offsets)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.diff(offsets)), pa.array(n), pa.array(n > limit)], names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(count, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"), "piece_bpe_32k.model")

"""Tokenizing whole texts by the tokenizers library, with each distinct piece of text encoded once per worker.

A text is cut before each single space that is followed by a printable ASCII character or a Latin-1 letter.
Both vocabularies' pre-tokenizers always start a new pre-token there, no normalizer composes across it and no
added token contains a space, so the pieces' ids joined are the ids of the whole text. The tests compare the two.

Neither joins letters with marks after them, so a text is also cut between an ASCII letter and a following ASCII mark other than an
apostrophe, which contractions need, and a bar, which added tokens hold. Vocabularies in APART drop white space, and are
also cut between a line end and a following ASCII letter. Words are then the same piece whatever mark follows them.
"""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa

from plinth.llm.common import ragged

#: A worker remembers the ids of so many distinct pieces; others are encoded again in each run.
CACHE_PIECES = 250_000
#: So many pieces are handed to the library at once; its results are large.
ENCODE_PIECES = 8192
APART = {"word_bpe_49k.json"}
_AFTER_SPACE = np.zeros(256, bool)
_AFTER_SPACE[0x21:0x7F] = True
_AFTER_SPACE[0xC3] = True
_LETTER = np.zeros(256, bool)
_LETTER[0x41:0x5B] = _LETTER[0x61:0x7B] = True
_MARK = np.zeros(256, bool)
_MARK[[ord(c) for c in "\n!\"#$%&()*+,-./:;<=>?@[\\]^_`{}~"]] = True


def vocabulary_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class PieceEncoder:
    """encode(data, offsets) -> (ids, first): all texts' ids as uint32 and each text's first id's place."""

    _made: dict[str, PieceEncoder] = {}

    def __init__(self, path: str):
        self.apart = os.path.basename(path) in APART
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.places: dict[bytes, int] = {}
        self.flat = np.zeros(1 << 16, np.uint32)
        self.first = np.zeros(1 << 12, np.int64)
        self.count = 0

    @classmethod
    def of(cls, path: str) -> PieceEncoder:
        if path not in cls._made:
            cls._made[path] = cls(path)
        return cls._made[path]

    def _add(self, pieces: list[bytes]) -> None:
        made = self.library.encode_batch_fast([p.decode("utf-8", "replace") for p in pieces], add_special_tokens=False)
        ids = [e.ids for e in made]
        lengths = np.fromiter(map(len, ids), np.int64, len(ids))
        end, total = int(self.first[self.count]), int(lengths.sum())
        while end + total > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros(len(self.flat), np.uint32)])
        while self.count + len(ids) + 1 > len(self.first):
            self.first = np.concatenate([self.first, np.zeros(len(self.first), np.int64)])
        self.flat[end : end + total] = np.fromiter((x for e in ids for x in e), np.uint32, total)
        self.first[self.count + 1 : self.count + 1 + len(ids)] = end + np.cumsum(lengths)
        self.count += len(ids)

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if len(data) == 0:
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
        space = np.flatnonzero(data[:-1] == 0x20)
        space = space[_AFTER_SPACE[data[space + 1]]]
        is_edge = np.zeros(len(data) + 1, bool)
        is_edge[offsets] = True
        space = space[~is_edge[space + 1]]
        is_edge[space] = True
        letter = _LETTER[data]
        is_edge[1:-1] |= letter[:-1] & _MARK[data[1:]]
        if self.apart:
            is_edge[1:-1] |= (data[:-1] == 0x0A) & letter[1:]
        edges = np.flatnonzero(is_edge)
        cut = pa.Array.from_buffers(pa.binary(), len(edges) - 1, [None, pa.py_buffer(edges.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))]).dictionary_encode()
        pieces = cut.dictionary.to_pylist()
        kept = self.count
        known = self.places
        slots = np.fromiter((known.get(p, -1) for p in pieces), np.int64, len(pieces))
        new = np.flatnonzero(slots < 0)
        if len(new):
            slots[new] = np.arange(self.count, self.count + len(new))
            added = [pieces[i] for i in new]
            for lo in range(0, len(added), ENCODE_PIECES):
                self._add(added[lo : lo + ENCODE_PIECES])
            room = max(0, CACHE_PIECES - kept)
            known.update(zip(added[:room], range(kept, kept + room), strict=False))
        of_piece = slots[cut.indices.to_numpy()]
        lengths = self.first[of_piece + 1] - self.first[of_piece]
        ids = self.flat[ragged(self.first[of_piece], lengths)]
        self.count = min(self.count, max(kept, CACHE_PIECES))  # pieces beyond the room are forgotten
        ends = np.concatenate([[0], np.cumsum(lengths)])
        return ids, ends[np.searchsorted(edges, offsets)]

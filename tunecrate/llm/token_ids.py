"""Token ids of whole columns of texts by a public tokenizer, each distinct piece encoded once.

The tokenizers library splits a text into pre-tokens and encodes each alone. For runs of
ASCII and Latin-1 letters, digits, punctuation and spaces the split is known, so it is made
here on bytes, and the library encodes each distinct pre-token once per worker. Words with
anything else (apostrophes, other scripts, combining marks, control characters) go to the
library whole; a text with white space outside ASCII, in the style that keeps white space,
goes to it whole. A known pre-token is found by one 64-bit hash and must agree in a second
(SipHash) before its ids are used; else the library encodes it anew. Strings of special tokens
in a text are ordinary text, as the description of the tokenizer files sets it.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa

from tunecrate.llm import words

SPACE, LETTER, DIGIT, SIGN, OTHER = range(5)
CACHE_ENTRIES = 1_000_000
RECENT = 50_000

_CLASS = np.full(256, OTHER, np.uint8)
_CLASS[words.IS_SPACE] = SPACE
for _c in range(0x21, 0x7F):
    _CLASS[_c] = LETTER if chr(_c).isalpha() else DIGIT if chr(_c).isdigit() else SIGN
_CLASS[ord("'")] = OTHER
_OTHER_SPACE = re.compile("[\x1c-\x1f\x85\xa0  -     　]")
_ODD_LEAD = np.zeros(256, bool)
_ODD_LEAD[[0x1C, 0x1D, 0x1E, 0x1F, 0xC2, 0xE1, 0xE2, 0xE3]] = True
_SALT = np.uint64(0xA24BAED4963EE407)


def _latin(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Second bytes of Latin-1 letters (lead byte 0xC3), and those of capitals."""
    second = np.zeros(len(data), bool)
    second[1:] = (data[:-1] == 0xC3) & (data[1:] != 0x97) & (data[1:] != 0xB7)
    return second, second & (data >= 0x80) & (data <= 0x9E)


class Encoder:
    """One tokenizer file. ``lower``: white space is dropped, case folded, digits stand alone; else white space counts."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self.lower = self.tokenizer.normalizer is not None
        self._clear()

    def _clear(self) -> None:
        self.known, self.slots, self.recent = np.zeros(0, np.uint64), np.zeros(0, np.int32), {}
        self.starts, self.sizes, self.flat = np.zeros(1024, np.int32), np.zeros(1024, np.int32), np.zeros(1024, np.uint32)
        self.marks = np.zeros(1024, np.int64)
        self.count = self.used = 0

    def _library(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _remember(self, hashes: np.ndarray, marks: np.ndarray, ids: list[list[int]]) -> None:
        count, base = self.count, self.used
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        flat = np.fromiter(chain.from_iterable(ids), np.uint32, int(sizes.sum()))
        for name, need in (("starts", count + len(ids)), ("sizes", count + len(ids)), ("marks", count + len(ids)), ("flat", base + len(flat))):
            old = getattr(self, name)
            if need > len(old):
                grown = np.zeros(2 * need, old.dtype)
                grown[: len(old)] = old
                setattr(self, name, grown)
        self.starts[count : count + len(ids)] = base + np.cumsum(sizes) - sizes
        self.sizes[count : count + len(ids)] = sizes
        self.marks[count : count + len(ids)] = marks
        self.flat[base : base + len(flat)] = flat
        self.count, self.used = count + len(ids), base + len(flat)
        self.recent.update(zip(hashes.tolist(), range(count, self.count)))
        if len(self.recent) > RECENT:  # kept as sorted arrays, a tenth of a dictionary's memory
            keys = np.concatenate([self.known, np.fromiter(self.recent.keys(), np.uint64, len(self.recent))])
            slots = np.concatenate([self.slots, np.fromiter(self.recent.values(), np.int32, len(self.recent))])
            order = np.argsort(keys)
            self.known, self.slots, self.recent = keys[order], slots[order], {}

    def _look_up(self, hashes: np.ndarray) -> np.ndarray:
        """Slots of pre-tokens, -1 for new ones."""
        slot = np.full(len(hashes), -1, np.int64)
        if len(self.known):
            at = np.minimum(np.searchsorted(self.known, hashes), len(self.known) - 1)
            slot = np.where(self.known[at] == hashes, self.slots[at], slot)
        rest = np.flatnonzero(slot < 0)
        slot[rest] = [self.recent.get(h, -1) for h in hashes[rest].tolist()]
        return slot

    def _spans(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Starts and ends of pre-tokens in order, which of them go to the library whole, and the bytes to hash."""
        kind = _CLASS[data]
        second, capital = _latin(data)
        kind[second] = LETTER
        lead = np.flatnonzero(second) - 1
        kind[lead] = LETTER
        starts, ends, word_offsets = words.word_spans(data, offsets)
        odd = np.concatenate([[0], np.cumsum(kind == OTHER)])
        whole_word = odd[ends] > odd[starts]
        kind[np.repeat(starts[whole_word], ends[whole_word] - starts[whole_word]) + _ramp(ends[whole_word] - starts[whole_word])] = OTHER
        begin = np.zeros(len(data), bool)
        begin[1:] = kind[1:] != kind[:-1]
        begin[offsets[:-1][offsets[:-1] < offsets[1:]]] = True
        folded = data
        if self.lower:
            begin |= kind == DIGIT
            begin &= kind != SPACE
            a = np.flatnonzero(begin)
            follow = np.concatenate([a[1:], [len(data)]])
            stop = np.concatenate([np.flatnonzero(kind == SPACE), offsets[1:]])
            stop.sort()
            b = np.minimum(follow, stop[np.searchsorted(stop, a, side="right")]) if len(a) else a
            folded = data.copy()
            folded[((data >= 65) & (data <= 90)) | capital] += 32
            return a, b, kind[a] == OTHER, folded
        last = np.zeros(len(data), bool)  # last white space before a word parts from the run; a space goes to the word
        last[:-1] = (kind[:-1] == SPACE) & (kind[1:] != SPACE)
        last[offsets[1:][offsets[1:] > offsets[:-1]] - 1] = False
        begin |= last
        begin[np.flatnonzero(last & (data == 32)) + 1] = False
        a3 = np.flatnonzero(begin)
        b3 = np.append(a3[1:], len(data)) if len(a3) else a3
        whole = kind[b3 - 1] == OTHER
        if _ODD_LEAD[data].any():
            raw = data.tobytes()
            strange = [i for i, (x, y) in enumerate(zip(offsets[:-1], offsets[1:])) if _OTHER_SPACE.search(raw[x:y].decode())]
            if strange:
                inside = np.isin(np.searchsorted(offsets, a3, side="right") - 1, strange)
                a3 = np.concatenate([a3[~inside], offsets[:-1][strange]])
                b3 = np.concatenate([b3[~inside], offsets[1:][strange]])
                whole = np.concatenate([whole[~inside], np.ones(len(strange), bool)])
                order = np.argsort(a3, kind="stable")
                a3, b3, whole = a3[order], b3[order], whole[order]
        return a3, b3, whole, data

    def encode(self, column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """(first row, end row, ids, id offsets by row) of consecutive runs of rows."""
        for low, high, data, offsets in words.byte_slices(words.filled(column)):
            a, b, whole, folded = self._spans(data, offsets)
            hashes = words.span_hashes(folded, a, b)
            if whole.any():
                hashes[whole] = words.span_hashes(data, a[whole], b[whole]) ^ _SALT
            distinct, at, place = np.unique(hashes, return_index=True, return_inverse=True)
            if self.count + len(distinct) > CACHE_ENTRIES:
                self._clear()
            slot = self._look_up(distinct)
            raw, raw_folded = data.tobytes(), folded.tobytes()
            names = [(raw if w else raw_folded)[x:y] for w, x, y in zip(whole[at].tolist(), a[at].tolist(), b[at].tolist())]
            marks = np.fromiter(map(hash, names), np.int64, len(names))
            slot[self.marks[slot] != marks] = -1
            new = np.flatnonzero(slot < 0)
            if len(new):
                slot[new] = np.arange(self.count, self.count + len(new))
                self._remember(distinct[new], marks[new], self._library([names[i].decode() for i in new]))
            slot = slot[place]
            sizes = self.sizes[slot].astype(np.int64)
            ids = self.flat[np.repeat(self.starts[slot].astype(np.int64), sizes) + _ramp(sizes)]
            total = np.concatenate([[0], np.cumsum(sizes)])
            yield low, high, ids, total[np.searchsorted(a, offsets)]


def _ramp(sizes: np.ndarray) -> np.ndarray:
    """0, 1, .. size - 1 for each size in turn."""
    return np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def installed(name: str) -> str:
    """Path of a public tokenizer's file on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)

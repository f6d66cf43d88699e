"""Token ids of whole texts, from a tokenizers file, with each distinct word encoded once.

A text is cut where no token and no pre-token can cross, the pieces are encoded
by the library and the ids joined, which gives the ids of the whole text. Pieces
come again and again, so each worker keeps the ids of those it met, by their
64-bit hash and length, in flat arrays of a bounded size.
"""

from __future__ import annotations

import os
import sys
import types
from collections.abc import Callable

import numpy as np
import pyarrow as pa

from kawaraban.llm.words import LOWER, SPACES, WORKER, Words, per_row, spans, text_bytes

#: Ids a worker keeps; beyond it, it starts anew with the pieces at hand.
KEPT = 8_000_000

_ALNUM = np.isin(np.arange(256), list(b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"))
_POINTS = np.isin(np.arange(256), list(b".,;:!?"))
_CONTROLS = np.isin(np.arange(256), [*range(9), *range(0x0E, 0x20), 0x7F])

#: (bytes, rows' offsets in them, starts and ends of the pieces)
Pieces = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def _neighbours(flags: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """flags of the byte before and after each byte, false beyond the row."""
    before, after = np.roll(flags, 1), np.roll(flags, -1)
    if len(flags):
        before[offsets[:-1][offsets[:-1] < len(flags)]] = False
        after[offsets[1:][offsets[1:] > 0] - 1] = False
    return before, after


def _special(data: np.ndarray) -> np.ndarray:
    """Where the mark that special tokens begin with stands."""
    return (data == 0x3C) & (np.roll(data, -1) == 0x7C)


def at_spaces(texts: pa.Array) -> Pieces:
    """Pieces for tokenizers that drop white space, ignore case, and part letters from points.

    Cut at ASCII white space and between an ASCII letter or digit and one point
    at the word's end; ASCII texts without marks of special tokens are
    lower-cased first.
    """
    words = Words(texts)
    data, offsets = words.data, words.offsets
    plain = per_row((data >= 0x80) | _special(data), offsets) == 0
    data = np.where(np.repeat(plain, np.diff(offsets)), LOWER[data], data)
    last = words.ends - 1
    cut = last[(last > words.starts) & _POINTS[data[last]] & _ALNUM[data[np.maximum(last - 1, 0)]]]
    return data, offsets, np.sort(np.concatenate([words.starts, cut])), np.sort(np.concatenate([words.ends, cut]))


def before_words(texts: pa.Array) -> Pieces:
    """Pieces for byte-level tokenizers, whose ids depend on the space before a word.

    Cut before a space and after a line end that stand alone between two other
    characters, and between an ASCII letter or digit and a point. A text with
    control characters, other white space or the marks of special tokens stays
    whole.
    """
    data, offsets = text_bytes(texts)
    solid = ~SPACES[data]
    before, after = _neighbours(solid, offsets)
    alnum, _ = _neighbours(_ALNUM[data], offsets)
    ends, _ = _neighbours((data == 0x0A) & before, offsets)
    cut = (data == 0x20) & before & after | _POINTS[data] & alnum | solid & ends
    second, third = np.roll(data, -1), np.roll(data, -2)
    odd = _CONTROLS[data] | _special(data) | (data == 0xC2) & ((second == 0x85) | (second == 0xA0)) | (data == 0xE1) & (second == 0x9A)
    odd |= (data == 0xE2) & ((second == 0x81) | (second == 0x80) & ((third <= 0x8A) | (third == 0xA8) | (third == 0xA9) | (third == 0xAF)))
    odd |= (data == 0xE3) & (second == 0x80)
    cut &= ~np.repeat(per_row(odd, offsets) > 0, np.diff(offsets))
    cut[offsets[:-1][offsets[:-1] < len(data)]] = True
    starts = np.flatnonzero(cut)
    return data, offsets, starts, np.append(starts[1:], len(data))[: len(starts)]


class Encoder:
    """Ids of texts without special tokens."""

    def __init__(self, path: str, cut: Callable[[pa.Array], Pieces]):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer, self._cut = Tokenizer.from_file(path), cut
        self.vocabulary = self._tokenizer.get_vocab_size(with_added_tokens=True)
        self._clear()

    def _clear(self) -> None:
        self._keys, self._first, self._many = np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
        self._ids = np.empty(0, np.uint32)

    def _learn(self, keys: np.ndarray, pieces: list[str]) -> None:
        many, ids = [], []
        for at in range(0, len(pieces), 5_000):
            for e in self._tokenizer.encode_batch_fast(pieces[at : at + 5_000], add_special_tokens=False):
                found = e.ids
                many.append(len(found))
                ids.extend(found)
        many = np.array(many, np.int64)
        place = np.searchsorted(self._keys, keys)
        self._keys = np.insert(self._keys, place, keys)
        self._first = np.insert(self._first, place, np.cumsum(many) - many + len(self._ids))
        self._many = np.insert(self._many, place, many)
        self._ids = np.concatenate([self._ids, np.array(ids, np.uint32)])

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All texts' ids in a row, and the bounds of every text's."""
        data, offsets, starts, ends = self._cut(texts)
        keys, example, which = np.unique(spans(data, starts, ends), return_index=True, return_inverse=True)
        if len(self._ids) > KEPT:
            self._clear()
        at = np.searchsorted(self._keys, keys)
        known = self._keys[np.minimum(at, len(self._keys) - 1)] == keys if len(self._keys) else np.zeros(len(keys), bool)
        if not known.all():
            raw = data.tobytes()
            new = example[~known]
            self._learn(keys[~known], [raw[a:b].decode() for a, b in zip(starts[new].tolist(), ends[new].tolist(), strict=True)])
            at = np.searchsorted(self._keys, keys)
        many, first = self._many[at][which], self._first[at][which]
        done = np.concatenate([[0], np.cumsum(many)])
        ids = self._ids[np.repeat(first - done[:-1], many) + np.arange(done[-1])]
        return ids, done[np.searchsorted(starts, offsets)]

    def encode_bytes(self, texts: pa.Array) -> list[bytes]:
        """Every text's ids, little-endian unsigned 32-bit."""
        ids, bounds = self.encode(texts)
        flat = ids.astype("<u4").tobytes()
        return [flat[4 * a : 4 * b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]


def encoder(path: str, cut: Callable[[pa.Array], Pieces]) -> Encoder:
    """This worker's encoder for a file; it outlives the task, until a task of other work runs here."""
    kept = sys.modules.setdefault(WORKER, types.ModuleType(WORKER))
    name = f"{cut.__name__} {path}"
    if name not in vars(kept):
        vars(kept)[name] = Encoder(path, cut)
    return vars(kept)[name]

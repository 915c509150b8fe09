"""Whole-text encoding with the tokenizers library, a distinct piece of text at a time.

The byte-level pre-tokenizer never joins a character that is no white space with white space after it. A text may
therefore be cut before each space or line feed that follows such a character, and the pieces' ids join up exactly. Each
distinct piece goes through the library once while a bounded cache holds it; Arrow then gathers the ids of all texts.
Texts with other white space before a space or line feed go through the library whole.

The cache knows a piece by two independent 64-bit hashes of its bytes.
"""

from __future__ import annotations

import os
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .bpe import safe_pieces
from .common import RangeHash, flat_bytes, mix

#: Bound on the pieces that a worker holds (about 50 bytes each); beyond it the cache starts anew.
CACHE_PIECES = 2_000_000
#: Bound on the text that goes through the library in one call, so that the library's offsets stay small.
CALL_CHARS = 1 << 18
_ASCII_WHITE = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f "
#: White space beyond ASCII: fixed values of Unicode.
_OTHER_WHITE = "\u0085\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
_ASCII_WHITE_TABLE = np.isin(np.arange(256), [ord(c) for c in _ASCII_WHITE])
_WHITE_INSIDE = f"[{_ASCII_WHITE}{_OTHER_WHITE}]"
#: A piece's mark tells what stands before it: a text's start, a space, or a line feed.
_START, _SPACE, _FEED = (np.uint64(k) for k in (1, 2, 3))


@lru_cache(maxsize=2)
def encoder(path: str) -> PieceEncoder:
    """The encoder of a tokenizer file, loaded once in each worker, which keeps its cache."""
    return PieceEncoder(path)


class PieceEncoder:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._kind = np.uint16 if self._tokenizer.get_vocab_size() <= 1 << 16 else np.uint32
        feed = self._whole(["\n"])[0]
        self._feed = int(feed[0]) if len(feed) == 1 else None
        self._clear()

    def _clear(self) -> None:
        self._keys = np.zeros(0, np.uint64)  # sorted
        self._checks, self._places = np.zeros(0, np.uint64), np.zeros(0, np.int32)
        self._starts, self._counts, self._values = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, self._kind)

    def _whole(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, self._kind) for e in self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts (null: empty), one after the other, and how many each text has."""
        found = self._encode(texts)
        pa.default_memory_pool().release_unused()  # else a worker keeps what its largest slice took
        return found

    def _encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        odd = np.ones(len(texts), bool) if self._feed is None else _is_odd(texts)
        counts = np.zeros(len(texts), np.int64)
        ids = np.zeros(0, self._kind)
        if not odd.all():
            ids, counts[~odd] = self._plain(texts.filter(pa.array(~odd)) if odd.any() else texts)
        if not odd.any():
            return ids, counts
        apart = [np.concatenate([self._whole([p])[0] for p in safe_pieces(t, CALL_CHARS)]) for t in texts.filter(pa.array(odd)).to_pylist()]
        n = counts[~odd]
        counts[odd] = [len(a) for a in apart]
        out, starts = np.zeros(int(counts.sum()), self._kind), np.cumsum(counts) - counts
        out[np.repeat(starts[~odd] - (np.cumsum(n) - n), n) + np.arange(len(ids))] = ids
        for start, a in zip(starts[odd], apart):
            out[start : start + len(a)] = a
        return out, counts

    def _plain(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """A line feed gets a space before it, then all texts fall apart at the spaces. Each text starts with a piece."""
        lists = pc.split_pattern(pc.replace_substring(texts, "\n", " \n"), " ")
        pieces = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
        kinds = lists.flatten().dictionary_encode()
        indices, words = kinds.indices.to_numpy().astype(np.int64), kinds.dictionary
        first = np.cumsum(pieces) - pieces
        # A text's first piece has no space before it, so it is another piece than the same characters elsewhere.
        heads, of_head = np.unique(indices[first], return_inverse=True)
        fed = pc.starts_with(words, "\n").to_numpy(zero_copy_only=False)
        marks = np.where(fed, _FEED, _SPACE)
        both = pa.concat_arrays([words, words.take(pa.array(heads))])
        indices[first] = len(words) + of_head
        counts, ids_of = self._find(both, np.concatenate([marks, np.where(fed[heads], _FEED, _START)]))
        offsets = np.zeros(len(both) + 1, np.int64)
        np.cumsum(counts, out=offsets[1:])
        taken = pa.LargeListArray.from_arrays(pa.array(offsets), pa.array(ids_of)).take(pa.array(indices))
        ends = np.cumsum(counts[indices])
        return taken.flatten().to_numpy(zero_copy_only=False), np.diff(ends[first + pieces - 1], prepend=0)

    def _find(self, words: pa.Array, marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How many ids each word has, and all their ids."""
        data, offsets = flat_bytes(words)
        plain = RangeHash(data)(offsets[:-1], offsets[1:])
        lengths = (offsets[1:] - offsets[:-1]).astype(np.uint64)
        keys, checks = mix(plain + marks), mix(_second_hash(data, offsets) ^ (lengths << np.uint64(2)) ^ marks)
        if len(self._keys) > CACHE_PIECES:
            self._clear()
        at = np.minimum(np.searchsorted(self._keys, keys), max(0, len(self._keys) - 1))
        known = (self._keys[at] == keys) & (self._checks[at] == checks) if len(self._keys) else np.zeros(len(keys), bool)
        counts, starts = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
        place = self._places[at[known]]
        counts[known], starts[known] = self._counts[place], self._starts[place]
        new = np.flatnonzero(~known)
        if len(new):
            n, values = self._encode_words(words.take(pa.array(new)), marks[new])
            counts[new], starts[new] = n, len(self._values) + np.cumsum(n) - n
            self._insert(keys[new], checks[new], starts[new], n, values)
        ends = np.cumsum(counts)
        return counts, self._values[np.repeat(starts - (ends - counts), counts) + np.arange(int(ends[-1]))]

    def _insert(self, keys: np.ndarray, checks: np.ndarray, starts: np.ndarray, counts: np.ndarray, values: np.ndarray) -> None:
        places = np.arange(len(self._counts), len(self._counts) + len(keys), dtype=np.int32)
        self._starts, self._counts, self._values = np.concatenate([self._starts, starts]), np.concatenate([self._counts, counts]), np.concatenate([self._values, values])
        order = np.argsort(keys)
        at = np.searchsorted(self._keys, keys[order])
        self._keys, self._checks, self._places = (np.insert(old, at, new[order]) for old, new in ((self._keys, keys), (self._checks, checks), (self._places, places)))

    def _encode_words(self, words: pa.Array, marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Words without white space go through the library line by line in one call; the line feeds' ids part them."""
        fed = marks == _FEED
        bodies = pc.if_else(pa.array(fed), pc.utf8_slice_codeunits(words, 1), words) if fed.any() else words
        odd = pc.match_substring_regex(bodies, _WHITE_INSIDE).to_numpy(zero_copy_only=False) | (pc.binary_length(bodies).to_numpy(zero_copy_only=False) == 0)
        counts = np.zeros(len(words), np.int64)
        parts: list[tuple[np.ndarray, np.ndarray]] = []  # positions of words, their ids
        for mark, before in ((_START, ""), (_SPACE, " "), (_FEED, "")):
            which = np.flatnonzero((marks == mark) & ~odd)
            for i in range(0, len(which), 1 << 14):
                some = which[i : i + (1 << 14)]
                ids = self._whole([before + ("\n" + before).join(bodies.take(pa.array(some)).to_pylist())])[0]
                is_feed = ids == self._feed
                cuts = np.flatnonzero(is_feed)
                if len(cuts) != len(some) - 1:
                    odd[some] = True
                    continue
                n = np.diff(cuts, prepend=-1, append=len(ids)) - 1
                if mark == _FEED:  # each word brings the line feed before it
                    ids, n = np.concatenate([np.array([self._feed], self._kind), ids]), n + 1
                else:
                    ids = ids[~is_feed]
                counts[some] = n
                parts.append((some, ids))
        alone = np.flatnonzero(odd)
        if len(alone):
            texts = words.take(pa.array(alone)).to_pylist()
            found = self._whole([f" {t}" if m == _SPACE else t for t, m in zip(texts, marks[alone])])
            counts[alone] = [len(a) for a in found]
            parts.append((alone, np.concatenate(found)))
        values, starts = np.zeros(int(counts.sum()), self._kind), np.cumsum(counts) - counts
        for some, ids in parts:
            n = counts[some]
            values[np.repeat(starts[some] - (np.cumsum(n) - n), n) + np.arange(len(ids))] = ids
        return counts, values


def _second_hash(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Another hash of the byte ranges between the offsets: the sum of scrambled (byte, place) pairs."""
    n = np.diff(offsets)
    place = np.arange(len(data), dtype=np.uint64) - np.repeat(offsets[:-1].astype(np.uint64), n)
    spread = mix(data.astype(np.uint64) + place * np.uint64(257) + np.uint64(1 << 40))
    sums = np.zeros(len(spread) + 1, np.uint64)
    np.cumsum(spread, out=sums[1:])
    return sums[offsets[1:]] - sums[offsets[:-1]]


def _is_odd(texts: pa.Array) -> np.ndarray:
    """Which texts have white space before a space or line feed."""
    data, offsets = flat_bytes(texts)
    ends_piece = (data == 32) | (data == 10)
    at = np.flatnonzero(ends_piece[1:]) + 1
    before = data[at - 1]
    # U+0085 and U+00A0 have the first byte C2; the other white space beyond ASCII has three bytes, E1 to E3 first.
    wide = (before >= 0x80) & ((data[np.maximum(at - 2, 0)] == 0xC2) | ((data[np.maximum(at - 3, 0)] >= 0xE1) & (data[np.maximum(at - 3, 0)] <= 0xE3)))
    at = at[_ASCII_WHITE_TABLE[before] | wide]
    text = np.searchsorted(offsets, at, side="right") - 1
    out = np.zeros(len(texts), bool)
    out[text[at > offsets[text]]] = True
    return out

"""Token ids of whole texts by way of remembered units (numpy, used inside Spark tasks).

For tokenizers that lower-case, drop white space and split texts by
``'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+``: the ids of a
text are those of its units, one after another, when units are cut only where that
pattern always ends a match.  Units are hashed and made distinct per piece of
text, so the tokenizer sees each unit once per worker.
"""

from __future__ import annotations

import re

import numpy as np

from .shingles import PIECE, _tables, mix

_LOWER = np.array([c + 32 if 65 <= c <= 90 else c for c in range(256)], np.uint8)
_SPACE, _LETTER, _BEYOND, _DIGIT, _MARK, _QUOTE = range(6)
_CLASS = np.full(256, _MARK, np.uint8)
_CLASS[[9, 10, 11, 12, 13, 32]] = _SPACE
_CLASS[97:123] = _LETTER
_CLASS[128:] = _BEYOND
_CLASS[48:58] = _DIGIT
_CLASS[39] = _QUOTE
#: [before, here]: does a unit end between bytes of these classes?
_CUT = np.zeros((6, 6), bool)
_CUT[_SPACE, :] = True
_CUT[_DIGIT, :] = _CUT[:, _DIGIT] = True
_CUT[_LETTER, [_MARK, _QUOTE]] = True
_CUT[_MARK, _LETTER] = True            # after a quote: it may begin a contraction
_CUT_FLAT = _CUT.ravel()
#: Units that are one letter run, and stay so when lower-cased.
_PLAIN = re.compile("[a-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+")
_WORD_END = "</w>"
#: Units that a worker remembers at most; beyond it begins anew.
REMEMBERED = 2_000_000


class UnitEncoder:
    def __init__(self, tokenizer_path: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(tokenizer_path)
        vocabulary = self.tokenizer.get_vocab()
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends_word[[i for token, i in vocabulary.items() if token.endswith(_WORD_END)]] = True
        self.special = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.forget()

    def forget(self):
        self.keys, self.slot = np.empty(0, np.uint64), np.empty(0, np.int64)     # sorted hashes, their units' numbers
        self.count = 0
        self.flat, self.used = np.empty(1 << 16, np.uint32), 0
        self.start, self.length = np.empty(1 << 12, np.int64), np.empty(1 << 12, np.int64)

    def _add(self, ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Remember units by their ids, which stand one after another; returns the units' numbers."""
        first, n = self.count, len(sizes)
        while self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate((self.flat, np.empty_like(self.flat)))
        while first + n > len(self.start):
            self.start = np.concatenate((self.start, np.empty_like(self.start)))
            self.length = np.concatenate((self.length, np.empty_like(self.length)))
        self.flat[self.used:self.used + len(ids)] = ids
        self.length[first:first + n] = sizes
        self.start[first:first + n] = self.used + np.cumsum(sizes) - sizes
        self.used += len(ids)
        self.count += n
        return np.arange(first, first + n)

    def _learn(self, hashes: np.ndarray, units: list[str]):
        """Letter runs go through the tokenizer as one text, cut at the ends of words; other units one by one."""
        number, rest = np.empty(len(units), np.int64), []
        for at in range(0, len(units), 2048):
            plain = []
            for i in range(at, min(at + 2048, len(units))):
                (plain if _PLAIN.fullmatch(units[i]) else rest).append(i)
            ids = np.array(self.tokenizer.encode(" ".join([units[i] for i in plain]), add_special_tokens=False).ids, np.uint32)
            ends = np.flatnonzero(self.ends_word[ids]) + 1 if len(ids) else np.empty(0, np.int64)
            if len(ends) == len(plain):
                number[plain] = self._add(ids, np.diff(ends, prepend=0))
            else:
                rest += plain
        for at in range(0, len(rest), 2048):
            some = rest[at:at + 2048]
            codes = [c.ids for c in self.tokenizer.encode_batch_fast([units[i] for i in some], add_special_tokens=False)]
            number[some] = self._add(np.array([x for c in codes for x in c], np.uint32),
                                     np.array([len(c) for c in codes], np.int64))
        place = np.searchsorted(self.keys, hashes)
        self.keys, self.slot = np.insert(self.keys, place, hashes), np.insert(self.slot, place, number)

    def _find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(self.keys):
            return np.zeros(len(hashes), np.int64), np.zeros(len(hashes), bool)
        at = np.minimum(np.searchsorted(self.keys, hashes), len(self.keys) - 1)
        return self.slot[at], self.keys[at] == hashes

    def _chunk(self, data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
        """Ids of each of some concatenated texts of about PIECE bytes together."""
        n = len(data)
        if not n:
            return [np.empty(0, np.uint32)] * (len(offsets) - 1)
        low = _LOWER[data]
        kind = _CLASS[low]
        fresh = np.zeros(n + 1, bool)
        fresh[offsets] = True
        solid = kind != _SPACE
        begins = np.ones(n, bool)
        begins[1:] = _CUT_FLAT[kind[:-1] * np.uint8(6) + kind[1:]]
        begins |= fresh[:n]
        begins &= solid
        ends = np.ones(n, bool)
        ends[:-1] = ~solid[1:] | begins[1:]
        ends &= solid
        start, last = np.flatnonzero(begins), np.flatnonzero(ends)
        if not len(start):
            return [np.empty(0, np.uint32)] * (len(offsets) - 1)
        up, down = _tables(n)
        total = np.empty(n + 1, np.uint64)
        total[0] = 0
        np.cumsum((low.astype(np.uint64) + np.uint64(1)) * up[:n], out=total[1:])
        hashes = mix((total[last + 1] - total[start]) * down[start]
                     + (last - start).astype(np.uint64) * np.uint64(0xA0761D6478BD642F))
        order = hashes.argsort()
        ranked = hashes[order]
        first = np.ones(len(ranked), bool)
        np.not_equal(ranked[1:], ranked[:-1], out=first[1:])
        known, at = ranked[first], order[first]
        where, found = self._find(known)
        if not found.all():
            if self.count and self.count + int((~found).sum()) > REMEMBERED:
                self.forget()
                found[:] = False
            raw, a, b = low.tobytes(), start[at].tolist(), (last[at] + 1).tolist()
            self._learn(known[~found], [raw[a[i]:b[i]].decode("utf-8", "replace") for i in np.flatnonzero(~found).tolist()])
            where, _ = self._find(known)
        unit = np.empty(len(order), np.int64)
        unit[order] = where[np.cumsum(first) - 1]
        size, begin = self.length[unit], self.start[unit]
        done = np.cumsum(size)
        ids = self.flat[np.repeat(begin - (done - size), size) + np.arange(done[-1])]
        before = np.concatenate(([0], done))
        return np.split(ids, before[np.searchsorted(start, offsets[1:-1])])

    def encode_texts(self, data: np.ndarray, offsets: np.ndarray):
        """Ids of ``data[offsets[i]:offsets[i + 1]]`` for each i, in order."""
        i, count = 0, len(offsets) - 1
        while i < count:
            j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + PIECE, side="right")) - 1)
            chunk = data[offsets[i]:offsets[j]]
            raw = chunk.tobytes()
            if any(s in raw for s in self.special):              # special tokens written out: the tokenizer decides
                for k in range(i, j):
                    text = data[offsets[k]:offsets[k + 1]].tobytes().decode("utf-8", "replace")
                    yield np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)
            elif j == i + 1 and len(chunk) > PIECE:
                yield np.concatenate(list(self._long(chunk)))
            else:
                yield from self._chunk(chunk, offsets[i:j + 1] - offsets[i])
            i = j

    def _long(self, data: np.ndarray):
        at = 0
        while at < len(data):
            end = at + PIECE
            while end < len(data):                               # to a white byte, so that no unit is cut
                gap = np.flatnonzero(_CLASS[data[end:end + PIECE]] == _SPACE)
                if len(gap):
                    end += int(gap[0])
                    break
                end += PIECE
            end = min(end, len(data))
            yield self._chunk(data[at:end], np.array([0, end - at]))[0]
            at = end


_ENCODERS: dict[str, UnitEncoder] = {}


def encoder(tokenizer_path: str) -> UnitEncoder:
    """The worker's encoder; it outlives tasks, as workers do."""
    if tokenizer_path not in _ENCODERS:
        _ENCODERS[tokenizer_path] = UnitEncoder(tokenizer_path)
    return _ENCODERS[tokenizer_path]

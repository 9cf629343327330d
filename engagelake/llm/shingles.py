"""Hashed word shingles and HyperMinHash sketches of texts (numpy, used inside Spark tasks).

A word's hash is a polynomial over its bytes (prefix sums modulo 2^64), mixed
afterwards; a shingle's hash mixes a linear form of five word hashes.  Texts
are taken whole; memory is bounded by working on pieces of ``PIECE`` bytes that
end at white space, so only 8 bytes per word are held for a very long text.
"""

from __future__ import annotations

import numpy as np

SHINGLE = 5
REGISTERS = 160
BAND_ROWS = 4
MANTISSA_BITS = 10
PIECE = 1 << 19
EMPTY = np.uint16(0xFFFF)
#: Sets up to SMALL shingles use one hash per register (classic MinHash); sets from LARGE on use one hash for all
#: registers.  LARGE <= 0.75 * SMALL, so two sets of similarity 3/4 or more always have one of the two in common.
SMALL, LARGE = 32, 24

_LOWER = np.array([c + 32 if 65 <= c <= 90 else c for c in range(256)], np.uint8)
_WORD = np.ones(256, bool)
_WORD[[32, 9, 10, 11, 12, 13]] = False
_BASE = 0x9E3779B97F4A7C15


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finalizer of 64-bit words."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out)


_FACTORS = mix(np.arange(11, 11 + SHINGLE, dtype=np.uint64) * np.uint64(_BASE)) | np.uint64(1)
_SEEDS = mix(np.arange(1, REGISTERS + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))
_PROBES = (mix(np.arange(64 * REGISTERS, dtype=np.uint64) + np.uint64(0x51ED27)) % np.uint64(REGISTERS)).astype(
    np.intp).reshape(64, REGISTERS)
_cache: dict[str, np.ndarray] = {}


def _tables(n: int):
    if len(_cache.get("up", ())) <= n:
        size = max(n + 1, PIECE + (PIECE >> 2))
        _cache["up"] = _powers(_BASE, size)
        _cache["down"] = _powers(pow(_BASE, -1, 1 << 64), size)
    return _cache["up"], _cache["down"]


def hash_words(data: np.ndarray, starts_of_texts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of concatenated texts, and for each text the index of its first word."""
    n = len(data)
    if not n:
        return np.empty(0, np.uint64), np.zeros(len(starts_of_texts), np.intp)
    data = _LOWER[data]
    inside = _WORD[data]
    fresh = np.zeros(n + 1, bool)
    fresh[starts_of_texts] = True
    before = np.concatenate(([False], inside[:-1])) & ~fresh[:n]
    after = np.concatenate((inside[1:], [False])) & ~fresh[1:]
    start, last = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after)
    up, down = _tables(n)
    total = np.empty(n + 1, np.uint64)
    total[0] = 0
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:n], out=total[1:])
    words = mix((total[last + 1] - total[start]) * down[start]
                + (last - start).astype(np.uint64) * np.uint64(0xA0761D6478BD642F))
    return words, np.searchsorted(start, starts_of_texts)


def _long_words(data: np.ndarray) -> np.ndarray:
    parts, at, zero = [], 0, np.zeros(1, np.intp)
    while at < len(data):
        end = min(len(data), at + PIECE)
        if end < len(data):
            gaps = np.flatnonzero(~_WORD[data[at:end]])
            while not len(gaps) and end < len(data):          # one word beyond the piece: take it whole
                step = min(len(data), end + PIECE)
                gaps, end = np.flatnonzero(~_WORD[data[end:step]]) + (end - at), step
            end = at + int(gaps[-1]) + 1 if len(gaps) else len(data)
        parts.append(hash_words(data[at:end], zero)[0])
        at = end
    return np.concatenate(parts) if parts else np.empty(0, np.uint64)


def _fold(words: np.ndarray, width: int) -> np.ndarray:
    n = len(words) - width + 1
    h = np.full(n, np.uint64(width) * np.uint64(0x2545F491))
    for k in range(width):
        h += words[k:k + n] * _FACTORS[k]
    return mix(h)


def shingle_sets(data: np.ndarray, offsets: np.ndarray):
    """Per text (``data[offsets[i]:offsets[i + 1]]``, UTF-8) the sorted distinct shingle hashes, in order."""
    i, count = 0, len(offsets) - 1
    while i < count:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + PIECE, side="right")) - 1)
        chunk = data[offsets[i]:offsets[j]]
        if j == i + 1 and len(chunk) > PIECE:
            words, first = _long_words(chunk), np.zeros(1, np.intp)
        else:
            words, first = hash_words(chunk, offsets[i:j] - offsets[i])
        ends = np.append(first[1:], len(words))
        full = _fold(words, SHINGLE) if len(words) >= SHINGLE else None
        for a, b in zip(first.tolist(), ends.tolist()):
            if b - a >= SHINGLE:
                s = np.sort(full[a:b - SHINGLE + 1])
                yield s[np.concatenate(([True], s[1:] != s[:-1]))]
            elif b > a:
                yield _fold(words[a:b], b - a)
            else:
                yield words[:0]
        i = j


def shingle_set(text: str | None) -> np.ndarray:
    """The set of one text."""
    raw = np.frombuffer((text or "").encode(), np.uint8)
    return next(shingle_sets(raw, np.array([0, len(raw)])))


def _compress(low: np.ndarray) -> np.ndarray:
    """Minima (64 bits) as leading zeros and the bits after the leading one."""
    low = low >> np.uint64(8)
    exp = np.frexp(low.astype(np.float64))[1].astype(np.int64)     # bit length, one too many after rounding up
    top = np.uint64(1) << np.clip(exp - 1, 0, 60).astype(np.uint64)
    exp = np.where((exp > 0) & (low < top), exp - 1, exp)
    shift = exp - 1 - MANTISSA_BITS
    body = np.where(shift >= 0, low >> np.maximum(shift, 0).astype(np.uint64),
                    low << np.clip(-shift, 0, 60).astype(np.uint64)) & np.uint64((1 << MANTISSA_BITS) - 1)
    zeros = np.minimum(56 - exp, 62).astype(np.uint16)
    return (zeros << np.uint16(MANTISSA_BITS)) | body.astype(np.uint16)


def small_sketches(sets: list[np.ndarray]) -> np.ndarray:
    """A row of registers per (non-empty) set, with one hash function per register."""
    low = np.empty((len(sets), REGISTERS), np.uint64)
    for i, shingles in enumerate(sets):
        low[i] = mix(shingles[:, None] ^ _SEEDS[None, :]).min(axis=0)
    return _compress(low)


def large_sketches(sets: list[np.ndarray]) -> np.ndarray:
    """A row of registers per set, by buckets of one hash; a bucket without a shingle holds EMPTY."""
    low = np.zeros((len(sets), REGISTERS), np.uint64)
    seen = np.zeros((len(sets), REGISTERS), bool)
    for i, shingles in enumerate(sets):
        h = np.sort(mix(shingles ^ np.uint64(0x2545F4914F6CDD1D)))
        bucket = (((h >> np.uint64(32)) * np.uint64(REGISTERS)) >> np.uint64(32)).astype(np.intp)    # grows with h
        first = np.flatnonzero(np.diff(bucket, prepend=-1))
        at = bucket[first]
        low[i, at] = h[first]
        seen[i, at] = True
    return np.where(seen, _compress(low * np.uint64(REGISTERS)), EMPTY)      # the place within the bucket


def filled(registers: np.ndarray) -> np.ndarray:
    """Empty registers take the value of a full one of their row, found by a fixed probe sequence (densification)."""
    out, turn = registers.copy(), 0
    row, col = np.nonzero(registers == EMPTY)
    while len(row):
        out[row, col] = registers[row, (_PROBES[turn % 64, col] + turn // 64) % REGISTERS]
        still = out[row, col] == EMPTY
        row, col, turn = row[still], col[still], turn + 1
    return out


def band_keys(registers: np.ndarray, scheme: int) -> np.ndarray:
    """Per row one signed 64-bit key for each band of BAND_ROWS registers; bands and schemes never share keys."""
    full = filled(registers).reshape(len(registers), -1, BAND_ROWS).astype(np.uint64)
    key = np.tile(np.arange(full.shape[1], dtype=np.uint64) * np.uint64(2) + np.uint64(scheme), (len(full), 1))
    for k in range(BAND_ROWS):
        key = mix(key * np.uint64(0xFF51AFD7ED558CCD) + full[:, :, k])
    return key.view(np.int64)


def collision_rate(n, m, large: bool) -> np.ndarray:
    """Chance that a full register agrees for two unrelated sets of n and m shingles."""
    scale = REGISTERS if large else 1
    a, b = np.asarray(n, float)[:, None] / scale, np.asarray(m, float)[:, None] / scale
    hi, lo = 2.0 ** -np.arange(0, 56)[None, :], 2.0 ** -np.arange(1, 57)[None, :]
    level = (np.exp(-a * lo) - np.exp(-a * hi)) * (np.exp(-b * lo) - np.exp(-b * hi))
    both = ((1 - np.exp(-a)) * (1 - np.exp(-b))).ravel()
    return level.sum(axis=1) / 2 ** MANTISSA_BITS / np.maximum(both, 1e-12)


def estimate(x: np.ndarray, y: np.ndarray, n, m, large: bool):
    """Collision-corrected Jaccard estimates for rows of registers, and how many registers counted."""
    ex, ey = x == EMPTY, y == EMPTY
    either = np.maximum((~(ex & ey)).sum(axis=1), 1)
    agree = ((x == y) & ~ex & ~ey).sum(axis=1) / either
    rate = collision_rate(n, m, large)
    return (agree - rate) / (1 - rate), either

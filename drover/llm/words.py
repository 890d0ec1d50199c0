"""Words of whole texts as arrays: places and 64-bit hashes, computed for a slice of
documents at once (no Python per word)."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import xxhash

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INV = np.uint64(pow(int(_BASE), -1, 1 << 64))
_powers: dict[str, np.ndarray] = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _random_table(seed: int) -> np.ndarray:
    t = np.random.default_rng(seed).integers(1, 2 ** 63, 256, dtype=np.uint64)
    return t * np.uint64(2) + np.uint64(1)


def separators_table(separators: bytes) -> np.ndarray:
    """Byte values for hashing (1 to 256); zero at the bytes that separate words."""
    t = np.arange(1, 257, dtype=np.uint64)
    t[list(separators)] = 0
    return t


#: Words ``[^\\x20\\x09-\\x0D]+``.
PLAIN = separators_table(b"\x20\x09\x0a\x0b\x0c\x0d")
#: Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z (upper case hashes as lower).
ALNUM = separators_table(bytes([*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]))
ALNUM[0x41:0x5B] = ALNUM[0x61:0x7B]
#: Every byte counts (byte strings rather than words).
BYTES = _random_table(11)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n (kept per process)."""
    if len(_powers["up"]) < n:
        for k, b in (("up", _BASE), ("down", _INV)):
            p = np.full(n, b, np.uint64)
            p[0] = 1
            _powers[k] = np.cumprod(p)
    return _powers["up"][:n], _powers["down"][:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser: spreads every input bit over the 64 bits."""
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


def prefix_hash(values: np.ndarray) -> np.ndarray:
    """Running polynomial sums with a leading zero; see :func:`range_hash`."""
    up, _ = powers(len(values) + 1)
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[:len(values)], out=out[1:])
    return out


def range_hash(prefix: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Hash of the bytes [lo, hi) of each range, independent of where it lies."""
    _, down = powers(len(prefix))
    return mix((prefix[hi] - prefix[lo]) * down[lo])


# ------------------------------------------------------------------ word hashes
#: Words are hashed by a polynomial modulo this prime (2**61 - 1): unlike one modulo 2**64,
#: no two words collide for every base.
PRIME = np.uint64((1 << 61) - 1)
_SHIFT = np.uint64(61)
_ROOT = 0x1B4D5F2A90C3E785 % int(PRIME)
_places: dict[str, np.ndarray] = {}
#: Texts are worked on in pieces of about this many bytes, cut between words.
PIECE = 4 << 20
#: Longer words than this (bytes) are hashed whole: their sums could exceed 64 bits.
LONG_WORD = 1 << 24


def _fold(x: np.ndarray) -> np.ndarray:
    x = (x & PRIME) + (x >> _SHIFT)
    return np.where(x >= PRIME, x - PRIME, x)


def times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a * b modulo PRIME, for numbers below it."""
    half, low = np.uint64(32), np.uint64(0xFFFFFFFF)
    ah, al, bh, bl = a >> half, a & low, b >> half, b & low
    mid, lo = ah * bl + al * bh, al * bl
    return _fold(((ah * bh) << np.uint64(3)) + (mid >> np.uint64(29)) + ((mid & np.uint64((1 << 29) - 1)) << half)
                 + (lo & PRIME) + (lo >> _SHIFT))


def places(n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For i < n: the low 31 and the high bits of root**i, and root**-i, modulo PRIME."""
    n = max(n, 1)
    if len(_places.get("low", ())) < n:
        up, down = (_powers_mod(b, n) for b in (_ROOT, pow(_ROOT, -1, int(PRIME))))
        _places.update(low=up & np.uint64((1 << 31) - 1), high=up >> np.uint64(31), down=down)
    return _places["low"][:n], _places["high"][:n], _places["down"][:n]


def _powers_mod(base: int, n: int) -> np.ndarray:
    out = np.ones(1, np.uint64)
    while len(out) < n:
        out = np.concatenate((out, times(out, np.full(len(out), pow(base, len(out), int(PRIME)), np.uint64))))
    return out[:n]


def _word_hashes(v: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
    """Hash of the values v[s[i]:e[i]] of each word, independent of where it lies."""
    low, high, down = places(len(v))
    sums = [np.concatenate((np.zeros(1, np.uint64), np.cumsum(v * w))) for w in (low, high)]
    # differences of wrapped sums are exact while a word is no longer than LONG_WORD
    lo, hi = (x[e] - x[s] for x in sums)
    hi = _fold(hi)
    h = _fold(_fold(lo) + (((hi << np.uint64(31)) & PRIME) | (hi >> np.uint64(30))))
    h = mix(times(h, down[s]))
    for k in np.flatnonzero(e - s > LONG_WORD):
        h[k] = xxhash.xxh3_64_intdigest(v[s[k]:e[k]].astype(np.uint16).tobytes())
    return h


def _word_checks(v: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
    """32 bits from the length and the outer letters of each word, apart from its hash."""
    inner = np.minimum(s + 1, e - 1)
    x = (e - s).astype(np.uint64)
    for y in (v[s], v[inner], v[e - 1], v[np.maximum(e - 2, s)]):
        x = x * np.uint64(0x100000001B3) + y
    return (mix(x) >> np.uint64(32)).astype(np.uint32)


@dataclass
class Words:
    start: np.ndarray   # first byte of each word in the slice
    end: np.ndarray     # one past its last byte
    hash: np.ndarray    # uint64
    check: np.ndarray   # uint32, further bits that equal words share
    first: np.ndarray   # per document: index of its first word; one more entry at the end

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def docs(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)


def words_of(data: np.ndarray, off: np.ndarray, values: np.ndarray) -> Words:
    """Words of the documents whose bytes are data[off[i]:off[i+1]]."""
    parts, at, n = [], 0, len(data)
    while at < n or not parts:
        end = n
        if n - at > PIECE:      # cut at a separator, in a piece of its own length at most
            end = at + PIECE
            while end < n:
                gap = np.flatnonzero(values[data[end:end + PIECE]] == 0)
                if len(gap):
                    end += int(gap[0])
                    break
                end = min(n, end + PIECE)
        v = values[data[at:end]]
        inside = v != 0
        start = inside.copy()
        start[1:] &= ~inside[:-1]
        stop = np.zeros(len(v) + 1, bool)
        stop[1:] = inside
        stop[1:-1] &= ~inside[1:]
        edge = off[(off > at) & (off < end)] - at
        start[edge] = inside[edge]
        stop[edge] = inside[edge - 1]
        s, e = np.flatnonzero(start), np.flatnonzero(stop)
        parts.append((s + at, e + at, _word_hashes(v, s, e), _word_checks(v, s, e) if len(s) else np.zeros(0, np.uint32)))
        at = end
    s, e, h, c = (np.concatenate(x) if len(parts) > 1 else x[0] for x in zip(*parts, strict=True))
    return Words(s, e, h, c, np.searchsorted(s, off))


def window_hash(h: np.ndarray, at: np.ndarray, k: int) -> np.ndarray:
    """Hash of the ``k`` consecutive words that begin at each word index of ``at``."""
    out = np.zeros(len(at), np.uint64)
    for j in range(k):
        out = out * np.uint64(0xD6E8FEB86659FD93) + h[at + j]
    return mix(out)


def window_check(w: Words, at: np.ndarray, k: int) -> np.ndarray:
    """32 further bits (int32) of the same words, by another polynomial and the words' checks."""
    out = np.zeros(len(at), np.uint64)
    for j in range(k):
        out = out * np.uint64(0xA0761D6478BD642F) + (w.hash[at + j] ^ (w.check[at + j].astype(np.uint64) << np.uint64(17)))
    return (mix(out) >> np.uint64(32)).astype(np.uint32).view(np.int32)


def in_spans(spans: np.ndarray, n: int) -> np.ndarray:
    """Boolean array of length n: true inside any [start, end) row of ``spans``."""
    d = np.zeros(n + 1, np.int64)
    if len(spans):
        lo, hi = np.clip(spans[:, 0], 0, n), np.clip(spans[:, 1], 0, n)
        np.add.at(d, lo, 1)
        np.add.at(d, hi, -1)
    return np.cumsum(d[:n]) > 0


def runs(mask: np.ndarray) -> np.ndarray:
    """[start, end) rows of the maximal runs of true values."""
    d = np.diff(np.concatenate(([0], mask.astype(np.int8), [0])))
    return np.stack([np.flatnonzero(d == 1), np.flatnonzero(d == -1)], axis=1)


def merge_spans(spans: np.ndarray) -> np.ndarray:
    """Union of [start, end) rows, sorted; touching rows merge."""
    if not len(spans):
        return spans.reshape(0, 2)
    s = spans[np.lexsort((spans[:, 1], spans[:, 0]))]
    reach = np.maximum.accumulate(s[:, 1])
    new = np.concatenate(([True], s[1:, 0] > reach[:-1]))
    lo = s[new, 0]
    hi = reach[np.concatenate((np.flatnonzero(new)[1:] - 1, [len(s) - 1]))]
    return np.stack([lo, hi], axis=1)

"""Word shingles as 64-bit hashes, computed on whole texts with numpy.

A text is lower-cased (A-Z), its words are runs of anything but the six ASCII
blanks; the hash of a word is a polynomial over its bytes (random 64-bit value
per byte), the hash of a shingle combines those of its words in order. Both
pass through a full 64-bit finalizer. A text is hashed ``PIECE`` bytes at a
time; the sum and the power of a word that a piece does not end are carried
into the next one, so a word of any length is one word.
"""

from __future__ import annotations

import zlib

import numpy as np

U = np.uint64
MASK = (1 << 64) - 1
# Odd 64-bit multipliers.
GOLDEN = 0x9E3779B97F4A7C15
MIX_1 = 0xBF58476D1CE4E5B9
MIX_2 = 0x94D049BB133111EB

_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_BYTE = np.random.default_rng(20240501).integers(0, 1 << 64, 256, dtype=np.uint64)
#: One odd multiplier per place in a shingle.
_PLACE = np.random.default_rng(20240502).integers(0, 1 << 64, 16, dtype=np.uint64) | U(1)
PIECE = 1 << 20  # bytes hashed at a time


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(30))) * U(MIX_1)
    x = (x ^ (x >> U(27))) * U(MIX_2)
    return x ^ (x >> U(31))


def _powers(base: int, n: int) -> np.ndarray:
    p = np.full(n, base, np.uint64)
    p[0] = 1
    return np.cumprod(p, dtype=np.uint64)


_POW: list[np.ndarray] = []


def _tables() -> list[np.ndarray]:
    if not _POW:
        _POW.extend([_powers(GOLDEN, PIECE + 1), _powers(pow(GOLDEN, -1, 1 << 64), PIECE + 1)])
    return _POW


def word_hashes(text: str) -> np.ndarray:
    """uint64 hash of every word, in order."""
    data = text.encode().lower()
    out = []
    at = total = length = 0  # of the unfinished word: polynomial sum, bytes
    power = 1                # and GOLDEN to the length
    while at < len(data):
        end = min(len(data), at + PIECE)
        b = np.frombuffer(data, np.uint8, end - at, at)
        if end < len(data):  # cut at a blank; without one the piece is the middle of a word
            blanks = np.flatnonzero(_BLANK[b])
            if not len(blanks):
                up = _tables()[0]
                total = (total + int(np.sum(_BYTE[b] * up[:len(b)], dtype=np.uint64)) * power) & MASK
                power = power * int(up[len(b)]) & MASK
                length += len(b)
                at = end
                continue
            b = b[:int(blanks[-1]) + 1]
        out.append(_hash_piece(b, total, power, length))
        at += len(b)
        total, power, length = 0, 1, 0
    return np.concatenate(out) if out else np.empty(0, np.uint64)


def _hash_piece(b: np.ndarray, total: int, power: int, length: int) -> np.ndarray:
    """Hashes of the words of a piece, after an unfinished word of ``length`` bytes."""
    up, down = _tables()
    edge = np.diff(np.concatenate(([True], _BLANK[b], [True])).astype(np.int8))
    start, stop = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    run = np.zeros(len(b) + 1, np.uint64)
    np.cumsum(_BYTE[b] * up[:len(b)], dtype=np.uint64, out=run[1:])
    sums, size = (run[stop] - run[start]) * down[start], (stop - start).astype(np.uint64)
    if length:
        if _BLANK[b[0]]:  # the word ended with the last piece
            sums, size = np.concatenate(([U(0)], sums)), np.concatenate(([U(0)], size))
        sums[0] = (int(sums[0]) * power + total) & MASK
        size[0] += U(length)
    return mix(sums + size)


def shingle_set(text: str | None, k: int = 5) -> np.ndarray:
    """Sorted distinct uint64 hashes of the k-word shingles of a text; fewer
    words: the whole sequence as one; none: empty."""
    w = word_hashes(text) if text else np.empty(0, np.uint64)
    if not len(w):
        return w
    size = min(k, len(w))
    n = len(w) - size + 1
    h = np.full(n, size, np.uint64)
    for i in range(size):
        h += w[i:i + n] * _PLACE[i]
    h = np.sort(mix(h))
    return h[np.concatenate(([True], h[1:] != h[:-1]))]


def sketch(s: np.ndarray) -> bytes:
    """How many of a set's hashes fall into each of B equal ranges, one byte each;
    B is a power of two, 2 to 4 hashes a range on average. Empty if a range holds
    over 255."""
    bits = max(4, len(s).bit_length() - 2)
    counts = np.bincount((s >> U(64 - bits)).astype(np.int64), minlength=1 << bits)
    return counts.astype(np.uint8).tobytes() if counts.max() < 256 else b""


def overlap_bound(a: np.ndarray, b: np.ndarray) -> int | None:
    """The most hashes that two sets with these sketches can share; None: unknown."""
    if not len(a) or not len(b):
        return None
    if len(a) > len(b):
        a, b = b, a
    folded = b.reshape(len(a), -1).sum(1, dtype=np.int64) if len(b) > len(a) else b
    return int(np.minimum(a, folded).sum(dtype=np.int64))


def pack_sketch(counts: bytes) -> bytes:
    """A sketch as it is moved: two ranges a byte, after a 4, if none holds over 15;
    else one, after an 8."""
    c = np.frombuffer(counts, np.uint8)
    if not len(c):
        return b""
    return b"\x04" + (c[::2] << 4 | c[1::2]).tobytes() if c.max() < 16 else b"\x08" + counts


def unpack_sketch(data) -> np.ndarray:
    """The counts of a packed sketch."""
    c = np.frombuffer(data, np.uint8)
    if not len(c) or c[0] == 8:
        return c[1:]
    return np.stack((c[1:] >> 4, c[1:] & 15), axis=1).ravel()


def pack_set(text: str, s: np.ndarray) -> bytes:
    """What a set is moved as: its text, compressed, or its hashes (which nothing
    compresses), whichever is shorter."""
    z = zlib.compress(text.encode(), 1)
    return b"t" + z if len(z) < s.nbytes else b"s" + s.tobytes()


def unpack_set(data, k: int = 5) -> np.ndarray:
    """The shingle set of ``pack_set``."""
    data = memoryview(data)
    if data[0] == ord("t"):
        return shingle_set(zlib.decompress(data[1:]).decode(), k)
    return np.frombuffer(data, np.uint64, offset=1)

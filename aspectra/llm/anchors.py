"""Content-defined anchors: every string of a fixed length belongs to one anchor inside it.

The anchor of a string is the leftmost of its k-grams with the smallest hash, so equal strings
have equal anchors at equal offsets, wherever they stand. Strings that follow each other mostly
share an anchor: a run of them is a segment.
"""
from __future__ import annotations

import numpy as np

#: Bytes of an anchor's k-gram.
GRAM = 32
_POSITION_BITS = 24
#: Bytes hashed at a time.
CHUNK = 1 << 19

_rng = np.random.default_rng(20240229)
_TABLES = _rng.integers(0, 1 << 63, (2, 256), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASES = [int(x) | 1 for x in _rng.integers(1 << 60, 1 << 63, 2, dtype=np.uint64)]


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(n, np.uint64)
    out[1:] = np.uint64(base)
    return np.multiply.accumulate(out)


_POWERS = [_powers(b, CHUNK + 4096) for b in _BASES]
_INVERSES = [_powers(pow(b, -1, 1 << 64), CHUNK + 4096) for b in _BASES]


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def _sums(data: np.ndarray, which: int) -> np.ndarray:
    """Prefix sums of table[byte] * base**place."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_TABLES[which][data] * _POWERS[which][: len(data)], out=out[1:])
    return out


def _sliding_min(v: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` values in a row, from running minima of blocks."""
    n = len(v)
    blocks = -(-n // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = v
    grid = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(grid, axis=1).reshape(-1)
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


def segments(data: np.ndarray, offs: np.ndarray, length: int, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """Segments of the strings of ``length`` bytes in the texts ``data[offs[i]:offs[i+1]]``.

    (start, count, gram hash, segment hash): ``count`` strings start at ``start`` and the bytes
    after it; the gram hash names the anchor, the segment hash all bytes of the segment and the
    anchor's place in it. Starts count over the whole of ``data``; no string crosses texts.
    """
    parts = []
    step = CHUNK - length + 1
    for a in range(0, max(0, len(data) - length + 1), step):
        piece = data[a : a + CHUNK]
        if len(piece) < length:
            break
        parts.append(_chunk_segments(piece, a, offs, length, gram))
    if not parts:
        z = np.zeros(0, np.int64)
        return z, z, z.astype(np.uint64), z.astype(np.uint64)
    return tuple(np.concatenate(p) for p in zip(*parts))


def _chunk_segments(piece: np.ndarray, a: int, offs: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    sums, sums2 = _sums(piece, 0), _sums(piece, 1)
    inv, inv2 = _INVERSES
    n = len(piece) - gram + 1
    h = mix((sums[gram:] - sums[:-gram]) * inv[:n])
    low = np.uint64((1 << _POSITION_BITS) - 1)
    at = np.arange(n, dtype=np.uint64)
    best = _sliding_min((h & ~low) | at, length - gram + 1) & low  # leftmost on equal upper bits
    strings = len(piece) - length + 1
    best = best[:strings].astype(np.int64)
    inside = np.zeros(strings + 1, np.int8)
    lo, hi = np.searchsorted(offs, a, "right") - 1, np.searchsorted(offs, a + len(piece), "left")
    first = np.maximum(offs[lo:hi] - a, 0)
    last = np.minimum(offs[lo + 1 : hi + 1] - a - length + 1, strings)
    ok = last > first
    np.add.at(inside, first[ok], 1)
    np.add.at(inside, last[ok], -1)
    valid = np.cumsum(inside[:-1]) > 0
    edge = np.ones(strings, bool)
    edge[1:] = (best[1:] != best[:-1]) | ~valid[:-1]
    edge[first[ok]] = True
    start = np.flatnonzero(edge & valid)
    stop = np.flatnonzero(np.append(edge[1:] | ~valid[1:], True) & valid) + 1
    gram_hash = mix(h[best[start]])
    body = mix((sums2[stop - 1 + length] - sums2[start]) * inv2[start])
    offset = (best[start] - start).astype(np.uint64)
    size = (stop - start).astype(np.uint64)
    return start + a, stop - start, gram_hash, mix(body + (offset << np.uint64(32)) + size)


def anchor_offsets(data: np.ndarray, start: np.ndarray, length: int, gram: int = GRAM, step: int = 4096) -> np.ndarray:
    """How many bytes after ``start`` the anchor stands of the string of ``length`` bytes that starts there."""
    out = np.empty(len(start), np.int64)
    n, low = length - gram + 1, np.uint64((1 << _POSITION_BITS) - 1)
    for a in range(0, len(start), step):
        rows = data[start[a : a + step, None] + np.arange(length)]
        sums = np.zeros((len(rows), length + 1), np.uint64)
        np.cumsum(_TABLES[0][rows] * _POWERS[0][:length], axis=1, out=sums[:, 1:])
        h = mix((sums[:, gram:] - sums[:, :-gram]) * _INVERSES[0][:n])
        out[a : a + step] = (h & ~low).argmin(axis=1)  # leftmost on equal upper bits
    return out


def range_hashes(data: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """A hash of the bytes from ``start`` to ``stop`` of each range, whatever its place; all have one length."""
    out = np.zeros(len(start), np.uint64)
    width = int((stop - start).max()) if len(start) else 0
    for k in range(width):  # by columns, so that no copy of all ranges is held
        out += _TABLES[1][data[start + k]] * _POWERS[1][k]
    return mix(out)

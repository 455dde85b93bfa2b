"""Word shingles of many texts at a time, as 64-bit hashes, in numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

SHINGLE = 5
BATCH_BYTES = 1 << 20
_RNG = np.random.default_rng(5)
_BYTE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_PLACE = _RNG.integers(1, 1 << 63, SHINGLE, dtype=np.uint64) | np.uint64(1)
_LENGTH = _RNG.integers(1, 1 << 63, SHINGLE + 1, dtype=np.uint64)
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, modulo 2^64."""
    size = BATCH_BYTES + (1 << 10) if n <= BATCH_BYTES + (1 << 10) else 1 << (n - 1).bit_length()
    if size not in _powers:
        _powers.clear()
        out = []
        for x in (_BASE, _INVERSE):
            p = np.full(size + 1, x, np.uint64)
            p[0] = 1
            out.append(np.multiply.accumulate(p))
        _powers[size] = (out[0], out[1])
    return _powers[size]


def mix(h: np.ndarray) -> np.ndarray:
    """A finaliser that spreads every bit."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def word_hashes(texts: list[bytes], spans: bool = False) -> tuple[np.ndarray, ...]:
    """Hash of every word (ASCII lower case), and the text it is in; with
    ``spans`` also all bytes (blanks made spaces), and where words start and end."""
    joined = b"\n".join(texts).lower() + b"\n"
    buf = np.frombuffer(joined, np.uint8)
    blank = _BLANK[buf]
    edge = np.diff(np.concatenate(([True], blank)).astype(np.int8))
    start, end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    up, down = _power(len(buf) + 1)
    total = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum(_BYTE[buf] * up[:len(buf)], out=total[1:])
    h = mix((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64))
    bounds = np.cumsum([len(t) + 1 for t in texts])
    doc = np.searchsorted(bounds, start, side="right")
    return (h, doc, np.where(blank, np.uint8(32), buf), start, end) if spans else (h, doc)


def _of_batch(texts: list[bytes]) -> list[np.ndarray]:
    h, doc = word_hashes(texts)
    ends = np.searchsorted(doc, np.arange(len(texts)), side="right")
    n = len(h)
    grams = np.zeros(max(0, n - SHINGLE + 1), np.uint64)
    for k in range(SHINGLE if n >= SHINGLE else 0):
        grams += h[k:n - SHINGLE + 1 + k] * _PLACE[k]
    grams = mix(grams + _LENGTH[SHINGLE])
    out, a = [], 0
    for b in ends.tolist():
        k = b - a
        if k >= SHINGLE:
            out.append(np.unique(grams[a:b - SHINGLE + 1]))
        elif k:
            out.append(mix((h[a:b] * _PLACE[:k]).sum(keepdims=True) + _LENGTH[k]))
        else:
            out.append(np.zeros(0, np.uint64))
        a = b
    return out


def shingle_sets(texts: Iterator[str | None]) -> list[np.ndarray]:
    """Sorted distinct hashes of the five-word shingles of every text; with
    fewer words, of the whole sequence; without words or text, none."""
    out: list[np.ndarray] = []
    batch: list[bytes] = []
    size = 0
    for t in texts:
        raw = t.encode("utf-8", "replace") if t else b""
        if batch and size + len(raw) > BATCH_BYTES:
            out += _of_batch(batch)
            batch, size = [], 0
        batch.append(raw)
        size += len(raw) + 1
    if batch:
        out += _of_batch(batch)
    return out

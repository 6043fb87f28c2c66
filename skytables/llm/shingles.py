"""Word and shingle hashes of many texts at once, for use inside tasks."""

from __future__ import annotations

import hashlib

import numpy as np

_SPACES = np.zeros(256, bool)
_SPACES[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_rng = np.random.default_rng(20)
_BYTE = _rng.integers(1 << 63, size=256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLACE = _rng.integers(1 << 63, size=1 << 12, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FOLD = _rng.integers(1 << 63, size=64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PIECE = 1 << 20


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _piece_hashes(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, start and end of every word of a piece that begins and ends between words."""
    space = _SPACES[raw]
    edge = np.flatnonzero(np.diff(np.concatenate(([True], space, [True])).view(np.int8)))
    start, end = edge[::2], edge[1::2]
    if not len(start):
        return np.zeros(0, np.uint64), start, end
    length = end - start
    first = np.cumsum(length) - length
    letters = raw[~space]
    place = np.arange(len(letters)) - np.repeat(first, length)
    value = _BYTE[_LOWER[letters]] * _PLACE[place & 4095] + (place >> 12).astype(np.uint64)
    return mixed(np.add.reduceat(value, first) + length.astype(np.uint64)), start, end


def _words(blob: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    found, at = [(np.zeros(0, np.uint64), np.zeros(0, int), np.zeros(0, int))], 0
    while at < len(blob):
        stop = min(at + _PIECE, len(blob))
        while stop < len(blob) and not _SPACES[blob[stop - 1]]:
            more = np.flatnonzero(_SPACES[blob[stop : stop + _PIECE]])
            stop = stop + int(more[0]) + 1 if len(more) else min(stop + _PIECE, len(blob))
        h, start, end = _piece_hashes(blob[at:stop])
        found.append((h, start + at, end + at))
        at = stop
    return tuple(np.concatenate(column) for column in zip(*found))


def word_hashes(texts: list[str | None], lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of all texts in order, and for each text the index behind its last word.

    Words are runs of bytes other than space and 0x09-0x0D; A-Z count as a-z. NULL has none. Work memory follows the piece
    size, whatever the length of a text.
    """
    coded = [(t or "").encode("utf-8", "replace") for t in texts]
    ends = np.cumsum([len(c) + 1 for c in coded]) if coded else np.zeros(0, int)
    hashes, starts, _ = _words(np.frombuffer(b"\n".join(coded) + b"\n", np.uint8))
    return hashes, np.searchsorted(starts, ends)


def word_spans(text: str | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, start and end (code points) of each word of a text."""
    blob = np.frombuffer((text or "").encode("utf-8", "replace"), np.uint8)
    hashes, starts, ends = _words(blob)
    if len(blob) != len(text or ""):
        before = np.concatenate(([0], np.cumsum((blob & 0xC0) != 0x80, dtype=np.int64)))
        starts, ends = before[starts], before[ends]
    return hashes, starts, ends


def rolling(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` words."""
    flat = np.zeros(max(len(words) - size + 1, 0), np.uint64)
    for i in range(size if len(flat) else 0):
        flat += words[i : i + len(flat)] * _FOLD[i]
    return mixed(flat)


def sets_of_words(words: np.ndarray, ends: np.ndarray, size: int, least: int = 0) -> list[np.ndarray]:
    """As :func:`shingle_sets`, from :func:`word_hashes`; texts of fewer than ``least`` words are left out."""
    flat = rolling(words, size)
    out, begin = [], 0
    for end in ends.tolist():
        n = end - begin
        if n < least:
            pass
        elif n >= size:
            out.append(np.unique(flat[begin : end - size + 1]))
        elif n:
            out.append(mixed((words[begin:end] * _FOLD[32 : 32 + n]).sum(keepdims=True) + _FOLD[63 - n : 64 - n]))
        else:
            out.append(np.zeros(0, np.uint64))
        begin = end
    return out


def shingle_sets(texts: list[str | None], size: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; a text with fewer words than ``size`` has its whole sequence as one."""
    return sets_of_words(*word_hashes(texts), size)


def digest(items: np.ndarray) -> bytes:
    return hashlib.blake2b(items.tobytes(), digest_size=16).digest()


def _random_functions(coordinates: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    a = rng.integers(1 << 63, size=coordinates, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return a, rng.integers(1 << 63, size=coordinates, dtype=np.uint64)


def minhash(items: np.ndarray, coordinates: int, seed: int = 1) -> np.ndarray:
    """Signature of a set: for each coordinate the least value of its own random function of the members."""
    a, b = (x[:, None] for x in _random_functions(coordinates, seed))
    least = np.full(coordinates, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(items), 1024):
        np.minimum(least, (a * items[None, at : at + 1024] + b).min(axis=1), out=least)
    return (mixed(least) >> np.uint64(32)).astype(np.uint32)


def minhashes(sets: list[np.ndarray], coordinates: int, seed: int = 1) -> np.ndarray:
    """:func:`minhash` of many sets that are not empty, one row each: a coordinate of all of them at a time."""
    least = np.empty((coordinates, len(sets)), np.uint64)
    if sets:
        flat = np.concatenate(sets)
        begins = np.cumsum([0, *(len(s) for s in sets[:-1])])
        values = np.empty_like(flat)
        for row, a, b in zip(least, *_random_functions(coordinates, seed)):
            np.multiply(flat, a, out=values)
            values += b
            np.minimum.reduceat(values, begins, out=row)
    return (mixed(least) >> np.uint64(32)).astype(np.uint32).T


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted sets."""
    return len(np.intersect1d(a, b, assume_unique=True))

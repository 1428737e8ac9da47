"""Words of many texts at once, as 64-bit hashes in NumPy arrays.

A word is a run of bytes other than space and TAB to CR (the same cut as the
pattern ``[^\\x20\\x09-\\x0D]+`` on characters, since those are ASCII). Whole
texts are read; long ones go through in pieces cut at white space, so the
scratch arrays stay small whatever the length.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np

U64 = np.uint64
_PIECE = 1 << 20  # bytes hashed at once
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BASE = 0x9E3779B97F4A7C15


def _powers(base: int, n: int) -> np.ndarray:
    out, x = np.empty(n, dtype=U64), 1
    for i in range(n):
        out[i] = x
        x = x * base & 0xFFFFFFFFFFFFFFFF
    return out


_NEAR = _powers(_BASE, 1 << 12)  # powers for a place inside a word: low 12 bits, then the rest
_FAR = _powers(pow(_BASE, 1 << 12, 1 << 64), 1 << 12)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    h = h ^ (h >> U64(33))
    h = h * U64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> U64(29))
    h = h * U64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> U64(32))


def _hash_piece(raw: np.ndarray, fold: bool) -> tuple[np.ndarray, np.ndarray]:
    """Starts and hashes of the words of one buffer."""
    space = _SPACE[raw]
    before = np.empty_like(space)
    if len(space):
        before[0] = True
        before[1:] = space[:-1]
    starts = np.flatnonzero(before & ~space)
    if not len(starts):
        return starts, np.empty(0, dtype=U64)
    at = np.arange(len(raw), dtype=np.int32)
    first = np.zeros(len(raw), dtype=np.int32)
    first[starts] = starts
    place = at - np.maximum.accumulate(first)
    power = _NEAR[place & 0xFFF]
    if place.max() > 0xFFF:
        power = power * _FAR[(place >> 12) & 0xFFF] * (U64(2) * (place >> 24).astype(U64) + U64(1))
    value = (_FOLD[raw] if fold else raw).astype(U64) + U64(1)
    value *= power
    value[space] = 0
    return starts, mix(np.add.reduceat(value, starts))


def _cuts(raw: np.ndarray) -> Iterator[np.ndarray]:
    """A long buffer in pieces that end at white space."""
    at = 0
    while at < len(raw):
        end = min(len(raw), at + _PIECE)
        if end < len(raw):
            inside = np.flatnonzero(_SPACE[raw[at:end]])
            if len(inside):
                end = at + int(inside[-1]) + 1
            else:  # one very long word: up to its end
                while end < len(raw) and not _SPACE[raw[end]]:
                    end += 1
        yield raw[at:end]
        at = end


def word_hashes(texts: Sequence[str | None], fold: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in order, and how many each text has.

    ``fold`` lower-cases A-Z. A null text has no words.
    """
    counts = np.zeros(len(texts), dtype=np.int64)
    found: list[np.ndarray] = []
    group: list[bytes] = []
    ids: list[int] = []
    size = 0

    def flush() -> None:
        nonlocal size
        if not group:
            return
        raw = np.frombuffer(b" ".join(group), dtype=np.uint8)
        begins = np.concatenate(([0], np.cumsum([len(b) + 1 for b in group])))
        starts, hashes = _hash_piece(raw, fold)
        counts[ids] = np.diff(np.searchsorted(starts, begins))
        found.append(hashes)
        group.clear()
        ids.clear()
        size = 0

    for i, text in enumerate(texts):
        blob = (text or "").encode("utf-8", "surrogatepass")
        if len(blob) > _PIECE:
            flush()
            for piece in _cuts(np.frombuffer(blob, dtype=np.uint8)):
                _, hashes = _hash_piece(piece, fold)
                counts[i] += len(hashes)
                found.append(hashes)
            continue
        if size + len(blob) > _PIECE:
            flush()
        group.append(blob)
        ids.append(i)
        size += len(blob) + 1
    flush()
    return (np.concatenate(found) if found else np.empty(0, dtype=U64)), counts


def shingle_sets(texts: Sequence[str | None], width: int) -> list[np.ndarray]:
    """The distinct ``width``-word shingles of each text, sorted, as hashes.

    A text with fewer words has its whole sequence as one shingle; one without
    words has none.
    """
    words, counts = word_hashes(texts)
    n, k = len(words), width
    rolled = words[: max(0, n - k + 1)].copy()
    for j in range(1, k):
        rolled = rolled * U64(0xD6E8FEB86659FD93) + words[j : n - k + 1 + j]
    rolled = mix(rolled + U64(k))
    out, at = [], 0
    for c in counts:
        if c >= k:
            out.append(np.unique(rolled[at : at + c - k + 1]))
        elif c:
            h = np.zeros(1, dtype=U64)
            for w in words[at : at + c]:
                h = h * U64(0xD6E8FEB86659FD93) + w
            out.append(mix(h + U64(c)))
        else:
            out.append(np.empty(0, dtype=U64))
        at += c
    return out

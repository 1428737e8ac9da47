"""Repeated strings of a fixed length among short strings, by merging transforms.

Strings are taken as rotations of themselves with a mark at the end. Each
shard of strings is suffix-sorted on its own and kept as a Burrows-Wheeler
transform over ``STEP``-byte symbols: for each suffix in order, the symbol
before it and the place of the suffix that starts there. The shards' orders
are then interleaved by refinement: from the order of all suffixes by their
first h bytes, the order by h + ``STEP`` follows by dealing each suffix's
predecessor, stably, by its symbol. Nothing is sorted by its text again. Two
neighbours stay in one interval while symbol and earlier interval agree, so
intervals are the suffixes that share a prefix of h bytes; those left with one
suffix are dropped on the way, as all their predecessors will be alone too.
"""

from __future__ import annotations

import numpy as np

STEP = 40
_SHARD = 1 << 18  # bytes of a shard


def _rotations(strings: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of all strings, each followed by STEP marks; start and size of each place's own string."""
    sizes = np.array([len(s) + STEP for s in strings], dtype=np.int64)
    starts = np.cumsum(sizes) - sizes
    raw = np.frombuffer((b"\0" * STEP).join(strings) + b"\0" * STEP, dtype=np.uint8).astype(np.int64) + 1
    raw[(starts + sizes - STEP)[:, None] + np.arange(STEP)] = 0
    return raw, np.repeat(starts, sizes), np.repeat(sizes, sizes)


def _symbols(raw: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The STEP bytes from each place on as their rank among all such."""
    place = np.arange(len(raw)) - start

    def then(first: np.ndarray, second: np.ndarray, width: int) -> np.ndarray:
        """Ranks of what ``first`` ranks followed, ``width`` bytes on, by what ``second`` ranks."""
        return np.unique(first * (second.max(initial=0) + 1) + second[start + (place + width) % size], return_inverse=True)[1]

    six = np.zeros(len(raw), dtype=np.int64)
    for j in range(6):  # nine bits a byte: the mark is a letter of its own
        six = (six << 9) | raw[start + (place + j) % size]
    six = np.unique(six, return_inverse=True)[1]
    twelve = then(six, six, 6)
    twenty_four = then(twelve, twelve, 12)
    thirty_six = then(twenty_four, twelve, 24)
    return then(thirty_six, six, 34)  # 34 to 39 overlap by two


def _suffix_order(symbol: np.ndarray, start: np.ndarray, size: np.ndarray, depth: int) -> np.ndarray:
    """Places in the order of their first ``depth`` bytes at least, by doubling ranks."""
    place = np.arange(len(symbol)) - start
    rank, known = symbol, STEP
    while known < depth:
        _, rank = np.unique(rank * (rank.max(initial=0) + 1) + rank[start + (place + known) % size], return_inverse=True)
        known *= 2
    return np.argsort(rank, kind="stable")


def repeated_starts(strings: list[bytes], length: int) -> list[np.ndarray]:
    """For each string the places at which a ``length``-byte piece starts that also starts elsewhere among them.
    """
    if length % STEP:
        raise ValueError(f"the length must be a multiple of {STEP}")
    if not strings:
        return []
    raw, start, extent = _rotations(strings)
    symbol = _symbols(raw, start, extent)
    ends = np.cumsum([len(s) + STEP for s in strings])
    before, link, places, base = [], [], [], 0
    for end in ends:
        if end - base < _SHARD and end < len(raw):
            continue
        own = slice(base, int(end))
        order = _suffix_order(symbol[own], start[own] - base, extent[own], length) + base
        at = np.empty(len(order), dtype=np.int64)
        at[order - base] = np.arange(base, end)
        earlier = start[order] + (order - start[order] - STEP) % extent[order]
        before.append(symbol[earlier])
        link.append(at[earlier - base])
        places.append(order)
        base = int(end)
    symbols, links = np.concatenate(before).astype(np.int32), np.concatenate(link)
    here = np.arange(base)  # suffixes in merged order, as places in their shards' orders
    interval = np.zeros(base, dtype=np.int64)
    for _ in range(length // STEP):
        dealt = np.argsort(symbols[here], kind="stable")
        key, came = symbols[here][dealt], interval[dealt]
        here = links[here][dealt]
        fresh = np.append(True, (key[1:] != key[:-1]) | (came[1:] != came[:-1]))
        interval = np.cumsum(fresh) - 1
        several = np.bincount(interval)[interval] > 1
        here, interval = here[several], interval[several]
        if not len(here):
            break
    found = np.sort(np.concatenate(places)[here])
    parts = np.split(found, np.searchsorted(found, ends[:-1]))
    return [p[p + length <= e - STEP] - (e - STEP - len(s)) for p, e, s in zip(parts, ends, strings)]

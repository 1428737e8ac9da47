"""Stretches of a text in which the same words come round again and again.

A run of period q is a stretch of words in which words q apart are identical,
that no neighbouring word extends, that has no smaller period, and that is at
least ``MIN_WORDS`` words and ``MIN_TURNS`` periods long. All of them are
found, without comparing all pairs of positions:

* Periods under ``SMALL`` words: the text against itself, shifted by each.
* Longer ones by *string synchronising sets*. At scale t (8, 16, 32 ... words)
  a position is selected if, of the hashes of the t words that begin at it and
  at each of the t positions after it, the first or the last is the smallest.
  Whether it is depends on the next 2 t words alone, so a run of period q
  selects the same places in each turn. Two selected positions with the same
  2 t words, q apart, propose the period q where 2 t <= q < 4 t; the proposal
  is extended word by word to both sides, on the words themselves.
* Where t words have a period of at most t / 3, they take no part in the
  selection: else a monotonous region would select everything or nothing. What
  is left out there are small periods, which smaller scales have found by
  then. Any t positions in a row with no selected one among them lie in such a
  region, so each run has a selected position in its first turn.

Words are runs of characters other than space and TAB to CR; they are compared
by exact numbers, hashes only select. A text costs its length times the number
of scales. Many texts go through as one array, parted by numbers of their own.

Null and empty texts have no runs and collapse to the empty text. Rows keep
all their columns, whatever their names; repeated rows repeat their result.
Whole texts are read; one very long text needs some 150 bytes a word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyroom.llm.words import U64, mix

MIN_WORDS, MIN_TURNS = 24, 3
SMALL = 16  # periods from here on are found by scales
CHUNK_WORDS = 1 << 18  # words of several texts in one array
_FIRST = SMALL // 2
_LAST = U64(0xFFFFFFFFFFFFFFFF)
_STEP = U64(0xD6E8FEB86659FD93)

RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_RUN_DDL = "struct<start: bigint, length: bigint, period: bigint>"


def least(period: int) -> int:
    """Words that a run of this period has at least."""
    return max(MIN_WORDS, MIN_TURNS * period)


def _stretches(words: np.ndarray, q: int, length: int) -> Iterator[tuple[int, int]]:
    """Maximal stretches with period ``q`` of at least ``length`` words, as start and end."""
    same = np.flatnonzero(words[q:] == words[:-q])
    if len(same) < length - q:
        return
    last = np.flatnonzero(np.diff(same) != 1)
    first = np.concatenate(([0], last + 1))
    last = np.append(last, len(same) - 1)
    long = last - first + 1 + q >= length
    yield from zip(same[first[long]].tolist(), (same[last[long]] + 1 + q).tolist())


def _agree(a: np.ndarray, b: np.ndarray) -> int:
    """How many first elements are equal; reads at most some twice as many."""
    n, at, step = min(len(a), len(b)), 0, 64
    while at < n:
        end = min(n, at + step)
        differ = a[at:end] != b[at:end]
        if differ.any():
            return at + int(differ.argmax())
        at, step = end, 2 * step
    return n


def _selected(codes: np.ndarray, t: int) -> np.ndarray:
    """Synchronising positions for the hashes of ``t`` words at each position; ``_LAST`` takes no part."""
    n = len(codes) - t
    if n <= 0:
        return np.empty(0, dtype=np.int64)
    smallest, step = codes, 1
    while step < t:
        smallest = np.minimum(smallest[:-step], smallest[step:])
        step *= 2
    smallest = np.minimum(smallest[:n], codes[t:])
    return np.flatnonzero((smallest != _LAST) & ((smallest == codes[:n]) | (smallest == codes[t:])))


def _proposals(at: np.ndarray, context: np.ndarray, t: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and periods (2 t to 4 t - 1) of selected positions with equal contexts, by period and position."""
    order = np.argsort(context, kind="stable")  # equal contexts by position
    at, context = at[order], context[order]
    found, periods, lag = [], [], 1
    while lag < len(at):
        gap = at[lag:] - at[:-lag]
        near = (context[lag:] == context[:-lag]) & (gap < 4 * t)
        if not near.any():
            break
        here = near & (gap >= 2 * t)
        found.append(at[:-lag][here])
        periods.append(gap[here])
        lag += 1
    if not found:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    at, q = np.concatenate(found), np.concatenate(periods)
    order = np.lexsort((at, q))
    return at[order], q[order]


def find_runs(texts: list[np.ndarray]) -> list[list[tuple[int, int, int]]]:
    """Runs (start, length, period) of each text, given as word numbers from 0, by start and period."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    kept = [i for i, words in enumerate(texts) if len(words) >= MIN_WORDS]
    if not kept:
        return out
    # One array; after each text a number that stands nowhere else.
    words = np.concatenate([part for i in kept for part in (texts[i], np.array([-1 - i]))])
    sizes = np.array([len(texts[i]) + 1 for i in kept])
    begins = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    texts_of = np.array(kept)
    seen: set[tuple[int, int, int]] = set()
    smooth: list[tuple[int, int, int, int]] = []  # text, start, end, period of stretches that repeat closely

    def keep(start: int, end: int, q: int) -> None:
        k = int(np.searchsorted(begins, start, side="right")) - 1
        text, shift = int(texts_of[k]), int(begins[k])
        smooth.append((text, start - shift, end - shift, q))
        # The same stretch with a smaller period was found before.
        if end - start >= least(q) and (key := (text, start - shift, end - shift)) not in seen:
            seen.add(key)
            out[text].append((start - shift, end - start, q))

    for q in range(1, min(SMALL, len(words))):
        # Shorter stretches of the smallest periods matter to the first two scales.
        need = next((t for t in (_FIRST, 2 * _FIRST) if q <= t // 3), least(q))
        for start, end in _stretches(words, q, need):
            keep(start, end, q)

    codes, t = mix(words.astype(U64)), 1
    while True:
        if t >= _FIRST:
            long = sizes > 2 * MIN_TURNS * t  # with room for three turns of 2 t words
            if not long.any():
                break
            if not long.all():
                inside = np.repeat(long, sizes)
                words, codes = words[inside], codes[inside]
                sizes, texts_of = sizes[long], texts_of[long]
                begins = np.concatenate(([0], np.cumsum(sizes)[:-1]))
            at_scale = codes
            place = dict(zip(texts_of.tolist(), begins.tolist()))
            dull = [(place[x] + s, place[x] + e) for x, s, e, q in smooth if q <= t // 3 and e - s >= t and x in place]
            if dull:
                at_scale = codes.copy()
                for s, e in dull:
                    at_scale[s : e - t + 1] = _LAST
            chosen = _selected(at_scale, t)
            done: dict[int, int] = {}  # period: end of the last stretch looked at
            at, periods = _proposals(chosen, mix(codes[chosen] * _STEP + codes[chosen + t]), t)
            for i, q in zip(at.tolist(), periods.tolist()):
                if i < done.get(q, 0):
                    continue
                left = _agree(words[:i][::-1], words[: i + q][::-1])
                right = _agree(words[i:], words[i + q :])
                done[q] = i + right
                if left + right + q >= least(q):
                    keep(i - left, i + right + q, q)
        ahead = np.concatenate((codes[t:], np.arange(min(t, len(codes)), dtype=U64)))
        codes, t = mix(codes * _STEP + ahead[: len(codes)]), 2 * t
    for found in out:
        found.sort(key=lambda run: (run[0], run[2]))
    return out


def strongest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run with the most turns, exactly; of equals the one that begins first, then that of the smaller period."""
    best = None
    for run in runs:  # by start and period
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words without those after the first turn of a run, joined by one space."""
    if not runs:
        return b" ".join(words)
    edge = np.zeros(len(words) + 1, dtype=np.int64)
    for start, length, q in runs:
        edge[start + q] += 1
        edge[start + length] -= 1
    gone = np.cumsum(edge[:-1]) > 0
    return b" ".join(w for w, out in zip(words, gone.tolist()) if not out)


class _Numbers(dict):
    """Numbers for words, in order of their first use."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def _chunks(texts: pa.Array) -> Iterator[list[list[bytes]]]:
    """The texts' words; some texts together, a very long one alone."""
    chunk, size = [], 0
    for text in texts:
        words = (text.as_py() or "").encode("utf-8", "surrogatepass").split()  # at space and TAB to CR
        if chunk and size + len(words) > CHUNK_WORDS:
            yield chunk
            chunk, size = [], 0
        chunk.append(words)
        size += len(words)
    if chunk:
        yield chunk


def _described(texts: pa.Array) -> pa.Array:
    runs, best, left = [], [], []
    for chunk in _chunks(texts):
        numbers = _Numbers()
        found = find_runs([np.fromiter(map(numbers.__getitem__, words), dtype=np.int64, count=len(words)) for words in chunk])
        for words, own in zip(chunk, found):
            named = [dict(zip(("start", "length", "period"), run)) for run in own]
            runs.append(named)
            top = strongest(own)
            best.append(None if top is None else named[own.index(top)])
            left.append(collapse(words, own).decode("utf-8", "surrogatepass"))
    return pa.StructArray.from_arrays(
        [pa.array(runs, pa.list_(RUN)), pa.array(best, RUN), pa.array(left, pa.string())], names=["runs", "strongest", "collapsed"]
    )


def runs_of(text: Column) -> Column:
    """A struct: ``runs`` by start and period, the ``strongest`` (null without runs), and the ``collapsed`` text,
    whose words are those outside runs and the first turn of each run."""
    return F.arrow_udf(_described, f"struct<runs: array<{_RUN_DDL}>, strongest: {_RUN_DDL}, collapsed: string>")(text)


def cycled(key: Column, text: Column) -> Column:
    """Texts of which one in ten, by crc32 h of the key, goes round in a cycle.

    Where h mod 10 is 0, the n words from a = floor(h / 10) mod n on repeat
    their first 1 + floor((n - a) / (3 + floor(h / 10) mod 8)). Other texts,
    those without words, and rows without a key stay as they are.
    """

    def turn(hashes: pa.Array, texts: pa.Array) -> pa.Array:
        out = []
        for h, text in zip(hashes.to_pylist(), texts.to_pylist()):
            words = text.encode("utf-8", "surrogatepass").split() if text and h is not None and h % 10 == 0 else []
            if words:
                n, g = len(words), h // 10
                a = g % n
                p = 1 + (n - a) // (3 + g % 8)
                text = b" ".join([*words[:a], *(words[a + i % p] for i in range(n - a))]).decode("utf-8", "surrogatepass")
            out.append(text)
        return pa.array(out, pa.string())

    return F.arrow_udf(turn, "string")(F.crc32(key.cast("string")), text)


#: All runs after one text in ten was made to go round, in SQL: equal words of a text are paired, so it is for small tables.
RUNS_SQL = """
WITH keys AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words,
    xor(list_reduce(
      list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda ch: ascii(ch)::BIGINT)),
      lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384::BIGINT) ELSE x >> 1 END)
    ), 4294967295::BIGINT) AS h
  FROM documents),
sized AS (SELECT doc_id, words, len(words) AS n, h, h // 10 AS g FROM keys),
cycles AS (
  SELECT *, CASE WHEN h % 10 = 0 AND n > 0 THEN g % n ELSE n END AS a,
    CASE WHEN h % 10 = 0 AND n > 0 THEN 1 + (n - g % n) // (3 + g % 8) ELSE 1 END AS p
  FROM sized),
words AS (
  SELECT doc_id, n, i, words[CASE WHEN i >= a THEN a + (i - a) % p ELSE i END + 1] AS w
  FROM (SELECT *, unnest(range(0, n)) AS i FROM cycles)),
pairs AS (
  SELECT x.doc_id, y.i - x.i AS q, x.i
  FROM words x JOIN words y ON y.doc_id = x.doc_id AND y.w = x.w AND y.i > x.i AND 3 * (y.i - x.i) <= x.n),
islands AS (SELECT doc_id, q, i, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM pairs),
stretches AS (SELECT doc_id, q, min(i) AS start, count(*) + q AS length FROM islands GROUP BY doc_id, q, island),
runs AS (
  SELECT doc_id, start, length, min(q) AS period FROM stretches WHERE length >= greatest(24, 3 * q) GROUP BY doc_id, start, length),
listed AS (
  SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines,
    first(struct_pack(start := start, length := length, period := period) ORDER BY length::DOUBLE / period DESC, start, period) AS best
  FROM runs GROUP BY doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM runs),
kept AS (
  SELECT doc_id, string_agg(w, ' ' ORDER BY i) AS collapsed FROM words ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, best.start AS start, best.length AS length, best.period AS period,
  1000 * best.length // best.period AS exponent_milli, sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(collapsed, '')) AS collapsed_sha256
FROM cycles LEFT JOIN listed USING (doc_id) LEFT JOIN kept USING (doc_id)"""

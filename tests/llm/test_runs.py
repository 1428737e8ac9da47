"""Runs of words against all periods tried out, and the query against a plain reading of its contract."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from tallyroom.llm import queries, runs


def brute(words):
    """Every stretch for every period, the smallest period of each kept."""
    n, found, seen = len(words), [], set()
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(24, 3 * q) and (i, j + q) not in seen:
                seen.add((i, j + q))
                found.append((i, j + q - i, q))
            i = j + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def texts_of(seed):
    r = random.Random(seed)
    fib = [[0], [0, 1]]
    while len(fib[-1]) < 700:
        fib.append(fib[-1] + fib[-2])
    out = [fib[-1], [0] * 200, [], [3] * 24, [3] * 23]
    for letters in (2, 3, 5, 40):
        out.append([r.randrange(letters) for _ in range(r.randrange(400))])
    for _ in range(12):
        words = [r.randrange(6) for _ in range(r.randrange(60))]
        for _ in range(r.randrange(1, 4)):  # cycles, also of texts that cycle inside
            unit = [r.randrange(r.choice([1, 2, 3, 50])) for _ in range(r.choice([1, 2, 5, 15, 16, 17, 31, 32, 33, 64, 90]))]
            if r.random() < 0.3:
                unit = unit * r.randrange(2, 5) + [99]
            if r.random() < 0.3:
                unit = [7] * r.randrange(1, 120) + unit
            turned = unit * r.randrange(2, 7) + unit[: r.randrange(len(unit))]
            if r.random() < 0.3:
                turned[r.randrange(len(turned))] = 123
            words += turned + [r.randrange(6) for _ in range(r.randrange(40))]
        out.append(words)
    return out


@pytest.mark.parametrize("seed", range(25))
def test_all_runs_are_found(seed):
    texts = texts_of(seed)
    found = runs.find_runs([np.array(t, dtype=np.int64) for t in texts])
    for text, own in zip(texts, found):
        assert own == brute(text)


def test_long_periods():
    r = random.Random(1)
    for q in (1000, 1024, 5000):
        unit = [r.randrange(1000) for _ in range(q)]
        unit[: q // 2] = ([4] * 30 + [5]) * (q // 62) + unit[: q // 2 - 31 * (q // 62)]
        words = [1, 2] + unit * 3 + unit[:7] + [-5]
        assert (2, 3 * q + 7, q) in runs.find_runs([np.array(words)])[0]


def expected(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        if h % 10 == 0:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
    found = brute(words)
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    left = " ".join(w for i, w in enumerate(words) if i not in gone)
    return (
        doc_id, len(found), *(best or (None, None, None)), best and 1000 * best[1] // best[2],
        hashlib.sha256("".join(f"{s},{length},{q}\n" for s, length, q in found).encode()).hexdigest(),
        hashlib.sha256(left.encode()).hexdigest(),
    )


COLUMNS = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def test_query_matches_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: tuple(r[c] for c in COLUMNS) for r in queries.QUERIES["op13_periodic_runs"](spark, SMALL).collect()}
    assert got == {d.doc_id: expected(d.doc_id, d.text) for d in docs}
    assert sum(r[1] > 0 for r in got.values()) > 10


def test_odd_texts_and_columns(spark):
    odd = [None, "", " \n", "one", "la " * 30, "la\x0bla\xa0la  " * 40, "x" * 3000, "d e f\n" * 300, "same", "same"]
    ids = [k for k in range(400) if zlib.crc32(str(k).encode()) % 10 == 0][: len(odd)]  # all go round
    for keys in (ids, [None] * len(odd)):
        df = spark.createDataFrame([(k, t, "a", "b", 1) for k, t in zip(keys, odd)], "doc_id bigint, text string, runs string, words string, start int")
        got = queries.described_runs(df).collect()
        assert sorted(map(repr, (tuple(r[c] for c in COLUMNS) for r in got))) == sorted(repr(expected(k, t)) for k, t in zip(keys, odd))
        kept = df.withColumn("found", runs.runs_of(F.col("text"))).select("runs", "words", "start", "found.strongest")
        assert {tuple(r)[:3] for r in kept.collect()} == {("a", "b", 1)}
        assert queries.described_runs(df.limit(0)).collect() == []

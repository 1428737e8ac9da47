"""Whole queries against brute force on the smallest tables: packing, quality, sharding, near duplicates, repeats."""

from __future__ import annotations

import hashlib
import re
import struct
import zlib
from collections import Counter, defaultdict

import pytest

from conftest import SMALL
from tallyroom.llm import quality, queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def docs(spark):
    return {r.doc_id: r for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}


def result(spark, name):
    return queries.QUERIES[name](spark, SMALL).collect()


def test_packing(spark, docs):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(queries.tokenizer_path())
    rows = result(spark, "op3_best_fit_packing")
    by_doc, by_sequence, tokens = defaultdict(list), defaultdict(list), 0
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append((r.offset, r.length))
    assert by_doc.keys() == docs.keys()
    for i, d in docs.items():
        ids = [*tokenizer.encode(d.text or "", add_special_tokens=False).ids, 2]
        tokens += len(ids)
        pieces = sorted(by_doc[i], key=lambda r: r.piece)
        assert [p.piece for p in pieces] == list(range(len(pieces)))
        at = 0
        for p in pieces:
            part = ids[p.start : p.start + p.length]
            assert p.start == at and p.ids_crc32 == zlib.crc32(struct.pack(f"<{len(part)}I", *part))
            at += p.length
        assert at == len(ids)
        assert len(pieces) == -(-len(ids) // 1024) and all(p.length == 1024 for p in pieces[1:])
    for places in by_sequence.values():
        places.sort()
        assert [o for o, _ in places] == [sum(n for _, n in places[:k]) for k in range(len(places))]
        assert sum(n for _, n in places) <= 1024
    assert len(by_sequence) <= 1.02 * -(-tokens // 1024) + 1


def test_quality(spark, docs):
    def counts(text):
        words = WORD.findall(text or "")
        windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
        inside = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
        seen, twice = set(), 0
        for line in (text or "").split("\n"):
            if WORD.search(line):
                twice += line in seen
                seen.add(line)
        return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), twice, len(inside)

    frame = spark.read.parquet(f"{SMALL}/documents.parquet")
    references = quality.references(frame)
    for r in result(spark, "op6_language_divergence"):
        n, chars, symbols, lines, repeated = counts(docs[r.doc_id].text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (n, chars, symbols, lines, repeated)
        assert r.base_failed == (n < 50 or 100 * repeated > 50 * n)
        assert not (r.kept and r.base_failed)
        if not r.base_failed:  # near some reference in both histograms
            classes = quality.char_classes(docs[r.doc_id].text)
            hashes = quality.word_hashes([docs[r.doc_id].text])[0]
            limits = [base + slack / n**0.5 for base, slack in (quality.MAX_CHARS, quality.MAX_WORDS)]
            near = any(all(d <= m for d, m in zip(ref.distances(classes, hashes), limits)) for ref in references)
            assert r.kept == near
    assert len(references) == len({d.lang for d in docs.values()})


def test_sharding(spark, docs):
    rows = result(spark, "op7_longest_first_shards")
    assert {r.doc_id for r in rows} == docs.keys() and len(rows) == len(docs)
    shard_of, load, slots = {}, Counter({s: 0 for s in range(24)}), defaultdict(list)
    for r in rows:
        raw = (docs[r.doc_id].text or "").encode()
        assert (r["size"], r.text_crc32, r.law, r.grown_shard) == (len(raw) + 8, zlib.crc32(raw), "bytes", None)
        assert shard_of.setdefault(raw, r.shard) == r.shard  # equal texts stay together
        load[r.shard] += r["size"]
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    group = Counter()
    for d in docs.values():
        group[d.text] += len((d.text or "").encode()) + 8
    mean = sum(load.values()) / 24
    assert max(load.values()) <= max(4 / 3 * mean, max(group.values()))  # what longest-first guarantees


def shingles(text):
    text = (text or "").translate({c: c + 32 for c in range(65, 91)})
    words = WORD.findall(text)
    return {tuple(words[i : i + 4]) for i in range(len(words) - 3)} or ({tuple(words)} if words else set())


def test_near_duplicates(spark, docs):
    sets = {i: shingles(d.text) for i, d in docs.items()}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for k, i in enumerate(ids):
        for j in ids[k + 1 :]:
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * len(sets[i] | sets[j]):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in result(spark, "op8_min_max_near_duplicates")}
    assert got == {i: (len(sets[i]), root(i), root(i) == i) for i in ids}
    assert any(not kept for _, _, kept in got.values())


def test_repeats(spark, docs):
    length, raw = 400, {i: (d.text or "").encode() for i, d in docs.items()}
    seen = Counter(b[k : k + length] for b in raw.values() for k in range(len(b) - length + 1))
    got = {r.doc_id: r for r in result(spark, "op9_interleaved_repeats")}
    assert got.keys() == raw.keys()
    for i, b in raw.items():
        gone = bytearray(len(b))
        for k in range(len(b) - length + 1):
            if seen[b[k : k + length]] > 1:
                gone[k : k + length] = b"\1" * length
        spans = len(re.findall(b"\1+", bytes(gone)))
        left = bytes(x for x, g in zip(b, gone) if not g)
        r = got[i]
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == (len(b), sum(gone), spans, hashlib.sha256(left).hexdigest())
    assert any(r.n_removed for r in got.values())

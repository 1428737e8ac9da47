"""The trie against one built of dictionaries from whole conversations."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from tallyroom.llm import prefix_trie, queries
from tallyroom.llm.frames import remainder

COLUMNS = [c.split()[0] for c in prefix_trie.NODE.split(", ")]
SCHEMA = "conv_id bigint, turn bigint, role string, text string, depth string, a string, len string, owner string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute(rows):
    """Nodes of the rebuilt conversations, from (conv_id, turn, role, text)."""
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            code = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).digest()
            turns[conv].append((turn is not None, turn or 0, code, (role, text)))
    original = {c: [x[-1] for x in sorted(own)] for c, own in turns.items()}
    rebuilt = {}
    for c, own in original.items():
        h = zlib.crc32(str(c).encode()) % 9
        rebuilt[c] = tuple(original.get(c - c % 5, [])[:h] + own[h:])
    if not rebuilt:
        return []
    members = defaultdict(list)
    for c in sorted(rebuilt):
        for d in range(len(rebuilt[c]) + 1):
            members[rebuilt[c][:d]].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)

    below = {}
    for node in sorted(members, key=len, reverse=True):
        own = children[node]
        saved = (len(members[node]) - 1) * len(node[-1][1].encode()) if node else 0
        below[node] = (sum(below[x][0] for x in own) or 1, saved + sum(below[x][1] for x in own))
    return [
        (c[0], len(node), members[node[:-1]][0] if node else None, len(c), len(children[node]), *below[node], sha(",".join(str(x) for x in c if len(rebuilt[x]) == len(node))))
        for node, c in members.items()
    ]


def taken(df):
    key = F.col("conv_id")
    rows = prefix_trie.prefixes(df)
    return [tuple(r[c] for c in COLUMNS) for r in prefix_trie.trie(*prefix_trie.graft(rows, key - key % 5, remainder(key, 9))).collect()]


def order(rows):
    return sorted(rows, key=repr)


def made(seed):
    r = random.Random(seed)
    rows = []
    for c in r.sample(range(300), 160):
        for t in range(r.randrange(1, 14)):
            rows.append((c, t, r.choice(["user", "assistant"]), r.choice(["yes", "no", "ж" * 9, ""]) if t < 3 or c % 7 else f"{c} {t}"))
    rows += [(c, t, "user", f"same {t}") for c in range(1000, 1060) for t in range(6)]  # copies
    rows += [(2000, t, "user", str(t)) for t in range(500)]  # one long conversation
    rows += [(2001, t, "user" if t == 5 else None, "x" if t == 2 else None) for t in (None, 5, 5, None, 7, 5, 2)]
    rows += [(None, 0, "user", "nobody's"), (2002, None, None, None)] + [(2003, 1, "user", "again")] * 5
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", range(2))
@pytest.mark.parametrize("bits", [25, 6])
def test_matches_brute_force(spark, monkeypatch, seed, bits):
    """Also with a sketch so small that it proves next to nothing, and with few rows to a task."""
    rows = made(seed)
    monkeypatch.setattr(prefix_trie, "CELL_BITS", bits)
    df = spark.createDataFrame([(*x, "p", "q", "r", "s") for x in rows], SCHEMA)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert order(taken(df)) == order(brute(rows))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_query_matches_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = [tuple(r[c] for c in COLUMNS) for r in queries.QUERIES["op11_conversation_prefix_trie"](spark, SMALL).collect()]
    assert order(got) == order(brute(rows))


def test_empty_and_turnless(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert taken(empty) == []
    assert taken(spark.createDataFrame([(None, 1, "user", "x", "", "", "", "")], SCHEMA)) == []
    # No conversation c - c % 5 and all own turns within the first h: nothing is left of them.
    gone = [c for c in range(1, 400) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 1][:7]
    rows = [(c, 0, "user", "x") for c in gone]
    assert order(taken(spark.createDataFrame([(*x, "", "", "", "") for x in rows], SCHEMA))) == order(brute(rows)) == [(gone[0], 0, None, 7, 0, 1, 0, sha(",".join(map(str, gone))))]


def test_singletons_are_not_shuffled(spark):
    """Conversations with nothing in common are all proven single."""
    df = spark.createDataFrame([(c, t, "user", f"{c} {t}", "", "", "", "") for c in range(300) for t in range(5)], SCHEMA)
    rows = prefix_trie.prefixes(df)
    full = prefix_trie.durable(rows.join(rows.groupBy("conv_id").agg(F.max("depth").alias("len")), "conv_id"), "t")
    screened = prefix_trie._screened(full, 13)
    assert screened.where(~F.col("single")).count() < 30
    nodes = prefix_trie.trie(full, full.select("conv_id", "len").distinct())
    assert nodes.count() == 1501 and nodes.where("n_convs = 1 and saved_tokens = 0 and n_leaves = 1").count() == 1500

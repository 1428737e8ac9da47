"""Groups of near-duplicate texts by min-max hashing.

A text is the set of its distinct word shingles. Each of ``hashes`` random
maps of the set keeps both its least and its greatest value, two signature
entries for one evaluation; either agrees between two sets with a probability
of their Jaccard similarity. Entries go into bands of ``rows``; sets that
agree in a whole band are candidates. With the 32 bands of 5 that 80 maps
give, a pair of similarity 0.8 is missed once in 300,000.

Equal sets are one node (the smallest id that has it), so exact copies cost
nothing. Candidates are confirmed on their full sets. A band's bucket is not
expanded into pairs: its members are first compared with one centre, the
member that shares most buckets; members whose components still differ after
that are then compared with each other, unless the shingles a member shares
with any other are too few for the threshold. No link between candidates is lost.

Null texts and texts without words have no shingles and are linked with
nothing. Ids must differ between different texts; rows repeated under one id
share one result, rows without an id are kept. An empty table gives an empty
result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyroom.llm.components import connected
from tallyroom.llm.frames import small_side
from tallyroom.llm.words import U64, mix, shingle_sets
from tallyroom.sources.durable import durable

WIDTH = 5
PERCENT = 80
HASHES = 80
ROWS = 5
_COLUMNS = 2048  # shingles counted at once
_RANDOM = np.random.default_rng(20)
_A = _RANDOM.integers(0, 1 << 63, 1024, dtype=np.int64).astype(U64) * U64(2) + U64(1)
_B = _RANDOM.integers(0, 1 << 63, 1024, dtype=np.int64).astype(U64)


def signatures(sets: list[np.ndarray], hashes: int = HASHES) -> np.ndarray:
    """One row per set (none empty): least and greatest value under each map."""
    items = np.concatenate(sets)
    starts = np.concatenate(([0], np.cumsum([len(s) for s in sets])[:-1]))
    out = np.empty((len(sets), 2 * hashes), dtype=U64)
    for j in range(hashes):
        h = items * _A[j] + _B[j]
        h ^= h >> U64(32)
        h *= U64(0x9FB21C651E98DF25)
        out[:, 2 * j] = np.minimum.reduceat(h, starts)
        out[:, 2 * j + 1] = np.maximum.reduceat(h, starts)
    return out


def band_keys(signature: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """One key per set and band, different between bands."""
    bands = signature.shape[1] // rows
    parts = signature[:, : bands * rows].reshape(len(signature), bands, rows)
    key = np.broadcast_to(np.arange(1, bands + 1, dtype=U64), parts.shape[:2]).copy()
    for j in range(rows):
        key = mix(key * U64(0xD6E8FEB86659FD93) + parts[:, :, j])
    return key.view(np.int64)


def _signed(docs: DataFrame, id_col: str, text_col: str, width: int, hashes: int, rows: int) -> DataFrame:
    """Of each row: set size, digest of the set and band keys (none for an empty set)."""

    @F.pandas_udf("n bigint, digest binary, bands array<bigint>")
    def sign(texts: pd.Series) -> pd.DataFrame:
        sets = shingle_sets(texts.tolist(), width)
        n = np.array([len(s) for s in sets], dtype=np.int64)
        bands: list = [None] * len(sets)
        digest: list = [None] * len(sets)
        some = np.flatnonzero(n)
        at = 0
        while at < len(some):  # some million shingles at once
            end = at + max(1, int(np.searchsorted(np.cumsum(n[some[at:]]), 1 << 20, side="right")))
            part = [sets[i] for i in some[at:end]]
            for i, s, keys in zip(some[at:end], part, band_keys(signatures(part, hashes), rows)):
                bands[i] = keys
                digest[i] = b"".join(int(v).to_bytes(8, "little") for v in (s.sum(), mix(s).sum()))
            at = end
        return pd.DataFrame({"n": n, "digest": digest, "bands": bands})

    signed = docs.select(F.col(id_col).alias("id"), sign(F.col(text_col)).alias("s"))
    return durable(signed.select("id", "s.*"), "signatures")


def _sets(docs: DataFrame, nodes: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """Full shingle sets of some documents."""

    @F.pandas_udf("array<bigint>")
    def shingles(texts: pd.Series) -> pd.Series:
        return pd.Series([s.view(np.int64) for s in shingle_sets(texts.tolist(), width)])

    some = docs.select(F.col(id_col).alias("node"), F.col(text_col).alias("text")).join(small_side(nodes), "node", "left_semi")
    return durable(some.select("node", shingles("text").alias("set")).dropDuplicates(["node"]), "sets")


def _near_in_size(a: Column, b: Column, percent: int) -> Column:
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def _reaches(common: Column, n: Column, m: Column, percent: int) -> Column:
    """Whether sets of n and m may be similar enough with no more than ``common`` shared."""
    return 100 * common >= percent * (n + m - common)


def _able(apart: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The rows of ``apart`` whose node may still be similar to another in its bucket.

    No pair can share more than a node's shingles found in any other node that
    is apart. Edited copies of one text each have
    shingles of their own, so most of them end here, however many there are.
    The least size a partner can have is that of the bucket's smallest set, or
    ``percent`` of the node's own.
    """
    nodes = apart.select("node").distinct()
    own = (
        sets.join(small_side(durable(nodes, "apart-nodes")), "node", "left_semi")
        .select("node", F.explode("set").alias("shingle"))
        .groupBy("shingle")
        .agg(F.count(F.lit(1)).alias("times"), F.min("node").alias("node"))
        .where(F.col("times") == 1)
        .groupBy("node")
        .agg(F.count(F.lit(1)).alias("own"))
    )
    least = F.greatest(F.col("n_least"), F.floor(F.col("n") * percent / 100))
    able = durable(
        apart.join(own, "node", "left")
        .where(_reaches(F.col("n") - F.coalesce("own", F.lit(0)), F.col("n"), least, percent))
        .select("key", "node", "component"),
        "able",
    )
    left = able.groupBy("key").agg(F.count(F.lit(1)).alias("members"), F.countDistinct("component").alias("parts"))
    return durable(able.join(left.where("parts > 1").select("key", "members"), "key"), "across")


def similar_pairs(sets: list[np.ndarray], component: np.ndarray, percent: int) -> np.ndarray:
    """Index pairs of similar enough sets in different components, by counting common shingles block by block."""
    n = np.array([len(s) for s in sets], dtype=np.int64)
    items, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(sets)), n)
    place = np.cumsum(times > 1) - 1
    met = times[column] > 1
    row, column = row[met], place[column[met]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    common = np.zeros((len(sets), len(sets)), dtype=np.float32)
    for lo in range(0, int(column[-1]) + 1 if len(column) else 0, _COLUMNS):
        at = slice(*np.searchsorted(column, [lo, lo + _COLUMNS]))
        part = np.zeros((len(sets), _COLUMNS), dtype=np.float32)
        part[row[at], column[at] - lo] = 1
        common += part @ part.T
    near = 100 * common >= percent * (n[:, None] + n[None, :] - common)
    return np.argwhere(np.triu(near & (component[:, None] != component[None, :]), 1))


def _across(apart: DataFrame, sets: DataFrame, percent: int, block: int = 1024) -> DataFrame:
    """Links ``(a, b)`` between members of one bucket that are in different components.

    A bucket is compared by one task, or, beyond ``block`` members, by one
    task for each pair of its parts; only links leave the task.
    """

    def compare(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        at = similar_pairs([np.asarray(s) for s in pdf["set"]], pdf["component"].to_numpy(), percent)
        node = pdf["node"].to_numpy()
        return pd.DataFrame({"a": node[at[:, 0]], "b": node[at[:, 1]]})

    parts = F.ceil(F.col("members") / block).cast("int")
    mine = F.pmod(F.xxhash64("node"), parts).cast("int")
    kind = dict(sets.dtypes)["node"]
    return (
        apart.join(sets, "node")
        .select("key", "node", "component", "set", mine.alias("mine"), F.explode(F.sequence(F.lit(0), parts - 1)).alias("theirs"))
        .groupBy("key", F.least("mine", "theirs").alias("i"), F.greatest("mine", "theirs").alias("j"))
        .applyInPandas(compare, f"a {kind}, b {kind}")
        .distinct()
    )


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The distinct pairs ``(a, b)`` whose sets are similar enough."""
    left, right = sets.toDF("a", "set_a"), sets.toDF("b", "set_b")
    both = pairs.join(right, "b").join(left, "a")
    common = F.size(F.array_intersect("set_a", "set_b"))
    measured = both.select("a", "b", common.alias("common"), (F.size("set_a") + F.size("set_b") - common).alias("union"))
    return measured.where(100 * F.col("common") >= percent * F.col("union")).select("a", "b")


def near_duplicate_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = WIDTH,
    percent: int = PERCENT,
    hashes: int = HASHES,
    rows: int = ROWS,
) -> DataFrame:
    """One row per document: id, ``n_shingles``, ``component_id`` and ``kept`` (it is its group's smallest id)."""
    signed = _signed(docs, id_col, text_col, width, hashes, rows)
    nodes = durable(
        signed.where((F.col("n") > 0) & F.col("id").isNotNull())
        .groupBy("digest")
        .agg(F.min("id").alias("node"), F.first("n").alias("n"), F.first("bands").alias("bands")),
        "nodes",
    )
    banded = nodes.select("node", "n", F.explode("bands").alias("key"))
    shared = banded.groupBy("key").agg(F.count(F.lit(1)).alias("members")).where(F.col("members") > 1)
    buckets = durable(banded.join(shared, "key"), "buckets")
    wanted = durable(buckets.select("node").distinct(), "candidates")
    sets = _sets(docs, wanted, id_col, text_col, width)

    fame = buckets.groupBy("node").agg(F.sum("members").alias("fame"))
    centres = (
        buckets.join(fame, "node")
        .groupBy("key")
        .agg(F.max(F.struct("fame", (-F.col("node")).alias("m"), "n")).alias("c"))
        .select("key", (-F.col("c.m")).alias("centre"), F.col("c.n").alias("n_centre"))
    )
    ordered = [F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b")]
    to_centre = (
        buckets.join(centres.withColumnRenamed("centre", "other"), "key")
        .where((F.col("node") != F.col("other")) & _near_in_size(F.col("n"), F.col("n_centre"), percent))
        .select(*ordered)
        .distinct()
    )
    links = durable(confirmed(to_centre, sets, percent), "links-centre")
    labels = connected(links)

    # buckets whose members are still apart
    placed = buckets.join(labels, "node", "left").select("key", "node", "n", F.coalesce("component", "node").alias("component"))
    split = (
        placed.groupBy("key")
        .agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.min("n").alias("n_least"))
        .where("lo != hi")
        .select("key", "n_least")
    )
    apart = _able(durable(placed.join(split, "key"), "apart"), sets, percent)
    more = durable(_across(apart, sets, percent), "links-rest")
    if more.limit(1).count():
        labels = connected(links.union(more))

    groups = nodes.join(labels, "node", "left").select(F.col("digest").alias("_digest"), F.coalesce("component", "node").alias("component"))
    return signed.join(groups, signed.digest == groups._digest, "left").select(
        F.col("id").alias(id_col),
        F.col("n").alias("n_shingles"),
        F.coalesce("component", "id").alias("component_id"),
        F.coalesce(F.col("id") == F.coalesce("component", "id"), F.lit(True)).alias("kept"),
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with one row of each group, columns unchanged, whatever their names.

    Of rows with equal id and text one stays; different texts under one id
    share its fate and stay if one of them does. Rows without an id all stay.
    """
    groups = near_duplicate_groups(docs, id_col, text_col, **options)
    kept = durable(groups.where(F.col("kept") & F.col(id_col).isNotNull()).select(F.col(id_col).alias("id")).distinct(), "kept")
    rows = docs.select(F.struct("*").alias("row"), F.col(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("h"), F.md5(F.col(text_col)).alias("digest"))
    one = rows.where(F.col("id").isNotNull()).join(small_side(kept), "id", "left_semi").dropDuplicates(["id", "h", "digest"])
    return one.unionByName(rows.where(F.col("id").isNull())).select("row.*")


#: The groups of ``width`` 4 and ``percent`` 80 in SQL: all texts with a common shingle are compared, so it is for small tables.
GROUPS_SQL = """
WITH RECURSIVE split AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))) END AS s
  FROM split),
members AS (SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM sets),
common AS (
  SELECT x.doc_id AS a, y.doc_id AS b, any_value(x.n) AS n, any_value(y.n) AS m, count(*) AS c
  FROM members x JOIN members y ON x.shingle = y.shingle AND x.doc_id <> y.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM common WHERE 100 * c >= 80 * (n + m - c)),
reach AS (SELECT doc_id, doc_id AS other FROM sets UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON l.a = r.other),
components AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT doc_id, len(s) AS n_shingles, component_id, doc_id = component_id AS kept FROM sets JOIN components USING (doc_id)"""

"""The trie of conversation beginnings: which turns do conversations share from the start?

A node is a distinct sequence of the first d turns (role and text) of some
conversation; its members are the conversations that begin with it.

* ``prefixes``: turns are sorted by range over the whole table, not gathered by
  conversation, so one conversation may hold any share of the rows. A prefix is
  represented by 128 bits: two sums, modulo 2^64, of each turn's digest times
  the power of a base. Such sums add up over pieces of a conversation that lie
  in different tasks; one row for each task reaches the driver for that.
* ``graft``: conversations that begin like another one, by the same sums.
* ``trie``: a *count-min sketch* of all prefixes is added up and broadcast. It
  counts up to two and never too little, so an estimate of one proves a prefix
  to be a singleton: such nodes are complete as they are and are emitted where
  they lie. Only prefixes that may be shared are shuffled and grouped exactly;
  those that were screened in by a chance collision turn out single there.

Sums over subtrees take no pass for each level. Every node belongs to its
smallest member, and if a conversation is the smallest member of a node then
also of all nodes below it on its path. So one depth for each conversation, the
deepest node that belongs to another, says what it adds to each node of its
path: bytes from there to that depth, whether it adds a child, and whether it
adds a leaf. Members' ids that end in one node are hashed in blocks, sorted by
range; a task that adds up a digest reads blocks, not ids, and holds one.

The sketch has 1 bit for each of ``ROWS`` x 2^25 cells at most (12 MB). With
many more prefixes than cells fewer singletons are proven and more rows are
shuffled; the result is the same.

Turns are ordered by number, null first; equal numbers by the md5 of length of
the role, ``:``, role and text. Null role and text are empty. Rows without
conversation id belong to none and take no part. Repeated rows are turns of
their own. An empty table has no nodes, not even a root. Other columns,
whatever their names, are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyroom.llm.words import U64, mix
from tallyroom.sources.durable import durable, small_frame

#: Odd bases of the two sums.
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
ROWS, CELL_BITS = 3, 25  # of the sketch; cells of a row at most
CELLS_EACH = 4  # cells of a row for each prefix, below that
SKETCH_TASKS = 256  # that hold a sketch of their own
KEPT = 8  # turns that graft() can take over
_WORD = 1 << 64
_BLOCK = 1 << 16  # cells in a row of the sketch's table
_IDS = 1 << 14  # bytes of joined ids in a block

NODE = "conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, ends_sha256 string"
_PREFIX = "conv_id bigint, len bigint, depth bigint, a bigint, b bigint, a0 bigint, b0 bigint, total bigint, size bigint"
_KEY = ["depth", "a", "b"]


def _powers(base: int, exponents: np.ndarray) -> np.ndarray:
    """``base`` to each exponent, modulo 2^64."""
    out = np.ones(len(exponents), dtype=np.uint64)
    left, unit = exponents.astype(np.int64), base
    while len(left) and left.max() > 0:
        table, x = np.empty(1 << 12, dtype=np.uint64), 1
        for i in range(1 << 12):
            table[i], x = x, x * unit % _WORD
        out *= table[left & 0xFFF]
        left, unit = left >> 12, x
    return out


def _unsigned(column: pd.Series) -> np.ndarray:
    return column.to_numpy(dtype=np.int64).view(np.uint64)


def _signed(x: int) -> int:
    return x - _WORD if x >> 63 else x


def prefixes(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row for each prefix of each conversation.

    ``depth`` turns; ``a``, ``b`` its digest and ``a0``, ``b0`` that without
    the last turn; ``size`` UTF-8 bytes of the last text, ``total`` of all.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in (role_col, text_col))
    turns = conversations.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("bigint").alias("conv_id"),
        F.col(turn_col).alias("turn"),
        F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text))).alias("code"),
        F.octet_length(text).cast("bigint").alias("size"),
    )
    # The last key parts repeated rows too, so that no set of equal rows must go to one task.
    order = ["conv_id", "turn", "code", "_at"]
    ranged = turns.withColumn("_at", F.monotonically_increasing_id()).repartitionByRange(*order).sortWithinPartitions(*order)

    def add_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part = TaskContext.get().partitionId()
        conv, before = None, (0, 0, 0, 0)  # the conversation so far: turns, sums, bytes
        for pdf in batches:
            if not len(pdf):
                continue
            ids, size = pdf["conv_id"].to_numpy(), pdf["size"].to_numpy()
            first = np.append(True, ids[1:] != ids[:-1])
            begin = np.flatnonzero(first)
            group = np.cumsum(first) - 1
            at = np.arange(len(ids)) - begin[group] + 1
            goes_on = conv == ids[0]
            if goes_on:
                at[group == 0] += before[0]
            codes = np.frombuffer(b"".join(pdf["code"]), dtype=np.uint64).reshape(-1, 2)
            out = {"part": part, "conv_id": ids, "depth": at}
            for lane, name in enumerate("ab"):
                term = codes[:, lane] * _powers(BASES[lane], at)
                added = np.cumsum(term, dtype=np.uint64)
                added -= (added - term)[begin][group]
                if goes_on:
                    added[group == 0] += U64(before[1 + lane])
                out |= {name: added.view(np.int64), name + "0": (added - term).view(np.int64)}
            total = np.cumsum(size)
            total -= (total - size)[begin][group]
            if goes_on:
                total[group == 0] += before[3]
            out |= {"total": total, "size": size}
            conv, before = ids[-1], (int(at[-1]), *(int(out[x].view(np.uint64)[-1]) for x in "ab"), int(total[-1]))
            yield pd.DataFrame(out)

    schema = "part int, conv_id bigint, depth bigint, a bigint, a0 bigint, b bigint, b0 bigint, total bigint, size bigint"
    runs = durable(ranged.mapInPandas(add_up, schema), "turn-runs")
    last = F.max_by(F.struct("conv_id", "depth", "a", "b", "total"), F.struct("conv_id", "depth"))
    ends = runs.groupBy("part").agg(F.min("conv_id").alias("first"), last.alias("last")).collect()  # one row per task
    carried: dict[int, tuple[int, ...]] = {}  # part: the conversation it goes on with, and that one's sums so far
    so_far = None
    for r in sorted(ends, key=lambda r: r.part):
        now = (r.last.conv_id, r.last.depth, r.last.a % _WORD, r.last.b % _WORD, r.last.total)
        if so_far and so_far[0] == r.first:
            carried[r.part] = so_far
            if now[0] == r.first:
                n = so_far[1]
                now = (now[0], n + now[1], *((so_far[2 + i] + now[2 + i] * pow(BASES[i], n, _WORD)) % _WORD for i in (0, 1)), so_far[4] + now[4])
        so_far = now
    if not carried:
        return runs.drop("part")

    def go_on(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for part, pieces in pdf.groupby("part"):
                if part in carried:
                    conv, n, *sums, total = carried[part]
                    here = (pieces["conv_id"] == conv).to_numpy()
                    pieces = pieces.copy()
                    pieces.loc[here, "depth"] += n
                    pieces.loc[here, "total"] += total
                    for lane, name in enumerate("ab"):
                        for x in (name, name + "0"):
                            value = _unsigned(pieces[x]).copy()
                            value[here] = U64(sums[lane]) + value[here] * U64(pow(BASES[lane], n, _WORD))
                            pieces[x] = value.view(np.int64)
                yield pieces.drop(columns="part")

    return runs.mapInPandas(go_on, schema.removeprefix("part int, "))


def graft(rows: DataFrame, base: Column, kept: Column) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin like others: prefixes with their conversation's length, and all conversations.

    Each conversation becomes the first ``kept`` (0 to ``KEPT``) turns of
    conversation ``base`` (all if it has fewer, none if it does not exist),
    then its own turns after its first ``kept``. Both are columns of
    ``conv_id``. The second frame has conv_id and len; a conversation may
    be left without turns.
    """
    entry = F.struct("depth", "a", "b", "a0", "b0", "total", "size")
    heads = durable(
        rows.groupBy("conv_id").agg(F.max("depth").alias("n"), F.sort_array(F.collect_list(F.when(F.col("depth") <= KEPT, entry))).alias("head")),
        "conversation-heads",
    )
    others = heads.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"), F.col("head").alias("base_head"))
    h, k = F.col("h"), F.col("k")

    def at(head: str, i: Column, field: str) -> Column:
        return F.coalesce(F.try_element_at(F.col(head), F.nullif(i, F.lit(0)))[field], F.lit(0).cast("bigint"))

    grafted = (
        heads.withColumns({"base": base, "h": kept.cast("int")})
        .join(others, "base", "left")
        .withColumn("k", F.least(h, F.coalesce(F.col("base_n"), F.lit(0))).cast("int"))
        .withColumn("len", k + F.greatest(F.col("n") - h, F.lit(0)))
        .select(
            "conv_id", "len", "h", "k",
            F.when(k > 0, F.slice("base_head", 1, F.greatest(k, F.lit(1)))).alias("taken"),
            *(at("base_head", k, x).alias(f"new_{x}") for x in ("a", "b", "total")),
            *(at("head", h, x).alias(f"old_{x}") for x in ("a", "b", "total")),
        )
    )
    members = durable(grafted, "conversation-grafts")

    def move(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            shift = (pdf["h"] - pdf["k"]).to_numpy()
            out = {"conv_id": pdf["conv_id"], "len": pdf["len"], "depth": pdf["depth"] - shift}
            for lane, name in enumerate("ab"):
                turn = _powers(pow(BASES[lane], -1, _WORD), shift)
                new, old = _unsigned(pdf[f"new_{name}"]), _unsigned(pdf[f"old_{name}"])
                for x in (name, name + "0"):
                    out[x] = (new + (_unsigned(pdf[x]) - old) * turn).view(np.int64)
            out |= {"total": pdf["total"] - pdf["old_total"] + pdf["new_total"], "size": pdf["size"]}
            yield pd.DataFrame(out)[[c.split()[0] for c in _PREFIX.split(", ")]]

    taken = members.select("conv_id", "len", F.explode("taken").alias("p")).select("conv_id", "len", "p.*")
    own = rows.join(members.drop("taken").where(F.col("len") > k), "conv_id").where(F.col("depth") > h).mapInPandas(move, _PREFIX)
    return taken.unionByName(own), members.select("conv_id", "len")


def _cells(depth: np.ndarray, a: np.ndarray, b: np.ndarray, row: int, bits: int) -> np.ndarray:
    return (mix(mix(a + U64(row + 1) * U64(BASES[0])) + b * U64(BASES[1]) + depth.astype(U64)) >> U64(64 - bits)).astype(np.int64)


def _sketch(rows: DataFrame, bits: int) -> np.ndarray:
    """For each row and cell, packed: do two prefixes or more fall into it?"""
    block = min(_BLOCK, 1 << bits)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = np.zeros((ROWS, 1 << bits), dtype=np.uint8)

        def add(pieces: list[pd.DataFrame]) -> None:
            pdf = pd.concat(pieces)
            depth, a, b = pdf["depth"].to_numpy(), _unsigned(pdf["a"]), _unsigned(pdf["b"])
            for r in range(ROWS):
                cells, n = np.unique(_cells(depth, a, b, r, bits), return_counts=True)
                counts[r, cells] = np.minimum(2, counts[r, cells] + np.minimum(2, n))

        pieces, size = [], 0
        for pdf in batches:
            pieces.append(pdf)
            size += len(pdf)
            if size >= 1 << 17:
                add(pieces)
                pieces, size = [], 0
        if pieces:
            add(pieces)
        for r in range(ROWS):
            for at in range(0, 1 << bits, block):
                some = counts[r, at : at + block]
                if some.any():
                    yield pd.DataFrame({"row": [r], "at": [at], "once": [np.packbits(some > 0).tobytes()], "twice": [np.packbits(some > 1).tobytes()]})

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        once, twice = np.zeros((2, (block + 7) // 8), dtype=np.uint8)
        for x, y in zip(pdf["once"], pdf["twice"]):
            x, y = np.frombuffer(x, dtype=np.uint8), np.frombuffer(y, dtype=np.uint8)
            twice = twice | y | (once & x)
            once = once | x
        return pd.DataFrame({"row": pdf["row"].iloc[:1], "at": pdf["at"].iloc[:1], "twice": [twice.tobytes()]})

    # A group has one row from each of the tasks, which coalesce() bounds.
    counted = rows.select(*_KEY).coalesce(SKETCH_TASKS).mapInPandas(count, "row int, at bigint, once binary, twice binary")
    out = np.zeros((ROWS, (1 << bits) // 8), dtype=np.uint8)
    for r in counted.groupBy("row", "at").applyInPandas(merge, "row int, at bigint, twice binary").toLocalIterator():
        out[r.row, r["at"] // 8 : r["at"] // 8 + len(r.twice)] = np.frombuffer(r.twice, dtype=np.uint8)
    return out


def _screened(rows: DataFrame, bits: int) -> DataFrame:
    """The prefixes with ``single``: proven to occur once, and ``under_single``: so is the one a turn shorter."""
    sketch = rows.sparkSession.sparkContext.broadcast(_sketch(rows, bits))

    def proven(depth: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        out = np.zeros(len(depth), dtype=bool)
        for r in range(ROWS):
            cells = _cells(depth, a, b, r, bits)
            out |= (sketch.value[r, cells >> 3] >> (7 - (cells & 7)).astype(np.uint8)) & 1 == 0
        return out

    def screen(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            depth = pdf["depth"].to_numpy()
            single = proven(depth, _unsigned(pdf["a"]), _unsigned(pdf["b"]))
            under = proven(depth - 1, _unsigned(pdf["a0"]), _unsigned(pdf["b0"])) & (depth > 1)
            yield pdf.assign(single=single, under_single=under)

    return rows.mapInPandas(screen, f"{_PREFIX}, single boolean, under_single boolean")


def _joined_digests(ends: DataFrame) -> DataFrame:
    """SHA-256 of the comma-joined ascending ids (``conv_id``) of each node (``depth``, ``a``, ``b``)."""

    def blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, first, held, size = None, 0, [], 0
        for pdf in batches:
            out = []
            for d, a, b, i in zip(pdf["depth"].tolist(), pdf["a"].tolist(), pdf["b"].tolist(), pdf["conv_id"].tolist()):
                if held and (key != (d, a, b) or size >= _IDS):
                    out.append((*key, first, ",".join(held)))
                    held, size = [], 0
                if not held:
                    key, first = (d, a, b), i
                held.append(str(i))
                size += len(held[-1]) + 1
            yield pd.DataFrame(out, columns=[*_KEY, "first", "ids"])
        if held:
            yield pd.DataFrame([(*key, first, ",".join(held))], columns=[*_KEY, "first", "ids"])

    def chain(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, digest = None, None
        for pdf in batches:
            out = []
            for d, a, b, ids in zip(pdf["depth"].tolist(), pdf["a"].tolist(), pdf["b"].tolist(), pdf["ids"]):
                if key == (d, a, b):
                    digest.update(b"," + ids.encode())
                    continue
                if key is not None:
                    out.append((*key, digest.hexdigest()))
                key, digest = (d, a, b), hashlib.sha256(ids.encode())
            yield pd.DataFrame(out, columns=[*_KEY, "ends_sha256"])
        if key is not None:
            yield pd.DataFrame([(*key, digest.hexdigest())], columns=[*_KEY, "ends_sha256"])

    order = [*_KEY, "conv_id"]
    cut = ends.select(*order).repartitionByRange(*order).sortWithinPartitions(*order).mapInPandas(blocks, "depth bigint, a bigint, b bigint, first bigint, ids string")
    together = cut.repartition(*_KEY).sortWithinPartitions(*_KEY, "first")
    return together.mapInPandas(chain, "depth bigint, a bigint, b bigint, ends_sha256 string")


def trie(rows: DataFrame, members: DataFrame) -> DataFrame:
    """Nodes of the conversations' beginnings.

    ``rows``: prefixes with ``len``, the length of their conversation;
    ``members``: conv_id and len of every conversation. For each node: its
    smallest member and depth, its parent's smallest member, the numbers of
    members, children and childless nodes below or at it, the bytes that
    keeping each node's last text below or at it only once would save, and the
    SHA-256 of the ids of the members that end in it.
    """
    spark = rows.sparkSession
    rows = durable(rows.select(*[c.split()[0] for c in _PREFIX.split(", ")]), "prefixes")
    bits = min(CELL_BITS, max(10, (CELLS_EACH * max(1, rows.count()) - 1).bit_length()))
    screened = durable(_screened(rows, bits), "prefixes-screened")
    shared, single = screened.where(~F.col("single")), screened.where("single")
    ends_here = F.col("depth") == F.col("len")

    owners = durable(
        shared.groupBy(*_KEY).agg(F.min("conv_id").alias("owner"), F.count(F.lit(1)).alias("n"), F.count(F.when(ends_here, 1)).alias("n_ends")),
        "node-owners",
    )
    # The deepest node of each conversation that belongs to another, and whether it ends in a leaf of its own.
    mine = F.col("owner") == F.col("conv_id")
    seen = shared.join(owners, _KEY).select(
        "conv_id",
        F.when(~mine, F.struct("depth", "total")).alias("other"),
        F.when(ends_here & mine & (F.col("n") == F.col("n_ends")), 1).otherwise(0).alias("leaf"),
    )
    alone = single.where(ends_here).select("conv_id", F.lit(None).cast("struct<depth: bigint, total: bigint>").alias("other"), F.lit(1).alias("leaf"))
    zero = F.lit(0).cast("bigint")
    paths = durable(
        seen.unionByName(alone)
        .groupBy("conv_id")
        .agg(F.max("other").alias("other"), F.max("leaf").alias("leaf"))
        .select("conv_id", F.coalesce("other.depth", zero).alias("until"), F.coalesce("other.total", zero).alias("until_total"), "leaf"),
        "conversation-paths",
    )

    def counted(condition: Column) -> Column:
        return F.count(F.when(condition, 1))

    nodes = durable(
        shared.join(paths, "conv_id")
        .groupBy(*_KEY)
        .agg(
            F.min("conv_id").alias("conv_id"),
            F.first("a0").alias("a0"),
            F.first("b0").alias("b0"),
            F.first("under_single").alias("under_single"),
            F.count(F.lit(1)).alias("n_convs"),
            counted((F.col("len") > F.col("depth")) & (F.col("until") <= F.col("depth"))).alias("n_children"),
            F.sum("leaf").alias("n_leaves"),
            F.sum(F.when(F.col("until") >= F.col("depth"), F.col("until_total") - F.col("total") + F.col("size")).otherwise(zero)).alias("saved_tokens"),
            counted(ends_here).alias("n_ends"),
            F.max(F.when(ends_here, F.col("conv_id"))).alias("last_end"),
        ),
        "shared-nodes",
    )

    top = members.agg(F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("conv_id"), counted(F.col("len") == 0).alias("n_ends"), F.max(F.when(F.col("len") == 0, F.col("conv_id"))).alias("last_end")).first()
    if not top.n_convs:
        return spark.createDataFrame([], NODE)
    below = paths.agg(counted(F.col("until") == 0).alias("n_children"), F.sum("leaf").alias("n_leaves"), F.sum("until_total").alias("saved_tokens")).first()
    root = small_frame(
        spark,
        [(top.conv_id, 0, 0, 0, None, False, top.n_convs, below.n_children, below.n_leaves or 1, below.saved_tokens or 0, top.n_ends, top.last_end)],
        "conv_id bigint, depth bigint, a bigint, b bigint, parent_conv_id bigint, under_single boolean, n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, n_ends bigint, last_end bigint",
    )

    # Digests of the nodes in which two or more end; the others need no list.
    several = nodes.where("n_ends > 1").select(*_KEY)
    ends = shared.where(ends_here).join(several, _KEY, "left_semi").select(*_KEY, "conv_id")
    if top.n_ends > 1:
        ends = ends.unionByName(members.where("len = 0").select(zero.alias("depth"), zero.alias("a"), zero.alias("b"), "conv_id"))
    digests = _joined_digests(ends)
    digest = F.coalesce("ends_sha256", F.sha2(F.coalesce(F.when(F.col("n_ends") == 1, F.col("last_end")).cast("string"), F.lit("")), 256)).alias("ends_sha256")

    # A parent that is no proven singleton was grouped; a proven one belongs to the same conversation.
    parents = owners.select((F.col("depth") + 1).alias("depth"), F.col("a").alias("a0"), F.col("b").alias("b0"), F.col("owner").alias("parent_conv_id"))
    one = F.lit(1).cast("bigint")
    tails = single.select(
        "conv_id", *_KEY, "a0", "b0", "under_single", one.alias("n_convs"), F.when(ends_here, zero).otherwise(one).alias("n_children"), one.alias("n_leaves"), zero.alias("saved_tokens"),
        F.when(ends_here, one).otherwise(zero).alias("n_ends"), F.col("conv_id").alias("last_end"),
    )
    grouped = nodes.join(digests, _KEY, "left")
    local = tails.where("under_single or depth = 1")
    linked = tails.where("not under_single and depth > 1").withColumn("ends_sha256", F.lit(None).cast("string")).unionByName(grouped).join(parents, ["depth", "a0", "b0"], "left")
    own_parent = F.when(F.col("depth") == 1, F.lit(top.conv_id)).when(F.col("under_single"), F.col("conv_id"))
    columns = [c.split()[0] for c in NODE.split(", ")]
    return (
        linked.withColumn("parent_conv_id", F.coalesce(own_parent, "parent_conv_id")).withColumn("ends_sha256", digest)
        .select(*columns)
        .unionByName(local.withColumns({"parent_conv_id": own_parent, "ends_sha256": F.lit(None).cast("string")}).withColumn("ends_sha256", digest).select(*columns))
        .unionByName(root.join(digests.where("depth = 0"), _KEY, "left").withColumn("ends_sha256", digest).select(*columns))
    )


#: The trie of conversations whose first turns come from others, in SQL: crc32 and all prefixes are spelled out.
TRIE_SQL = """
WITH ids AS (SELECT DISTINCT conv_id FROM conversations WHERE conv_id IS NOT NULL),
keys AS (
  SELECT conv_id, xor(list_reduce(
      list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda ch: ascii(ch)::BIGINT)),
      lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384::BIGINT) ELSE x >> 1 END)
    ), 4294967295::BIGINT) % 9 AS h
  FROM ids),
turns AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
originals AS (
  SELECT conv_id, count(*) AS n,
    list(struct_pack(role := role, text := text) ORDER BY turn NULLS FIRST, md5(strlen(role) || ':' || role || text)) AS turns
  FROM turns GROUP BY conv_id),
rebuilt AS (
  SELECT c.conv_id, list_concat(CASE WHEN h > 0 AND b.n > 0 THEN list_slice(b.turns, 1, h) ELSE [] END,
      CASE WHEN c.n > h THEN list_slice(c.turns, h + 1, c.n) ELSE [] END) AS turns
  FROM originals c JOIN keys USING (conv_id) LEFT JOIN originals b ON b.conv_id = c.conv_id - c.conv_id % 5),
prefixes AS (SELECT conv_id, len(turns) AS n, unnest(range(0, len(turns) + 1)) AS depth, turns FROM rebuilt),
nodes AS (
  SELECT depth, CASE WHEN depth > 0 THEN list_slice(turns, 1, depth) ELSE [] END AS p, min(conv_id) AS conv_id, count(*) AS n_convs,
    coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE n = depth), '') AS ends
  FROM prefixes GROUP BY ALL),
linked AS (
  SELECT x.*, y.conv_id AS parent_conv_id
  FROM nodes x LEFT JOIN nodes y ON y.depth = x.depth - 1 AND y.p = CASE WHEN x.depth > 1 THEN list_slice(x.p, 1, x.depth - 1) ELSE [] END),
children AS (
  SELECT depth - 1 AS depth, CASE WHEN depth > 1 THEN list_slice(p, 1, depth - 1) ELSE [] END AS p, count(*) AS n_children
  FROM nodes WHERE depth > 0 GROUP BY ALL),
counted AS (
  SELECT l.*, coalesce(c.n_children, 0) AS n_children,
    CASE WHEN l.depth > 0 THEN (l.n_convs - 1) * strlen(l.p[l.depth].text) ELSE 0 END AS saved
  FROM linked l LEFT JOIN children c ON c.depth = l.depth AND c.p = l.p),
above AS (SELECT unnest(range(0, depth + 1)) AS d, p, n_children, saved FROM counted),
sums AS (
  SELECT d AS depth, CASE WHEN d > 0 THEN list_slice(p, 1, d) ELSE [] END AS p,
    count(*) FILTER (WHERE n_children = 0) AS n_leaves, sum(saved) AS saved_tokens
  FROM above GROUP BY ALL)
SELECT c.conv_id, c.depth, c.parent_conv_id, c.n_convs, c.n_children, s.n_leaves, s.saved_tokens::BIGINT AS saved_tokens, sha256(c.ends) AS ends_sha256
FROM counted c JOIN sums s ON s.depth = c.depth AND s.p = c.p"""

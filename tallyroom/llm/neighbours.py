"""Largest inner products by small-world graphs, one per shard of the vectors.

Vectors are dealt by the hash of their id into shards of about ``shard_rows``.
Each shard is one task's work: a hierarchical navigable small-world graph,
kept as flat arrays (one int32 block of ``links`` neighbours a node and level,
-1 where unused) and written as one row of a table in the shared folder. A
search joins each shard with each block of queries, descends the levels
greedily and widens a beam on the lowest one; the shards' nearest are merged.

Inner products become distances by one more component that gives all vectors
of a shard the same length. Graphs run in single precision, the reported
scores are computed from the original components in double precision.

Equal vectors of a shard are one node: of its ids the smallest that can still
be wanted are returned (``k`` + 1, as a query may be one of them), so many
copies neither split the graph nor hide others. Nodes are inserted, and
queries searched, a batch at a time in lockstep.

Vectors that are null, zero or hold null or non-finite components, and those
whose length is not the commonest one, take no part, neither do null ids. With
fewer than k candidates all are returned. Ties go to the smaller id. Repeated
rows count as copies of the vector with that id; a query's own id is left out.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyroom.sources.durable import durable

SHARD_ROWS = 16384
QUERY_ROWS = 8192  # queries of a block
LINKS = 16  # neighbours a node chooses; it may gather twice as many before they are thinned
BUILD_WIDTH = 64
SEARCH_WIDTH = 192
_BATCH = 256


def _levels(n: int, seed: int = 7) -> np.ndarray:
    """Highest level of each node; a factor of 16 between levels."""
    u = np.random.default_rng(seed).random(n)
    return np.minimum((-np.log(np.maximum(u, 1e-12)) / math.log(16)).astype(np.int64), 6)


def _beam(x: np.ndarray, links: np.ndarray, q: np.ndarray, entry: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Nearest ``width`` nodes to each query on one level: distances and nodes (-1 where none), nearest first.

    All queries go in step: each expands its nearest node not expanded yet and
    stops when that lies beyond its beam.
    """
    m = len(q)
    rows = np.arange(m)
    seen = np.zeros((m, len(x) + 1), dtype=bool)  # the last column stands for -1
    dist = np.full((m, width), np.inf, dtype=np.float32)
    node = np.full((m, width), -1, dtype=np.int32)
    done = np.ones((m, width), dtype=bool)
    start = entry[:, :width]
    ok = start >= 0
    d0 = ((x[start] - q[:, None, :]) ** 2).sum(axis=2)
    d0[~ok] = np.inf
    dist[:, : start.shape[1]], node[:, : start.shape[1]], done[:, : start.shape[1]] = d0, np.where(ok, start, -1), ~ok
    seen[rows[:, None], start] = True
    seen[:, -1] = True
    active = rows
    while len(active):
        waiting = np.where(done[active], np.inf, dist[active])
        best = waiting.argmin(axis=1)
        live = np.isfinite(waiting[np.arange(len(active)), best])
        active, best = active[live], best[live]
        if not len(active):
            break
        done[active, best] = True
        near = links[node[active, best]]
        fresh = ~seen[active[:, None], near]
        seen[active[:, None], near] = True
        d = ((x[near] - q[active][:, None, :]) ** 2).sum(axis=2)
        d[~fresh] = np.inf
        all_d = np.concatenate([dist[active], d], axis=1)
        all_n = np.concatenate([node[active], near.astype(np.int32)], axis=1)
        all_f = np.concatenate([done[active], ~fresh], axis=1)
        keep = np.argpartition(all_d, width - 1, axis=1)[:, :width]
        dist[active] = np.take_along_axis(all_d, keep, axis=1)
        node[active] = np.take_along_axis(all_n, keep, axis=1)
        done[active] = np.take_along_axis(all_f, keep, axis=1)
    order = np.argsort(dist, axis=1, kind="stable")
    dist, node = np.take_along_axis(dist, order, axis=1), np.take_along_axis(node, order, axis=1)
    return dist, np.where(np.isfinite(dist), node, -1)


def _spread(x: np.ndarray, dist: np.ndarray, node: np.ndarray, most: int) -> list[int]:
    """Of candidates, nearest first, those nearer to the base than to any chosen one; the rest fills up."""
    node = node[node >= 0]
    if len(node) <= most:
        return node.tolist()
    apart = ((x[node][:, None, :] - x[node][None, :, :]) ** 2).sum(axis=2)
    chosen: list[int] = []
    least = np.full(len(node), np.inf, dtype=np.float32)
    for i in range(len(node)):
        if dist[i] < least[i]:
            chosen.append(i)
            np.minimum(least, apart[i], out=least)
            if len(chosen) == most:
                break
    taken = set(chosen)
    rest = [i for i in range(len(node)) if i not in taken]
    return node[(chosen + rest)[:most]].tolist()


def build_graph(x: np.ndarray, links: int = LINKS, width: int = BUILD_WIDTH) -> list[np.ndarray]:
    """Neighbour arrays by level, lowest first; level l has a row for every node, -1 filled above its own level."""
    n = len(x)
    level = _levels(n)
    order = np.argsort(-level, kind="stable")  # the top first: each level is complete before the next batch searches it
    graph = [np.full((n + 1, 2 * links), -1, dtype=np.int32) for _ in range(int(level.max(initial=0)) + 1)]
    held = [np.zeros(n + 1, dtype=np.int64) for _ in graph]
    entry = int(order[0]) if n else -1

    def connect(lv: int, a: int, found_d: np.ndarray, found_n: np.ndarray) -> None:
        rows, used = graph[lv], held[lv]
        mine = _spread(x, found_d, found_n, links)
        rows[a, : len(mine)] = mine
        used[a] = len(mine)
        for b in mine:
            if used[b] < 2 * links:
                rows[b, used[b]] = a
                used[b] += 1
                continue
            others = np.append(rows[b], a)
            d = ((x[others] - x[b]) ** 2).sum(axis=1)
            at = np.argsort(d, kind="stable")
            kept = _spread(x, d[at], others[at], links)
            rows[b] = -1
            rows[b, : len(kept)] = kept
            used[b] = len(kept)

    first = min(n, 32)
    for begin in range(0, n, _BATCH):
        batch = order[begin : begin + _BATCH] if begin else order[:first]
        if begin == 0:
            # a seed: every node sees all before it
            for lv in range(len(graph)):
                members = [int(i) for i in batch if level[i] >= lv]
                for k in range(1, len(members)):
                    earlier = np.array(members[:k])
                    d = ((x[earlier] - x[members[k]]) ** 2).sum(axis=1)
                    at = np.argsort(d, kind="stable")
                    connect(lv, members[k], d[at], earlier[at])
            batch = order[first:_BATCH]
        for lo in range(0, len(batch), 64 if begin == 0 else _BATCH):
            part = batch[lo : lo + (64 if begin == 0 else _BATCH)]
            at = np.full((len(part), 1), entry)
            for lv in range(len(graph) - 1, -1, -1):
                here = np.flatnonzero(level[part] >= lv)
                d, found = _beam(x, graph[lv], x[part], at, width if len(here) else 1)
                for k in here:
                    connect(lv, int(part[k]), d[k], found[k])
                at = found[:, : max(1, width // 4)] if len(here) else found[:, :1]
    return graph


def search_graph(x: np.ndarray, graph: list[np.ndarray], q: np.ndarray, width: int) -> np.ndarray:
    """Nearest nodes of each query (-1 where fewer), nearest first."""
    entry = int(np.argsort(-_levels(len(x)), kind="stable")[0])
    at = np.full((len(q), 1), entry)
    for lv in range(len(graph) - 1, 0, -1):
        at = _beam(x, graph[lv], q, at, 8)[1]
    return _beam(x, graph[0], q, at, min(width, max(1, len(x))))[1]


def _flat(x: np.ndarray) -> np.ndarray:
    """Unit-free copy in single precision with the component that makes all lengths equal."""
    x = x / max(np.sqrt((x * x).sum(axis=1)).max(initial=0.0), 1e-300)
    rest = np.sqrt(np.maximum(0.0, 1.0 - (x * x).sum(axis=1)))
    return np.ascontiguousarray(np.column_stack([x, rest]).astype(np.float32))


def _matrix(rows: pd.Series) -> np.ndarray:
    return np.stack(rows.to_numpy()).astype(np.float64)


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``(vec_id, v)`` of the rows that take part, components as doubles."""
    v = F.col("v")
    sound = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))) & F.exists(v, lambda c: c != 0)
    rows = vectors.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v")).where(
        F.col("vec_id").isNotNull() & v.isNotNull() & sound
    )
    size = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.col("count").desc(), "d").first()
    return rows.where(F.size("v") == (size.d if size else 0))


def index(rows: DataFrame, k: int, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """One row per shard: number of nodes, their vectors, ids and neighbour arrays, as bytes."""
    shards = max(1, math.ceil(rows.count() / shard_rows))

    def build(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("vec_id")
        x = _matrix(pdf["v"]) + 0.0  # -0.0 and 0.0 are equal
        distinct, node = np.unique(x, axis=0, return_inverse=True)
        ids = pd.DataFrame({"node": node.ravel(), "id": pdf["vec_id"].to_numpy()}).drop_duplicates()
        ids = ids.groupby("node").head(k + 1).sort_values(["node", "id"], kind="stable")
        ends = np.searchsorted(ids["node"].to_numpy(), np.arange(len(distinct)), side="right")
        graph = build_graph(_flat(distinct))
        return pd.DataFrame(
            {
                "shard": [key[0]],
                "n": [len(distinct)],
                "vectors": [distinct.tobytes()],
                "ids": [ids["id"].to_numpy(np.int64).tobytes()],
                "ends": [ends.astype(np.int64).tobytes()],
                "links": [[g.tobytes() for g in graph]],
            }
        )

    return durable(
        rows.withColumn("shard", F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int"))
        .groupBy("shard")
        .applyInPandas(build, "shard int, n bigint, vectors binary, ids binary, ends binary, links array<binary>"),
        "graphs",
    )


def nearest(
    vectors: DataFrame,
    is_query: Column,
    k: int = 20,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    shard_rows: int = SHARD_ROWS,
    query_rows: int = QUERY_ROWS,
    width: int = SEARCH_WIDTH,
) -> DataFrame:
    """The ``k`` nearest of each query (``is_query``, on ``vec_id``): ``query_id``, ``rank``, ``vec_id``, ``score``."""
    rows = usable(vectors, id_col, vector_col)
    graphs = index(rows, k, shard_rows)
    queries = rows.where(is_query).dropDuplicates(["vec_id"]).select(F.col("vec_id").alias("query_id"), "v")
    blocks = max(1, math.ceil(queries.count() / query_rows))
    asked = queries.withColumn("block", F.pmod(F.xxhash64("query_id"), F.lit(blocks)).cast("int")).withColumn(
        "shard", F.explode(F.sequence(F.lit(0), F.lit(max(0, graphs.agg(F.max("shard").alias("s")).first().s or 0))))
    )
    served = graphs.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def search(graph: pd.DataFrame, q: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        if graph.empty or q.empty:
            return empty
        g = graph.iloc[0]
        n = int(g["n"])
        x = np.frombuffer(g["vectors"], dtype=np.float64).reshape(n, -1)
        ids, ends = np.frombuffer(g["ids"], dtype=np.int64), np.frombuffer(g["ends"], dtype=np.int64)
        begins = np.append(0, ends[:-1])
        links = [np.frombuffer(b, dtype=np.int32).reshape(n + 1, -1) for b in g["links"]]
        flat, parts = _flat(x), []
        for lo in range(0, len(q), _BATCH):
            part = q.iloc[lo : lo + _BATCH]
            original = _matrix(part["v"])
            unit = original / np.sqrt((original**2).sum(axis=1, keepdims=True))
            found = search_graph(flat, links, np.column_stack([unit, np.zeros(len(unit))]).astype(np.float32), max(width, k + 1))
            for own, vector, nodes in zip(part["query_id"], original, found):
                nodes = nodes[nodes >= 0]
                products = (x[nodes] * vector).sum(axis=1)
                times = ends[nodes] - begins[nodes]
                hit = np.concatenate([ids[begins[i] : ends[i]] for i in nodes]) if len(nodes) else np.empty(0, np.int64)
                value = np.repeat(products, times)
                other = hit != own
                hit, value = hit[other], value[other]
                at = np.lexsort((hit, -value))[:k]
                parts.append(pd.DataFrame({"query_id": own, "vec_id": hit[at], "score": value[at]}))
        return pd.concat(parts) if parts else empty

    found = asked.groupBy("shard", "block").cogroup(served.groupBy("shard", "block")).applyInPandas(
        lambda q, g: search(g, q), "query_id bigint, vec_id bigint, score double"
    )
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
    )

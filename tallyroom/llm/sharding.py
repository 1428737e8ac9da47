"""Deal documents to shards of near equal bytes, equal texts together.

Longest processing time first: groups go, by falling size, to the shard with
the least load, kept in a heap. A table has as many groups as texts, so the
heap does not see them one by one: a group of at least 1/``units`` of all
bytes stands for itself (there are at most ``units`` such groups), and the
smaller ones are bundled by the hash of their text into ``units`` bundles, so
at most twice ``units`` sizes reach the driver, whatever the input. A bundle
holds about 1/``units`` of the bytes, which bounds how far shards differ.

Group sizes are summed before the shuffle, so a text that a third of the rows
repeat is one row per task. Null and empty texts are one group. Ties go by the
group's digest. Repeated rows are rows of their own. No rows, no result.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyroom.operators.ranking import _AT, _run
from tallyroom.sources.durable import durable, small_frame

ROW_BYTES = 8  # counted for each row besides its text
UNITS_PER_SHARD = 1024


def longest_first(sizes: list[tuple[int, str]], shards: int) -> dict[str, int]:
    """Shard of each ``(size, name)``, by falling size to the least load."""
    heap = [(0, s) for s in range(shards)]
    out = {}
    for size, name in sorted(sizes, key=lambda x: (-x[0], x[1])):
        load, shard = heap[0]
        heapq.heapreplace(heap, (load + size, shard))
        out[name] = shard
    return out


def deal(
    docs: DataFrame, shards: int = 24, id_col: str = "doc_id", text_col: str = "text", units_per_shard: int = UNITS_PER_SHARD
) -> DataFrame:
    """One row per document: id, ``size``, ``text_crc32``, ``shard`` and its gapless ``slot`` there."""
    spark, units = docs.sparkSession, shards * units_per_shard
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = durable(
        docs.select(
            F.col(id_col).alias("id"),
            (F.octet_length(text) + ROW_BYTES).cast("bigint").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.sha2(text, 256).alias("group"),
        ),
        "shard-rows",
    ).withColumn("bundle", F.pmod(F.xxhash64("group"), F.lit(units)))
    total = rows.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("n")).first().n
    groups = durable(rows.groupBy("group", "bundle").agg(F.sum("size").alias("size")), "shard-groups")
    is_large = F.col("size") * units >= total
    large = groups.where(is_large).select("size", F.col("group").alias("name")).collect()  # at most `units`
    bundles = (
        groups.where(~is_large).groupBy("bundle").agg(F.sum("size").alias("size"))
        .select("size", F.col("bundle").cast("string").alias("name")).collect()  # at most `units`
    )
    place = longest_first([(r["size"], r["name"]) for r in large + bundles], shards)
    alone = small_frame(spark, [(r["name"], place[r["name"]]) for r in large], "group string, own int")
    shared = small_frame(spark, [(int(r["name"]), place[r["name"]]) for r in bundles], "bundle bigint, with_others int")
    dealt = (
        rows.join(F.broadcast(alone), "group", "left")
        .join(F.broadcast(shared), "bundle", "left")
        .select("id", "size", "text_crc32", F.coalesce("own", "with_others").alias("shard"))
    )
    # slots: the rows of a shard in the written order, counted per partition first
    runs = durable(dealt.withColumn(_AT, F.monotonically_increasing_id()), "shard-dealt").withColumn("run", _run())
    counts = runs.groupBy("run", "shard").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("run", "shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    inside = Window.partitionBy("run", "shard").orderBy(_AT)
    return (
        runs.withColumn("at", F.row_number().over(inside) - 1)
        .join(offsets, ["run", "shard"])
        .select(F.col("id").alias(id_col), "size", "text_crc32", "shard", (F.col("at") + F.col("before")).alias("slot"))
    )

"""Mix sources to target weights by weighted fair queueing.

Each source's documents stand in a shuffled order (md5 of seed and id), and
stand in it twice, as a document may be taken up to twice. The virtual finish
time of an entry is the source's running number of words up to and with it,
divided by the source's target: all sources reach their target at time 1. The
entries are then sorted by finish time over the whole table and taken up to
the total budget.

Running totals never gather a source in one task: rows are range-partitioned
and sorted, sums per partition give each partition's offset, and a window runs
inside each partition only. All of it is DataFrame operations.

Null text: size 0. Null source: a source of its own, after all others. Empty
documents take no part (taken 0); a source of nothing else has target 0. Repeated rows count each; entries with equal
id are ordered by size. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyroom.llm.frames import WORD, small_side
from tallyroom.operators.ranking import _run, sorted_runs
from tallyroom.sources.durable import durable

WEIGHTS = (3, 1, 2)  # by rank of the source, repeating
SHARE = 1.5  # words of the mix per word of the input
REPEATS = 2  # times a document may be taken
SEED = "mix-1"


def _offsets(runs: DataFrame, value: str) -> DataFrame:
    """Sum of ``value`` in each sorted partition and in those before it."""
    sums = runs.groupBy(_run().alias("run")).agg(F.sum(value).alias("in_run"))
    before = Window.orderBy("run").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    return sums.withColumn("before", F.coalesce(F.sum("in_run").over(before), F.lit(0)))


def running_total(df: DataFrame, order: list[Column | str], value: str, out: str) -> DataFrame:
    """Add the sum of ``value`` over all rows up to and with this one in ``order``."""
    runs = sorted_runs(df, order, "mix-runs").withColumn("run", _run())
    inside = Window.partitionBy("run").orderBy("_at")
    return (
        runs.withColumn(out, F.sum(value).over(inside))
        .join(F.broadcast(_offsets(runs, value).select("run", "before")), "run")  # one row per partition
        .withColumn(out, F.col(out) + F.col("before"))
        .drop("run", "before", "_at")
    )


def source_targets(
    sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, repeats: int = REPEATS
) -> DataFrame:
    """Target of each ``(source, source_size)``; one row per source.

    Water filling: with sources in order of their limit per weight, the level
    after the first i are full is (budget - their limits) / (weight left); the
    level reached is the largest of these.
    """
    ordered = Window.orderBy(F.col("source").asc_nulls_last())
    place = (F.row_number().over(ordered) - 1) % len(weights)
    by_limit = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    earlier, all_rows = by_limit.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    none_yet = lambda c: F.coalesce(F.sum(c).over(earlier), F.lit(0))
    level = (F.lit(share) * F.sum("source_size").over(all_rows) - F.lit(float(repeats)) * none_yet("source_size")) / (
        F.sum("weight").over(all_rows) - none_yet("weight")
    )
    return (
        sizes.withColumn("weight", F.element_at(F.array(*[F.lit(w) for w in weights]), place + 1))
        .withColumn("level", level)
        .withColumn("target", F.least(F.lit(float(repeats)) * F.col("source_size"), F.col("weight") * F.max("level").over(all_rows)))
        .select("source", "source_size", "target")
    )


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    share: float = SHARE,
    repeats: int = REPEATS,
    seed: str = SEED,
) -> DataFrame:
    """One row per document: id, ``size``, ``source_size``, ``target`` and the words ``taken``."""
    sized = durable(
        docs.select(
            F.col(id_col).alias("id"),
            F.col(source_col).alias("source"),
            F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("bigint").alias("size"),
            F.md5(F.concat(F.lit(seed + "|"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))).alias("place"),
        ),
        "mix-sized",
    )
    totals = durable(sized.groupBy("source").agg(F.sum("size").alias("source_size")), "mix-sources")
    targets = durable(source_targets(totals, weights, share, repeats), "mix-targets")
    earlier = Window.orderBy(F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    starts = durable(
        targets.withColumn("start", F.coalesce(F.sum("source_size").over(earlier), F.lit(0))).withColumnRenamed("source", "_source"),
        "mix-starts",
    )
    order = [F.col("source").asc_nulls_last(), "place", "size"]
    placed = running_total(sized, order, "size", "upto")
    queued = durable(
        placed.join(small_side(starts), F.col("source").eqNullSafe(F.col("_source")))
        .select("id", "source", "size", "place", "source_size", "target", (F.col("upto") - F.col("start")).alias("upto")),
        "mix-queued",
    )

    def finish(copy: Column) -> Column:
        """Virtual finish time of the entry's n-th standing in the queue; null in a source without words."""
        return (F.col("upto") + F.col("source_size") * copy) / F.nullif(F.col("target"), F.lit(0.0))

    key = ["finish", "source", "place", "size", "copy"]
    entries = (
        queued.where(F.col("size") > 0)
        .select("source", "place", "size", "upto", "source_size", "target", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))).alias("copy"))
        .withColumn("finish", finish(F.col("copy")))
    )
    sort = ["finish", F.col("source").asc_nulls_first(), "place", "size", "copy"]
    runs = sorted_runs(entries.select(*key), sort, "mix-finish").withColumn("run", _run())
    budget = F.lit(share) * F.lit(totals.agg(F.coalesce(F.sum("source_size"), F.lit(0)).alias("n")).first().n)
    offsets = _offsets(runs, "size")
    # the partition in which the budget runs out, and in it the last entry that still fits
    at = offsets.where((F.col("before") <= budget) & (F.col("before") + F.col("in_run") > budget)).orderBy("run").first()
    taken = F.lit(repeats) * F.col("size")
    if at is not None:
        upto = F.sum("size").over(Window.partitionBy("run").orderBy("_at"))
        last = (
            runs.where(F.col("run") == at.run)
            .withColumn("sum", upto + F.lit(at.before))
            .where(F.col("sum") > budget)
            .orderBy("_at")
            .first()
        )
        kinds = dict(runs.dtypes)
        stop = F.struct(*[F.lit(last[k]).cast(kinds[k]).alias(k) for k in key])
        taken = sum(
            F.when(
                F.struct(finish(F.lit(c)).alias("finish"), "source", "place", "size", F.lit(c).alias("copy")) < stop, F.col("size")
            ).otherwise(0)
            for c in range(repeats)
        )
    return queued.select(
        F.col("id").alias(id_col),
        "size",
        "source_size",
        "target",
        F.when(F.col("size") > 0, taken).otherwise(0).cast("bigint").alias("taken"),
    )


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with each row as often as the mix takes it, columns unchanged.

    Rows of equal id and size are taken equally often (as the least taken).
    Columns may have any names: the rows travel as one struct.
    """
    taken = mix(docs, id_col, text_col, **options).where(F.col("taken") > 0)
    times = taken.groupBy(F.col(id_col).alias("_id"), F.col("size").alias("_size")).agg(F.min(F.col("taken") / F.col("size")).cast("int").alias("times"))
    rows = docs.select(F.struct("*").alias("row"), F.col(id_col).alias("id"), F.regexp_count(F.col(text_col), F.lit(WORD)).cast("bigint").alias("size"))
    chosen = rows.join(small_side(durable(times, "mix-times")), F.col("id").eqNullSafe(F.col("_id")) & (F.col("size") == F.col("_size")))
    return chosen.select("row", F.explode(F.sequence(F.lit(1), "times"))).select("row.*")


MIX_SQL = f"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
         md5('{SEED}|' || doc_id::VARCHAR) AS place
  FROM documents),
totals AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighed AS (
  SELECT source, source_size,
         [{', '.join(map(str, WEIGHTS))}][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(WEIGHTS)} + 1)::INT] AS weight
  FROM totals),
filled AS (
  SELECT source, source_size, weight,
         ({SHARE}::DOUBLE * (sum(source_size) OVER ())::DOUBLE
           - {REPEATS}::DOUBLE * (coalesce(sum(source_size) OVER w, 0))::DOUBLE)
         / (sum(weight) OVER () - coalesce(sum(weight) OVER w, 0))::DOUBLE AS level
  FROM weighed
  WINDOW w AS (ORDER BY source_size::DOUBLE / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
targets AS (
  SELECT source, source_size, least({REPEATS}::DOUBLE * source_size, weight * max(level) OVER ()) AS target FROM filled),
queued AS (
  SELECT s.doc_id, s.source, s.size, s.place, t.source_size, t.target,
         sum(s.size) OVER (PARTITION BY s.source ORDER BY s.place, s.size ROWS UNBOUNDED PRECEDING) AS upto
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
entries AS (
  SELECT *, (upto + source_size * copy)::DOUBLE / target AS finish
  FROM queued, (SELECT unnest(range({REPEATS})) AS copy) WHERE size > 0),
summed AS (
  SELECT doc_id, size, sum(size) OVER (ORDER BY finish, source NULLS FIRST, place, size, copy ROWS UNBOUNDED PRECEDING) AS total
  FROM entries),
mixed AS (
  SELECT doc_id, sum(size) AS taken FROM summed WHERE total <= {SHARE} * (SELECT sum(size) FROM sized) GROUP BY doc_id)
SELECT q.doc_id, q.size, q.source_size, q.target, coalesce(m.taken, 0)::BIGINT AS taken
FROM queued q LEFT JOIN mixed m USING (doc_id)"""

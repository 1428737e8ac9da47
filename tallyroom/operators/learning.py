"""Preparation of training data: guards, fingerprint, split, numbers and text."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, Normalizer, SQLTransformer
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyroom.functions.exprs import hash_part, row_md5
from tallyroom.functions.text import is_pair, some_pairs, with_pairs, words
from tallyroom.operators.selection import extent_columns, extent_of, extents, nth_of_ties, order_key, quantiles, spots
from tallyroom.sources.durable import small_frame


class TrainingRefused(RuntimeError):
    """The training data does not meet the minimum requirements."""


def guard_facts(df: DataFrame, label: str = "satisfied") -> DataFrame:
    """One row: number of rows, of label values and of positives, and their share."""
    value = F.col(label)
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.countDistinct(value).alias("n_classes"),
        F.coalesce(F.sum(value.cast("bigint")), F.lit(0)).alias("n_positive"),
        F.avg(value.cast("double")).alias("positive_share"),
    )


def guard(df: DataFrame, label: str = "satisfied", min_rows: int = 50_000) -> int:
    """Refuse small or one-sided training data; returns the number of rows."""
    facts = guard_facts(df, label).first()
    if facts.n_rows < min_rows:
        raise TrainingRefused(f"only {facts.n_rows} rows, at least {min_rows} are needed")
    if facts.n_classes != 2:
        raise TrainingRefused(f"{label} must hold exactly two classes, found {facts.n_classes}")
    return facts.n_rows


def fingerprint_parts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: row count and sums of two 48-bit slices of each row's MD5.

    Sums do not depend on row order, so no sort is needed, and two tasks can
    be combined in any order.
    """
    hashed = df.select(row_md5(*columns).alias("h"))
    return hashed.agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[
            F.coalesce(F.sum(hash_part(F.col("h"), i).cast("decimal(38,0)")), F.lit(0))
            .cast("decimal(38,0)")
            .alias(f"part{i}")
            for i in (0, 1)
        ],
    )


def fingerprint_by_batch(df: DataFrame, columns: Sequence[str], batch: str = "_batch_id") -> DataFrame:
    """``batch, n_rows, part0, part1``: what each batch adds to the fingerprint of all.

    Kept with the batches, so that a new fingerprint reads new batches only.
    """
    hashed = df.select(F.col(batch).alias("batch"), row_md5(*columns).alias("h"))
    return hashed.groupBy("batch").agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.sum(hash_part(F.col("h"), i).cast("decimal(38,0)")).cast("decimal(38,0)").alias(f"part{i}") for i in (0, 1)],
    )


def add_new_batches(known: DataFrame, df: DataFrame, columns: Sequence[str], batch: str = "_batch_id") -> DataFrame:
    """The parts of all batches: those ``known``, and those of batches in ``df`` that are not; a row per batch."""
    names = [r.batch for r in known.select("batch").collect()]
    new = df.where(~F.coalesce(F.col(batch).isin(names), F.lit(False))) if names else df
    return known.unionByName(fingerprint_by_batch(new, columns, batch))


def combined_fingerprint(parts: DataFrame) -> DataFrame:
    """One row ``n_rows, fingerprint`` of all batches together, equal to :func:`fingerprint` of their rows."""
    zero = F.lit(0).cast("decimal(38,0)")
    sums = [F.coalesce(F.sum(f"part{i}").cast("decimal(38,0)"), zero).alias(f"part{i}") for i in (0, 1)]
    return _named(parts.agg(F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_rows"), *sums))


def fingerprint(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row ``n_rows, fingerprint``: equal for equal contents in any order."""
    return _named(fingerprint_parts(df, columns))


def _named(parts: DataFrame) -> DataFrame:
    return parts.select(
        "n_rows",
        F.sha2(
            F.concat_ws("-", *[F.col(c).cast("string") for c in ("n_rows", "part0", "part1")]), 256
        ).alias("fingerprint"),
    )


def split_hash(key: str, seed: int) -> Column:
    return hash_part(F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string"))), 0)


def stratified_split(
    df: DataFrame, key: str, label: str, test: float = 0.2, seed: int = 42
) -> DataFrame:
    """Add ``is_test``: in each class the given share of rows, by hash of the key.

    The rows with the lowest hashes are taken, exactly ``round(share * n)`` per
    class. The same rows are drawn again on every run and wherever they lie.
    The hash up to which a class is taken is selected by counting, no row is
    sorted or moved; of rows with that very hash the smaller keys are taken.
    ``df`` is read several times: pass a table or a written frame.
    """
    bucket, kind = split_hash(key, seed), df.schema[key].dataType
    hashed = df.select(F.col(label).alias("label"), F.col(key).alias("key"), bucket.alias("bucket"))
    sizes = hashed.where("label IS NOT NULL").groupBy("label").agg(*extent_columns(F.col("bucket"), [test], "")).collect()
    known = {r.label: extent_of(r, "") for r in sizes}  # one row per class
    last = {v: math.floor(e.n * test + 0.5) - 1 for v, e in known.items()}
    own = {v: F.when(F.col("label") == F.lit(v), F.col("bucket")) for v in known}
    at = {v: found[last[v]] for v, found in spots(hashed, own, known, {v: [r] for v, r in last.items()}).items() if found}
    split = {v: (own[v] == F.lit(s.key), [last[v] - s.below], s.equal) for v, s in at.items() if last[v] + 1 < s.below + s.equal}
    ends = {v: found for (v, _), found in nth_of_ties(hashed, split, "key").items()}
    chosen = F.lit(False)
    for v, s in at.items():
        taken = bucket <= F.lit(s.key)
        if v in ends:
            taken = (bucket < F.lit(s.key)) | ((bucket == F.lit(s.key)) & (F.col(key) <= F.lit(ends[v]).cast(kind)))
        chosen = chosen | ((F.col(label) == F.lit(v)) & taken)
    return df.withColumn("is_test", F.coalesce(chosen, F.lit(False)))


@dataclass(frozen=True)
class NumericScale:
    """Median, mean and population deviation per column, as fitted."""

    median: dict[str, float]
    mean: dict[str, float]
    deviation: dict[str, float]
    center: bool

    def expression(self, column: str) -> str:
        shift = self.mean[column] if self.center else 0.0
        size = self.deviation[column] or 1.0
        return (
            f"(coalesce(cast({column} as double), {self.median[column]!r}D) - {shift!r}D)"
            f" / {size!r}D"
        )

    def stage(self, columns: Sequence[str], prefix: str = "x_") -> SQLTransformer:
        parts = ", ".join(f"{self.expression(c)} AS {prefix}{c}" for c in columns)
        return SQLTransformer(statement=f"SELECT *, {parts} FROM __THIS__")


def medians(df: DataFrame, columns: Sequence[str]) -> dict[str, float]:
    """Exact median of each column over its non-null values; 0 without any."""
    keys = {c: order_key(F.col(c).cast("double"), T.DoubleType()) for c in columns}
    known, _ = extents(df, keys, dict.fromkeys(columns, [0.5]))
    found = quantiles(df, keys, known, [0.5])
    return {c: found[c][0] if c in found else 0.0 for c in columns}


def median_impute(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Replace NULL by the column's median."""
    middle = medians(df, columns)
    return df.withColumns(
        {c: F.coalesce(F.col(c).cast("double"), F.lit(middle[c])) for c in columns}
    )


def fit_scale(df: DataFrame, columns: Sequence[str], *, center: bool) -> NumericScale:
    """Medians, then mean and population deviation of the filled columns."""
    middle = medians(df, columns)
    filled = {c: F.coalesce(F.col(c).cast("double"), F.lit(middle[c])) for c in columns}
    facts = df.agg(
        *[F.avg(v).alias(f"mean_{c}") for c, v in filled.items()],
        *[F.stddev_pop(v).alias(f"dev_{c}") for c, v in filled.items()],
    ).first()
    return NumericScale(
        middle,
        {c: facts[f"mean_{c}"] or 0.0 for c in columns},
        {c: facts[f"dev_{c}"] or 0.0 for c in columns},
        center,
    )


def scale(df: DataFrame, columns: Sequence[str], center: bool) -> DataFrame:
    """Impute and scale in place: by population deviation, optionally centred."""
    fitted = fit_scale(df, columns, center=center)
    return df.withColumns({c: F.expr(fitted.expression(c)) for c in columns})


def with_terms(df: DataFrame, text: str, out: str = "terms", ngrams: tuple[int, int] = (1, 2)) -> DataFrame:
    """Add the terms of a text: its words and, for (1, 2), neighbouring pairs."""
    if ngrams not in ((1, 1), (1, 2)):
        raise ValueError("ngrams must be (1, 1) or (1, 2)")
    listed = df.withColumn(out, words(F.coalesce(F.col(text), F.lit(""))))
    return listed.withColumn(out, with_pairs(F.col(out))) if ngrams == (1, 2) else listed


def term_counts(df: DataFrame, terms: str = "terms") -> DataFrame:
    """``term, n_total, n_docs`` over all documents.

    Every term of a document comes first, then every distinct one; both counts
    come from one map-side combined shuffle on the term, so a term found
    everywhere is one partial row per task; (document, term) pairs are never
    shuffled.
    """
    n = F.size(terms)
    marked = df.select(terms, n.alias("n")).select("n", F.posexplode(F.concat(F.col(terms), F.array_distinct(terms))).alias("at", "term"))
    total = F.count(F.when(F.col("at") < F.col("n"), 1))
    return marked.groupBy("term").agg(total.alias("n_total"), (F.count(F.lit(1)) - total).alias("n_docs"))


def _most_frequent(counts: DataFrame, max_features: int, min_df: int) -> DataFrame:
    return counts.where(F.col("n_docs") >= min_df).orderBy(F.col("n_total").desc(), F.col("term").asc()).limit(max_features)


def vocabulary(
    df: DataFrame, terms: str = "terms", max_features: int = 500, min_df: int = 5, ngrams: tuple[int, int] | None = None
) -> DataFrame:
    """The most frequent terms found in at least ``min_df`` documents.

    Ties at the cut go to the smaller term. At most ``max_features`` rows.
    ``terms`` is as :func:`with_terms` makes it, or holds just the words where
    ``ngrams`` says what to count. It is read twice: words are counted first,
    then only pairs that can still be among the most frequent. A pair is found
    no more often than either of its words and sorts after the first, so its
    first word is among the most frequent itself, its second counts as much
    as the last of them or more.
    """
    word_lists = df.select(F.col(terms) if ngrams else F.filter(terms, lambda t: ~is_pair(t)).alias(terms))
    known = _most_frequent(term_counts(word_lists, terms), 4 * max_features + 1, min_df).collect()
    best, spark = known[:max_features], df.sparkSession
    found = small_frame(spark, [(r.term, r.n_total, r.n_docs) for r in best], "term string, n_total bigint, n_docs bigint")
    if not best or ngrams == (1, 1):
        return found
    least = best[-1].n_total if len(best) == max_features else 0
    second = [r.term for r in known if r.n_total >= least]
    if len(second) > 4 * max_features:  # a tie of more words than were read
        second = None
    pairs = word_lists.select(some_pairs(F.col(terms), [r.term for r in best], second).alias(terms))
    return _most_frequent(found.unionByName(term_counts(pairs, terms)), max_features, min_df)


def smooth_idf(n_docs: Column, n: Column) -> Column:
    return F.log((n + 1) / (n_docs + 1)) + 1


@dataclass(frozen=True)
class TextWeights:
    """Vocabulary in term order with its inverse document frequencies."""

    terms: list[str]
    idf: list[float]

    def stages(self, terms: str = "terms", out: str = "tfidf") -> list:
        """Count, weight and L2-normalise; each row on its own, no shuffle."""
        counts, weighted = f"{out}_counts", f"{out}_weighted"
        return [
            CountVectorizerModel.from_vocabulary(self.terms, inputCol=terms, outputCol=counts),
            ElementwiseProduct(
                scalingVec=Vectors.dense(self.idf), inputCol=counts, outputCol=weighted
            ),
            Normalizer(p=2.0, inputCol=weighted, outputCol=out),
        ]


def fit_tfidf(
    df: DataFrame, terms: str = "terms", max_features: int = 500, min_df: int = 5, ngrams: tuple[int, int] | None = None
) -> TextWeights:
    """Choose the vocabulary; only its at most ``max_features`` rows are collected. ``ngrams`` as for :func:`vocabulary`."""
    n = df.count()
    chosen = (
        vocabulary(df, terms, max_features, min_df, ngrams)
        .select("term", smooth_idf(F.col("n_docs").cast("double"), F.lit(float(n))).alias("idf"))
        .collect()
    )
    chosen = sorted(chosen, key=lambda r: r.term)
    return TextWeights([r.term for r in chosen], [r.idf for r in chosen])


def tfidf(
    df: DataFrame,
    key: str,
    text: str,
    max_features: int = 500,
    min_df: int = 5,
    ngrams: tuple[int, int] = (1, 2),
) -> DataFrame:
    """``key, term, weight``: L2-normalised smooth TF-IDF in long form."""
    worded = with_terms(df.select(key, text), text, "terms", (1, 1))
    weights = fit_tfidf(worded, "terms", max_features, min_df, ngrams)
    if not weights.terms:
        return worded.select(key, F.lit("").alias("term"), F.lit(0.0).alias("weight")).limit(0)
    # Only terms of the vocabulary go on to the model's stages, which take them as objects.
    halves = [list(dict.fromkeys(t.split(" ")[i] for t in weights.terms if " " in t)) for i in (0, 1)]
    kept = F.filter("terms", lambda t: t.isin(*weights.terms))
    if halves[0]:
        kept = F.concat(kept, F.filter(some_pairs(F.col("terms"), *halves), lambda t: t.isin(*weights.terms)))
    vectors = worded.select(key, kept.alias("terms"))
    for stage in weights.stages():
        vectors = stage.transform(vectors)
    names = F.array(*[F.lit(t) for t in weights.terms])
    # A sparse vector is its index and value arrays; read them as such.
    parts = F.from_json(F.to_json(F.struct("tfidf")), "tfidf struct<indices:array<int>,values:array<double>>")
    listed = vectors.select(key, parts["tfidf"].alias("v")).select(
        key, F.inline(F.arrays_zip("v.indices", "v.values"))
    )
    return listed.select(
        key, F.element_at(names, F.col("indices") + 1).alias("term"), F.col("values").alias("weight")
    )

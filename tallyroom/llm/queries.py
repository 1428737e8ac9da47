"""The registered queries ``opN_<name>``: each applies its operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyroom.llm import language_model, licences, mixing, near_duplicates, neighbours, packing, prefix_trie, quality, repeats, runs, sharding, string_kernel, toxicity
from tallyroom.llm.frames import remainder
from tallyroom.session import configure

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def _query(name: str, sql: str | None = None):
    def add(build):
        QUERIES[name] = lambda spark, sf_dir: build(configure(spark), sf_dir)
        if sql is not None:
            ORACLE[name] = sql
        return build

    return add


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def toxicity_model(docs: DataFrame, labels: DataFrame) -> toxicity.Model:
    return toxicity.fit(docs, labels, remainder(F.col("doc_id"), 5) != 0)


@_query("op1_toxicity")
def toxicity_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.score(docs, toxicity_model(docs, _table(spark, sf_dir, "labels")))
    return scored.select(
        "doc_id",
        (remainder(F.col("doc_id"), 5) == 0).alias("held_out"),
        F.col("toxicity").alias("score"),
        (F.col("toxicity") >= 0.5).cast("int").alias("predicted"),
        "n_hits",
        "n_misspelt",
    )


@_query("op2_nearest_vectors")
def nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, 20)


@_query("op3_best_fit_packing")
def best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.token_pieces(_table(spark, sf_dir, "documents"), tokenizer_path())
    return packing.pack(pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")))


@_query("op4_mix_sources", mixing.MIX_SQL)
def mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents"))


@_query("op5_pair_trie_scores")
def pair_trie_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.score(_table(spark, sf_dir, "documents"), remainder(F.col("doc_id"), 5) == 1)


@_query("op6_language_divergence")
def language_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return quality.judge(docs, quality.references(docs))


@_query("op7_longest_first_shards")
def longest_first_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    dealt = sharding.deal(_table(spark, sf_dir, "documents"), 24)
    return dealt.withColumns({"law": F.lit("bytes"), "grown_shard": F.lit(None).cast("int")})


@_query("op8_min_max_near_duplicates", near_duplicates.GROUPS_SQL)
def min_max_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.near_duplicate_groups(_table(spark, sf_dir, "documents"), width=4)


@_query("op9_interleaved_repeats")
def interleaved_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = repeats.remove_repeats(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return left.select("doc_id", "_left.n_bytes", "_left.n_removed", "_left.n_spans", F.col("_left.sha256").alias("kept_sha256"))


@_query("op10_licence_scan", licences.licence_sql())
def licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.licence_scan(_table(spark, sf_dir, "documents"), parts=True)


def described_runs(docs: DataFrame) -> DataFrame:
    """Count, digest and strongest run of the runs in each text, after some texts were made to go round."""
    found = docs.select("doc_id", runs.runs_of(runs.cycled(F.col("doc_id"), F.col("text"))).alias("found")).select("doc_id", "found.*")
    lines = F.transform("runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n")))
    best = F.col("strongest")
    return found.select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        best["start"].alias("start"),
        best["length"].alias("length"),
        best["period"].alias("period"),
        F.floor(1000 * best["length"] / best["period"]).alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@_query("op13_periodic_runs", runs.RUNS_SQL)
def periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return described_runs(_table(spark, sf_dir, "documents"))


@_query("op12_string_kernel_language")
def string_kernel_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    held_out = remainder(F.col("doc_id"), 5) == 0
    model = string_kernel.fit(docs, ~held_out)
    told = docs.select("doc_id", held_out.alias("held_out"), string_kernel.language_of(spark, model, F.col("text")).alias("found"))
    return told.select("doc_id", "held_out", F.col("found.lang").alias("lang_pred"), F.col("found.score").alias("score"))


@_query("op11_conversation_prefix_trie", prefix_trie.TRIE_SQL)
def conversation_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("conv_id")
    rows = prefix_trie.prefixes(_table(spark, sf_dir, "conversations"))
    return prefix_trie.trie(*prefix_trie.graft(rows, key - key % 5, remainder(key, 9)))

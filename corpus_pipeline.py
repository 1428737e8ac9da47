"""From raw documents to packed token sequences, stage by stage.

Every stage takes ``(spark, docs, sf_dir)`` and works on all documents its
predecessor kept; its result is written as Parquet in the shared folder and
read again for the next. All but the last return the columns of ``documents``.

Nulls, empty texts, repeated rows and empty tables are treated as each
operator states. Rows without an id are kept by the filters, as they cannot be
told apart by id. Other columns, whatever their names, pass through: the rows
travel as one struct.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyroom.llm import mixing, near_duplicates, packing, repeats, toxicity
from tallyroom.llm.queries import tokenizer_path, toxicity_model
from tallyroom.session import configure
from tallyroom.sources.durable import durable

#: Bytes of a repeated passage: what 50 short words take, in whole steps of the merge.
PASSAGE_BYTES = 240


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model, fitted on the labelled ones among them, finds not toxic."""
    configure(spark)
    model = toxicity_model(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = toxicity.score(docs.withColumn("_all", F.struct("*")).select("_all", F.col("text").alias("_text")), model, "_text")
    return scored.where(F.col("toxicity") < 0.5).select("_all.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group, the one with the smallest id."""
    configure(spark)
    return near_duplicates.keep_one(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that stand in the corpus more than once; partly cut characters go too."""
    configure(spark)
    left = repeats.remove_repeats(docs.select(F.struct("*").alias("row"), "text"), length=PASSAGE_BYTES)
    text = F.when(F.col("_left.n_removed") > 0, repeats.as_text(F.col("_left.left"))).otherwise(F.col("text"))
    cut = left.select("row", text.alias("text"))
    new = {"text": F.col("text"), "n_chars": F.length("text").cast("bigint")}
    return cut.select(*(new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    configure(spark)
    return mixing.mixed(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their sequence and place in it."""
    configure(spark)
    pieces = packing.token_pieces(docs, tokenizer_path())
    return packing.pack(pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("repeats", cut_repeats),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

ORACLE_SQL = None  # learned scores, hashing and packing have no SQL form


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents in ``sf_dir``."""
    configure(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = durable(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

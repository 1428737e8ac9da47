"""Score arriving requests and keep an audit row of each."""

from __future__ import annotations

from pyspark.ml import Transformer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallyroom.plans.learning import TrainConfig
from tallyroom.plans.scoring import audit, derive_features, score, validate_requests
from tallyroom.sources.readers import utc_now
from tallyroom.streaming.ingest import batch_name, replace_batch

REQUEST_SCHEMA = (
    "review_comment_message string, delivery_delay_days double, review_comment_length int, "
    "has_comment boolean, payment_type_encoded int"
)


def score_stream(
    spark: SparkSession,
    model: Transformer | None,
    src: str,
    dst: str,
    checkpoint: str,
    *,
    cfg: TrainConfig = TrainConfig(),
    stream_id: str = "stream",
) -> StreamingQuery:
    """Score new JSON-lines files; audit rows go to ``dst/audit``, refused
    requests to ``dst/rejected``, each micro-batch in its own directory.

    A line that is no readable request is refused with its text; every refused
    row names its file.
    """
    if model is None:
        raise LookupError("no model is loaded")
    requests = (
        spark.readStream.schema(f"{REQUEST_SCHEMA}, _corrupt string")
        .option("columnNameOfCorruptRecord", "_corrupt")
        .json(src)
        .select("*", F.col("_metadata.file_name").alias("_source_file"))
        .withColumnRenamed("_corrupt", "text")
    )

    def write(batch: DataFrame, number: int) -> None:
        root, batch_id = dst.rstrip("/"), batch_name(batch, stream_id, number)
        batch.persist()  # read once, written twice
        try:
            valid, rejected = validate_requests(batch.where(F.col("text").isNull()))
            unreadable = batch.where(F.col("text").isNotNull()).withColumn("reason", F.lit("line is no readable request"))
            rejected = rejected.unionByName(unreadable)
            valid = valid.drop("text", "_source_file")
            scored = score(model, derive_features(valid), cfg)
            replace_batch(audit(scored, utc_now()), f"{root}/audit", batch_id)
            replace_batch(rejected, f"{root}/rejected", batch_id)
        finally:
            batch.unpersist()

    return (
        requests.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )

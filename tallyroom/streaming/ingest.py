"""Newly arrived files to bronze, as they come."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tallyroom.sources.readers import CSV_OPTIONS, LINEAGE, blank_cells_kept, text_schema, utc_now
from tallyroom.sources.registry import ENTITIES

_FILES = "path string, modificationTime timestamp, length bigint, content binary"
_CORRUPT = "_corrupt"
FILES_AT_ONCE = 1000  # files of a micro-batch: their names and first lines reach the driver
REFUSED = "_source_file string, reason string, text string, _loaded_at string"


def replace_batch(df: DataFrame, path: str, batch_id: str) -> None:
    """Write one micro-batch into its own ``_batch_id`` directory.

    A replayed micro-batch has the same id and replaces its first attempt, so
    a restart after a failure leaves no duplicates.
    """
    df.drop("_batch_id").write.mode("overwrite").parquet(f"{path.rstrip('/')}/_batch_id={batch_id}")


def batch_name(batch: DataFrame, stream_id: str, number: int) -> str:
    """Name of a micro-batch: the same when it is replayed, different between streams.

    The query's id, which lives as long as its checkpoint, is in it, so two
    streams into one target, or one whose checkpoint was lost, never meet in a
    directory.
    """
    query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    return f"{stream_id}-{query}-{number}"


def quarantine(dst: str) -> str:
    """Where the rows and files that a stream into ``dst`` cannot load are kept."""
    return f"{dst.rstrip('/')}_quarantine"


def _first_lines(spark: SparkSession, paths: list[str]) -> dict[str, list[str]]:
    """The files by their first line; empty files have none."""
    lines = spark.read.text(paths).select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("at"),
        "value",
    )
    # Numbers only are grouped, in a hash table of one entry a file: to group lines they would all be sorted.
    begins = lines.where("start = 0").groupBy("path").agg(F.min("at").alias("at"))
    at = [r["at"] for r in begins.collect()]  # a row per file
    first = lines.where(F.col("at").isin(at)).select("path", F.col("value").alias("line")).collect()
    if len({r.path for r in first}) < len(at):
        raise RuntimeError("files changed while they were read")
    by_line: dict[str, list[str]] = {}
    for r in sorted(first, key=lambda r: r.path):
        by_line.setdefault(r.line, []).append(r.path)
    return by_line


def _read_files(spark: SparkSession, name: str, paths: list[str]) -> tuple[list[DataFrame], list[DataFrame], list[DataFrame]]:
    """Frames to read once, good rows and refused ones of the files of one micro-batch.

    Files are read by their own header, so columns may stand in any order and
    new ones are kept, as in a full load. A file without a column that the
    entity needs is refused as a whole.
    """
    raws, good, bad = [], [], []
    for line, files in _first_lines(spark, paths).items():
        header = spark.read.options(**CSV_OPTIONS).csv(files[0]).columns
        missing = sorted(set(ENTITIES[name].columns) - set(header))
        if missing:
            rows = [(f.rsplit("/", 1)[-1], f"file lacks {missing}", line) for f in files]
            bad.append(spark.createDataFrame(rows, "_source_file string, reason string, text string"))
            continue
        schema = T.StructType([*text_schema(header).fields, T.StructField(_CORRUPT, T.StringType())])
        options = {**CSV_OPTIONS, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}
        raw = spark.read.options(**options).schema(schema).csv(files)
        raw = raw.select(*header, _CORRUPT, F.col("_metadata.file_name").alias("_source_file")).persist()
        raws.append(raw)
        columns = [c for c in header if c not in LINEAGE]
        good.append(raw.where(F.col(_CORRUPT).isNull()).select(*blank_cells_kept(columns), "_source_file"))
        refused = raw.where(F.col(_CORRUPT).isNotNull())
        bad.append(refused.select("_source_file", F.lit("cells do not match the header").alias("reason"), F.rtrim(F.col(_CORRUPT), F.lit("\r\n")).alias("text")))
    return raws, good, bad


def ingest_stream(
    spark: SparkSession,
    name: str,
    src: str,
    dst: str,
    checkpoint: str,
    *,
    stream_id: str = "stream",
    files_at_once: int = FILES_AT_ONCE,
) -> StreamingQuery:
    """Append each new file of a CSV entity once; stops when none is left.

    Rows carry the same lineage columns as a full load; the batch id is the
    stream's name, its query's id and the number of the micro-batch. Rows with
    too many or too few cells, and files without a needed column, go to the
    quarantine table with their text, file and reason; the stream goes on.
    """
    # Only the names of new files pass through the stream; the contents are not read here.
    files = spark.readStream.format("binaryFile").schema(_FILES).option("maxFilesPerTrigger", files_at_once).load(src).select("path")

    def write(batch: DataFrame, number: int) -> None:
        session, now = batch.sparkSession, F.lit(utc_now())
        paths = sorted(r.path for r in batch.collect())  # at most files_at_once
        raws, good, bad = _read_files(session, name, paths) if paths else ([], [], [])
        try:
            at = batch_name(batch, stream_id, number)
            empty = session.createDataFrame([], text_schema([*ENTITIES[name].columns, "_source_file"]))
            rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), good, empty)
            replace_batch(rows.withColumn("_loaded_at", now), dst, at)
            refused = reduce(DataFrame.unionByName, bad, session.createDataFrame([], REFUSED.rsplit(", ", 1)[0]))
            replace_batch(refused.withColumn("_loaded_at", now), quarantine(dst), at)
        finally:
            for raw in raws:
                raw.unpersist()

    return (
        files.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )

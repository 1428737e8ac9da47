"""Cut the lineage of a frame with a table that outlives its executors, and
bring a handful of rows from the driver into a plan."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

import pyarrow as pa
from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

_own_roots: dict[str, str] = {}
_scopes: list[list[str]] = []


def _configured(spark: SparkSession) -> str | None:
    return (
        spark.conf.get("spark.checkpoint.dir", None)
        or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
        or spark.sparkContext.getCheckpointDir()
    )


def shared_root(spark: SparkSession) -> str:
    """Folder for intermediate tables: the session's ``spark.checkpoint.dir``.

    A temporary folder is made only where that setting is missing and the
    session runs in one process, as in tests.
    """
    configured = _configured(spark)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    app = spark.sparkContext.applicationId
    if app not in _own_roots:
        _own_roots[app] = tempfile.mkdtemp(prefix="tallyroom-")
    return _own_roots[app]


def intermediate_path(spark: SparkSession, label: str) -> str:
    """A new folder for something that is needed for a while; see :func:`owned`."""
    path = f"{shared_root(spark)}/{label}-{uuid.uuid4().hex}"
    for scope in _scopes[-1:]:
        scope.append(path)
    return path


@contextmanager
def owned(spark: SparkSession) -> Iterator[None]:
    """Intermediate tables written inside are removed on leaving, also after a failure.

    For work whose results are written elsewhere by then; a frame that still
    reads an intermediate table must not leave the scope.
    """
    _scopes.append([])
    try:
        yield
    finally:
        files = spark._jvm.org.apache.hadoop.fs
        for path in _scopes.pop():
            at = files.Path(path)
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def durable(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    Used before a value that would not survive a second evaluation (range
    partition numbers) and before a frame that several jobs read.
    """
    spark = df.sparkSession
    path = intermediate_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def together(*calls: Callable[[], object]) -> list:
    """Results of calls that run Spark jobs side by side, in their order.

    Cores that one job's last tasks leave idle go to the next. All calls end
    before the first failure is raised.
    """
    inherit = inheritable_thread_target(SparkSession.active())
    with ThreadPoolExecutor(max(1, len(calls))) as threads:
        running = [threads.submit(inherit(call)) for call in calls]
    return [one.result() for one in running]


def small_frame(spark: SparkSession, rows: list[tuple], ddl: str) -> DataFrame:
    """A few rows as a local relation: its size is known to the planner and
    reading it takes no job. For bin edges, offsets and the like."""
    schema = T.StructType.fromDDL(ddl)
    records = [dict(zip(schema.names, row)) for row in rows]
    return spark.createDataFrame(pa.Table.from_pylist(records, schema=to_arrow_schema(schema)), schema)

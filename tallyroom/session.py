"""Session settings the library relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Runtime SQL settings: they can be put on a session that already runs.
SQL_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even where the operator above the join then needs
    # one more shuffle. Without a hot key the plan is unchanged.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Long texts go to Python in batches of rows; keep a batch to some tens of MB.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    # Batch ids are directory names in bronze; "01" must stay "01".
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the SQL settings to a running session and return it."""
    for name, value in SQL_SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def build(app_name: str = "tallyroom", **extra: str) -> SparkSession:
    """Session with the library's settings; the master comes from spark-submit."""
    builder = SparkSession.builder.appName(app_name)
    for name, value in {**SQL_SETTINGS, **extra}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()

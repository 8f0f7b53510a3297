"""Session settings the plans rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

def tuned(builder: SparkSession.Builder) -> SparkSession.Builder:
    """Add the runtime settings to a session builder; sizes stay the cluster's choice."""
    return (
        builder.config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        # Recording the Python line of every expression takes longer than building it.
        .config("spark.sql.dataFrameQueryContext.enabled", "false")
        .config("spark.ui.enabled", "false")
    )

"""Session settings the operators count on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Adaptive execution re-plans joins by measured size and splits hot partitions, also where
# the split costs a further shuffle.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
}


def configured(builder: SparkSession.Builder) -> SparkSession.Builder:
    """Apply the settings; the cluster names ``spark.checkpoint.dir`` and the partition counts itself."""
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder

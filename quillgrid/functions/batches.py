"""The one session setting that batch functions need: how many bytes an Arrow batch may hold."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTING, MOST_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 2 << 20


def bounded(spark: SparkSession, most: int = MOST_BYTES) -> SparkSession:
    """Bounds Arrow batches by bytes, whatever their rows hold. A smaller bound stays, so plans built earlier never see a larger one."""
    now = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(SETTING))
    spark.conf.set(SETTING, str(min(now, most)))
    return spark

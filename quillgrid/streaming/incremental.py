"""Incremental extraction: new manifests become strips to read as they arrive, each read once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillgrid.operators.readings import MANIFEST_TYPE


def pending_stream(spark: SparkSession, manifests: str) -> DataFrame:
    """A stream of (stem, idx, path) from JSON manifest lines in a folder; pages that are not ok are left out."""
    new = spark.readStream.schema(MANIFEST_TYPE).json(manifests)
    return new.where("status = 'ok'").select("stem", F.explode("records").alias("r")).select("stem", F.col("r.index").alias("idx"), F.col("r.strip").alias("path"))


def extract_available(spark: SparkSession, manifests: str, out: str, checkpoint: str, read: Callable[[DataFrame], DataFrame]) -> int:
    """Reads the strips of all manifests that have arrived since the last call and appends them to out; returns the rows there.

    The checkpoint remembers files already seen. A batch that is run again after a failure first drops strips that out
    has, so nothing is read twice.
    """

    def batch(df: DataFrame, _: int) -> None:
        try:
            done = spark.read.parquet(out).where("error IS NULL").select("stem", "idx")
            todo = df.dropDuplicates(["stem", "idx"]).join(done, ["stem", "idx"], "left_anti")
        except Exception as e:  # the first batch has nothing to compare with
            if "PATH_NOT_FOUND" not in str(e):
                raise
            todo = df.dropDuplicates(["stem", "idx"])
        read(todo).write.mode("append").parquet(out)

    query = pending_stream(spark, manifests).writeStream.trigger(availableNow=True).option("checkpointLocation", checkpoint).foreachBatch(batch).start()
    query.awaitTermination()
    return spark.read.parquet(out).count()

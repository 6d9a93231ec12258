"""Tables in the folder that driver and executors share, and batch functions that give memory back."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir as the cluster names it; a temporary folder only where it is unset, as in local tests."""
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = "file://" + tempfile.mkdtemp(prefix="quillgrid-")
    spark.conf.set("spark.checkpoint.dir", folder)
    atexit.register(__import__("shutil").rmtree, folder[7:], True)
    return folder


def tidy(run):
    """run, a batch function, giving freed memory back to the system at its end: Spark keeps the worker for later tasks."""

    def inner(batches):
        try:
            yield from run(batches)
        finally:
            import ctypes
            import gc

            import pyarrow as pa

            gc.collect()
            pa.default_memory_pool().release_unused()
            try:
                ctypes.CDLL(None).malloc_trim(0)
            except (AttributeError, OSError):  # another C library
                pass

    return inner


class Tables:
    """Parquet tables of one query, which cut its lineage and outlive any executor.

    A result may be read long after its query was built, so tables that it may read belong to the application: they go when it ends.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.root, self.n = spark, f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex[:12]}", 0

    def keep(self, df: DataFrame, rows_per_file: int = 0) -> DataFrame:
        """df as written and read again; rows_per_file bounds what a reader of wide rows holds at a time."""
        self.n += 1
        path, conf = f"{self.root}/{self.n}", self.spark.conf
        before = conf.get(CLEANUP, "false")
        conf.set(CLEANUP, "true")  # once a table is written, the shuffle files behind it are of no use
        try:
            df.write.option("maxRecordsPerFile", rows_per_file).parquet(path)
        finally:
            conf.set(CLEANUP, before)
        if self.n == 1:
            self._path(self.root)[1].deleteOnExit(self._path(self.root)[0])
        out = self.spark.read.schema(df.schema).parquet(path)
        out.kept_at = path
        return out

    def _path(self, at: str):
        """A path and its file system, as the JVM knows them."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(at)
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def drop(self, *frames: DataFrame) -> None:
        """Deletes tables that nothing reads any more."""
        for df in frames:
            path, store = self._path(df.kept_at)
            store.delete(path, True)

    def drop_but(self, *frames: DataFrame) -> None:
        """Deletes all tables but these."""
        kept = {df.kept_at for df in frames}
        for k in range(1, self.n + 1):
            if (at := f"{self.root}/{k}") not in kept:
                path, store = self._path(at)
                store.delete(path, True)

"""Audit samples and their outcome."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillgrid.operators.records import confidence

#: What every document and page weighs besides its share of confident cells.
FLOOR = 0.05


def accuracy(log: DataFrame, *keys: str) -> DataFrame:
    """Counts by result and the unrounded accuracy in percent over judged rows; 0 if none is judged."""
    n = lambda r: F.count_if(F.col("result") == r)
    out = log.groupBy(*keys).agg(F.count("*").alias("n_rows"), n("MATCH").alias("matched"), n("MISMATCH").alias("mismatched"), n("UNCLEAR").alias("unclear"))
    judged = F.col("matched") + F.col("mismatched")
    return out.withColumn("accuracy", F.when(judged == 0, F.lit(0.0)).otherwise(F.col("matched") * 100 / judged))


def log_rows(comparisons: DataFrame, timestamp: str, pdf_name: str = "") -> DataFrame:
    """Rows to append to the log, all strings, with one timestamp."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    return comparisons.select(F.lit(timestamp).alias("timestamp"), F.coalesce("pdf", F.lit(pdf_name)).alias("source_pdf"), text("page"), text("record_no"), "field", F.coalesce("stored", F.lit("")).alias("stored_value"), F.coalesce("reread", F.lit("")).alias("reread_value"), "result")


def weights(cells: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Weights of documents and of pages: share of confident cells plus a floor. The sheet of a page is that of its first row."""
    fine = cells.where((F.coalesce("pdf", F.lit("")) != "") & F.col("page").isNotNull())
    weigh = F.col("confident") / F.col("total") + FLOOR
    sheet = fine.groupBy("pdf", "page").agg(F.min_by("region", F.struct("region", "row_id")).alias("sheet"))
    pages = confidence(fine, "pdf", "page").join(sheet, ["pdf", "page"]).withColumn("weight", weigh)
    documents = pages.groupBy("pdf").agg(F.sum("confident").alias("confident"), F.sum("total").alias("total")).withColumn("weight", weigh)
    return documents, pages


def uniform(seed: int, *keys: str) -> Column:
    """A number in (0, 1) from a hash of the keys, the same in any engine that has MD5."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys])
    return (F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double") + 0.5) / 4294967296.0


def draw(weighted: DataFrame, n: int, seed: int, *keys: str) -> DataFrame:
    """n rows drawn without replacement, with probabilities by weight (Efraimidis and Spirakis)."""
    return weighted.withColumn("_key", -F.log(uniform(seed, *keys)) / F.col("weight")).orderBy("_key", *keys).limit(n).drop("_key")


def pick(cells: DataFrame, n_pages: int = 3, seed: int = 0) -> DataFrame:
    """pdf, page and sheet: a document drawn by weight, and n_pages of its pages."""
    documents, pages = weights(cells)
    chosen = draw(documents, 1, seed, "pdf").select("pdf")
    return draw(pages.join(chosen, "pdf", "left_semi"), n_pages, seed, "pdf", "page").select("pdf", "page", "sheet")


def pick_each(cells: DataFrame, n_pages: int = 3, seed: int = 0) -> DataFrame:
    """n_pages of every document, by weight."""
    _, pages = weights(cells)
    place = F.row_number().over(Window.partitionBy("pdf").orderBy(-F.log(uniform(seed, "pdf", "page")) / F.col("weight"), "page"))
    return pages.withColumn("_place", place).where(F.col("_place") <= n_pages).select("pdf", "page", "sheet")

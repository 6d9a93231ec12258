"""The progress table: pdf, extracted, optimized, records, verified, notes, row_no."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillgrid import fixed
from quillgrid.functions import text


def upsert(progress: DataFrame, updates: DataFrame) -> DataFrame:
    """progress with updates by pdf; empty, zero and null updates leave what is there."""
    old = progress.select("pdf", *[F.col(c).alias(f"_{c}") for c in ("extracted", "optimized", "records", "notes")])
    both = old.join(updates, "pdf", "full_outer")
    said = lambda c: F.when(F.coalesce(F.col(c), F.lit("")) != "", F.col(c)).otherwise(F.col(f"_{c}"))
    count = F.when(F.coalesce("records", F.lit(0)) != 0, F.col("records")).otherwise(F.col("_records"))
    return both.select("pdf", said("extracted").alias("extracted"), said("optimized").alias("optimized"), count.alias("records"), said("notes").alias("notes"))


def done(c: Column) -> Column:
    return F.lower(text.strip(F.coalesce(c, F.lit("")))) == "yes"


def percentages(progress: DataFrame, total: int = fixed.SOURCES) -> DataFrame:
    """One row: counts of extracted, optimized and verified documents and their unrounded shares of total, in percent."""
    real = progress.where(F.coalesce("pdf", F.lit("")) != "")
    verified = F.contains(F.lower(F.coalesce("notes", F.lit(""))), F.lit("verified-done"))
    out = real.agg(F.count_if(done(F.col("extracted"))).alias("extracted"), F.count_if(done(F.col("optimized"))).alias("optimized"), F.count_if(verified).alias("verified"))
    return out.withColumns({f"{c}_pct": F.col(c) * 100 / F.lit(float(total)) for c in ("extracted", "optimized", "verified")})


def next_pending(progress: DataFrame) -> DataFrame:
    """The first document that is not extracted yet."""
    return progress.where(~done(F.col("extracted")) & (F.coalesce("pdf", F.lit("")) != "")).orderBy("row_no").limit(1).select("pdf")


def incomplete(progress: DataFrame) -> DataFrame:
    return progress.where(~done(F.col("extracted")) & (F.coalesce("pdf", F.lit("")) != "")).orderBy("row_no").select("pdf", "extracted", F.coalesce("records", F.lit(0)).alias("records"))


def stored_update(pdf: Column, records: Column, finished: Column, last_page: Column, pages: Column, day: Column) -> list[Column]:
    """The update that follows storing records: status and note."""
    partial = (F.coalesce(last_page, F.lit(0)) != 0) & (F.coalesce(pages, F.lit(0)) != 0)
    through = F.concat(F.lit("Partial through page "), last_page.cast("string"), F.lit("/"), pages.cast("string"), F.lit(" "), day, F.lit("."))
    note = F.when(finished, F.concat(F.lit("Completed "), day, F.lit("."))).when(partial, through).otherwise(F.concat(F.lit("Updated "), day, F.lit(".")))
    return [pdf.alias("pdf"), F.when(finished, "yes").otherwise("partial").alias("extracted"), F.lit("").alias("optimized"), records.alias("records"), note.alias("notes")]


def verified_note(notes: Column, through_page: Column) -> Column:
    """The note with the verification step added, parted by a bar."""
    step = F.when(F.coalesce(through_page, F.lit(0)) != 0, F.concat(F.lit("V:through p"), through_page.cast("string"))).otherwise("V:partial")
    return F.regexp_replace(F.concat_ws(" | ", F.coalesce(notes, F.lit("")), step), r"^[ |]+|[ |]+$", "")

"""Strips and readings: a strip is a row with one (value, confidence) a field; readings are its long form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillgrid import fixed
from quillgrid.functions import text

READING = "struct<value:string,confidence:string>"
FIELDS_TYPE = "struct<" + ",".join(f"{f}:{READING}" for f in fixed.FIELDS) + ">"
EXTRACTION_RECORDS = f"map<string,struct<fields:{FIELDS_TYPE},usage:struct<input_tokens:bigint,output_tokens:bigint,latency_s:double>>>"
EXTRACTION_TYPE = f"stem string, model string, prompt_version string, records {EXTRACTION_RECORDS}"
MANIFEST_TYPE = "stem string, status string, source_image string, canonical_size array<int>, header_band array<int>, records array<struct<index:int,y0:int,y1:int,pad_top:int,pad_bottom:int,strip:string>>, col_x array<int>, warnings array<string>"


def value(fields: Column, name: str) -> Column:
    """The stripped value of a field, empty if there is none."""
    return text.strip(F.coalesce(fields[name]["value"], F.lit("")))


def strips(extractions: DataFrame) -> DataFrame:
    """stem, model, idx, fields and usage, a row for each record of the extraction documents."""
    return extractions.select("stem", "model", F.explode("records").alias("idx", "record")).select("stem", "model", F.col("idx").cast("int").alias("idx"), "record.fields", "record.usage")


def to_long(df: DataFrame) -> DataFrame:
    """stem, idx, pos, field, value and confidence from strips, nothing shuffled."""
    cells = F.array(*[F.struct(F.lit(k).alias("pos"), F.lit(f).alias("field"), F.col("fields")[f]["value"].alias("value"), F.col("fields")[f]["confidence"].alias("confidence")) for k, f in enumerate(fixed.FIELDS)])
    return df.select("stem", "idx", F.inline(cells))


def to_fields(values: dict[str, Column], confidence: Column) -> Column:
    """A fields struct from columns by name; other fields are empty. An illegible reading has no value."""
    one = lambda v: F.struct(F.when(confidence == "illegible", "").otherwise(v).alias("value"), confidence.alias("confidence"))
    none = F.struct(F.lit("").alias("value"), F.lit("high").alias("confidence"))
    return F.struct(*[(one(values[f]) if f in values else none).alias(f) for f in fixed.FIELDS])


def illegible_violations(readings: DataFrame) -> DataFrame:
    """Readings that are called illegible and yet have a value."""
    return readings.where((F.col("confidence") == "illegible") & (F.coalesce("value", F.lit("")) != ""))


def checked(readings: DataFrame) -> DataFrame:
    """readings, failing at the first violation or unknown confidence."""
    fine = F.col("confidence").isin(fixed.CONFIDENCES) & ((F.col("confidence") != "illegible") | (F.col("value") == ""))
    return readings.withColumn("value", F.when(F.coalesce(fine, F.lit(False)), F.col("value")).otherwise(F.raise_error(F.concat(F.lit("invalid reading of "), F.col("field")))))


def usable(manifests: DataFrame, extractions: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Pages of status ok (of which there is an extraction, where those are given), and the refused ones with the reason."""
    status = F.coalesce("status", F.lit("unknown"))
    fine, refused = manifests.where(status == "ok"), manifests.where(status != "ok").select("stem", status.alias("refused"))
    if extractions is None:
        return fine, refused
    have = extractions.select("stem").distinct()
    return fine.join(have, "stem", "left_semi"), refused.union(fine.join(have, "stem", "left_anti").select("stem", F.lit("no-extraction")))


def pending(expected: DataFrame, present: DataFrame, keys: list[str], force: bool = False, limit: int | None = None, order: list[str] | None = None) -> DataFrame:
    """Expected rows that are not present yet; with a limit, the first so many over all pages."""
    out = expected if force else expected.join(present, keys, "left_anti")
    return out if limit is None else out.orderBy(*(order or keys)).limit(limit)

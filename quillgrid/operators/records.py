"""The record store: a table of string columns, and its cells with their colours.

records: the workbook's columns as strings plus row_id (order of storing); cells: region, row_id, pdf, page, record_no,
pos, field, value, colour. Both are immutable snapshots, partitioned by region when written.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillgrid import fixed
from quillgrid.functions import text


def build(raw: Column, meta: dict[str, Column]) -> list[Column]:
    """The store's columns from a map of raw values and metadata; a raw value goes before metadata of its name."""
    return [F.coalesce(raw[c], meta[c].cast("string") if c in meta else F.lit(None).cast("string")).alias(c) for c in fixed.COLUMNS]


def tag_confidence(records: DataFrame) -> DataFrame:
    """Overall confidence, where none is given, and a note, from markers in and blanks among the audited columns."""
    col = lambda c: F.col(f"`{c}`")
    said = {c: F.coalesce(col(c), F.lit("")) for c in fixed.AUDITED}
    listed = lambda test: F.array_compact(F.array(*[F.when(test(v), F.lit(c)) for c, v in said.items()]))
    unsure, empty = listed(lambda v: F.contains(v, F.lit("[?]")) | F.contains(v, F.lit("[??]"))), listed(text.blank)
    n = F.size(unsure) + F.size(empty)
    part = lambda label, a: F.when(F.size(a) > 0, F.concat(F.lit(label), F.array_join(a, ", ")))
    note = F.nullif(F.concat_ws("; ", F.nullif(col("Notes / uncertainties"), F.lit("")), part("Uncertain: ", unsure), part("Empty: ", empty)), F.lit(""))
    own = F.coalesce(col("Overall confidence"), F.when(n == 0, "high").when(n <= 2, "medium").otherwise("low"))
    return records.withColumns({"Overall confidence": own, "Notes / uncertainties": F.coalesce(note, col("Notes / uncertainties"))})


def append(store: DataFrame, rows: DataFrame, once: bool = False) -> DataFrame:
    """store with rows added to their region (Unknown where none is given); columns the store lacks are ignored.

    once leaves out rows whose (pdf, page, number) is stored already, so storing again changes nothing.
    """
    known = rows.select(*[(F.col(f"`{c}`").cast("string") if c in rows.columns else F.lit(None).cast("string")).alias(c) for c in fixed.COLUMNS])
    known = known.withColumn("Region", F.coalesce("Region", F.lit("Unknown")))
    if once:
        keys = {"_pdf": "`Source PDF`", "_page": "Page", "_number": "`Record No.`"}
        known = known.withColumns({k: F.coalesce(F.col(c), F.lit("")) for k, c in keys.items()}).dropDuplicates(list(keys))
        known = known.join(store.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(k) for k, c in keys.items()]), list(keys), "left_anti").drop(*keys)
    return store.unionByName(known, allowMissingColumns=True)


def data(store: DataFrame) -> DataFrame:
    return store.where(~F.col("Region").isin(fixed.RESERVED))


def cells(store: DataFrame, colours: Column | None = None) -> DataFrame:
    """Long form: one row a cell; colours: a map of column to colour, by default from the markers in values."""
    one = lambda k, c: F.struct(F.lit(k).alias("pos"), F.lit(c).alias("field"), F.col(f"`{c}`").alias("value"), (colours[c] if colours is not None else text.marker_colour(F.col(f"`{c}`"))).alias("colour"))
    return data(store).select(F.col("Region").alias("region"), "row_id", F.col("Source PDF").alias("pdf"), F.col("Page").alias("page"), F.col("`Record No.`").alias("record_no"), F.inline(F.array(*[one(k, c) for k, c in enumerate(fixed.COLUMNS)])))


def flagged(c: DataFrame) -> DataFrame:
    """Flagged cells in reading order; pages and numbers that are no numbers come first."""
    number = lambda x: F.coalesce(F.col(x).try_cast("bigint"), F.lit(0))
    return c.where(text.flagged(F.col("colour"))).orderBy("pdf", number("page"), number("record_no"), "row_id", "pos")


def documents_with_flags(c: DataFrame) -> DataFrame:
    return c.where(text.flagged(F.col("colour")) & (F.coalesce("pdf", F.lit("")) != "")).select("pdf").distinct().orderBy("pdf")


def confidence(c: DataFrame, *keys: str) -> DataFrame:
    """keys, confident and total cells; empty cells count."""
    return c.groupBy(*keys).agg(F.count_if(~text.flagged(F.col("colour"))).alias("confident"), F.count("*").alias("total"))


def matched(store: DataFrame, corrections: DataFrame) -> DataFrame:
    """corrections (pdf, page, record_no, updates, entry) with the row_id of the first stored row of their key, as strings."""
    s = data(store).select("row_id", *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(k) for k, c in (("pdf", "Source PDF"), ("page", "Page"), ("record_no", "Record No."))])
    first = s.groupBy("pdf", "page", "record_no").agg(F.min("row_id").alias("row_id"))
    return corrections.withColumns({k: F.col(k).cast("string") for k in ("pdf", "page", "record_no")}).join(first, ["pdf", "page", "record_no"], "left")


def unmatched(store: DataFrame, corrections: DataFrame) -> DataFrame:
    return matched(store, corrections).where("row_id IS NULL").select("pdf", "page", "record_no")


def apply_corrections(store: DataFrame, corrections: DataFrame) -> DataFrame:
    """store with corrected values; of several corrections of a cell the last entry holds. Unknown columns are ignored."""
    each = matched(store, corrections).where("row_id IS NOT NULL").select("row_id", "entry", F.explode("updates").alias("field", "value"))
    last = each.groupBy("row_id", "field").agg(F.max_by("value", "entry").alias("value"))
    own = last.groupBy("row_id").agg(F.map_from_entries(F.collect_list(F.struct("field", "value"))).alias("_new"))
    both = store.join(own, "row_id", "left")
    new = lambda c: F.when(F.coalesce(F.map_contains_key("_new", F.lit(c)), F.lit(False)), F.col("_new")[c]).otherwise(F.col(f"`{c}`"))
    return both.select(*[(new(c) if c in fixed.COLUMNS else F.col(f"`{c}`")).alias(c) for c in store.columns])


def stored(store: DataFrame) -> DataFrame:
    """pdf and its number of rows over all regions."""
    return data(store).groupBy(F.col("Source PDF").alias("pdf")).agg(F.count("*").alias("records"))


def legend(spark) -> DataFrame:
    return spark.createDataFrame(fixed.LEGEND, "name string, marker string, colour string")


def numbered(store: DataFrame, order: list[str]) -> DataFrame:
    """store with row_id by the order in which rows are to be searched."""
    return store.withColumn("row_id", F.row_number().over(Window.partitionBy("Region").orderBy(*order)))

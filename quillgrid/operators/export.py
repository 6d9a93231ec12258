"""Entities as flat rows of strings, in natural page order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillgrid import fixed
from quillgrid.functions import text


def low_confidence(fields: dict[str, Column], treatments: Column) -> Column:
    """Names of fields read with low confidence or illegible, then treatments[i]; tablet numbers are never named."""
    weak = lambda r: F.coalesce(r["confidence"].isin("low", "illegible"), F.lit(False))
    named = F.array_compact(F.array(*[F.when(weak(r), F.lit(n)) for n, r in fields.items()]))
    listed = F.array_compact(F.transform(treatments, lambda t, i: F.when(weak(t), F.concat(F.lit("treatments["), i.cast("string"), F.lit("]")))))
    return F.array_join(F.concat(named, listed), ",")


def review_reasons(warnings: Column) -> Column:
    parts = F.transform(warnings, lambda w: F.coalesce(w["reason"], F.concat(F.lit("field:"), w["field"])))
    return F.array_join(F.array_compact(parts), "; ")


def rows(entities: DataFrame, model: str = "", version: str = fixed.RECONCILER) -> DataFrame:
    """The fixed columns of an export. A page's own model and version go before the arguments."""
    raw = lambda n: F.coalesce(F.col(n)["value"], F.lit(""))
    joined = lambda n: F.array_join(F.transform(n, lambda r: r["value"]), "; ")
    own = lambda n, other: F.coalesce(F.col(n), F.lit(other)) if n in entities.columns else F.lit(other)
    yes = lambda c: F.when(c, "TRUE").otherwise("FALSE")
    special = {
        "record_id": F.concat_ws("-", "stem", F.col("seq").cast("string")), "page_stem": F.col("stem"), "seq": F.col("seq"), "record_no": text.strip(raw("record_no")),
        "time": text.clock(raw("time_hh"), raw("time_mm"), raw("am_pm")), "treatments": joined("treatments"), "tab_nos": joined("tab_nos"),
        "low_confidence_fields": low_confidence({n: F.col(n) for n in fixed.SCALARS}, F.col("treatments")), "review": yes(F.coalesce("review", F.lit(False))), "review_reasons": review_reasons(F.col("warnings")),
        "repaired_fields": F.array_join("repaired_fields", ","), "source_strips": F.array_join(F.transform("source_strips", lambda x: x.cast("string")), "+"), "merged": yes(F.size("merged_from") > 0),
        "model": own("model", model), "reconciler_version": own("reconciler_version", version),
    }
    return entities.select(*[(special[c] if c in special else raw(c)).alias(c) for c in fixed.EXPORTED])


def ordered(exported: DataFrame) -> DataFrame:
    return exported.orderBy(text.natural_key(F.col("page_stem")), "page_stem", "seq")


def places(pages: DataFrame, ranges: int = 256) -> DataFrame:
    """stem and place (from 1) of every distinct page in natural order. Pages are dealt into ranges between the keys of a sample of fixed size, so no window holds them all."""
    own = pages.select("stem").distinct().withColumn("k", text.natural_key(F.col("stem")))
    sample = own.orderBy(F.xxhash64("stem"), "stem").limit(ranges).agg(F.sort_array(F.collect_list("k")).alias("cuts"))
    dealt = own.crossJoin(F.broadcast(sample)).select("stem", "k", F.size(F.filter("cuts", lambda c: c <= F.col("k"))).alias("range"))
    n = dealt.groupBy("range").agg(F.count("*").alias("n"))
    before = n.select("range", (F.sum("n").over(Window.orderBy("range")) - F.col("n")).alias("before"))  # a row for each range
    row = F.row_number().over(Window.partitionBy("range").orderBy("k", "stem"))
    return dealt.join(F.broadcast(before), "range").select("stem", (F.col("before") + row).cast("int").alias("place"))


def write_csv(exported: DataFrame, path: str) -> None:
    """One ordered CSV file with a header; empty values stay empty strings."""
    ordered(exported).coalesce(1).write.mode("overwrite").option("header", True).option("emptyValue", "").option("quote", '"').option("escape", '"').csv(path)


def summary(pages: DataFrame, exported: DataFrame) -> DataFrame:
    """One row: pages, entities and reviewed. pages: a row for each reconciled page, also those without entities."""
    n = pages.agg(F.countDistinct("stem").alias("pages"))
    return n.join(exported.agg(F.count("*").alias("entities"), F.count_if(F.expr("review = 'TRUE'")).alias("reviewed")))  # one row each

"""Agreement of two readings of the same strips."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillgrid import fixed
from quillgrid.functions import text


def rate(agree: Column, total: Column) -> Column:
    """Share of agreement, 1 where nothing was compared."""
    return F.when(total == 0, F.lit(1.0)).otherwise(agree / total)


def pairs(a: DataFrame, b: DataFrame) -> DataFrame:
    """Readings of the strips of both sides (stem, idx, fields) by field: values, confidences, both_empty (exactly) and agree (normalised).

    Strips are joined, one row each, and spread into fields after that, so a strip is shuffled once and not once a field.
    """
    both = a.select("stem", "idx", F.col("fields").alias("a")).join(b.select("stem", "idx", F.col("fields").alias("b")), ["stem", "idx"])
    cell = lambda n: F.struct(F.lit(n).alias("field"), *[F.col(x)[n][k].alias(f"{v}_{x}") for x in "ab" for k, v in (("value", "value"), ("confidence", "conf"))])
    read = lambda n: F.col("a")[n].isNotNull() & F.col("b")[n].isNotNull()  # noqa: E731  what one side does not have is not compared
    cells = both.select("stem", "idx", F.inline(F.array_compact(F.array(*[F.when(read(n), cell(n)) for n in fixed.FIELDS]))))
    va, vb = F.col("value_a"), F.col("value_b")
    return cells.select("*", ((va == "") & (vb == "")).alias("both_empty"), F.when(va == vb, True).otherwise(text.norm(va) == text.norm(vb)).alias("agree"))


def by_field(both: DataFrame) -> DataFrame:
    """field, total, agree and rate for every field of the form, also those never compared."""
    spark = both.sparkSession
    form = spark.createDataFrame(list(enumerate(fixed.FIELDS)), "pos int, field string")
    seen = both.where("NOT both_empty").groupBy("field").agg(F.count("*").alias("total"), F.count_if("agree").alias("agree"))
    filled = F.broadcast(form).join(seen, "field", "left").select("field", "pos", F.coalesce("total", F.lit(0)).alias("total"), F.coalesce("agree", F.lit(0)).alias("agree"))
    return filled.withColumn("rate", rate(F.col("agree"), F.col("total")))


def worst_first(fields: DataFrame) -> DataFrame:
    """Compared fields, the least agreed on first, in form order where equal."""
    return fields.where("total > 0").orderBy("rate", "pos")


def by_confidence(both: DataFrame) -> DataFrame:
    """pair of confidences, total, agree and rate, for the pairs that occur."""
    seen = both.where("NOT both_empty").groupBy("conf_a", "conf_b").agg(F.count("*").alias("total"), F.count_if("agree").alias("agree"))
    return seen.select(F.concat_ws("|", "conf_a", "conf_b").alias("pair"), "total", "agree", rate(F.col("agree"), F.col("total")).alias("rate"))


def overall(both: DataFrame) -> DataFrame:
    """One row: n_records, compared, agreed, both_empty and rate."""
    seen = both.groupBy("stem", "idx").agg(F.count_if("both_empty").alias("e"), F.count_if(F.expr("NOT both_empty")).alias("c"), F.count_if(F.expr("NOT both_empty AND agree")).alias("g"))
    zero = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    out = seen.agg(F.count("*").alias("n_records"), zero("c").alias("compared"), zero("g").alias("agreed"), zero("e").alias("both_empty"))
    return out.withColumn("rate", rate(F.col("agreed"), F.col("compared")))


def disagreements(both: DataFrame) -> DataFrame:
    return both.where("NOT both_empty AND NOT agree").select("stem", F.col("idx").alias("record"), "field", "value_a", "conf_a", "value_b", "conf_b")


def compare(a: DataFrame, b: DataFrame) -> dict[str, DataFrame]:
    """All four reports of one join of the two sides, which is made by each that is asked for; persist a and b, and release them, where all are."""
    both = pairs(a, b)
    return {"by_field": by_field(both), "by_confidence": by_confidence(both), "overall": overall(both), "disagreements": disagreements(both)}

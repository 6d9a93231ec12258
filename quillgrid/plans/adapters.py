"""Inputs of the register operators, made from the star-schema tables by SQL that both engines read.

Every adapter is partitioned by the key that its operator works on; no window runs over a whole table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillgrid import fixed
from quillgrid.operators import readings

#: Strips from orders: three customers share a run of pages of five strips. Name, sex and boxes stand on a customer's first strip
#: of a page and on every third order; some strips are blank, some numbers are off by one or missing, some days invalid.
STRIPS = """
SELECT okey, ckey, stem, idx, conf, shown,
  CASE WHEN gone OR okey % 5 = 2 OR okey % 11 = 0 THEN '' ELSE CAST(ckey + CASE WHEN okey % 7 = 0 THEN 1 ELSE 0 END AS STRING) END AS record_no,
  CASE WHEN gone THEN '' WHEN okey % 19 = 4 THEN '86' ELSE CAST(extract(day FROM odate) AS STRING) END AS day,
  CASE WHEN gone THEN '' ELSE CAST(extract(month FROM odate) AS STRING) END AS month,
  CASE WHEN gone OR okey % 4 = 1 THEN '' ELSE CAST(okey % 13 AS STRING) END AS time_hh,
  CASE WHEN gone OR okey % 4 = 1 THEN '' ELSE CAST(okey % 60 AS STRING) END AS time_mm,
  CASE WHEN gone OR okey % 8 = 1 THEN '' WHEN okey % 2 = 0 THEN 'AM' ELSE 'PM' END AS am_pm,
  CASE WHEN shown THEN substr(md5(CAST(ckey AS STRING)), 1, 10) ELSE '' END AS patient_name,
  CASE WHEN shown THEN substr(md5(CAST(ckey % 50 AS STRING)), 1, 8) ELSE '' END AS village,
  CASE WHEN shown THEN CASE WHEN ckey % 2 = 0 THEN 'M' ELSE 'F' END ELSE '' END AS sex,
  CASE WHEN shown THEN CAST(18 + ckey % 60 AS STRING) ELSE '' END AS age_yrs,
  CASE WHEN shown AND okey % 4 <> 0 THEN 'Y' ELSE '' END AS first_time_odh,
  CASE WHEN shown AND okey % 4 <> 0 THEN 'N' ELSE '' END AS hh_owns_phone,
  CASE WHEN shown AND okey % 4 <> 0 THEN 'Y' ELSE '' END AS hh_owns_toilet,
  CASE WHEN gone OR okey % 3 = 1 THEN '' ELSE 'P' END AS result_pn,
  CASE WHEN gone OR okey % 6 = 0 THEN '' ELSE 'D' || CAST(okey % 23 AS STRING) END AS diagnosis,
  CASE WHEN gone OR okey % 4 = 3 THEN '' ELSE 'T' || CAST(okey % 9 AS STRING) END AS treatment_line1,
  CASE WHEN gone OR okey % 3 <> 0 THEN '' ELSE 'U' || CAST(okey % 5 AS STRING) END AS treatment_line2,
  CASE WHEN gone OR okey % 5 <> 0 THEN '' ELSE CAST(okey % 100 AS STRING) END AS tab_no,
  CASE WHEN gone OR okey % 9 = 0 THEN '' ELSE CAST(CAST(floor(price) AS BIGINT) AS STRING) END AS full_cost
FROM (
  SELECT *, okey % 17 = 3 AS gone, okey % 17 <> 3 AND (okey % 3 = 0 OR row_number() OVER (PARTITION BY stem, ckey ORDER BY idx) = 1) AS shown
  FROM (
    SELECT o_orderkey AS okey, o_custkey AS ckey, o_orderdate AS odate, o_totalprice AS price,
      CASE substr(o_orderpriority, 1, 1) WHEN '2' THEN 'medium' WHEN '3' THEN 'low' WHEN '5' THEN 'illegible' ELSE 'high' END AS conf,
      'c' || CAST(CAST(floor(o_custkey / 3) AS BIGINT) AS STRING) || 'p' || CAST(CAST(floor((n - 1) / 5) AS BIGINT) AS STRING) AS stem,
      CAST((n - 1) % 5 + 1 AS INT) AS idx
    FROM (SELECT *, row_number() OVER (PARTITION BY CAST(floor(o_custkey / 3) AS BIGINT) ORDER BY o_custkey, o_orderkey) AS n FROM {orders}) a
  ) b
) c
"""
GIVEN = ["record_no", "day", "month", "time_hh", "time_mm", "am_pm", "patient_name", "village", "sex", "age_yrs", "first_time_odh", "hh_owns_phone", "hh_owns_toilet", "result_pn", "diagnosis", "treatment_line1", "treatment_line2", "tab_no", "full_cost"]

#: Cells from parts: the marker goes by size.
CELLS = """
SELECT 'R' || CAST(p_partkey % 4 AS STRING) AS region, CAST(floor(p_partkey / 4) AS BIGINT) AS row_id, p_brand AS pdf, CAST(p_partkey % 12 AS STRING) AS page,
  CAST(p_partkey % 7 AS STRING) AS record_no, p_name || CASE p_size % 6 WHEN 0 THEN ' [verified]' WHEN 1 THEN ' [?]' WHEN 2 THEN ' [??]' WHEN 3 THEN ' [faded]' WHEN 4 THEN '' ELSE ' [illegible] [?]' END AS value
FROM {part}
"""

#: Usage from line items and orders.
USAGE = """
SELECT 'p' || CAST(l_orderkey % 997 AS STRING) AS stem, CASE l_linenumber % 3 WHEN 0 THEN 'gemini-3.5-flash-lite' WHEN 1 THEN 'gemini-3.7-flash' ELSE 'other' END AS model,
  CAST(l_quantity AS BIGINT) * 100 AS input_tokens, CAST(floor(l_extendedprice / 10) AS BIGINT) AS output_tokens
FROM {lineitem}
"""

#: A progress table from customers: one document each.
PROGRESS = """
SELECT 'doc' || CAST(c_custkey AS STRING) AS pdf, CASE c_custkey % 3 WHEN 0 THEN ' YES ' WHEN 1 THEN 'partial' ELSE '' END AS extracted,
  CASE WHEN c_custkey % 5 = 0 THEN 'yes' ELSE '' END AS optimized, CAST(c_custkey % 40 AS BIGINT) AS records,
  CASE WHEN c_custkey % 4 = 0 THEN 'Verified-Done' ELSE 'V:partial' END AS notes, c_custkey AS row_no
FROM {customer}
"""

#: Replies of a reader from events.
REPLIES = """
SELECT event_id, CASE event_id % 4 WHEN 0 THEN '```json' || chr(10) || '[' || props || ']' || chr(10) || '```' WHEN 1 THEN 'Here: [' || props || ',' || props || '] done' WHEN 2 THEN '  [' || props || ']' ELSE 'nothing to see' END AS reply
FROM {events}
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    names = [n for n in ("orders", "part", "lineitem", "customer", "events") if "{" + n + "}" in sql]
    return spark.sql(sql, **{n: table(spark, sf_dir, n) for n in names})


def for_duckdb(sql: str) -> str:
    for n in ("orders", "part", "lineitem", "customer", "events"):
        sql = sql.replace("{" + n + "}", n)
    return sql


def strips(spark: SparkSession, sf_dir: str, blanked: bool = True) -> DataFrame:
    """stem, idx, okey and fields; blanked: an illegible strip's readings have no value."""
    conf = F.col("conf") if blanked else F.when(F.col("conf") == "illegible", "low").otherwise(F.col("conf"))
    return view(spark, sf_dir, STRIPS).select("stem", "idx", "okey", readings.to_fields({n: F.col(n) for n in GIVEN}, conf).alias("fields"))


def plain_strips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return strips(spark, sf_dir, blanked=False).select("stem", "idx", "fields")


def second_strips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second reading: by a modulus of the order and field, another case with white space, an edit, or nothing."""
    cells = []
    for k, f in enumerate(fixed.FIELDS):
        m, value = F.col("okey") + k, F.col("fields")[f]["value"]
        v = F.when(m % 5 == 0, F.concat(F.lit(" "), F.upper(value), F.lit(" "))).when(m % 7 == 0, F.concat(value, F.lit("x"))).when(m % 11 == 0, "").otherwise(value)
        conf = F.when(m % 3 == 0, "high").when(m % 3 == 1, "medium").otherwise("low")
        cells.append(F.struct(v.alias("value"), conf.alias("confidence")).alias(f))
    return strips(spark, sf_dir).select("stem", "idx", F.struct(*cells).alias("fields"))


def strips_sql() -> str:
    return for_duckdb(STRIPS)


def long_sql(source: str, keep: str) -> str:
    """DuckDB SQL of the long form of a strips relation."""
    cells = ", ".join("{'pos': %d, 'field': '%s', 'value': %s}" % (k, f, f if f in GIVEN else "''") for k, f in enumerate(fixed.FIELDS))
    return f"SELECT {keep}, c.pos AS pos, c.field AS field, c.value AS value FROM (SELECT *, unnest([{cells}]) AS c FROM {source}) u"

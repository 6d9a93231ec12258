"""All queries over the register operators, by name, with their SQL counterparts written from the semantics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillgrid import fixed
from quillgrid.functions import text
from quillgrid.functions.similarity import similarity
from quillgrid.operators import audit, compare, export, grid, progress, readings, reconcile, records, usage
from quillgrid.plans import adapters as ad

QUERIES: dict = {}
ORACLES: dict[str, str] = {}
FLAGSHIP = "entities"


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def _s(c: str) -> str:
    """Stripped text in DuckDB."""
    return f"trim({c}, chr(32) || chr(9) || chr(10) || chr(13))"


# --- agreement of two readers ---

_A = ad.long_sql("s", "okey, stem, idx, CASE WHEN conf = 'illegible' THEN 'illegible' ELSE conf END AS conf").replace("c.value AS value", "CASE WHEN conf = 'illegible' AND c.field IN (" + ", ".join(f"'{n}'" for n in ad.GIVEN) + ") THEN '' ELSE c.value END AS value")
_BOTH = f"""
WITH s AS ({ad.strips_sql()}), a0 AS ({_A}),
a AS (SELECT *, CASE WHEN field IN ({", ".join(f"'{n}'" for n in ad.GIVEN)}) THEN conf ELSE 'high' END AS conf_a, (okey + pos) AS m FROM a0),
b AS (SELECT *, value AS value_a, CASE WHEN m % 5 = 0 THEN ' ' || upper(value) || ' ' WHEN m % 7 = 0 THEN value || 'x' WHEN m % 11 = 0 THEN '' ELSE value END AS value_b,
  CASE m % 3 WHEN 0 THEN 'high' WHEN 1 THEN 'medium' ELSE 'low' END AS conf_b FROM a),
r AS (SELECT *, value_a = '' AND value_b = '' AS e, lower(trim(value_a)) = lower(trim(value_b)) AS g FROM b)
"""


def _both(spark: SparkSession, d: str) -> DataFrame:
    return compare.pairs(ad.strips(spark, d), ad.second_strips(spark, d))


@query(_BOTH + f"""
SELECT f.field, CAST(count(r.field) FILTER (NOT e) AS BIGINT) AS total, CAST(count(r.field) FILTER (NOT e AND g) AS BIGINT) AS agree,
  CASE WHEN count(r.field) FILTER (NOT e) = 0 THEN 1.0 ELSE CAST(count(r.field) FILTER (NOT e AND g) AS DOUBLE) / count(r.field) FILTER (NOT e) END AS rate
FROM (SELECT unnest([{", ".join(f"'{n}'" for n in fixed.FIELDS)}]) AS field) f LEFT JOIN r ON r.field = f.field GROUP BY f.field
""")  # fmt: skip
def agreement_by_field(spark, d):
    return compare.by_field(_both(spark, d)).select("field", "total", "agree", "rate")


@query(_BOTH + """
SELECT conf_a || '|' || conf_b AS pair, count(*) AS total, count(*) FILTER (g) AS agree, CAST(count(*) FILTER (g) AS DOUBLE) / count(*) AS rate FROM r WHERE NOT e GROUP BY conf_a, conf_b
""")  # fmt: skip
def agreement_by_confidence(spark, d):
    return compare.by_confidence(_both(spark, d))


@query(_BOTH + """
SELECT count(DISTINCT (stem, idx)) AS n_records, count(*) FILTER (NOT e) AS compared, count(*) FILTER (NOT e AND g) AS agreed, count(*) FILTER (e) AS both_empty,
  CAST(count(*) FILTER (NOT e AND g) AS DOUBLE) / count(*) FILTER (NOT e) AS rate FROM r
""")  # fmt: skip
def agreement_overall(spark, d):
    return compare.overall(_both(spark, d))


@query(_BOTH + "SELECT stem, idx AS record, field, value_a, conf_a, value_b, conf_b FROM r WHERE NOT e AND NOT g")
def disagreements(spark, d):
    return compare.disagreements(_both(spark, d))


@query(_BOTH + ", f AS (SELECT field, count(*) FILTER (NOT e) AS n, count(*) FILTER (NOT e AND g) AS k FROM r GROUP BY field) SELECT field, CAST(row_number() OVER (ORDER BY CAST(k AS DOUBLE) / n, list_position([" + ", ".join(f"'{n}'" for n in fixed.FIELDS) + "], field)) AS INT) AS place FROM f WHERE n > 0")
def worst_fields(spark, d):
    fields = compare.by_field(_both(spark, d)).where("total > 0")  # at most one row a field
    return fields.select("field", F.row_number().over(Window.orderBy("rate", "pos")).alias("place"))


@query(f"WITH s AS ({ad.strips_sql()}), l AS ({ad.long_sql('s', 'stem, idx, conf')}) SELECT stem, idx, field, value FROM l WHERE conf = 'illegible' AND value <> ''")
def illegible_violations(spark, d):
    raw = ad.view(spark, d, ad.STRIPS)
    cells = F.array(*[F.struct(F.lit(n).alias("field"), (F.col(n) if n in ad.GIVEN else F.lit("")).alias("value")) for n in fixed.FIELDS])
    return readings.illegible_violations(raw.select("stem", "idx", F.col("conf").alias("confidence"), F.inline(cells))).select("stem", "idx", "field", "value")


# --- pages and their checks ---


@query("""
WITH s AS (SELECT l_orderkey AS page, l_linenumber AS n, lag(l_linenumber) OVER (PARTITION BY l_orderkey ORDER BY l_shipdate, l_partkey, l_suppkey, l_linenumber) AS p FROM lineitem)
SELECT page, CASE WHEN count(DISTINCT n) < count(*) THEN 'duplicate' WHEN bool_or(n - p <> 1) THEN 'gap' ELSE 'ok' END AS status FROM s GROUP BY page
""")  # fmt: skip
def sequence_status(spark, d):
    lines = ad.table(spark, d, "lineitem")
    own = lines.groupBy(F.col("l_orderkey").alias("page")).agg(F.array_sort(F.collect_list(F.struct("l_shipdate", "l_partkey", "l_suppkey", "l_linenumber"))).alias("v"))
    return own.select("page", reconcile.sequence_status(F.transform("v", lambda x: x["l_linenumber"].cast("string"))).alias("status"))


_EXPECTED = "e AS (SELECT l_orderkey AS stem, unnest(range(1, max(l_linenumber) + 1)) AS idx FROM lineitem GROUP BY l_orderkey), p AS (SELECT DISTINCT l_orderkey AS stem, l_linenumber AS idx FROM lineitem)"


def _expected(spark, d):
    lines = ad.table(spark, d, "lineitem").select(F.col("l_orderkey").alias("stem"), F.col("l_linenumber").alias("idx"))
    return lines.groupBy("stem").agg(F.max("idx").alias("n")).select("stem", F.explode(F.sequence(F.lit(1), "n")).alias("idx")), lines.distinct()


@query(f"WITH {_EXPECTED} SELECT stem, CAST(idx AS INT) AS idx FROM e WHERE (stem, idx) NOT IN (SELECT (stem, idx) FROM p)")
def missing_strips(spark, d):
    return reconcile.missing(*_expected(spark, d))


@query(f"WITH {_EXPECTED} SELECT stem, CAST(count(*) AS BIGINT) AS n FROM (SELECT * FROM e EXCEPT SELECT * FROM p) GROUP BY stem")
def pending_strips(spark, d):
    return readings.pending(*_expected(spark, d), ["stem", "idx"]).groupBy("stem").agg(F.count("*").alias("n"))


@query(f"WITH {_EXPECTED} SELECT stem, CAST(idx AS INT) AS idx FROM (SELECT * FROM e EXCEPT SELECT * FROM p) ORDER BY stem, idx LIMIT 100")
def pending_limited(spark, d):
    return readings.pending(*_expected(spark, d), ["stem", "idx"], limit=100)


def _empties(names: list[str]) -> str:
    return " + ".join(f"CAST({n} = '' AS INT)" if n in ad.GIVEN else "1" for n in names)


@query(f"WITH s AS ({ad.strips_sql()}) SELECT stem, idx, ({_empties(fixed.CHECKBOXES)}) = 4 OR ({_empties(fixed.CLIP)}) >= 5 AS clipped FROM s")
def clip_signature(spark, d):
    return ad.plain_strips(spark, d).select("stem", "idx", reconcile.clipped(F.col("fields")).alias("clipped"))


@query(f"""
WITH s AS ({ad.strips_sql()}), l AS ({ad.long_sql('s', 'stem, idx')}),
v AS (SELECT field, value <> '' AS given, CASE field
  WHEN 'day' THEN regexp_full_match(value, '[0-9]+') AND TRY_CAST(value AS INT) BETWEEN 1 AND 31 WHEN 'month' THEN TRY_CAST(value AS INT) BETWEEN 1 AND 12
  WHEN 'time_hh' THEN TRY_CAST(value AS INT) BETWEEN 0 AND 12 WHEN 'time_mm' THEN TRY_CAST(value AS INT) BETWEEN 0 AND 59 WHEN 'record_no' THEN regexp_full_match(value, '[0-9]+')
  WHEN 'sex' THEN value IN ('M', 'F') WHEN 'result_pn' THEN value IN ('P', 'N') WHEN 'am_pm' THEN value IN ('AM', 'PM') ELSE regexp_full_match(value, '[0-9]+([.][0-9]+)?') END AS fine
  FROM l WHERE field IN ('day', 'month', 'time_hh', 'time_mm', 'record_no', 'sex', 'result_pn', 'am_pm', 'age_yrs', 'weight_kg', 'full_cost', 'balance', 'cost_after_discount'))
SELECT field, count(*) FILTER (given AND fine) AS valid, count(*) FILTER (given AND NOT coalesce(fine, FALSE)) AS invalid, count(*) FILTER (NOT given) AS blank FROM v GROUP BY field
""")  # fmt: skip
def validator_outcomes(spark, d):
    df = ad.plain_strips(spark, d)
    ruled = [f for f in fixed.FIELDS if text.valid(f, F.lit("")) is not None]
    v = lambda f: readings.value(F.col("fields"), f)
    cells = F.array(*[F.struct(F.lit(f).alias("field"), (v(f) != "").alias("given"), F.coalesce(text.valid(f, v(f)), F.lit(False)).alias("fine")) for f in ruled])
    return df.select(F.inline(cells)).groupBy("field").agg(F.count_if(F.expr("given AND fine")).alias("valid"), F.count_if(F.expr("given AND NOT fine")).alias("invalid"), F.count_if(F.expr("NOT given")).alias("blank"))


# --- entities ---

#: Classification as a recursion over strips. Names of different customers are never alike here, so equality stands for the ratio.
def _kinds(where: str = "TRUE") -> str:
    return f"""
WITH RECURSIVE s AS (SELECT * FROM ({ad.strips_sql()}) z WHERE {where}), t AS (SELECT *, row_number() OVER (PARTITION BY stem ORDER BY idx) AS n, {" AND ".join(f"{n} = ''" for n in ad.GIVEN)} AS empty,
  NOT ({" AND ".join(f"{n} = ''" for n in fixed.CONTENT if n in ad.GIVEN)}) AS content FROM s),
k AS (
  SELECT stem, CAST(0 AS BIGINT) AS n, 0 AS idx, '' AS kind, CAST(NULL AS STRING) AS reason, CAST(NULL AS STRING) AS name, '' AS place, '' AS number, '' AS sex, '' AS age FROM (SELECT DISTINCT stem FROM t) x
  UNION ALL
  SELECT z.stem, z.n, z.idx, z.kind, z.reason, CASE WHEN z.kind = 'primary' THEN z.patient_name ELSE z.name END, CASE WHEN z.kind = 'primary' THEN z.village ELSE z.place END,
    CASE WHEN z.kind = 'primary' THEN z.record_no ELSE z.number END, CASE WHEN z.kind = 'primary' THEN z.own_sex ELSE z.sex END, CASE WHEN z.kind = 'primary' THEN z.age_yrs ELSE z.age END
  FROM (
    SELECT t.stem, t.n, t.idx, t.patient_name, t.village, t.record_no, t.sex AS own_sex, t.age_yrs, k.name, k.place, k.number, k.sex, k.age,
      CASE WHEN t.empty THEN 'empty' WHEN k.name IS NULL THEN 'primary'
        WHEN t.record_no <> '' AND t.record_no = k.number AND t.patient_name <> '' AND k.name <> '' AND t.patient_name <> k.name THEN 'primary'
        WHEN CASE WHEN t.patient_name <> '' AND k.name <> '' THEN t.patient_name = k.name ELSE t.record_no = '' OR k.number = '' OR t.record_no = k.number END
          AND (t.sex = '' OR k.sex = '' OR t.sex = k.sex) AND (t.age_yrs = '' OR k.age = '' OR t.age_yrs = k.age) AND (t.village = '' OR k.place = '' OR t.village = k.place) AND t.content THEN 'continuation'
        ELSE 'primary' END AS kind,
      CASE WHEN t.empty OR k.name IS NULL THEN NULL
        WHEN t.record_no <> '' AND t.record_no = k.number AND t.patient_name <> '' AND k.name <> '' AND t.patient_name <> k.name THEN 'ambiguous-continuation'
        WHEN t.patient_name <> '' AND t.patient_name = k.name AND t.record_no <> '' AND k.number <> '' AND t.record_no <> k.number
          AND (t.sex = '' OR k.sex = '' OR t.sex = k.sex) AND (t.age_yrs = '' OR k.age = '' OR t.age_yrs = k.age) AND (t.village = '' OR k.place = '' OR t.village = k.place) AND t.content THEN 'recno-mismatch-name-match' END AS reason
    FROM k JOIN t ON t.stem = k.stem AND t.n = k.n + 1
  ) z
),
seqs AS (SELECT t.*, k.kind, k.reason, CAST(sum(CASE WHEN k.kind = 'primary' THEN 1 ELSE 0 END) OVER (PARTITION BY t.stem ORDER BY t.idx) AS INT) AS seq FROM t JOIN k ON t.stem = k.stem AND t.idx = k.idx)
"""


_KINDS = _kinds()


@query(_KINDS + "SELECT stem, idx, kind, reason, CASE WHEN kind = 'empty' THEN NULL ELSE seq END AS seq FROM seqs")
def entity_grouping(spark, d):
    c = reconcile.classify(ad.plain_strips(spark, d)).select("stem", "idx", "kind", "reason")
    return c.where("kind = 'empty'").select("*", F.lit(None).cast("int").alias("seq")).unionByName(reconcile.numbered(c))


@query()
def entity_grouping_fuzzy(spark, d):
    """Names and places with a letter changed on some strips, so that only the ratio holds entities together."""
    f, swap = F.col("fields"), lambda v: F.when(F.col("okey") % 4 == 1, F.regexp_replace(v, "^.", "z")).otherwise(v)
    changed = F.struct(*[(f[n].withField("value", swap(f[n]["value"])) if n in (fixed.NAME, fixed.PLACE) else f[n]).alias(n) for n in fixed.FIELDS])
    df = ad.strips(spark, d, blanked=False).withColumn("fields", changed).select("stem", "idx", "fields")
    return reconcile.numbered(reconcile.classify(df).select("stem", "idx", "kind", "reason"))


def _first(n: str) -> str:
    return f"coalesce(arg_min({n}, idx) FILTER ({n} <> ''), '')" if n in ad.GIVEN else "''"


def _valid_first(n: str, rule: str) -> str:
    return f"coalesce(arg_min({n}, idx) FILTER ({n} <> '' AND ({rule})), arg_min({n}, idx) FILTER ({n} <> ''), '')"


_RULES = {"day": "TRY_CAST(day AS INT) BETWEEN 1 AND 31", "month": "TRUE", "time_hh": "TRUE", "time_mm": "TRUE"}
_MERGED = [n for n in fixed.SCALARS if n in ad.GIVEN]
_MERGE_SQL = (
    _KINDS + ", e AS (SELECT stem, seq, "
    + ", ".join(f"{_valid_first(n, _RULES[n]) if n in _RULES else _first(n)} AS {n}" for n in _MERGED)
    + ", coalesce(string_agg(CASE WHEN treatment_line1 <> '' THEN treatment_line1 END || CASE WHEN treatment_line2 <> '' THEN '; ' || treatment_line2 ELSE '' END, '; ' ORDER BY idx) FILTER (treatment_line1 <> ''), '') AS _t,"
    " string_agg(concat_ws('; ', nullif(treatment_line1, ''), nullif(treatment_line2, '')), '; ' ORDER BY idx) FILTER (treatment_line1 <> '' OR treatment_line2 <> '') AS treatments,"
    " string_agg(tab_no, '; ' ORDER BY idx) FILTER (tab_no <> '') AS tab_nos, string_agg(CAST(idx AS STRING), '+' ORDER BY idx) AS source_strips, count(*) > 1 AS merged FROM seqs WHERE kind <> 'empty' GROUP BY stem, seq) "
)


@query(_MERGE_SQL + f"SELECT stem || '-' || CAST(seq AS STRING) AS record_id, {', '.join(_MERGED)}, coalesce(treatments, '') AS treatments, coalesce(tab_nos, '') AS tab_nos, source_strips, CASE WHEN merged THEN 'TRUE' ELSE 'FALSE' END AS merged FROM e")
def merged_entities(spark, d):
    c = reconcile.numbered(reconcile.classify(ad.plain_strips(spark, d)))
    e = reconcile.merge(c)
    joined = lambda n: F.array_join(F.transform(n, lambda r: r["value"]), "; ").alias(n)
    return e.select(
        F.concat_ws("-", "stem", F.col("seq").cast("string")).alias("record_id"), *[F.col(n)["value"].alias(n) for n in _MERGED], joined("treatments"), joined("tab_nos"),
        F.array_join(F.transform("source_strips", lambda x: x.cast("string")), "+").alias("source_strips"), F.when(F.size("merged_from") > 0, "TRUE").otherwise("FALSE").alias("merged"),
    )


def _rereads(spark, d):
    """A second reading of every strip of which the first was taken: what the strip of the order before it in the page's run said in full."""
    full = F.struct(*[(F.when(F.col("fields")[n]["value"] == "", F.struct(F.lit("R").alias("value"), F.lit("medium").alias("confidence"))).otherwise(F.col("fields")[n])).alias(n) for n in fixed.FIELDS])
    return ad.plain_strips(spark, d).where("idx % 2 = 1").select("stem", "idx", full.alias("fields"), F.lit(5400).cast("long").alias("input_tokens"), F.lit(1000).cast("long").alias("output_tokens"))


def _same_person(record_no: str = "record_no", other: str = "rb") -> str:
    return f"({record_no} <> '' AND {other} <> '' AND ({record_no} = {other} OR (length({record_no}) <> length({other}) AND (contains({record_no}, {other}) OR contains({other}, {record_no}) OR levenshtein({record_no}, {other}) <= 1))))"


#: Readings of an entity's strips in long form, after repair; then merged strip by strip: the first valid reading, else the first.
_FINE = {
    "day": "TRY_CAST(v AS INT) BETWEEN 1 AND 31", "month": "TRY_CAST(v AS INT) BETWEEN 1 AND 12", "time_hh": "TRY_CAST(v AS INT) BETWEEN 0 AND 12", "time_mm": "TRY_CAST(v AS INT) BETWEEN 0 AND 59",
    "age_yrs": "regexp_full_match(v, '[0-9]+([.][0-9]+)?')", "full_cost": "regexp_full_match(v, '[0-9]+([.][0-9]+)?')", "sex": "v IN ('M', 'F')", "result_pn": "v IN ('P', 'N')", "am_pm": "v IN ('AM', 'PM')",
}
_READ = [n for n in fixed.SCALARS if n in ad.GIVEN or n in fixed.REPAIRABLE]
_CELL = ", ".join(f"{{'f': '{n}', 'pos': {fixed.SCALARS.index(n)}, 'rep': {n in fixed.REPAIRABLE}, 'given': {n in ad.GIVEN}, 'v': {n if n in ad.GIVEN else "''"}}}" for n in _READ)


def _entities_sql(reread: str) -> str:
    """The rows of entities, of which the strips where `reread` holds are read again."""
    return _KINDS + f"""
, r AS (SELECT *, needs AND ({reread}) AS used FROM (SELECT *, kind = 'primary' AND (({_empties(fixed.CHECKBOXES)}) = 4 OR ({_empties(fixed.CLIP)}) >= 5) AS needs, ({_empties(fixed.CHECKBOXES)}) = 4 AS box, 8 - ({_empties(fixed.CLIP)}) AS core FROM seqs WHERE kind <> 'empty') q),
l AS (SELECT stem, seq, idx, c.f AS f, c.pos AS pos, used AND c.rep AND c.v = '' AS filled, CASE WHEN used AND c.rep AND c.v = '' THEN 'R' ELSE c.v END AS v,
  CASE WHEN used AND c.rep AND c.v = '' THEN 'medium' WHEN NOT c.given THEN 'high' WHEN conf = 'illegible' THEN 'low' ELSE conf END AS cf FROM (SELECT *, unnest([{_CELL}]) AS c FROM r) q),
v AS (SELECT *, v <> '' AND coalesce(CASE f {" ".join(f"WHEN '{n}' THEN {rule}" for n, rule in _FINE.items())} ELSE TRUE END, FALSE) AS fine FROM l),
w AS (SELECT *, first_value(CASE WHEN fine THEN v END IGNORE NULLS) OVER p AS good, first_value(CASE WHEN v <> '' THEN v END IGNORE NULLS) OVER p AS any_ FROM v WINDOW p AS (PARTITION BY stem, seq, f ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
c AS (SELECT stem, seq, string_agg('field:' || f, '; ' ORDER BY idx, pos) AS conflicts FROM w WHERE f <> 'record_no' AND v <> '' AND any_ IS NOT NULL AND v <> coalesce(good, any_) AND fine = (good IS NOT NULL) GROUP BY stem, seq),
m AS (SELECT stem, seq, f, min(pos) AS pos, coalesce(arg_min(v, idx) FILTER (fine), arg_min(v, idx) FILTER (v <> ''), '') AS v,
  coalesce(arg_min(cf, idx) FILTER (fine), arg_min(cf, idx) FILTER (v <> ''), arg_min(cf, idx)) AS cf, string_agg(f, ',') FILTER (filled) AS filled FROM v GROUP BY stem, seq, f),
p AS (SELECT stem, seq, {", ".join(f"max(v) FILTER (f = '{n}') AS {n}" for n in _READ)}, string_agg(f, ',' ORDER BY pos) FILTER (cf = 'low') AS low, coalesce(string_agg(filled, ',' ORDER BY pos), '') AS repaired_fields FROM m GROUP BY stem, seq),
ti AS (SELECT stem, seq, v, conf, row_number() OVER (PARTITION BY stem, seq ORDER BY idx, line) - 1 AS i FROM (
  SELECT stem, seq, idx, 1 AS line, treatment_line1 AS v, conf FROM r UNION ALL SELECT stem, seq, idx, 2, treatment_line2, conf FROM r) q WHERE v <> ''),
tr AS (SELECT stem, seq, string_agg(v, '; ' ORDER BY i) AS treatments, string_agg('treatments[' || CAST(i AS STRING) || ']', ',' ORDER BY i) FILTER (conf IN ('low', 'illegible')) AS weak FROM ti GROUP BY stem, seq),
g AS (SELECT stem, seq, string_agg(CAST(idx AS STRING), '+' ORDER BY idx) AS source_strips, count(*) AS strips, bool_or(needs) AS needs, bool_or(used) AS used, max(reason) FILTER (kind = 'primary') AS reason,
  string_agg(reason, '; ' ORDER BY idx) FILTER (kind <> 'primary') AS told, bool_or(box) FILTER (kind = 'primary') AS box, max(core) FILTER (kind = 'primary') AS core, coalesce(string_agg(tab_no, '; ' ORDER BY idx) FILTER (tab_no <> ''), '') AS tab_nos FROM r GROUP BY stem, seq),
e AS (SELECT p.*, g.* EXCLUDE (stem, seq), c.conflicts, coalesce(tr.treatments, '') AS treatments, tr.weak FROM p JOIN g USING (stem, seq) LEFT JOIN c USING (stem, seq) LEFT JOIN tr USING (stem, seq)),
n AS (SELECT *, lead(record_no) OVER o AS rb, lead(strips = 1 AND (treatments <> '' OR tab_nos <> '' OR full_cost <> '' OR diagnosis <> '') AND box AND core <= 2) OVER o AS fb FROM e WINDOW o AS (PARTITION BY stem ORDER BY seq)),
z AS (SELECT *, coalesce(lag(after) OVER (PARTITION BY stem ORDER BY seq), FALSE) AS before FROM (SELECT *, rb IS NOT NULL AND (coalesce(fb, FALSE) OR {_same_person()}) AS after FROM n) q),
x AS (SELECT *, conflicts IS NOT NULL OR (needs AND NOT used) OR reason IS NOT NULL OR before OR after AS look FROM z)
"""


_GONE = {n: "''" for n in fixed.SCALARS if n not in _READ}
_ROW = _GONE | {
    "record_id": "stem || '-' || CAST(seq AS STRING)", "page_stem": "stem", "time": "CASE WHEN time_hh = '' AND time_mm = '' AND am_pm = '' THEN '' ELSE trim(time_hh || ':' || time_mm || ' ' || am_pm) END",
    "low_confidence_fields": "concat_ws(',', low, weak)", "review": "CASE WHEN look THEN 'TRUE' ELSE 'FALSE' END", "merged": "CASE WHEN strips > 1 THEN 'TRUE' ELSE 'FALSE' END",
    "review_reasons": "concat_ws('; ', conflicts, CASE WHEN needs AND NOT used THEN 'clipped-no-repair' END, reason, told, CASE WHEN before THEN 'possible-same-patient' END, CASE WHEN after THEN 'possible-same-patient' END)",
    "model": "'gemini-3.5-flash-lite'", "reconciler_version": f"'{fixed.RECONCILER}'",
}


@query(_entities_sql("idx % 2 = 1") + "SELECT " + ", ".join(f"{_ROW.get(c, c)} AS {c}" for c in fixed.EXPORTED) + " FROM x")
def entities(spark, d):
    """Strips to exported rows: classified, repaired, merged and flagged."""
    strips = ad.plain_strips(spark, d)
    return export.rows(reconcile.reconcile(strips, _rereads(spark, d)), "gemini-3.5-flash-lite")


@query(_kinds("idx % 5 <> 3") + f"""
, e AS (SELECT stem, seq, coalesce(arg_min(record_no, idx) FILTER (record_no <> ''), '') AS num FROM seqs WHERE kind <> 'empty' GROUP BY stem, seq),
x AS (SELECT stem, CAST(num AS BIGINT) AS v, lag(CAST(num AS BIGINT)) OVER (PARTITION BY stem ORDER BY seq) AS p FROM e WHERE num <> ''),
y AS (SELECT stem, CASE WHEN count(DISTINCT v) < count(*) THEN 'duplicate' WHEN bool_or(v - p <> 1) THEN 'gap' ELSE 'ok' END AS status FROM x GROUP BY stem),
a AS (SELECT stem, string_agg('missing-extraction:' || CAST(idx AS STRING), ',' ORDER BY idx) FILTER (idx % 5 = 3) AS gone FROM ({ad.strips_sql()}) q GROUP BY stem),
c AS (SELECT stem, count(*) AS n FROM e GROUP BY stem),
w AS (SELECT stem, coalesce(n, 0) AS n_entities, coalesce(status, 'ok') AS record_no_sequence, concat_ws(',', gone, CASE WHEN n IS NULL THEN 'no-patients' END) AS warnings FROM a LEFT JOIN c USING (stem) LEFT JOIN y USING (stem))
SELECT stem, CAST(n_entities AS BIGINT) AS n_entities, record_no_sequence, warnings, warnings <> '' AS review FROM w
""")  # fmt: skip
def page_checks(spark, d):
    strips = ad.plain_strips(spark, d)
    present = strips.where("idx % 5 <> 3")
    return reconcile.page_checks(strips.select("stem", "idx"), present, reconcile.reconcile(present)).select("stem", "n_entities", "record_no_sequence", F.array_join(F.transform("warnings", lambda w: F.concat_ws(":", w["reason"], w["strip"].cast("string"))), ",").alias("warnings"), "review")


@query(_KINDS + f"""
, r AS (SELECT stem, idx, kind, ({_empties(fixed.CHECKBOXES)}) = 4 OR ({_empties(fixed.CLIP)}) >= 5 AS clipped, [x for x in [{", ".join(f"CASE WHEN {n + " = ''" if n in ad.GIVEN else 'TRUE'} THEN '{n}' END" for n in fixed.FIELDS if n in fixed.REPAIRABLE)}] if x IS NOT NULL] AS names FROM seqs)
SELECT stem, idx, array_to_string(names, ',') AS repaired FROM r WHERE kind = 'primary' AND clipped AND idx % 2 = 1
""")  # fmt: skip
def repair_fill(spark, d):
    done = reconcile.repair(reconcile.classify(ad.plain_strips(spark, d)), _rereads(spark, d))
    return done.where("calls = 1").select("stem", "idx", F.array_join("repaired", ",").alias("repaired"))


@query("""
SELECT l_orderkey AS page, CAST(l_linenumber AS INT) AS idx, CAST(y0 - greatest(100, y0 - sub) AS INT) AS above, CAST(least(1000, y1 + sub) - y1 AS INT) AS below
FROM (SELECT *, greatest(1, (y1 - y0) // 3) AS sub FROM (SELECT *, 100 + 120 * (l_linenumber - 1) AS y0, 100 + 120 * (l_linenumber - 1) + CAST(l_quantity AS INT) AS y1 FROM lineitem) a) b
""")  # fmt: skip
def repair_geometry(spark, d):
    y0 = (100 + 120 * (F.col("l_linenumber") - 1)).cast("int")
    above, below = reconcile.repair_geometry(F.lit(100), F.lit(1000), y0, y0 + F.col("l_quantity").cast("int"))
    return ad.table(spark, d, "lineitem").select(F.col("l_orderkey").alias("page"), F.col("l_linenumber").cast("int").alias("idx"), above.cast("int").alias("above"), below.cast("int").alias("below"))


@query(_MERGE_SQL + f"""
, n AS (SELECT *, lead(seq) OVER w AS b, lead(record_no) OVER w AS rb FROM e WINDOW w AS (PARTITION BY stem ORDER BY seq))
SELECT stem, seq, b AS next_seq FROM n WHERE b IS NOT NULL AND record_no <> '' AND rb <> '' AND (record_no = rb OR (length(record_no) <> length(rb) AND (contains(record_no, rb) OR contains(rb, record_no) OR levenshtein(record_no, rb) <= 1)))
""")  # fmt: skip
def possible_splits_by_number(spark, d):
    e = reconcile.merge(reconcile.numbered(reconcile.classify(ad.plain_strips(spark, d))))
    own = e.select("stem", "seq", F.col("record_no")["value"].alias("n"))
    w = Window.partitionBy("stem").orderBy("seq")
    both = own.select("stem", "seq", F.lead("seq").over(w).alias("next_seq"), "n", F.lead("n").over(w).alias("m"))
    return both.where(F.col("next_seq").isNotNull() & text.similar_numbers(F.col("n"), F.col("m"))).select("stem", "seq", "next_seq")


@query(_entities_sql("FALSE") + "SELECT stem, seq, CAST(seq - 1 AS INT) AS with_seq FROM x WHERE before UNION ALL SELECT stem, seq, CAST(seq + 1 AS INT) FROM x WHERE after")
def possible_splits(spark, d):
    e = reconcile.reconcile(ad.plain_strips(spark, d))
    return e.select("stem", "seq", F.inline(F.filter("warnings", lambda w: w["reason"] == "possible-same-patient"))).select("stem", "seq", "with_seq")


@query()
def name_similarity(spark, d):
    """The ratio of neighbouring customers' names, as the classifier sees them."""
    c = ad.table(spark, d, "customer").select(F.col("c_custkey").alias("a"), F.lower("c_name").alias("name"))
    both = c.join(c.select((F.col("a") - 1).alias("a"), F.col("name").alias("other")), "a")
    return both.select("a", similarity(F.col("name"), F.col("other")).alias("ratio"))


_PAGES = "SELECT DISTINCT stem FROM (" + ad.strips_sql() + ") s"


@query(f"SELECT stem, CAST(row_number() OVER (ORDER BY CAST(regexp_extract(stem, 'c([0-9]+)p', 1) AS BIGINT), CAST(regexp_extract(stem, 'p([0-9]+)', 1) AS BIGINT)) AS INT) AS place FROM ({_PAGES}) p")
def natural_page_order(spark, d):
    """The place of every page."""
    return export.places(ad.plain_strips(spark, d))


@query(_MERGE_SQL + f"SELECT (SELECT count(*) FROM ({_PAGES}) p) AS pages, count(*) AS entities FROM e")
def export_summary(spark, d):
    strips = ad.plain_strips(spark, d)
    return export.summary(strips, export.rows(reconcile.reconcile(strips))).select("pages", "entities")


@query(_entities_sql("idx % 2 = 1") + f"""
, tot AS (SELECT count(*) AS entities, count(*) FILTER (strips > 1) AS merged, count(*) FILTER (used) AS repaired, count(*) FILTER (look) AS looks, count(DISTINCT stem) AS held FROM x), a AS (SELECT count(*) AS pages FROM ({_PAGES}) q)
SELECT pages, entities, merged, repaired, looks + pages - held AS reviews, CAST(CASE WHEN looks + pages - held > 0 THEN 2 ELSE 0 END AS INT) AS exit_code FROM tot, a
""")  # fmt: skip
def reconcile_totals(spark, d):
    strips = ad.plain_strips(spark, d)
    e = reconcile.reconcile(strips, _rereads(spark, d))
    return reconcile.run_totals(reconcile.page_checks(strips.select("stem", "idx"), strips, e), e)


# --- usage ---

_U = f"WITH u AS ({ad.for_duckdb(ad.USAGE)}), p(model, a, b) AS (VALUES {', '.join(f"('{m}', CAST({a} AS DOUBLE), CAST({b} AS DOUBLE))" for m, (a, b) in fixed.PRICES.items())})"


@query(_U + " SELECT stem, u.model, CAST(sum(input_tokens) AS BIGINT) AS input_tokens, CAST(sum(output_tokens) AS BIGINT) AS output_tokens, coalesce((sum(input_tokens) * any_value(a) + sum(output_tokens) * any_value(b)) / 1000000, 0.0) AS cost FROM u LEFT JOIN p USING (model) GROUP BY stem, u.model")
def token_totals(spark, d):
    return usage.totals(ad.view(spark, d, ad.USAGE))


@query(_U + " SELECT u.model, count(*) AS strips, CAST(sum(input_tokens) AS BIGINT) AS input_tokens, CAST(sum(output_tokens) AS BIGINT) AS output_tokens, coalesce((sum(input_tokens) * any_value(a) + sum(output_tokens) * any_value(b)) / 1000000, 0.0) AS cost FROM u LEFT JOIN p USING (model) GROUP BY u.model")
def cost_by_model(spark, d):
    return usage.by_model(ad.view(spark, d, ad.USAGE))


@query(f"WITH {_EXPECTED}, n AS (SELECT least(count(*), 500) AS n FROM (SELECT * FROM e EXCEPT SELECT * FROM p)) SELECT CAST(n AS BIGINT) AS pending, (SELECT count(*) FROM orders WHERE o_orderstatus <> 'F') AS refused, (n * 5400 * CAST(0.25 AS DOUBLE) + n * 1000 * CAST(1.5 AS DOUBLE)) / 1000000 AS cost FROM n")
def dry_run_estimate(spark, d):
    pages = ad.table(spark, d, "orders").select(F.col("o_orderkey").cast("string").alias("stem"), F.when(F.col("o_orderstatus") == "F", "ok").otherwise("needs_review").alias("status"))
    _, refused = readings.usable(pages)
    return usage.dry_run(readings.pending(*_expected(spark, d), ["stem", "idx"]), refused, "gemini-3.5-flash-lite", limit=500)


@query("""
SELECT count(*) FILTER (k = 0) AS "new", count(*) FILTER (k = 1) AS skipped, count(*) FILTER (k = 2) AS errors, count(DISTINCT CASE WHEN k = 3 THEN user_id END) AS refused,
  CAST(coalesce(sum(event_id % 100) FILTER (k = 0), 0) AS BIGINT) AS input_tokens, CAST(coalesce(sum(event_id % 10) FILTER (k = 0), 0) AS BIGINT) AS output_tokens,
  (coalesce(sum(event_id % 100) FILTER (k = 0), 0) * CAST(0.75 AS DOUBLE) + coalesce(sum(event_id % 10) FILTER (k = 0), 0) * CAST(3.75 AS DOUBLE)) / 1000000 AS cost, CAST(CASE WHEN count(*) FILTER (k = 2) > 0 THEN 1 ELSE 0 END AS INT) AS exit_code
FROM (SELECT *, event_id % 4 AS k FROM events) e
""")  # fmt: skip
def extract_totals(spark, d):
    kind = F.element_at(F.array(*[F.lit(x) for x in ("new", "skipped", "error", "refused")]), (F.col("event_id") % 4 + 1).cast("int"))
    e = ad.table(spark, d, "events").select(F.col("user_id").alias("stem"), kind.alias("outcome"), (F.col("event_id") % 100).alias("input_tokens"), (F.col("event_id") % 10).alias("output_tokens"))
    return usage.run_totals(e, "gemini-3.7-flash")


@query("SELECT event_id, CASE WHEN event_id % 3 = 0 THEN code IN (429, 500, 501, 502, 503, 504) ELSE regexp_matches(message, '\\b(429|50[0-4])\\b') OR contains(message, 'UNAVAILABLE') END AS again FROM (SELECT event_id, 400 + event_id % 110 AS code, CASE event_id % 5 WHEN 0 THEN 'code ' || CAST(400 + event_id % 110 AS STRING) WHEN 1 THEN 'server UNAVAILABLE' ELSE 'size 15000' || CAST(event_id AS STRING) END AS message FROM events) e")
def retryable_errors(spark, d):
    e, n = ad.table(spark, d, "events"), (400 + F.col("event_id") % 110)
    message = F.when(F.col("event_id") % 5 == 0, F.concat(F.lit("code "), n.cast("string"))).when(F.col("event_id") % 5 == 1, "server UNAVAILABLE").otherwise(F.concat(F.lit("size 15000"), F.col("event_id").cast("string")))
    return e.select("event_id", text.retryable(F.when(F.col("event_id") % 3 == 0, n), message).alias("again"))


# --- the record store ---


@query(f"WITH r AS ({ad.for_duckdb(ad.REPLIES)}) SELECT event_id, CAST(CASE event_id % 4 WHEN 1 THEN 2 WHEN 3 THEN NULL ELSE 1 END AS INT) AS n, CASE WHEN event_id % 4 = 3 THEN NULL ELSE json_extract_string((SELECT props FROM events v WHERE v.event_id = r.event_id), '$.k') END AS k FROM r")
def parse_responses(spark, d):
    got = ad.view(spark, d, ad.REPLIES).select("event_id", text.parse_response(F.col("reply")).alias("r"))
    return got.select("event_id", F.when(F.col("r").isNotNull(), F.size("r")).alias("n"), F.col("r")[0]["k"].alias("k"))


_MARK = "CASE WHEN contains(value, '[verified]') THEN 'FF00B050' WHEN contains(value, '[illegible]') THEN 'FFFF0000' WHEN contains(value, '[??]') THEN 'FFFFC000' WHEN contains(value, '[faded]') THEN 'FF4472C4' WHEN contains(value, '[?]') THEN 'FFFFFF00' END"
_CELLS = f"WITH c AS (SELECT *, {_MARK} AS colour FROM ({ad.for_duckdb(ad.CELLS)}) x), f AS (SELECT *, colour IN ('FFFFFF00', 'FFFFC000', 'FFFF0000', 'FF4472C4') AS flag FROM c)"


def _cells(spark, d):
    return ad.view(spark, d, ad.CELLS).select("*", F.lit(7).alias("pos"), F.lit("Patient name").alias("field"), text.marker_colour(F.col("value")).alias("colour"))


@query(_CELLS + " SELECT value, colour, count(*) AS n FROM c GROUP BY value, colour")
def marker_colour(spark, d):
    return _cells(spark, d).groupBy("value", "colour").agg(F.count("*").alias("n"))


@query(_CELLS + " SELECT region, row_id, pdf, page, record_no, value, colour FROM f WHERE flag")
def flagged_cells(spark, d):
    return records.flagged(_cells(spark, d)).select("region", "row_id", "pdf", "page", "record_no", "value", "colour")


@query(_CELLS + " SELECT DISTINCT pdf FROM f WHERE flag")
def documents_with_flags(spark, d):
    return records.documents_with_flags(_cells(spark, d))


@query(_CELLS + " SELECT pdf, count(*) FILTER (NOT coalesce(flag, FALSE)) AS confident, count(*) AS total FROM f GROUP BY pdf")
def cell_confidence(spark, d):
    return records.confidence(_cells(spark, d), "pdf")


_STORE = "WITH s AS (SELECT p_partkey, p_partkey % 9 AS m, p_name AS nm, p_brand AS pl, CAST(p_size AS STRING) AS ag, p_type AS dg FROM part)"


def _store(spark, d):
    p, m = ad.table(spark, d, "part"), F.col("p_partkey") % 9
    own = {
        "Record No.": F.col("p_partkey").cast("string"), "Region": F.concat(F.lit("R"), (F.col("p_partkey") % 4).cast("string")), "Source PDF": F.col("p_brand"), "Page": (F.col("p_partkey") % 12).cast("string"),
        "Patient name": F.when(m == 0, F.lit("")).when(m == 1, F.concat("p_name", F.lit(" [?]"))).otherwise(F.col("p_name")), "Village": F.when(m == 2, F.lit(None)).otherwise(F.col("p_brand")),
        "Age (yrs)": F.when(m.isin(3, 0), F.lit(" ")).otherwise(F.col("p_size").cast("string")), "Sex": F.when(m == 4, F.concat(F.lit("M"), F.lit("[??]"))).otherwise("F"), "Diagnosis": F.when(m == 0, F.lit("")).otherwise(F.col("p_type")),
        "Malaria result": F.lit("neg"), "Cost (UGX)": F.floor("p_retailprice").cast("string"), "Overall confidence": F.when(m == 5, F.lit("set")), "Notes / uncertainties": F.when(m.isin(4, 6), F.lit("n")),
    }
    return p.select(F.col("p_partkey").alias("row_id"), *[own.get(c, F.lit(None)).cast("string").alias(c) for c in fixed.COLUMNS])


@query(_STORE + """
SELECT p_partkey AS row_id, CASE WHEN m = 5 THEN 'set' WHEN m IN (6, 7, 8) THEN 'high' WHEN m IN (1, 2, 3, 4) THEN 'medium' ELSE 'low' END AS confidence,
  CASE m WHEN 0 THEN 'Empty: Patient name, Age (yrs), Diagnosis' WHEN 1 THEN 'Uncertain: Patient name' WHEN 2 THEN 'Empty: Village' WHEN 3 THEN 'Empty: Age (yrs)' WHEN 4 THEN 'n; Uncertain: Sex' WHEN 6 THEN 'n' END AS notes FROM s
""")  # fmt: skip
def tag_confidence(spark, d):
    out = records.tag_confidence(_store(spark, d))
    return out.select("row_id", F.col("Overall confidence").alias("confidence"), F.col("`Notes / uncertainties`").alias("notes"))


def _corrections(spark, d):
    o = ad.table(spark, d, "orders")
    return o.select(F.concat(F.lit("Brand#"), (F.col("o_orderkey") % 60).cast("string")).alias("pdf"), (F.col("o_orderkey") % 12).alias("page"), F.col("o_orderkey").alias("record_no"), F.create_map(F.lit("Sex"), F.lit("M [verified]"), F.lit("No such"), F.lit("x")).alias("updates"), F.col("o_orderkey").alias("entry"))


_C = "c AS (SELECT 'Brand#' || CAST(o_orderkey % 60 AS STRING) AS pdf, o_orderkey % 12 AS page, o_orderkey AS record_no FROM orders)"


@query(f"WITH {_C} SELECT p_partkey AS row_id, CASE WHEN EXISTS (SELECT 1 FROM c WHERE c.pdf = p_brand AND c.page = p_partkey % 12 AND c.record_no = p_partkey) THEN 'M [verified]' WHEN p_partkey % 9 = 4 THEN 'M[??]' ELSE 'F' END AS sex FROM part")
def apply_corrections(spark, d):
    return records.apply_corrections(_store(spark, d), _corrections(spark, d)).select("row_id", F.col("Sex").alias("sex"))


@query(f"WITH {_C} SELECT pdf, CAST(page AS STRING) AS page, CAST(record_no AS STRING) AS record_no FROM c WHERE NOT EXISTS (SELECT 1 FROM part WHERE c.pdf = p_brand AND c.page = p_partkey % 12 AND c.record_no = p_partkey)")
def unmatched_corrections(spark, d):
    return records.unmatched(_store(spark, d), _corrections(spark, d))


@query("SELECT region, CAST(count(*) AS BIGINT) AS n FROM (SELECT 'R' || CAST(p_partkey % 4 AS STRING) AS region FROM part UNION ALL SELECT CASE WHEN p_size % 2 = 0 THEN 'Unknown' ELSE 'X' END FROM part) a GROUP BY region")
def append_records(spark, d):
    rows = ad.table(spark, d, "part").select(F.when(F.col("p_size") % 2 == 1, "X").alias("Region"), F.col("p_name").alias("Patient name"), F.lit(1).alias("unknown"))
    return records.append(_store(spark, d), rows).groupBy(F.col("Region").alias("region")).agg(F.count("*").alias("n"))


@query("SELECT p_brand AS pdf, count(*) AS records FROM part GROUP BY p_brand")
def stored_per_document(spark, d):
    return records.stored(_store(spark, d))


@query("SELECT * FROM (VALUES " + ", ".join(f"('{a}', '{b}', '{c}')" for a, b, c in fixed.LEGEND) + ") v(name, marker, colour)")
def legend(spark, d):
    return records.legend(spark)


# --- progress and audit ---


@query("""
SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE 'Center: c' || CAST(o_custkey % 9 AS STRING) END || CASE WHEN o_orderkey % 3 <> 0 AND o_orderkey % 2 = 1 THEN ', ' ELSE '' END || CASE WHEN o_orderkey % 2 = 1 THEN 'Year: ' || CAST(extract(year FROM o_orderdate) AS STRING) ELSE '' END AS context FROM orders
""")  # fmt: skip
def page_context(spark, d):
    k = F.col("o_orderkey")
    center = F.when(k % 3 != 0, F.concat(F.lit("c"), (F.col("o_custkey") % 9).cast("string")))
    return ad.table(spark, d, "orders").select("o_orderkey", text.context(center, F.when(k % 2 == 1, F.year("o_orderdate").cast("string"))).alias("context"))


@query("""
SELECT 'doc' || CAST(c_custkey AS STRING) AS pdf, CASE WHEN c_custkey % 3 = 0 THEN 'yes' ELSE 'partial' END AS extracted, c_custkey % 40 AS records,
  CASE WHEN c_custkey % 3 = 0 THEN 'Completed 2020-01-02.' WHEN c_custkey % 5 <> 0 THEN 'Partial through page ' || CAST(c_custkey % 5 AS STRING) || '/9 2020-01-02.' ELSE 'Updated 2020-01-02.' END AS notes FROM customer
""")  # fmt: skip
def stored_updates(spark, d):
    k = F.col("c_custkey")
    up = progress.stored_update(F.concat(F.lit("doc"), k.cast("string")), k % 40, k % 3 == 0, k % 5, F.lit(9), F.lit("2020-01-02"))
    return ad.table(spark, d, "customer").select(*up).drop("optimized")


@query("SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN '' WHEN 1 THEN 'n | ' ELSE 'V:partial | ' END || CASE WHEN c_custkey % 4 = 0 THEN 'V:partial' ELSE 'V:through p' || CAST(c_custkey % 4 AS STRING) END AS notes FROM customer")
def verified_notes(spark, d):
    k = F.col("c_custkey")
    return ad.table(spark, d, "customer").select("c_custkey", progress.verified_note(F.when(k % 3 == 0, F.lit(None)).when(k % 3 == 1, "n").otherwise("V:partial"), k % 4).alias("notes"))


@query("SELECT event_id, 'T' AS timestamp, CASE WHEN event_id % 3 = 0 THEN 'own' ELSE 'all' END AS source_pdf, CAST(user_id AS STRING) AS page, event_type AS field, CASE WHEN event_id % 2 = 0 THEN '' ELSE 'v' END AS stored_value FROM events")
def audit_rows(spark, d):
    k = F.col("event_id")
    c = ad.table(spark, d, "events").select(F.when(k % 3 == 0, "own").alias("pdf"), F.col("user_id").alias("page"), k.alias("record_no"), F.col("event_type").alias("field"), F.when(k % 2 == 1, "v").alias("stored"), F.lit("x").alias("reread"), F.lit("MATCH").alias("result"))
    return audit.log_rows(c, "T", "all").select(F.col("record_no").cast("long").alias("event_id"), "timestamp", "source_pdf", "page", "field", "stored_value")


@query("SELECT DISTINCT o_custkey AS stem FROM orders WHERE o_custkey NOT IN (SELECT s_suppkey FROM supplier)")
def resumed_pages(spark, d):
    pages = ad.table(spark, d, "orders").select(F.col("o_custkey").alias("stem")).distinct()
    return reconcile.resumed(pages, ad.table(spark, d, "supplier").select(F.col("s_suppkey").alias("stem")))


@query(f"WITH s AS ({ad.strips_sql()}) SELECT stem, idx, CASE WHEN time_hh = '' AND time_mm = '' AND am_pm = '' THEN '' ELSE trim(time_hh || ':' || time_mm || ' ' || am_pm) END AS clock FROM s")
def clock_times(spark, d):
    v = lambda n: F.col("fields")[n]["value"]
    return ad.plain_strips(spark, d).select("stem", "idx", text.clock(v("time_hh"), v("time_mm"), v("am_pm")).alias("clock"))


@query(f"WITH s AS ({ad.strips_sql()}) SELECT stem, idx, CASE WHEN conf = 'low' OR conf = 'illegible' THEN '{','.join(n for n in fixed.SCALARS if n in ad.GIVEN)},treatments[0],treatments[1]' ELSE '' END AS fields FROM s")
def low_confidence_fields(spark, d):
    f = F.col("fields")
    treatments = F.array(f["treatment_line1"], f["treatment_line2"])
    return ad.plain_strips(spark, d).select("stem", "idx", export.low_confidence({n: f[n] for n in fixed.SCALARS}, treatments).alias("fields"))


_P = f"WITH p AS ({ad.for_duckdb(ad.PROGRESS)})"


@query(_P + """, u AS (SELECT 'doc' || CAST(s_suppkey * 3 AS STRING) AS pdf, CASE WHEN s_suppkey % 2 = 0 THEN 'yes' ELSE '' END AS extracted, '' AS optimized, CAST(s_suppkey % 3 AS BIGINT) AS records, CASE WHEN s_suppkey % 5 = 0 THEN 'note' ELSE '' END AS notes FROM supplier)
SELECT coalesce(p.pdf, u.pdf) AS pdf, CASE WHEN u.extracted <> '' THEN u.extracted ELSE p.extracted END AS extracted, CASE WHEN u.optimized <> '' THEN u.optimized ELSE p.optimized END AS optimized,
  CASE WHEN u.records <> 0 THEN u.records ELSE p.records END AS records, CASE WHEN u.notes <> '' THEN u.notes ELSE p.notes END AS notes FROM p FULL JOIN u ON p.pdf = u.pdf
""")  # fmt: skip
def progress_upsert(spark, d):
    k = F.col("s_suppkey")
    u = ad.table(spark, d, "supplier").select(F.concat(F.lit("doc"), (k * 3).cast("string")).alias("pdf"), F.when(k % 2 == 0, "yes").otherwise("").alias("extracted"), F.lit("").alias("optimized"), (k % 3).cast("long").alias("records"), F.when(k % 5 == 0, "note").otherwise("").alias("notes"))
    return progress.upsert(ad.view(spark, d, ad.PROGRESS), u)


@query(_P + """, c AS (SELECT count(*) FILTER (lower(trim(extracted)) = 'yes') AS extracted, count(*) FILTER (lower(trim(optimized)) = 'yes') AS optimized, count(*) FILTER (contains(lower(notes), 'verified-done')) AS verified FROM p)
SELECT *, extracted * 100 / CAST(312 AS DOUBLE) AS extracted_pct, optimized * 100 / CAST(312 AS DOUBLE) AS optimized_pct, verified * 100 / CAST(312 AS DOUBLE) AS verified_pct FROM c
""")  # fmt: skip
def progress_percentages(spark, d):
    return progress.percentages(ad.view(spark, d, ad.PROGRESS))


@query(_P + " SELECT pdf FROM p WHERE lower(trim(extracted)) <> 'yes' ORDER BY row_no LIMIT 1")
def next_pending(spark, d):
    return progress.next_pending(ad.view(spark, d, ad.PROGRESS))


_LOG = "WITH l AS (SELECT l_suppkey AS supplier, CASE l_returnflag WHEN 'R' THEN 'MATCH' WHEN 'A' THEN 'MISMATCH' ELSE 'UNCLEAR' END AS result FROM lineitem)"


@query(_LOG + " SELECT supplier, count(*) AS n_rows, count(*) FILTER (result = 'MATCH') AS matched, count(*) FILTER (result = 'MISMATCH') AS mismatched, count(*) FILTER (result = 'UNCLEAR') AS unclear, CASE WHEN count(*) FILTER (result <> 'UNCLEAR') = 0 THEN 0.0 ELSE CAST(count(*) FILTER (result = 'MATCH') * 100 AS DOUBLE) / count(*) FILTER (result <> 'UNCLEAR') END AS accuracy FROM l GROUP BY supplier")
def audit_accuracy(spark, d):
    result = F.when(F.col("l_returnflag") == "R", "MATCH").when(F.col("l_returnflag") == "A", "MISMATCH").otherwise("UNCLEAR")
    return audit.accuracy(ad.table(spark, d, "lineitem").select(F.col("l_suppkey").alias("supplier"), result.alias("result")), "supplier")


_W = _CELLS + ", g AS (SELECT pdf, page, count(*) FILTER (NOT coalesce(flag, FALSE)) AS confident, count(*) AS total, arg_min(region, region || lpad(CAST(row_id AS STRING), 12, '0')) AS sheet FROM f GROUP BY pdf, page)"


@query(_W + " SELECT pdf, page, confident, total, sheet, CAST(confident AS DOUBLE) / total + 0.05 AS weight FROM g")
def audit_weights(spark, d):
    return audit.weights(_cells(spark, d))[1].select("pdf", "page", "confident", "total", "sheet", "weight")


_UNI = "(CAST(('0x' || substr(md5('7|' || {k}), 1, 8)) AS UBIGINT) + 0.5::DOUBLE) / 4294967296.0::DOUBLE"


@query(_W + f"""
, w AS (SELECT *, -ln({_UNI.format(k="pdf || '|' || page")}) / (CAST(confident AS DOUBLE) / total + 0.05) AS key FROM g)
SELECT pdf, page, sheet FROM (SELECT *, row_number() OVER (PARTITION BY pdf ORDER BY key, page) AS n FROM w) x WHERE n <= 3
""")  # fmt: skip
def audit_pick_seeded(spark, d):
    return audit.pick_each(_cells(spark, d), 3, 7)


_WEIGH = "CAST(confident AS DOUBLE) / total + 0.05"


@query(_W + f"""
, u AS (SELECT pdf, sum(confident) AS confident, sum(total) AS total FROM g GROUP BY pdf),
chosen AS (SELECT pdf FROM (SELECT pdf, -ln({_UNI.replace("7|", "11|").format(k="pdf")}) / ({_WEIGH}) AS key FROM u) q ORDER BY key, pdf LIMIT 1)
SELECT pdf, page, sheet FROM (SELECT *, -ln({_UNI.replace("7|", "11|").format(k="pdf || '|' || page")}) / ({_WEIGH}) AS key FROM g WHERE pdf IN (SELECT pdf FROM chosen)) q ORDER BY key, pdf, page LIMIT 3
""")  # fmt: skip
def audit_pick(spark, d):
    return audit.pick(_cells(spark, d), 3, 11)


# --- grid geometry ---

_INK = "WITH ink AS (SELECT user_id AS page, CAST(extract(hour FROM ts) * 60 + extract(minute FROM ts) AS INT) AS y, count(*) AS ink FROM events GROUP BY 1, 2), lines AS (SELECT page, y FROM ink)"


def _ink(spark, d):
    y = (F.hour("ts") * 60 + F.minute("ts")).cast("int")
    return ad.table(spark, d, "events").groupBy(F.col("user_id").alias("page"), y.alias("y")).agg(F.count("*").alias("ink"))


_CL = _INK + ", s AS (SELECT *, sum(CASE WHEN y - p <= 6 THEN 0 ELSE 1 END) OVER (PARTITION BY page ORDER BY y) AS k FROM (SELECT *, lag(y) OVER (PARTITION BY page ORDER BY y) AS p FROM lines) a), c AS (SELECT page, CAST(k AS BIGINT) AS cluster, CAST(round_even(avg(y), 0) AS INT) AS centre, count(*) AS size FROM s GROUP BY page, k)"


@query(_CL + " SELECT * FROM c")
def line_clusters(spark, d):
    return grid.line_clusters(grid.long_lines(_ink(spark, d), 1, 0.5))


def _snap(ideal: str) -> str:
    near = f"list_aggregate(list_transform(ls, lambda z: {{'d': abs(z - ({ideal})), 'y': z}}), 'min')"
    return f"CASE WHEN ({near}).d <= 43.2 THEN ({near}).y ELSE CAST(round_even({ideal}, 0) AS INT) END"


_BOUNDS = _CL + f"""
, p AS (SELECT page, list(centre ORDER BY centre) AS ls FROM c GROUP BY page),
q AS (SELECT *, {_snap('1440 * CAST(0.177 AS DOUBLE)')} AS top, {_snap('CAST(1439 AS DOUBLE)')} AS bottom FROM p),
b AS (SELECT page, top AS b0, {", ".join(f"{_snap(f'{k} * ((bottom - top) / CAST(5 AS DOUBLE)) + top')} AS b{k}" for k in range(1, 5))}, bottom AS b5 FROM q)
"""


def _bounds(spark, d):
    lines = line_clusters(spark, d).groupBy("page").agg(F.sort_array(F.collect_list("centre")).alias("lines"))
    return grid.page_bounds(lines.withColumn("height", F.lit(1440.0)))


@query(_BOUNDS + " SELECT page, b0, b1, b2, b3, b4, b5 FROM b")
def snap_bounds(spark, d):
    return _bounds(spark, d).select("page", *[F.col("bounds")[k].alias(f"b{k}") for k in range(6)])


@query(_BOUNDS + ", e AS (" + " UNION ALL ".join(f"SELECT page, {k} AS idx, b0 AS top, b{k - 1} AS y0, b{k} AS y1 FROM b" for k in range(1, 6)) + ") SELECT page, CAST(idx AS INT) AS idx, y0, y1, CAST(y0 - greatest(top, y0 - 25) AS INT) AS pad_top, CAST(least(1440, y1 + 25) - y1 AS INT) AS pad_bottom FROM e")
def strip_geometry(spark, d):
    return grid.strip_geometry(_bounds(spark, d))


_QUAD = "WITH q AS (SELECT o_orderkey AS k, [(o_orderkey * 7) % 101, (o_orderkey * 11) % 97, (o_orderkey * 13) % 89, (o_orderkey * 17) % 83] AS x, [(o_orderkey * 3) % 103, (o_orderkey * 5) % 107, (o_orderkey * 19) % 109, (o_orderkey * 23) % 113] AS y FROM orders), p AS (SELECT k, unnest(range(1, 5)) AS i, x, y FROM q), r AS (SELECT k, i, x[i] AS px, y[i] AS py FROM p)"


@query(_QUAD + """
SELECT k, arg_min(px || ',' || py, (px + py) * 10 + i) AS tl, arg_min(px || ',' || py, (py - px) * 10 + i) AS tr, arg_min(px || ',' || py, -(px + py) * 10 + i) AS br, arg_min(px || ',' || py, -(py - px) * 10 + i) AS bl FROM r GROUP BY k
""")  # fmt: skip
def quad_order(spark, d):
    k = F.col("o_orderkey")
    at = lambda a, m, b, n: F.struct(((k * a) % m).alias("x"), ((k * b) % n).alias("y"))
    points = F.array(at(7, 101, 3, 103), at(11, 97, 5, 107), at(13, 89, 19, 109), at(17, 83, 23, 113))
    q = grid.corners(points)
    say = lambda p: F.concat_ws(",", p["x"].cast("string"), p["y"].cast("string"))
    return ad.table(spark, d, "orders").select(k.alias("k"), *[say(q[c]).alias(c) for c in ("tl", "tr", "br", "bl")])


@query(_INK + " SELECT page, coalesce(sum(ink) FILTER (y >= 1224), 0) > coalesce(sum(ink) FILTER (y < 216), 0) AS flip FROM ink GROUP BY page")
def upright_decision(spark, d):
    zero = lambda c: F.coalesce(F.sum(F.when(c, F.col("ink"))), F.lit(0))
    each = _ink(spark, d).groupBy("page").agg(zero(F.col("y") < 216).alias("top"), zero(F.col("y") >= 1224).alias("bottom"))
    return each.select("page", grid.upside_down(F.col("top"), F.col("bottom")).alias("flip"))


@query("""
WITH s AS (SELECT l_orderkey AS page, l_linenumber % 3 AS channel, round(stddev_pop(l_quantity), 9) AS s FROM lineitem GROUP BY 1, 2)
SELECT page, CAST(channel AS INT) AS channel FROM (SELECT *, row_number() OVER (PARTITION BY page ORDER BY s DESC, channel) AS n FROM s) r WHERE n = 1
""")  # fmt: skip
def best_channel(spark, d):
    lines = ad.table(spark, d, "lineitem").select(F.col("l_orderkey").alias("page"), (F.col("l_linenumber") % 3).cast("int").alias("channel"), F.col("l_quantity").alias("value"))
    return grid.best_channel(lines)


@query("SELECT o_orderstatus AS status, count(*) AS pages FROM orders GROUP BY 1")
def page_status(spark, d):
    return grid.status_counts(ad.table(spark, d, "orders").select(F.col("o_orderstatus").alias("status")))


# --- image kernels, on pages drawn from the events ---


def _drawn(spark, d):
    """A table page for each user: a border, a header line and body lines, drawn by a page-wise batch function."""
    import numpy as np
    import pandas as pd

    def draw(batches):
        for batch in batches:
            # a batch of ids may be thousands of pages, so each is handed on alone
            for page in batch["page"]:
                x = np.full((600, 850), 235, np.uint8)
                x[40:43, 30:820] = x[560:563, 30:820] = x[130:133, 30:820] = 0
                x[40:563, 30:33] = x[40:563, 817:820] = 0
                for k in range(1, 5):
                    x[130 + 86 * k : 132 + 86 * k, 30:820] = 0
                x[12:26, 100 : 100 + 40 * (page % 9 + 2) : 3] = 20
                yield pd.DataFrame([(str(page), 600, 850, 1, x.tobytes())], columns=["page", "height", "width", "channels", "data"])

    ids = ad.table(spark, d, "events").select(F.col("user_id").alias("page")).where("page IS NOT NULL").distinct()
    # ids are a few bytes, which adaptive execution would put into one task; a page is half a megabyte and its work over a second
    return ids.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "page").mapInPandas(draw, "page string, height int, width int, channels int, data binary")


@query()
def segmented_pages(spark, d):
    """Drawn pages through the whole geometry: table, rectification, cleaning, orientation, lines, bounds."""
    from quillgrid.operators import imaging

    found = imaging.segment_pages(_drawn(spark, d), full=False)
    # what a page has travels with its name: a join would run the kernels twice
    bounds = grid.page_bounds(found.select(F.struct("page", "status", "flipped", "columns").alias("page"), "lines", F.lit(float(fixed.HEIGHT)).alias("height")))
    return grid.manifests(bounds.select("page.*", "bounds", "missed", "ok", "height")).select("stem", "status", F.size("records").alias("strips"), "records", "header_band", "warnings")

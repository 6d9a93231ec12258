import collections
import random

from pyspark.sql import functions as F

from quillgrid import fixed
from quillgrid.operators import audit, compare, progress, records
from quillgrid.operators import readings as rd


def store(spark, rows):
    full = [(k, *[r.get(c) for c in fixed.COLUMNS]) for k, r in enumerate(rows)]
    return spark.createDataFrame(full, "row_id long, " + ", ".join(f"`{c}` string" for c in fixed.COLUMNS))


def test_append_and_build(spark):
    s = store(spark, [{"Region": "R", "Source PDF": "a", "Page": "1", "Record No.": "5"}])
    new = spark.createDataFrame([("a", 1, 5, "x"), ("a", 1, 6, None)], "`Source PDF` string, Page int, `Record No.` int, other string")
    out = records.append(s, new)
    assert out.count() == 3 and {r.Region for r in out.collect()} == {"R", "Unknown"}
    assert records.append(s, new, once=True).count() == 2
    built = spark.range(1).select(*records.build(F.create_map(F.lit("Page"), F.lit("9"), F.lit("zz"), F.lit("1")), {"Page": F.lit(3), "Region": F.lit("N")})).first()
    assert built["Page"] == "9" and built["Region"] == "N" and built["Sex"] is None


def test_tagging(spark):
    good = dict.fromkeys(fixed.AUDITED, "v")
    rows = [good, good | {"Sex": "M [?]", "Village": " "}, good | {"Sex": "", "Village": "", "Diagnosis": "[??]"}, good | {"Overall confidence": "kept", "Notes / uncertainties": "n", "Sex": ""}]
    out = records.tag_confidence(store(spark, rows)).orderBy("row_id").collect()
    assert [r["Overall confidence"] for r in out] == ["high", "medium", "low", "kept"]
    assert [r["Notes / uncertainties"] for r in out] == [None, "Uncertain: Sex; Empty: Village", "Uncertain: Diagnosis; Empty: Village, Sex", "n; Empty: Sex"]


def test_corrections_take_the_first_match(spark):
    key = {"Region": "R", "Source PDF": "a", "Page": "1", "Record No.": "5"}
    s = store(spark, [key | {"Sex": "F"}, key | {"Sex": "F"}, key | {"Region": "Legend"}])
    fixes = spark.createDataFrame([("a", 1, 5, {"Sex": "M [verified]", "no column": "x"}, 0), ("a", 1, 5, {"Sex": "F [?]"}, 1), ("a", 2, 5, {"Sex": "M"}, 2)], "pdf string, page int, record_no int, updates map<string,string>, entry int")
    out = records.apply_corrections(s, fixes).orderBy("row_id").collect()
    assert [r.Sex for r in out] == ["F [?]", "F", None] and out[0].__fields__ == s.columns
    assert [tuple(r) for r in records.unmatched(s, fixes).collect()] == [("a", "2", "5")]


def test_cells_flags_and_confidence(spark):
    s = store(spark, [{"Region": "R", "Source PDF": "a", "Page": "10", "Record No.": "1", "Sex": "F [?]"}, {"Region": "R", "Source PDF": "a", "Page": "2", "Record No.": "x", "Village": "v [faded]"}, {"Region": "R", "Source PDF": "b", "Page": "2"}])
    c = records.cells(s)
    assert [(r.page, r.field, r.colour) for r in records.flagged(c).collect()] == [("2", "Village", "FF4472C4"), ("10", "Sex", "FFFFFF00")]
    assert [r.pdf for r in records.documents_with_flags(c).collect()] == ["a"]
    assert {r.pdf: (r.confident, r.total) for r in records.confidence(c, "pdf").collect()} == {"a": (48, 50), "b": (25, 25)}
    assert records.legend(spark).count() == 5 and records.stored(s).count() == 2


def test_progress(spark):
    p = spark.createDataFrame([("a", "yes", "", 5, "", "n", 1), ("b", " No ", "yes", 0, "", "Verified-Done", 2), ("", "", "", 0, "", "", 0)], "pdf string, extracted string, optimized string, records long, verified string, notes string, row_no int")
    u = spark.createDataFrame([("a", "", "yes", 0, ""), ("c", "partial", "", 3, "x")], "pdf string, extracted string, optimized string, records long, notes string")
    got = {r.pdf: tuple(r)[1:] for r in progress.upsert(p, u).collect()}
    assert got["a"] == ("yes", "yes", 5, "n") and got["c"] == ("partial", None, 3, "x")
    assert progress.next_pending(p).first().pdf == "b" and [r.pdf for r in progress.incomplete(p).collect()] == ["b"]
    r = progress.percentages(p).first()
    assert (r.extracted, r.optimized, r.verified) == (1, 1, 1) and abs(r.extracted_pct - 100 / 312) < 1e-12
    note = spark.createDataFrame([("", 3), ("x", 0), (None, None)], "n string, p int").select(progress.verified_note(F.col("n"), F.col("p")).alias("x")).collect()
    assert [r.x for r in note] == ["V:through p3", "x | V:partial", "V:partial"]
    up = spark.range(1).select(*progress.stored_update(F.lit("d"), F.lit(4), F.lit(False), F.lit(2), F.lit(9), F.lit("2020-01-01"))).first()
    assert tuple(up) == ("d", "partial", "", 4, "Partial through page 2/9 2020-01-01.")


def test_audit(spark):
    log = spark.createDataFrame([(x,) for x in ["MATCH", "MATCH", "MISMATCH", "UNCLEAR"]], "result string")
    r = audit.accuracy(log).first()
    assert (r.n_rows, r.matched, r.mismatched, r.unclear) == (4, 2, 1, 1) and abs(r.accuracy - 200 / 3) < 1e-12
    assert audit.accuracy(log.where("result = 'UNCLEAR'")).first().accuracy == 0.0
    c = spark.createDataFrame([("R", k, f"d{k % 2}", str(k % 5), "1", 0, "f", "v", "FFFF0000" if k % 3 else None) for k in range(60)], "region string, row_id long, pdf string, page string, record_no string, pos int, field string, value string, colour string")
    seen = collections.Counter()
    for seed in range(12):
        got = audit.pick(c, 3, seed).collect()
        assert len(got) == 3 and len({r.pdf for r in got}) == 1 and len({r.page for r in got}) == 3
        seen[got[0].pdf] += 1
    assert len(seen) == 2
    rows = spark.createDataFrame([(None, 1, 2, "f", None, "y", "MATCH")], "pdf string, page int, record_no int, field string, stored string, reread string, result string")
    assert tuple(audit.log_rows(rows, "t", "doc").first()) == ("t", "doc", "1", "2", "f", "", "y", "MATCH")


def test_weighted_draws_follow_the_weights(spark):
    w = spark.createDataFrame([(k, 0.9 if k else 0.1) for k in (0, 1)], "k int, weight double")
    seeds = random.Random(1).sample(range(10**6), 60)
    assert sum(audit.draw(w, 1, s, "k").first().k for s in seeds[:25]) >= 17


def test_agreement(spark):
    def one(rows):
        strips = {}
        for i, f, v, c in rows:
            strips.setdefault(i, dict.fromkeys(fixed.FIELDS))[f] = {"value": v, "confidence": c}
        return spark.createDataFrame([("p", i, f) for i, f in strips.items()], f"stem string, idx int, fields {rd.FIELDS_TYPE}")

    a = one([(1, "sex", "M", "high"), (1, "day", "", "high"), (1, "village", " Lake  side", "low"), (1, "balance", " ", "high"), (2, "sex", "F", "high")])
    b = one([(1, "sex", "F", "medium"), (1, "day", "", "low"), (1, "village", "lake side ", "high"), (1, "balance", "", "high"), (9, "sex", "F", "high")])
    out = compare.compare(a, b)
    fields = {r.field: (r.total, r.agree, r.rate) for r in out["by_field"].collect()}
    assert len(fields) == 35 and fields["sex"] == (1, 0, 0.0) and fields["day"] == (0, 0, 1.0) and fields["village"] == (1, 1, 1.0) and fields["balance"] == (1, 1, 1.0)
    r = out["overall"].first()
    assert (r.n_records, r.compared, r.agreed, r.both_empty) == (1, 3, 2, 1)
    assert {r.pair: (r.total, r.agree) for r in out["by_confidence"].collect()} == {"high|medium": (1, 0), "low|high": (1, 1), "high|high": (1, 1)}
    assert [tuple(r) for r in out["disagreements"].collect()] == [("p", 1, "sex", "M", "high", "F", "medium")]
    assert [r.field for r in compare.worst_first(out["by_field"]).collect()][0] == "sex"


def test_readings(spark):
    r = spark.createDataFrame([("sex", "M", "illegible"), ("sex", "", "illegible")], "field string, value string, confidence string")
    assert rd.illegible_violations(r).count() == 1
    fine, refused = rd.usable(spark.createDataFrame([("a", "ok"), ("b", "needs_review"), ("c", None)], "stem string, status string"))
    assert [x.stem for x in fine.collect()] == ["a"] and sorted(tuple(x) for x in refused.collect()) == [("b", "needs_review"), ("c", "unknown")]
    e = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1)], "stem string, idx int")
    assert rd.pending(e, e.limit(1), ["stem", "idx"]).count() == 2 and rd.pending(e, e, ["stem", "idx"], force=True).count() == 3
    assert [tuple(x) for x in rd.pending(e, e.where("idx = 2"), ["stem", "idx"], limit=1).collect()] == [("a", 1)]

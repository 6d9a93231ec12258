import json
import struct
import zlib

import pytest

from quillgrid import fixed
from quillgrid.operators import readings as rd
from quillgrid.operators import reconcile, records
from quillgrid.sources import files
from quillgrid.streaming import incremental


def png(width, height, value):
    chunk = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    raw = b"".join(b"\0" + bytes([value]) * width for _ in range(height))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, 0, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b"")


def test_images(spark, tmp_path):
    (tmp_path / "a_p1.png").write_bytes(png(4, 3, 77))
    (tmp_path / "bad.png").write_bytes(b"no image")
    out = {r.page: r for r in files.images(spark, str(tmp_path)).collect()}
    assert (out["a_p1"].height, out["a_p1"].width, out["a_p1"].channels, bytes(out["a_p1"].data)) == (3, 4, 1, bytes([77]) * 12)
    assert out["bad"].height == -1


def test_documents_and_stems(spark, tmp_path):
    reading = lambda v: {"value": v, "confidence": "high"}
    for stem in ("b_p10", "b_p2", "a_p1"):
        (tmp_path / "seg" / stem).mkdir(parents=True)
        (tmp_path / "seg" / stem / f"{stem}.json").write_text(json.dumps({"stem": stem, "status": "ok", "records": [{"index": 1, "y0": 0, "y1": 5, "strip": "s"}], "col_x": [1], "warnings": []}, indent=1))
        (tmp_path / "seg" / stem / "other.json").write_text("{}")
        (tmp_path / "ext").mkdir(exist_ok=True)
        (tmp_path / "ext" / f"{stem}.json").write_text(json.dumps({"stem": stem, "model": "m", "prompt_version": "1", "records": {"2": {"fields": {f: reading(f) for f in fixed.FIELDS}, "usage": {"input_tokens": 3, "output_tokens": 4, "latency_s": 0.5}}}}, indent=1))
    (tmp_path / "ext" / "compare_x.json").write_text("{}")
    stems = files.stems(spark, str(tmp_path / "seg"), own_folder=True)
    assert [r.stem for r in stems.collect()] == ["a_p1", "b_p2", "b_p10"]
    assert [r.stem for r in files.stems(spark, str(tmp_path / "ext"), skip="compare_").collect()] == ["a_p1", "b_p2", "b_p10"]
    assert [r.stem for r in files.listed(spark, ["b_p2", "z"], stems).collect()] == ["b_p2", "z", "a_p1", "b_p10"]
    strips = rd.strips(files.extractions(spark, str(tmp_path / "ext"))).collect()
    assert len(strips) == 3 and strips[0].idx == 2 and strips[0].fields.sex.value == "sex" and strips[0].usage.input_tokens == 3
    manifests = files.manifests(spark, str(tmp_path / "seg")).where("stem IS NOT NULL")
    assert manifests.count() == 3 and manifests.first().records[0].y1 == 5
    assert files.find_file(spark, str(tmp_path), "b_p2.json").count() == 1


def test_extractions_of_any_stem(spark, tmp_path):
    for stem in ("c1p0", "clinic", "compare_c1p0", "b"):
        (tmp_path / f"{stem}.json").write_text(json.dumps({"stem": stem, "model": "m", "records": {}}))
    assert sorted(r.stem for r in files.extractions(spark, str(tmp_path)).collect()) == ["b", "c1p0", "clinic"]


def test_pages_without_extraction_are_refused(spark):
    pages = spark.createDataFrame([("a", "ok"), ("b", "needs_review"), ("c", None), ("d", "ok")], "stem string, status string")
    fine, refused = rd.usable(pages, spark.createDataFrame([("a",), ("b",)], "stem string"))
    assert [r.stem for r in fine.collect()] == ["a"]
    assert {tuple(r) for r in refused.collect()} == {("b", "needs_review"), ("c", "unknown"), ("d", "no-extraction")}


def test_extraction_documents_after_a_run(spark):
    cells = {n: {"value": "x", "confidence": "high"} for n in fixed.FIELDS}
    old = spark.createDataFrame([("p", "was", "0", {"1": (cells, (1, 2, 0.5)), "2": (cells, (3, 4, 0.5))}), ("q", "was", "0", {})], rd.EXTRACTION_TYPE)
    new = {n: {"value": "y", "confidence": "low"} for n in fixed.FIELDS}
    read = spark.createDataFrame([("p", 2, None, 0, 0, "E: no"), ("p", 3, new, 1_000_000, 10, None), ("r", 1, None, 0, 0, "E: no")], f"stem string, idx int, fields {rd.FIELDS_TYPE}, input_tokens bigint, output_tokens bigint, error string")
    out = {r.stem: r for r in files.extraction_pages(old, read, "gemini-3.7-flash", "2").collect()}
    assert set(out) == {"p", "q", "r"} and out["q"].records == {} and out["r"].records == {}
    p = out["p"]
    assert (p.model, p.prompt_version, sorted(p.records)) == ("gemini-3.7-flash", "2", ["1", "2", "3"])
    assert p.records["2"].fields.sex.value == "x" and p.records["3"].fields.sex.value == "y"
    assert (p.totals.input_tokens, p.totals.output_tokens, p.totals.est_cost_usd) == (1_000_004, 16, 0.750063)
    assert files.extraction_pages(None, read, "m", "2").count() == 2


def test_logs_and_corrections(spark, tmp_path):
    rows = spark.createDataFrame([("t", "d", "1", "2", "Sex", "", 'a "b"', "MATCH")], files.AUDIT_TYPE)
    files.append_audit(rows, str(tmp_path / "log"))
    files.append_audit(rows, str(tmp_path / "log"))
    back = files.audit_log(spark, str(tmp_path / "log")).collect()
    assert len(back) == 2 and back[0].stored_value == "" and back[0].result == "MATCH"
    (tmp_path / "c.json").write_text(json.dumps([[3, "7", {"Sex": "M"}], [4, 8, {}]]))
    assert [tuple(r) for r in files.corrections(spark, str(tmp_path / "c.json")).collect()] == [("3", "7", {"Sex": "M"}, 0), ("4", "8", {}, 1)]


def test_record_partitions(spark, tmp_path):
    s = spark.createDataFrame([(0, "R1", "x"), (1, "R2", "y")], "row_id long, Region string, Sex string")
    files.write_records(records.append(spark.createDataFrame([], "row_id long, " + ", ".join(f"`{c}` string" for c in fixed.COLUMNS)), s), str(tmp_path / "s"))
    assert sorted(p.name for p in (tmp_path / "s").iterdir() if p.is_dir()) == ["region=R1", "region=R2"]


class Busy(Exception):
    code = 503


def make_reader():
    tries = {}

    def read(path, instruction, context):
        assert "strip" in instruction
        tries[path] = tries.get(path, 0) + 1
        if path == "busy" and tries[path] < 3:
            raise Busy("wait")
        if path == "bad":
            raise ValueError("size 15000")
        return {"sex": ("F", "high")}, (5, 6)

    return read


class Fussy:
    def __init__(self, plain=False):
        self.plain = plain

    def __call__(self, path, instruction, context):
        if not self.plain:
            raise ValueError("option thinking is not known")
        return {"sex": ("F", "high")}, (1, 1)

    def plainer(self, error):
        return Fussy(True) if "thinking" in str(error) and not self.plain else None


def test_a_rejected_option_uses_no_attempt(spark):
    todo = spark.createDataFrame([("p", 1, "x", None), ("p", 2, "y", None)], "stem string, idx int, path string, context string")
    out = files.read_strips(todo.coalesce(1), Fussy, attempts=1, pause=lambda s: None).collect()
    assert all(r.error is None and r.fields.sex.value == "F" for r in out)


def test_reading_strips(spark):
    todo = spark.createDataFrame([("p", 1, "fine", None), ("p", 2, "busy", "c"), ("p", 3, "bad", None)], "stem string, idx int, path string, context string")
    out = {r.idx: r for r in files.read_strips(todo.coalesce(1), make_reader, pause=lambda s: None).collect()}
    assert out[1].fields.sex.value == "F" and out[1].fields.day.value == "" and out[2].error is None and out[2].input_tokens == 5
    assert out[3].fields is None and out[3].error.startswith("ValueError")


def test_incremental_reading(spark, tmp_path):
    manifest = lambda stem, n, status="ok": json.dumps({"stem": stem, "status": status, "records": [{"index": i + 1, "strip": f"{stem}{i}"} for i in range(n)]})
    src, out, ck = (str(tmp_path / x) for x in ("in", "out", "ck"))
    (tmp_path / "in").mkdir()

    def read(df):
        from pyspark.sql import functions as F

        return df.select("stem", "idx", F.lit(None).cast("string").alias("error"))

    (tmp_path / "in" / "1.json").write_text(manifest("a", 2) + "\n" + manifest("no", 3, "needs_review"))
    assert incremental.extract_available(spark, src, out, ck, read) == 2
    assert incremental.extract_available(spark, src, out, ck, read) == 2
    (tmp_path / "in" / "2.json").write_text(manifest("a", 3))
    assert incremental.extract_available(spark, src, out, ck, read) == 3


def test_page_documents(spark):
    fields = {n: {"value": "1" if n in ("record_no", "full_cost", "sex") else "", "confidence": "high"} for n in fixed.FIELDS}
    strips = spark.createDataFrame([("p", 1, fields)], f"stem string, idx int, fields {rd.FIELDS_TYPE}")
    e = reconcile.reconcile(strips)
    from pyspark.sql import functions as F

    doc = files.documents(e, reconcile.page_checks(strips, strips, e), F.lit("m")).first()
    assert doc.stem == "p" and doc.entities[0].record_no.value == "1" and doc.page_checks.record_no_sequence == "ok"


def test_strict_readings(spark):
    r = spark.createDataFrame([("sex", "M", "illegible")], "field string, value string, confidence string")
    with pytest.raises(Exception, match="invalid reading of sex"):
        rd.checked(r).collect()

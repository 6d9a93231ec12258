"""Sources and sinks: page images, JSON documents, CSV logs, record partitions."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillgrid import fixed
from quillgrid.functions import text
from quillgrid.operators.imaging import PAGE_TYPE
from quillgrid.operators.readings import EXTRACTION_RECORDS, EXTRACTION_TYPE, FIELDS_TYPE, MANIFEST_TYPE
from quillgrid.operators.reconcile import WARNING

AUDIT_TYPE = "timestamp string, source_pdf string, page string, record_no string, field string, stored_value string, reread_value string, result string"


def images(spark: SparkSession, *paths: str) -> DataFrame:
    """Page rows of image files; an unreadable file is a row of height -1."""
    raw = spark.read.format("image").option("dropInvalid", False).load(list(paths)).select("image.*")
    name = F.regexp_extract(F.element_at(F.split("origin", "/"), -1), r"^(.*?)(\.[^.]*)?$", 1)
    return raw.select(name.alias("page"), "height", "width", F.col("nChannels").alias("channels"), "data").to(spark.createDataFrame([], PAGE_TYPE).schema)


def stems(spark: SparkSession, root: str, own_folder: bool = False, skip: str | None = None) -> DataFrame:
    """Stems of the JSON files under root, in natural order; own_folder keeps files named as their folder, skip drops a prefix."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").load(root).select("path")
    named = files.select(F.regexp_extract("path", r"([^/]+)\.json$", 1).alias("stem"), F.regexp_extract("path", r"([^/]+)/[^/]+\.json$", 1).alias("folder"))
    if own_folder:
        named = named.where("stem = folder")
    if skip:
        named = named.where(~F.col("stem").startswith(skip))
    return named.select("stem").orderBy(text.natural_key(F.col("stem")), "stem")


def listed(spark: SparkSession, named: list[str], found: DataFrame) -> DataFrame:
    """Named stems first, in their order, then found ones; each once."""
    own = spark.createDataFrame(list(enumerate(named)), "place int, stem string").select(F.lit(0).alias("side"), "place", "stem")
    rest = found.select(F.lit(1).alias("side"), F.lit(0).alias("place"), "stem")
    return own.union(rest).groupBy("stem").agg(F.min(F.struct("side", "place")).alias("at")).orderBy("at", text.natural_key(F.col("stem"))).select("stem")


def manifests(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(MANIFEST_TYPE).option("multiLine", True).option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").json(path)


def extractions(spark: SparkSession, path: str) -> DataFrame:
    """Extraction documents; reports of comparisons, which lie beside them, are left out."""
    found = spark.read.schema(EXTRACTION_TYPE).option("multiLine", True).option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").json(path)
    return found.where(~F.col("_metadata.file_name").startswith("compare_"))


def audit_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(AUDIT_TYPE).option("header", True).option("escape", '"').csv(path).fillna("")


def corrections(spark: SparkSession, path: str) -> DataFrame:
    """page, record_no, updates (map) and entry from a JSON list of [page, number, {field: value}]."""
    whole = spark.read.text(path, wholetext=True).select(F.from_json("value", "array<string>").alias("list"))
    entry = whole.select(F.posexplode("list").alias("entry", "e"))
    part = lambda k: F.get_json_object("e", f"$[{k}]")
    return entry.select(part(0).alias("page"), part(1).alias("record_no"), F.from_json(part(2), "map<string,string>").alias("updates"), "entry")


def find_file(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The path of the first file of that name below root, if there is one."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", name).load(root).select("path").orderBy("path").limit(1)


def write_pages(df: DataFrame, path: str) -> None:
    """One JSON line file a page, in folders by stem."""
    df.repartition("stem").write.mode("overwrite").partitionBy("stem").json(path)


def write_records(store: DataFrame, path: str) -> None:
    """The record store as Parquet, a partition a region."""
    store.withColumn("region", F.col("Region")).write.mode("overwrite").partitionBy("region").parquet(path)


def append_audit(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").option("header", True).option("quoteAll", True).option("escape", '"').csv(path)


def write_disagreements(df: DataFrame, path: str) -> None:
    df.coalesce(1).write.mode("overwrite").option("header", True).option("emptyValue", "").option("escape", '"').csv(path)


def read_strips(pending: DataFrame, make_reader: Callable[[], Callable], attempts: int = 4, pause: Callable[[float], None] | None = None) -> DataFrame:
    """Reads pending strips (stem, idx, path, context) with an injected reader; a failing strip gives an error row only.

    make_reader is called once a partition, so a client is made where it is used, and only if there is a strip. The
    reader takes (path, instruction, context) and returns ({field: (value, confidence)}, (input tokens, output tokens)).
    An error that is worth it is tried again after 1, 2, 4 ... seconds. Where a reader has a method plainer(error) that returns
    a reader (it does when an option of its own was rejected), that one goes on at once, and no attempt is used.
    """
    import re

    codes, words, pattern = set(fixed.RETRY_CODES), tuple(fixed.RETRY_WORDS), re.compile(fixed.RETRY_PATTERN)

    def again(error: Exception) -> bool:
        code = getattr(error, "code", None)
        return code in codes if code is not None else bool(pattern.search(str(error))) or any(w in str(error) for w in words)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import time

        reader, wait = None, pause or time.sleep
        for batch in batches:
            out = []
            for row in batch.itertuples():
                reader = reader or make_reader()
                fields, usage, error = None, (0, 0), None
                k = 0
                while k < attempts:
                    try:
                        fields, usage = reader(row.path, row.instruction, row.context)
                        error = None
                        break
                    except Exception as e:  # noqa: BLE001  a strip's error is its own row
                        error = f"{type(e).__name__}: {e}"
                        if (other := getattr(reader, "plainer", lambda _: None)(e)) is not None:
                            reader = other
                            continue
                        k += 1
                        if k == attempts or not again(e):
                            break
                        wait(2.0 ** (k - 1))
                if fields is not None:
                    fields = {n: dict(zip(("value", "confidence"), fields.get(n, ("", "high")), strict=True)) for n in fixed.FIELDS}
                out.append((row.stem, row.idx, fields, *usage, error))
            yield pd.DataFrame(out, columns=["stem", "idx", "fields", "input_tokens", "output_tokens", "error"])

    rows = pending.select("stem", "idx", "path", F.coalesce("context", F.lit("")).alias("context")).withColumn("instruction", text.instruction(F.col("idx"), F.col("context")))
    return rows.mapInPandas(run, f"stem string, idx int, fields {FIELDS_TYPE}, input_tokens bigint, output_tokens bigint, error string")


def extraction_pages(before: DataFrame | None, read: DataFrame, model: str, prompt_version: str) -> DataFrame:
    """Extraction documents after a run: stem, model, prompt_version, records and totals. read: rows of read_strips(), before: the documents as they were.

    A strip that was read takes its place; one that failed keeps what it had, so it is tried again; model and prompt version are those of
    this run.
    """
    usage = F.struct("input_tokens", "output_tokens", F.lit(None).cast("double").alias("latency_s")).alias("usage")
    fine = read.where("error IS NULL").groupBy("stem").agg(F.map_from_entries(F.collect_list(F.struct(F.col("idx").cast("string"), F.struct("fields", usage)))).alias("new"))
    pages = read.select("stem").distinct().join(fine, "stem", "left")
    kind = EXTRACTION_RECORDS
    if before is not None:
        pages = pages.join(before.select("stem", F.col("records").alias("old")), "stem", "full")
    own = lambda c: F.coalesce(F.col(c).cast(kind) if c in pages.columns else F.lit(None).cast(kind), F.create_map().cast(kind))
    merged = pages.select("stem", F.map_zip_with(own("old"), own("new"), lambda k, a, b: F.coalesce(b, a)).alias("records"))
    total = lambda c: F.aggregate(F.map_values("records"), F.lit(0).cast("long"), lambda a, r: a + F.coalesce(r["usage"][c], F.lit(0).cast("long")))
    tokens = merged.withColumns({"input_tokens": total("input_tokens"), "output_tokens": total("output_tokens")})
    totals = F.struct("input_tokens", "output_tokens", F.round(text.cost(F.lit(model), F.col("input_tokens"), F.col("output_tokens")), 6).alias("est_cost_usd"))
    return tokens.select("stem", F.lit(model).alias("model"), F.lit(prompt_version).alias("prompt_version"), "records", totals.alias("totals"))


def documents(entities: DataFrame, checks: DataFrame, model: Column) -> DataFrame:
    """Reconciled page documents: stem, model, reconciler_version, entities and page_checks, one row a page."""
    own = [c for c in entities.columns if c not in ("stem", "model")]
    grouped = entities.groupBy("stem").agg(F.sort_array(F.collect_list(F.struct("seq", *[c for c in own if c != "seq"]))).alias("entities"))
    checked = checks.select("stem", F.struct("record_no_sequence", F.col("warnings").cast(f"array<{WARNING}>").alias("warnings"), "review").alias("page_checks"))
    return checked.join(grouped, "stem", "left").select("stem", model.alias("model"), F.lit(fixed.RECONCILER).alias("reconciler_version"), "entities", "page_checks")

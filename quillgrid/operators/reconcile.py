"""Strips of a page to entities: classify, repair, group, merge, and flag for review, for all pages in one plan.

One shuffle brings a page's strips together; classification is a fold over a page's few strips in an Arrow batch
function (it needs the matching-blocks ratio), everything else is window and array functions over the same
partitioning. A page is a bounded unit: its strips fit in a row.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructType

from quillgrid import fixed
from quillgrid.functions import similarity, text
from quillgrid.operators.readings import READING, value

WARNING = "struct<reason:string,strip:int,field:string,primary:string,continuation:string,with_seq:int>"
EVENT = "struct<strip:int,pos:int,field:string,what:string,a:string,b:string>"


def warning(**given: Column) -> Column:
    kinds = {"reason": "string", "strip": "int", "field": "string", "primary": "string", "continuation": "string", "with_seq": "int"}
    return F.struct(*[given.get(k, F.lit(None)).cast(t).alias(k) for k, t in kinds.items()])


# --- classification ---


def alike(a: str, b: str) -> bool:
    return similarity.alike(a, b, fixed.ALIKE)


def continues(p: dict, c: dict) -> bool:
    """Whether strip c goes on with the entity that strip p began. p and c: normalised identity, number, and whether there is content."""
    if p["name"] and c["name"]:
        if not alike(p["name"], c["name"]):
            return False
    elif p["number"] and c["number"] and p["number"] != c["number"]:
        return False
    for key, same in (("sex", str.__eq__), ("age", str.__eq__), ("place", alike)):
        if p[key] and c[key] and not same(p[key], c[key]):
            return False
    return c["content"]


def fold(page: list[dict]) -> list[dict]:
    """kind and reason of each strip of a page, in order."""
    out, begun = [], None
    for c in page:
        kind, reason = "primary", None
        if c["blank"]:
            out.append({"kind": "empty", "reason": None})
            continue
        if begun is not None:
            same_number = c["number"] and c["number"] == begun["number"]
            if same_number and c["name"] and begun["name"] and not alike(begun["name"], c["name"]):
                reason = "ambiguous-continuation"
            elif continues(begun, c):
                kind = "continuation"
                reason = "recno-mismatch-name-match" if begun["number"] and c["number"] and not same_number else None
        out.append({"kind": kind, "reason": reason})
        if kind == "primary":
            begun = c
    return out


@F.pandas_udf(ArrayType(StructType().add("kind", StringType()).add("reason", StringType())))
def _kinds(names: pd.Series, places: pd.Series, numbers: pd.Series, sexes: pd.Series, ages: pd.Series, contents: pd.Series, blanks: pd.Series) -> pd.Series:
    keys = ("name", "place", "number", "sex", "age", "content", "blank")
    return pd.Series([fold([dict(zip(keys, row, strict=True)) for row in zip(*page, strict=True)]) for page in zip(names, places, numbers, sexes, ages, contents, blanks, strict=True)])


def classify(strips: DataFrame) -> DataFrame:
    """strips (stem, idx, fields; a model column is kept) with kind and reason."""
    f = F.col("fields")
    any_of = lambda names: F.greatest(*[value(f, n) != "" for n in names])
    light = F.struct(
        "idx", "fields", text.norm(value(f, fixed.NAME)).alias("name"), text.norm(value(f, fixed.PLACE)).alias("place"), value(f, fixed.NUMBER).alias("number"),
        text.norm(value(f, "sex")).alias("sex"), text.norm(value(f, "age_yrs")).alias("age"), any_of(fixed.CONTENT).alias("content"), (~any_of(fixed.FIELDS)).alias("blank"),
    )
    keys = [c for c in ("stem", "model") if c in strips.columns]
    pages = strips.groupBy(*keys).agg(F.array_sort(F.collect_list(light), lambda a, b: a["idx"] - b["idx"]).alias("s"))
    kinds = _kinds(*[F.col("s")[k] for k in ("name", "place", "number", "sex", "age", "content", "blank")])
    # the function's rows and the strips are zipped once, so the batch function runs once a page
    return pages.withColumn("k", kinds).select(*keys, F.explode(F.arrays_zip("s", "k")).alias("z")).select(*keys, "z.s.idx", "z.s.fields", "z.k.kind", "z.k.reason")


# --- clipping and repair ---


def empties(fields: Column, names: list[str]) -> Column:
    return sum((F.when(value(fields, n) == "", 1).otherwise(0) for n in names), F.lit(0))


def clipped(fields: Column) -> Column:
    """All checkboxes empty, or most core fields."""
    return (empties(fields, fixed.CHECKBOXES) == len(fixed.CHECKBOXES)) | (empties(fields, fixed.CLIP) >= fixed.LEAST_EMPTY)


def repair_geometry(header: Column, height: Column, y0: Column, y1: Column) -> tuple[Column, Column]:
    """Slack above and below a strip that is read again: a sub-row, within the body of the page."""
    sub = F.greatest(F.lit(1), F.floor((y1 - y0) / fixed.SUBROWS).cast("int"))
    return y0 - F.greatest(header, y0 - sub), F.least(height, y1 + sub) - y1


def filled(fields: Column, again: Column) -> tuple[Column, Column]:
    """fields with blank repairable readings taken from the second reading, and their names in form order."""
    take = {n: again.isNotNull() & (value(fields, n) == "") & (value(again, n) != "") for n in fixed.FIELDS if n in fixed.REPAIRABLE}
    new = F.struct(*[(F.when(take[n], again[n]).otherwise(fields[n]) if n in take else fields[n]).alias(n) for n in fixed.FIELDS])
    return new, F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in take.items()]))


def repair(classified: DataFrame, rereads: DataFrame | None) -> DataFrame:
    """classified strips with clipped primaries repaired from rereads (stem, idx, fields, input_tokens, output_tokens).

    Adds repaired (names, null where nothing could be read again), and boxes_empty and core_filled as they were before.
    """
    f = F.col("fields")
    needs = (F.col("kind") == "primary") & clipped(f)
    before = classified.withColumns({"needs": needs, "boxes_empty": empties(f, fixed.CHECKBOXES) == len(fixed.CHECKBOXES), "core_filled": len(fixed.CLIP) - empties(f, fixed.CLIP)})
    if rereads is None:
        return before.withColumns({"repaired": F.when(~F.col("needs"), F.array().cast("array<string>")), "calls": F.lit(0), "input_tokens": F.lit(0).cast("long"), "output_tokens": F.lit(0).cast("long")})
    again = rereads.select("stem", "idx", F.col("fields").alias("again"), "input_tokens", "output_tokens")
    both = before.join(again, ["stem", "idx"], "left")
    new, names = filled(f, F.col("again"))
    used = F.col("needs") & F.col("again").isNotNull()
    return both.select(
        *[c for c in before.columns if c != "fields"], F.when(used, new).otherwise(f).alias("fields"),
        F.when(used, names).when(~F.col("needs"), F.array().cast("array<string>")).alias("repaired"), used.cast("int").alias("calls"),
        *[F.when(used, F.coalesce(F.col(c), F.lit(0))).otherwise(0).cast("long").alias(c) for c in ("input_tokens", "output_tokens")],
    )


# --- grouping and merging ---


def numbered(classified: DataFrame) -> DataFrame:
    """Non-empty strips with seq, the running count of primaries on their page."""
    page = Window.partitionBy("stem").orderBy("idx").rowsBetween(Window.unboundedPreceding, 0)
    return classified.where("kind <> 'empty'").withColumn("seq", F.sum(F.when(F.col("kind") == "primary", 1).otherwise(0)).over(page).cast("int"))


def merge_field(group: Column, name: str, pos: int) -> Column:
    """The reading of one scalar field of a group of strips (primary first) and what happened to it, strip by strip."""
    start = F.struct(group[0]["fields"][name].cast(READING).alias("r"), F.array().cast(f"array<{EVENT}>").alias("events"))
    check = lambda v: text.valid(name, v)

    def step(s: Column, x: Column) -> Column:
        mine, other = text.strip(F.coalesce(s["r"]["value"], F.lit(""))), value(x["fields"], name)

        def note(what: str, a: Column, b: Column) -> Column:
            return F.concat(s["events"], F.array(F.struct(x["idx"].cast("int").alias("strip"), F.lit(pos).alias("pos"), F.lit(name).alias("field"), F.lit(what).alias("what"), a.alias("a"), b.alias("b")).cast(EVENT)))

        def state(r: Column, events: Column) -> Column:
            return F.struct(r.cast(READING).alias("r"), events.alias("events"))

        new = x["fields"][name]
        out = F.when(other == "", s).when(mine == "", state(new, note("filled", other, F.lit("")))).when(text.norm(mine) == text.norm(other), s)
        if name == fixed.NUMBER:
            return out.otherwise(s)
        if check(mine) is not None:
            out = out.when(check(other) & ~check(mine), state(new, note("resolved", other, mine))).when(check(mine) & ~check(other), state(s["r"], note("resolved", mine, other)))
        return out.otherwise(state(s["r"], note("conflict", mine, other)))

    return F.aggregate(F.slice(group, 2, F.greatest(F.size(group), F.lit(1))), start, step)


def merge(strips: DataFrame) -> DataFrame:
    """Entities of (stem, seq): merged scalar readings, treatments, tab_nos, provenance, and warnings of conflicts."""
    own = ["idx", "fields", "reason", "repaired", "boxes_empty", "core_filled", "calls", "input_tokens", "output_tokens"]
    have = [c for c in own if c in strips.columns]
    keys = [c for c in ("stem", "model", "seq") if c in strips.columns]
    g = F.col("g")
    grouped = strips.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(*have)), lambda a, b: a["idx"] - b["idx"]).alias("g"))
    merged = grouped.select(*keys, "g", *[merge_field(g, n, k).alias(f"m_{n}") for k, n in enumerate(fixed.SCALARS)])
    events = F.array_sort(F.concat(*[F.col(f"m_{n}")["events"] for n in fixed.SCALARS]))
    listed = lambda names: F.filter(F.flatten(F.transform(g, lambda s: F.array(*[s["fields"][n].cast(READING) for n in names]))), lambda r: ~text.blank(r["value"]))
    what = lambda kind: F.filter("events", lambda e: e["what"] == kind)
    conflicts = F.transform(what("conflict"), lambda e: warning(field=e["field"], primary=e["a"], continuation=e["b"]))
    return (
        merged.withColumn("events", events)
        .withColumns(
            {
                "treatments": listed(fixed.TREATMENTS), "tab_nos": listed([fixed.TABLET]),
                "source_strips": F.transform(g, lambda s: s["idx"]), "merged_from": F.transform(F.slice(g, 2, F.size(g)), lambda s: s["idx"]),
                "filled_from_continuation": F.transform(what("filled"), lambda e: e["field"]),
                "resolved_conflicts": F.transform(what("resolved"), lambda e: F.struct(e["field"].alias("field"), e["a"].alias("kept"), e["b"].alias("rejected"), F.lit("validator").alias("how"))),
                "warnings": conflicts, "review": F.size(conflicts) > 0, **{n: F.col(f"m_{n}")["r"] for n in fixed.SCALARS},
            }
        )
        .drop("events", *[f"m_{n}" for n in fixed.SCALARS])
    )


def possible_split(next_: Column) -> Column:
    """Whether an entity (this row) and the next on its page (a struct of it) may be one that was taken apart."""
    stripped = lambda c: text.strip(F.coalesce(c, F.lit("")))
    numbers = text.similar_numbers(stripped(F.col("record_no")["value"]), stripped(next_["record_no"]["value"]))
    content = (F.size(next_["treatments"]) > 0) | (F.size(next_["tab_nos"]) > 0) | F.greatest(*[~text.blank(next_[n]["value"]) for n in ("full_cost", "balance", "cost_after_discount", "diagnosis")])
    fragment = (F.size(next_["source_strips"]) == 1) & content & next_["boxes_empty"] & (next_["core_filled"] <= 2)
    return next_.isNotNull() & (numbers | F.coalesce(fragment, F.lit(False)))


def flag_splits(entities: DataFrame) -> DataFrame:
    """Adjacent entities that may be one: both get a warning that names the other, and review."""
    page = Window.partitionBy("stem").orderBy("seq")
    own = F.struct("seq", "record_no", "treatments", "tab_nos", "full_cost", "balance", "cost_after_discount", "diagnosis", "source_strips", "boxes_empty", "core_filled")
    after = entities.withColumn("_next", F.lead(own).over(page))
    after = after.withColumn("_split", F.coalesce(possible_split(F.col("_next")), F.lit(False)))
    before = after.withColumn("_before", F.coalesce(F.lag("_split").over(page), F.lit(False)))
    same = lambda seq: warning(reason=F.lit("possible-same-patient"), with_seq=seq)
    extra = F.array_compact(F.array(F.when(F.col("_before"), same(F.col("seq") - 1)), F.when(F.col("_split"), same(F.col("seq") + 1))))
    return before.withColumns({"warnings": F.concat("warnings", extra), "review": F.col("review") | F.col("_split") | F.col("_before")}).drop("_next", "_split", "_before")


def reconcile(strips: DataFrame, rereads: DataFrame | None = None) -> DataFrame:
    """Entities of all pages. strips: stem, idx, fields (and model); rereads: second readings of clipped strips."""
    merged = merge(numbered(repair(classify(strips), rereads)))
    first, rest = F.col("g")[0], F.slice(F.col("g"), 2, F.size("g"))
    unread = F.when(first["repaired"].isNull(), warning(reason=F.lit("clipped-no-repair"), strip=first["idx"]))
    began = F.when(first["reason"].isNotNull(), warning(reason=first["reason"], strip=first["idx"]))
    told = F.transform(F.filter(rest, lambda s: s["reason"].isNotNull()), lambda s: warning(reason=s["reason"], strip=s["idx"]))
    total = lambda c: F.aggregate("g", F.lit(0).cast("long"), lambda a, s: a + s[c].cast("long"))
    whole = merged.withColumns(
        {
            "warnings": F.concat("warnings", F.array_compact(F.array(unread, began)), told), "review": F.col("review") | first["repaired"].isNull() | first["reason"].isNotNull(),
            "repaired_fields": F.coalesce(first["repaired"], F.array().cast("array<string>")), "boxes_empty": first["boxes_empty"], "core_filled": first["core_filled"],
            "calls": total("calls"), "input_tokens": total("input_tokens"), "output_tokens": total("output_tokens"),
        }
    ).drop("g")
    return flag_splits(whole)


# --- page checks ---


def sequence_status(numbers: Column) -> Column:
    """non-numeric, duplicate, gap or ok of an array of non-blank numbers in order."""
    n = F.transform(numbers, lambda x: x.try_cast("decimal(38,0)"))
    steps = F.zip_with(F.slice(n, 1, F.greatest(F.size(n) - 1, F.lit(0))), F.slice(n, 2, F.greatest(F.size(n), F.lit(1))), lambda a, b: b - a)
    return F.when(F.exists(numbers, lambda x: ~text.digits(x)), "non-numeric").when(F.size(F.array_distinct(n)) < F.size(n), "duplicate").when(F.exists(steps, lambda d: d != 1), "gap").otherwise("ok")


def missing(expected: DataFrame, present: DataFrame) -> DataFrame:
    """(stem, idx) that a manifest lists and no extraction has."""
    return expected.select("stem", "idx").join(present.select("stem", "idx"), ["stem", "idx"], "left_anti")


def page_checks(expected: DataFrame, present: DataFrame, entities: DataFrame) -> DataFrame:
    """stem, n_entities, record_no_sequence, warnings and review of every page of a manifest (stem, idx)."""
    gone = missing(expected, present).groupBy("stem").agg(F.transform(F.array_sort(F.collect_list("idx")), lambda i: warning(reason=F.lit("missing-extraction"), strip=i)).alias("gone"))
    number = text.strip(F.coalesce(F.col("record_no")["value"], F.lit("")))
    seen = entities.groupBy("stem").agg(F.count("*").alias("n"), F.array_sort(F.collect_list(F.when(number != "", F.struct("seq", number.alias("v"))))).alias("v"))
    pages = expected.select("stem").distinct().join(gone, "stem", "left").join(seen, "stem", "left")
    none = F.array().cast(f"array<{WARNING}>")
    told = F.concat(F.coalesce("gone", none), F.when(F.col("n").isNull(), F.array(warning(reason=F.lit("no-patients")))).otherwise(none))
    numbers = F.coalesce(F.transform("v", lambda x: x["v"]), F.array().cast("array<string>"))
    return pages.select("stem", F.coalesce("n", F.lit(0)).alias("n_entities"), sequence_status(numbers).alias("record_no_sequence"), told.alias("warnings")).withColumn("review", F.size("warnings") > 0)


def resumed(pages: DataFrame, done: DataFrame, force: bool = False) -> DataFrame:
    """Pages that still have to be reconciled."""
    return pages if force else pages.join(done.select("stem").distinct(), "stem", "left_anti")


def repair_usage(entities: DataFrame, model: str) -> DataFrame:
    """stem, calls, tokens and est_cost_usd (to six digits) of the second readings of every page."""
    each = entities.groupBy("stem").agg(*[F.sum(c).alias(c) for c in ("calls", "input_tokens", "output_tokens")])
    return each.withColumn("est_cost_usd", F.round(text.cost(F.lit(model), F.col("input_tokens"), F.col("output_tokens")), 6))


def run_totals(checks: DataFrame, entities: DataFrame) -> DataFrame:
    """One row over a run: pages, entities, merged, repaired, reviews (a page's own review counts once more) and exit_code."""
    e = entities.agg(F.count("*").alias("entities"), F.count_if(F.size("merged_from") > 0).alias("merged"), F.coalesce(F.sum("calls"), F.lit(0)).cast("long").alias("repaired"), F.count_if("review").alias("r"))
    p = checks.agg(F.count("*").alias("pages"), F.count_if("review").alias("p"))
    both = p.join(e)  # one row each
    return both.select("pages", "entities", "merged", "repaired", (F.col("r") + F.col("p")).alias("reviews"), F.when(F.col("r") + F.col("p") > 0, 2).otherwise(0).alias("exit_code"))



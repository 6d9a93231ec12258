"""Scalar functions on readings, as column expressions that stay in generated code."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillgrid import fixed

#: White space as str.split() and str.strip() know it.
SPACE = r"[\p{IsWhite_Space}\x1c-\x1f]+"


def strip(c: Column) -> Column:
    return F.regexp_replace(c, rf"^{SPACE}|{SPACE}$", "")


#: Characters that case folding changes into one character, and into several, as long strings: a map would be a literal a letter in every plan.
_FOLDS = {c: c.casefold() for c in map(chr, range(0x110000)) if c.casefold() != c}
_FROM, _TO = ("".join(x) for x in zip(*[(c, f) for c, f in _FOLDS.items() if len(f) == 1], strict=True))
_LONGER = {c: f for c, f in _FOLDS.items() if len(f) > 1}
_TABLE = ";" + ";".join(f"{c}={f}" for c, f in _LONGER.items()) + ";"


def fold(c: Column) -> Column:
    """Case folded as str.casefold() does it, character by character."""
    some = "[" + "".join(_LONGER) + "]"
    one = lambda x: F.when(x.rlike(some), F.call_function("regexp_extract", F.lit(_TABLE), F.concat(F.lit(";"), x, F.lit("=([^;]*)")), F.lit(1))).otherwise(x)
    longer = F.array_join(F.transform(F.split(c, ""), one), "")
    full = F.translate(F.when(c.rlike(some), longer).otherwise(c), _FROM, _TO)
    return F.when(F.length(c) == F.octet_length(c), F.lower(c)).otherwise(full)  # ASCII needs no table


def norm(c: Column) -> Column:
    """Runs of white space become one space, and case is folded."""
    return fold(F.regexp_replace(strip(c), SPACE, " "))


def blank(c: Column) -> Column:
    return strip(F.coalesce(c, F.lit(""))) == ""


def digits(c: Column) -> Column:
    return F.coalesce(c, F.lit("")).rlike("^[0-9]+$")


def valid(field: str, c: Column) -> Column | None:
    """Whether a non-blank value of the field is valid; None if the field has no rule."""
    if field in fixed.RANGES:
        low, high = fixed.RANGES[field]
        return digits(c) & F.coalesce(c.try_cast("decimal(38,0)").between(low, high), F.lit(False))
    if field in fixed.DECIMALS:
        return c.rlike(r"^[0-9]+(\.[0-9]+)?$")
    if field in fixed.CHOICES:
        return c.isin(fixed.CHOICES[field])
    return digits(c) if field == fixed.NUMBER else None


def similar_numbers(a: Column, b: Column) -> Column:
    """Numbers that may be one, misread: equal, one within the other, or a digit dropped or added; equally long ones that differ are two."""
    close = F.contains(a, b) | F.contains(b, a) | F.levenshtein(a, b, 1).between(0, 1)
    return F.when((a == "") | (b == ""), False).when(a == b, True).when(F.length(a) == F.length(b), False).otherwise(close)


def natural_key(c: Column) -> Column:
    """Orders runs of digits as numbers: p2 before p10."""
    parts = F.filter(F.regexp_extract_all(c, F.lit("[0-9]+|[^0-9]+"), F.lit(0)), lambda x: x != "")
    number = lambda x: x.rlike("^[0-9]+$")
    # a name begins with its (perhaps empty) text, so that a leading number sorts before any letter
    lead = F.when(F.coalesce(parts.getItem(0), F.lit("")).rlike("^[0-9]"), F.concat(F.array(F.lit("")), parts)).otherwise(parts)
    return F.transform(lead, lambda x: F.struct(F.when(number(x), "").otherwise(x).alias("t"), F.when(number(x), x.try_cast("decimal(38,0)")).otherwise(F.lit(-1).cast("decimal(38,0)")).alias("n")))


def marker_colour(c: Column) -> Column:
    """The colour of the marker of highest precedence in a value; null without one."""
    return reduce(lambda out, m: out.when(F.contains(c, F.lit(m[0])), m[1]), fixed.MARKERS[1:], F.when(F.contains(c, F.lit(fixed.MARKERS[0][0])), fixed.MARKERS[0][1]))


def flagged(colour: Column) -> Column:
    return F.coalesce(F.nullif(colour, F.lit(fixed.CLEAR)).isin(fixed.FLAGS), F.lit(False))


def clock(hh: Column, mm: Column, am_pm: Column) -> Column:
    """hh:mm AM, stripped; empty if all three are."""
    return F.when((hh == "") & (mm == "") & (am_pm == ""), "").otherwise(strip(F.concat(hh, F.lit(":"), mm, F.lit(" "), am_pm)))


def context(center: Column, year: Column) -> Column:
    given = lambda label, c: F.when(F.coalesce(c, F.lit("")) != "", F.concat(F.lit(f"{label}: "), c))
    return F.concat_ws(", ", given("Center", center), given("Year", year))


def instruction(index: Column, page_context: Column) -> Column:
    """The reader's instruction for one strip."""
    return F.concat(
        F.lit("Transcribe strip "), index.cast("string"), F.lit(" exactly as written, one reading with its confidence for each field; an illegible cell stays empty."),
        F.when(page_context != "", F.concat(F.lit("\nPage: "), page_context)).otherwise(""),
    )


def retryable(code: Column, message: Column) -> Column:
    """A status code decides where there is one, else the message does."""
    words = reduce(lambda a, b: a | b, (F.contains(message, F.lit(w)) for w in fixed.RETRY_WORDS))
    return F.when(code.isNotNull(), code.isin(fixed.RETRY_CODES)).otherwise(F.coalesce(message.rlike(fixed.RETRY_PATTERN) | words, F.lit(False)))


def parse_response(c: Column) -> Column:
    """The list of records of a reply: fence lines go, then from the first [ to the last ] as JSON; null if there is none."""
    bare = strip(c)
    bare = F.when(bare.startswith("```"), F.regexp_replace(bare, r"(?m)^```.*$", "")).otherwise(bare)
    first, last = F.locate("[", bare), F.length(bare) - F.locate("]", F.reverse(bare)) + 1
    return F.when((first > 0) & (F.locate("]", bare) > 0) & (last > first), F.from_json(F.substring(bare, first, last - first + 1), "array<map<string,string>>"))


def cost(model: Column, tokens_in: Column, tokens_out: Column, prices: dict[str, tuple[float, float]] | None = None) -> Column:
    """USD at the model's prices; 0 for a model without one."""
    table = fixed.PRICES if prices is None else prices
    out = F.lit(0.0)
    for name, (a, b) in table.items():
        out = F.when(model == name, (tokens_in * F.lit(float(a)) + tokens_out * F.lit(float(b))) / 1_000_000).otherwise(out)
    return out

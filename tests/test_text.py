import difflib
import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quillgrid.functions import text
from quillgrid.functions.similarity import similarity


def column(spark, values, f, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r.x for r in df.select("i", f(F.col("v")).alias("x")).orderBy("i").collect()]


def test_strip_and_norm_are_those_of_str(spark):
    values = ["", " a ", "\t\n a b  ", "\x1c x \x1f", "Straße", "ÀB  c", "　", "ſtop", "ΟΔΟΣ", "ﬁne oﬃce", "ŉ", "İstanbul", "ẞ", "Ꭰ", "ꭰ", "ǅ"]
    assert column(spark, values, text.strip) == [v.strip() for v in values]
    assert column(spark, values, text.norm) == [" ".join(v.split()).casefold() for v in values]


def test_validators(spark):
    cases = {
        "day": (["1", "31", "01"], ["0", "32", "86", "x", "-1", "1.0", "99999999999999999999999999999999999999999"]),
        "time_hh": (["0", "12"], ["13"]), "age_yrs": (["7", "7.5"], ["7.", ".5", "-7", "7,5"]), "sex": (["M", "F"], ["m", "X"]),
        "am_pm": (["AM", "PM"], ["am"]), "record_no": (["304"], ["30a", "3 4"]),
    }
    for field, (good, bad) in cases.items():
        assert column(spark, good + bad, lambda c, f=field: text.valid(f, c)) == [True] * len(good) + [False] * len(bad)
    assert text.valid("village", F.lit("")) is None


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i, *row[1:]], row
        for j, y in enumerate(b, 1):
            row[j] = min(last[j] + 1, row[j - 1] + 1, last[j - 1] + (x != y))
    return row[-1]


def test_similar_numbers(spark):
    pairs = [("307", "3067"), ("31", "314"), ("304", "305"), ("304", "304"), ("", "1"), ("1", ""), ("12", "345"), ("1234", "134"), ("99", "1299"), ("5", "67")]
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "i int, a string, b string")
    got = [r.x for r in df.select("i", text.similar_numbers(F.col("a"), F.col("b")).alias("x")).orderBy("i").collect()]
    assert got == [bool(a and b) and (a == b or len(a) != len(b) and (a in b or b in a or distance(a, b) <= 1)) for a, b in pairs]


def natural(s):
    return [int(x) if x.isdigit() else x for x in re.split(r"(\d+)", s)]


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(alphabet="ab-019", min_size=1, max_size=6), min_size=2, max_size=12, unique_by=lambda s: str(natural(s))))
def test_natural_order(spark, stems):
    df = spark.createDataFrame([(s,) for s in stems], "s string")
    assert [r.s for r in df.orderBy(text.natural_key(F.col("s"))).collect()] == sorted(stems, key=natural)


def test_markers_and_flags(spark):
    values = ["a [verified] [?]", "[illegible] [??]", "x [??] [faded]", "[faded] [?]", "[?]", "plain", ""]
    assert column(spark, values, text.marker_colour) == ["FF00B050", "FFFF0000", "FFFFC000", "FF4472C4", "FFFFFF00", None, None]
    assert column(spark, ["FFFF0000", "FF00B050", "00000000", None, "FFFFFF00"], text.flagged) == [True, False, False, False, True]


def test_clock_and_context(spark):
    df = spark.createDataFrame([("8", "05", "AM"), ("", "", ""), ("", "", "AM"), ("8", "", "")], "h string, m string, a string")
    assert [r.x for r in df.select(text.clock(F.col("h"), F.col("m"), F.col("a")).alias("x")).collect()] == ["8:05 AM", "", ": AM", "8:"]
    df = spark.createDataFrame([("x", "2020"), ("", "2020"), (None, "")], "c string, y string")
    assert [r.x for r in df.select(text.context(F.col("c"), F.col("y")).alias("x")).collect()] == ["Center: x, Year: 2020", "Year: 2020", ""]


def test_retry(spark):
    rows = [(None, "size 15000"), (None, "got 502 back"), (503, "x"), (400, "503"), (None, "RESOURCE_EXHAUSTED now"), (None, None)]
    df = spark.createDataFrame(rows, "c int, m string")
    assert [r.x for r in df.select(text.retryable(F.col("c"), F.col("m")).alias("x")).collect()] == [False, True, True, False, True, False]


def test_replies(spark):
    values = ['```json\n[{"a": "1"}]\n```', 'so: [{"a": "[x]"}, {"b": "2"}] end', "none", "[", "] [", "  [] "]
    got = column(spark, values, text.parse_response)
    assert got == [[{"a": "1"}], [{"a": "[x]"}, {"b": "2"}], None, None, None, []]


def test_cost(spark):
    df = spark.createDataFrame([("gemini-3.5-flash-lite", 1_000_000, 1_000_000), ("unknown", 5, 5)], "m string, a long, b long")
    assert [r.x for r in df.select(text.cost(F.col("m"), F.col("a"), F.col("b")).alias("x")).collect()] == [1.75, 0.0]


def test_ratio(spark):
    pairs = [("tide", "diet"), ("diet", "tide"), ("", ""), ("abc", ""), ("bulago", "bulaga"), ("x" * 300, "x" * 250 + "y")]
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "i int, a string, b string")
    got = [r.x for r in df.select("i", similarity(F.col("a"), F.col("b")).alias("x")).orderBy("i").collect()]
    assert got == [difflib.SequenceMatcher(None, a, b).ratio() for a, b in pairs]

import re

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall((text or "").translate(LOW))


def documents(spark, rows, extra=True):
    """A documents table with columns that clash with those the operators add."""
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    more = ", score string, row string, key int, n string, a string, held_out string" if extra else ""
    return spark.createDataFrame([(i, t, None, "s", None if t is None else len(t), *(["x", "y", 1, "z", "q", "w"] if extra else [])) for i, t in rows], schema + more)


ODD = [(1, None), (2, ""), (3, "   \n\t "), (4, "one"), (5, "One two three É é"), (None, "no id here"), (4, "one"), (7, "x" * 30000), (8, "word " * 20000), (9, "a\x1cb \x85 c d")]

"""Benchmark decontamination on a distributed positional inverted index, in DataFrame operations only.

The index stores a posting (term, row, position) for every training word that some benchmark item has, and one end
posting a document, whose position is its number of words. Every window of LENGTH item words (all words of a shorter
item) is looked up by its ANCHORS rarest words: their postings, moved back by the word's place in the item, meet at
one alignment (row, item, shift) if the window may occur there. Windows whose anchors all meet are compared word by
word with the text, so matches are exact. The common words of a window are never looked up.

proximity() finds documents that hold all words of a query within a span, from the same index.

Equal windows, of one item or of several, are looked up once, so a text has at most one match of each length at a place,
however repetitive it and the items are. Terms are 64-bit hashes: a collision could only add a candidate, which the
comparison rejects. A row is its id and the hash of its text, so rows of one id with different texts are told apart. Item words
are broadcast while they are few (BROADCAST_TERMS); beyond that the joins are left to Spark. Only texts of rows with a candidate are
shuffled, at every size: a bitmap of at most MOST_BITS bits tells most others apart where they are read, and the join the rest.

Cases: a null text has no words; null ids are kept; items without words have no window; an item id in several rows
counts once; repeated document rows are each returned; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._store import Tables

#: Fixed parameters: words of a window, looked-up words of each, most item positions that are broadcast.
LENGTH, ANCHORS, BROADCAST_TERMS = 10, 3, 200_000
#: Bits of the bitmap: for each row in it, at least, and at most (8 MB). With fewer bits more rows are joined for nothing.
ROW_BITS, LEAST_BITS, MOST_BITS = 64, 1 << 15, 1 << 26
#: Words before A-Z are lower-cased.
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
END = 0


def lowered(word: Column) -> Column:
    """A-Z in lower case, other letters as they are."""
    return F.when(F.length(word) == F.octet_length(word), F.lower(word)).otherwise(F.translate(word, UPPER, LOWER))


def words_of(text: Column) -> Column:
    return F.transform(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), lowered)


def row_key(docs: DataFrame) -> DataFrame:
    return docs.select(F.struct(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text")).alias("row"), "text")


def item_words(items: DataFrame) -> DataFrame:
    """item (a number for each row of items that has words), item_id, words."""
    return items.select(F.xxhash64("item_id", "text").alias("item"), "item_id", words_of(F.col("text")).alias("words")).where("size(words) > 0").dropDuplicates(["item"])


def small(df: DataFrame, rows: int) -> DataFrame:
    """df with a broadcast hint if it is known to have few rows."""
    return F.broadcast(df) if rows <= BROADCAST_TERMS else df


def sift(docs: DataFrame, rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """docs (with a column `row`) in two parts: those whose row may be in rows (kept, each once), with all that are, and those whose row is not."""
    n = max(rows.count(), 1)
    m = min(MOST_BITS, max(LEAST_BITS, 1 << (ROW_BITS * n - 1).bit_length()))
    bit = F.pmod(F.xxhash64("row"), F.lit(m)) + 1
    marked = rows.select(bit.alias("bit")).groupBy(F.bitmap_bucket_number("bit").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits"))
    names = docs.columns
    placed = docs.select("*", bit.alias("_bit")).join(F.broadcast(marked), F.bitmap_bucket_number("_bit") == F.col("bucket"), "left")
    at = F.bitmap_bit_position("_bit")
    byte = F.conv(F.hex(F.substring("bits", F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    set_ = F.coalesce(F.getbit(byte, (at % 8).cast("int")) == 1, F.lit(False))
    return placed.where(set_).select(*names), placed.where(~set_).select(*names)


def build_index(docs: DataFrame, terms: DataFrame, n_terms: int) -> DataFrame:
    """Postings (term, row, pos) of the terms (a column `term`), and ends."""
    every = row_key(docs).select("row", F.posexplode(F.concat(F.coalesce(F.regexp_extract_all("text", F.lit(WORD), F.lit(0)), F.array()), F.array(F.lit("")))).alias("pos", "word"))
    hashed = every.select("row", "pos", F.when(F.col("word") == "", F.lit(END).cast("long")).otherwise(F.xxhash64(lowered(F.col("word")))).alias("term"))
    wanted = terms.select("term").union(docs.sparkSession.sql(f"SELECT CAST({END} AS BIGINT) AS term")).distinct()
    return hashed.join(small(wanted, n_terms), "term").select("term", "row", "pos")


def frequencies(index: DataFrame) -> DataFrame:
    return index.where(F.col("term") != END).groupBy("term").agg(F.count("*").alias("df"))


def windows(words: DataFrame, df: DataFrame) -> DataFrame:
    """item, off, len, phrase and anchors (places in the item of the rarest words) of all windows whose words all occur in the index."""
    places = words.select("item", F.posexplode("words").alias("at", "word")).select("item", "at", F.xxhash64("word").alias("term")).join(df, "term", "left")
    own = places.groupBy("item").agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "df"))), lambda x: x["df"]).alias("dfs")).join(words.select("item", "words"), "item")
    n = F.size("dfs")
    cut = own.select("item", "dfs", "words", F.explode(F.sequence(F.lit(0), F.greatest(n - LENGTH, F.lit(0)))).alias("off"), F.least(n, F.lit(LENGTH)).alias("len"))
    inside = F.slice("dfs", F.col("off") + 1, F.col("len"))
    ranked = F.array_sort(F.transform(inside, lambda d, i: F.struct(d.alias("df"), (F.col("off") + i).alias("at"))))
    phrase = F.array_join(F.slice("words", F.col("off") + 1, F.col("len")), " ")
    return cut.where(~F.exists(inside, lambda d: d.isNull())).select("item", "off", "len", phrase.alias("phrase"), F.transform(F.slice(ranked, 1, ANCHORS), lambda x: x["at"]).alias("anchors"))


def alignments(index: DataFrame, words: DataFrame, cut: DataFrame, n_places: int) -> DataFrame:
    """row, start, len and phrase of the windows (each phrase once) whose anchors meet: offset-adjusted postings intersected."""
    anchors = cut.select("item", F.explode("anchors").alias("at")).distinct()
    terms = words.select("item", F.posexplode("words").alias("at", "word")).join(anchors, ["item", "at"]).select("item", "at", F.xxhash64("word").alias("term"))
    met = (
        index.join(small(terms, n_places), "term")
        .select("row", "item", (F.col("pos") - F.col("at")).alias("shift"), "at")
        .groupBy("row", "item", "shift")
        .agg(F.collect_set("at").alias("met"))
    )
    whole = small(cut, n_places)
    return met.join(whole, "item").where(F.size(F.array_intersect("anchors", "met")) == F.size("anchors")).where("shift + off >= 0").select("row", (F.col("shift") + F.col("off")).alias("start"), "len", "phrase")


def matches(docs: DataFrame, items: DataFrame, tables: Tables | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows, found, whose): row and n_words of every document; row and its exact matches, an array of (phrase, start, len); phrase and
    item_id of the items that have it."""
    tables = tables or Tables(docs.sparkSession, "decontaminate")
    words = tables.keep(item_words(items))
    n_places = words.agg(F.coalesce(F.sum(F.size("words")), F.lit(0))).first()[0]
    terms = words.select(F.explode("words").alias("word")).select(F.xxhash64("word").alias("term")).distinct()
    index = tables.keep(build_index(docs, terms, n_places))
    every = tables.keep(windows(words, frequencies(index)))
    cut = tables.keep(every.groupBy("phrase").agg(F.min(F.struct("item", "off", "len", "anchors")).alias("w")).select("phrase", "w.*"))
    likely = tables.keep(alignments(index, words, cut, n_places).groupBy("row").agg(F.collect_set(F.struct("phrase", "start", "len")).alias("ms")))
    # the texts of rows that have a candidate
    own = sift(row_key(docs), likely)[0].join(likely, "row").select("row", "ms", words_of(F.col("text")).alias("own")).dropDuplicates(["row"])
    exact = F.filter("ms", lambda m: F.array_join(F.slice("own", m["start"] + 1, m["len"]), " ") == m["phrase"])
    found = own.select("row", exact.alias("found")).where("size(found) > 0")
    whose = every.join(words.select("item", "item_id"), "item").select("phrase", "item_id").distinct()
    return index.where(F.col("term") == END).select("row", F.col("pos").cast("long").alias("n_words")), found, whose


def report(docs: DataFrame, items: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256 and contaminated of every document."""
    tables = Tables(docs.sparkSession, "decontaminate")
    rows, found, whose = matches(docs, items, tables)
    found = tables.keep(found)
    hit = F.size(F.array_distinct(F.flatten(F.transform("found", lambda m: F.sequence(m["start"], m["start"] + m["len"] - 1)))))
    named = found.select("row", F.explode(F.array_distinct(F.transform("found", lambda m: m["phrase"]))).alias("phrase")).join(whose, "phrase")
    ids = named.groupBy("row").agg(F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("ids"))
    each = found.select("row", hit.cast("long").alias("n_hit")).join(ids, "row")
    return rows.join(each, "row", "left").select(
        "row.doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.when(F.col("ids").isNull(), 0).otherwise(F.size("ids")).cast("long").alias("n_items"),
        F.sha2(F.coalesce(F.array_join("ids", ","), F.lit("")), 256).alias("items_sha256"), (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
    )


def proximity(index: DataFrame, queries: DataFrame, span: int) -> DataFrame:
    """query, row and pos of every occurrence of a query's rarest word with all its other words at most `span` words away.

    queries: query, words (distinct, lower case). Positions are dealt into strips of `span` words, so each posting meets
    those of three strips only.
    """
    terms = queries.select("query", F.explode(F.array_distinct("words")).alias("word")).select("query", F.xxhash64("word").alias("term"))
    sized = terms.join(frequencies(index), "term", "left").groupBy("query").agg(F.min(F.struct(F.coalesce("df", F.lit(0)), "term")).alias("least"), F.count("*").alias("n"))
    hits = index.join(terms, "term").select("query", "row", "pos", "term", F.floor(F.col("pos") / span).alias("strip"))
    at = hits.join(sized.select("query", "n", F.col("least.term").alias("term")), ["query", "term"]).select("query", "row", F.col("pos").alias("at"), "n", F.explode(F.sequence(F.col("strip") - 1, F.col("strip") + 1)).alias("strip"))
    near = at.join(hits, ["query", "row", "strip"]).where(F.abs(F.col("pos") - F.col("at")) <= span)
    return near.groupBy("query", "row", "at").agg(F.countDistinct("term").alias("met"), F.max("n").alias("n")).where("met = n").select("query", "row", F.col("at").alias("pos"))


def drop_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of docs that hold no window of any item, with all their columns."""
    tables = Tables(docs.sparkSession, "decontaminate")
    found = tables.keep(matches(docs, items, tables)[1].select("row"))
    tables.drop_but(found)
    key = F.struct(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text"))
    maybe, clean = sift(docs.select(key.alias("row"), F.struct("*").alias("own")), found)
    return clean.union(maybe.join(found, "row", "left_anti")).select("own.*")


def query(spark, sf_dir: str) -> DataFrame:
    return report(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (SELECT item_id, least(len(w), 10) AS n, w, unnest(range(0, greatest(len(w) - 10, 0) + 1)) AS s FROM b WHERE len(w) > 0),
win AS (SELECT DISTINCT item_id, n, array_to_string(w[s + 1 : s + n], ' ') AS phrase FROM bw),
ds AS (SELECT doc_id, w, unnest(range(0, len(w))) AS s FROM d),
grams AS (SELECT doc_id, s, l.n AS n, array_to_string(w[s + 1 : s + l.n], ' ') AS phrase FROM ds, (SELECT DISTINCT n FROM win) l WHERE s + l.n <= len(w)),
hits AS (SELECT g.doc_id, g.s, g.n, win.item_id FROM grams g JOIN win ON g.phrase = win.phrase AND g.n = win.n),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM hits) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS ids FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""

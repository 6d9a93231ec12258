"""Preference pairs: the longest common turn prefix of a chosen and a rejected conversation becomes the prompt, once.

A conversation is its turns in order of (turn, role, text). Turns are equal if role and text are, nulls included.
After the prompt come two completions; the mask of each is the list of spans [from, to) of characters that assistant
turns said, so nothing of a header or another speaker is learnt from.

Cases: a conversation missing from a pair has no turns; equal conversations have empty completions; null roles and texts
render as empty; a null turn number sorts first; rows without a conversation id take no part; repeated turns are each
a turn; other columns are ignored. All of it is DataFrame functions; the only shuffles group turns and join pairs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The fixed form of a turn: header of the role, text, end. LEARNT is the role whose words are learnt from.
BEFORE, AFTER, CLOSE, LEARNT = "<|", "|>\n", "\n", "assistant"


def conversations(turns: DataFrame) -> DataFrame:
    """conv_id and its turns, an array of (turn, role, text)."""
    return turns.where(F.col("conv_id").isNotNull()).groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))


def _header(t: Column) -> Column:
    return F.concat(F.lit(BEFORE), F.coalesce(t["role"], F.lit("")), F.lit(AFTER))


def render(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(_header(t), F.coalesce(t["text"], F.lit("")), F.lit(CLOSE))), "")


def learnt(turns: Column) -> Column:
    """Spans of the rendered turns that are to be learnt, as an array of (from, to)."""
    said = lambda t: F.length(F.coalesce(t["text"], F.lit("")))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<from:int,to:int>>").alias("spans"))

    def step(s: Column, t: Column) -> Column:
        a = s["at"] + F.length(_header(t))
        span = F.array(F.struct(a.alias("from"), (a + said(t)).alias("to")))
        return F.struct((a + said(t) + len(CLOSE)).alias("at"), F.when(t["role"] == LEARNT, F.concat(s["spans"], span)).otherwise(s["spans"]).alias("spans"))

    return F.aggregate(turns, start, step, lambda s: s["spans"])


def format_pairs(turns: DataFrame, pairs: DataFrame) -> DataFrame:
    """pair_id, n_prompt_turns, prompt, chosen, rejected, chosen_spans and rejected_spans for pairs (pair_id, chosen_id, rejected_id)."""
    own = conversations(turns)
    side = lambda k, v: own.select(F.col("conv_id").alias(k), F.col("turns").alias(v))
    none = F.array().cast(own.schema["turns"].dataType)
    both = pairs.join(side("chosen_id", "a"), "chosen_id", "left").join(side("rejected_id", "b"), "rejected_id", "left").withColumns({"a": F.coalesce("a", none), "b": F.coalesce("b", none)})
    short = F.least(F.size("a"), F.size("b"))
    same = F.transform(F.slice("a", 1, short), lambda t, i: t["role"].eqNullSafe(F.col("b")[i]["role"]) & t["text"].eqNullSafe(F.col("b")[i]["text"]))
    differ = F.array_position(same, False)
    n = F.when(differ == 0, short).otherwise((differ - 1).cast("int"))
    cut = both.withColumn("n", n).select("pair_id", "n", *[F.slice(x, F.col("n") + 1, F.size(x)).alias(x) for x in ("a", "b")], F.slice("a", F.lit(1), F.col("n")).alias("p"))
    return cut.select("pair_id", F.col("n").alias("n_prompt_turns"), render(F.col("p")).alias("prompt"), render(F.col("a")).alias("chosen"), render(F.col("b")).alias("rejected"), learnt(F.col("a")).alias("chosen_spans"), learnt(F.col("b")).alias("rejected_spans"))


def query(spark, sf_dir: str) -> DataFrame:
    """Conversations 2k (chosen) and 2k + 1 (rejected) as pair k."""
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    ids = turns.where("conv_id IS NOT NULL").select(F.floor(F.col("conv_id") / 2).cast("long").alias("pair_id")).distinct()
    out = format_pairs(turns, ids.select("pair_id", (F.col("pair_id") * 2).alias("chosen_id"), (F.col("pair_id") * 2 + 1).alias("rejected_id")))
    spans = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws("-", s["from"].cast("string"), s["to"].cast("string"))), ",")
    return out.select("pair_id", F.col("n_prompt_turns").cast("long").alias("n_prompt_turns"), "prompt", "chosen", "rejected", spans("chosen_spans").alias("chosen_spans"), spans("rejected_spans").alias("rejected_spans"))


SQL = r"""
WITH c AS (SELECT conv_id, conv_id // 2 AS pair_id, conv_id % 2 AS side, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS k FROM conversations WHERE conv_id IS NOT NULL),
ids AS (SELECT DISTINCT pair_id FROM c),
n AS (SELECT pair_id, count(*) FILTER (side = 0) AS na, count(*) FILTER (side = 1) AS nb FROM c GROUP BY pair_id),
bad AS (SELECT a.pair_id, min(a.k) AS k FROM c a JOIN c b ON a.pair_id = b.pair_id AND a.k = b.k AND a.side = 0 AND b.side = 1 WHERE a.role <> b.role OR a.text <> b.text GROUP BY a.pair_id),
p AS (SELECT n.pair_id, coalesce(bad.k - 1, least(na, nb)) AS len FROM n LEFT JOIN bad USING (pair_id)),
r AS (SELECT c.pair_id, side, k, k <= len AS shared, role, text, '<|' || role || '|>' || chr(10) || text || chr(10) AS said, length(role) + 5 AS head FROM c JOIN p USING (pair_id)),
s AS (SELECT *, coalesce(sum(length(said)) OVER (PARTITION BY pair_id, side, shared ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS p0 FROM r)
SELECT ids.pair_id, CAST(any_value(p.len) AS BIGINT) AS n_prompt_turns,
  coalesce(string_agg(said, '' ORDER BY k) FILTER (shared AND side = 0), '') AS prompt,
  coalesce(string_agg(said, '' ORDER BY k) FILTER (NOT shared AND side = 0), '') AS chosen,
  coalesce(string_agg(said, '' ORDER BY k) FILTER (NOT shared AND side = 1), '') AS rejected,
  coalesce(string_agg(CAST(p0 + head AS BIGINT) || '-' || CAST(p0 + head + length(text) AS BIGINT), ',' ORDER BY k) FILTER (NOT shared AND side = 0 AND role = 'assistant'), '') AS chosen_spans,
  coalesce(string_agg(CAST(p0 + head AS BIGINT) || '-' || CAST(p0 + head + length(text) AS BIGINT), ',' ORDER BY k) FILTER (NOT shared AND side = 1 AND role = 'assistant'), '') AS rejected_spans
FROM ids JOIN p USING (pair_id) LEFT JOIN s USING (pair_id) GROUP BY ids.pair_id
"""

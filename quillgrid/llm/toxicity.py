"""Toxicity by maximum-scoring segments.

Each word's score is its log-odds between toxic and clean labelled text under an informative Dirichlet prior; a word
that is not telling by itself has the score of its longest telling beginning (inflected and compounded forms), and
any other word costs a constant, so the expected score is negative. A linear scan (Ruzzo and Tompa) finds every maximal
scoring passage. With scores of negative drift the best passage of n clean tokens follows an extreme-value law,
P(S >= s) = 1 - exp(-K n exp(-lambda s)) (Karlin and Altschul): lambda solves sum p exp(lambda s) = 1 over clean
words, K is its maximum-likelihood value over clean labelled documents. A logistic curve over the surprise
-log P of the best passage and of all significant passages together gives the score.

Cases: a null or empty text has no passage and gets the curve's value at none; without labels of both kinds every
score is 0. Repeated rows are each scored alike; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillgrid.functions.batches import bounded

from ._labels import SAMPLE_ROWS, held_out, labelled, logistic, sigmoid
from ._store import tidy
from ._text import Words, pieces

#: Fixed parameters: weight of the prior as a share of all tokens, least z of a scored unit, cost of any other word,
#: E-value under which a passage is significant, and lengths in bytes of beginnings.
PRIOR, LEAST_Z, COST, SIGNIFICANT, BEGINNINGS = 0.1, 4.0, 0.4, 0.05, (4, 5, 6)


@dataclass
class Model:
    words: np.ndarray  # sorted hashes
    scores: np.ndarray
    law: tuple[float, float]  # lambda, K
    curve: np.ndarray  # weights of the two surprises and the intercept; empty if there was nothing to learn


def look_up(hashes: np.ndarray, model: Model) -> np.ndarray:
    """The score of each unit; NaN for those that have none."""
    out = np.full(len(hashes), np.nan)
    mask = np.uint64((1 << 18) - 1)
    seen = np.zeros(1 << 18, bool)
    seen[(model.words & mask).astype(np.int64)] = True
    at = np.flatnonzero(seen[(hashes & mask).astype(np.int64)])
    k = np.minimum(np.searchsorted(model.words, hashes[at]), len(model.words) - 1)
    hit = model.words[k] == hashes[at]
    out[at[hit]] = model.scores[k[hit]]
    return out


def token_scores(w: Words, model: Model) -> np.ndarray:
    if not len(model.words):
        return np.full(len(w.hash), -COST)
    out = look_up(w.hash, model)
    for k in reversed(BEGINNINGS):
        bare = np.isnan(out)
        out[bare] = look_up(w.prefixes(k)[bare], model)
    return np.nan_to_num(out, nan=-COST)


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments of one document as (first token, token past the last, score), in order.

    Every segment keeps the place of the last one before it whose sum before is smaller, so that a search follows that chain and
    passes no segment twice: the scan is linear.
    """
    positive = np.flatnonzero(scores > 0)
    if not len(positive):
        return []
    total = np.concatenate([[0.0], np.cumsum(scores)])
    held: list[tuple[int, int, float, float, int]] = []  # first, past, sum before, sum after, place of the last smaller sum before
    for i, before, after in zip(positive.tolist(), total[positive].tolist(), total[positive + 1].tolist(), strict=True):
        first, j = i, len(held) - 1
        while True:
            while j >= 0 and held[j][2] >= before:
                j = held[j][4]
            if j < 0 or held[j][3] >= after:
                held.append((first, i + 1, before, after, j))
                break
            first, _, before, _, back = held[j]
            del held[j:]
            j = back
    return [(a, b, r - l) for a, b, l, r, _ in held]


def surprises(found: list[tuple[int, int, float]], n: int, law: tuple[float, float]) -> tuple[float, float, list]:
    """-log P of the best passage, the sum of log 1/E over significant passages, and those passages."""
    rate, k = law
    if not found or not n:
        return 0.0, 0.0, []
    evalue = [k * n * np.exp(-rate * s) for _, _, s in found]
    best = min(evalue)
    surprise = -np.log(max(-np.expm1(-best), 1e-300))
    sure = [(a, b, s) for (a, b, s), e in zip(found, evalue, strict=True) if e < SIGNIFICANT]
    return float(surprise), float(sum(-np.log(max(e, 1e-300)) for e in evalue if e < SIGNIFICANT)), sure


def _count_words(batches):
    for batch in batches:
        for part in pieces(batch, "text"):
            w = Words(part.column("text"))
            y = np.repeat(part.column("y").to_numpy(zero_copy_only=False), w.counts)
            for kind in (0, 1):
                units = np.concatenate([x[(y == kind) & (x != 0)] for x in (w.hash, *map(w.prefixes, BEGINNINGS))])
                h, n = np.unique(units, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n * (kind == 0)), pa.array(n * (kind == 1))], ["h", "clean", "toxic"])


def lexicon(counts: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted hashes, log-odds and clean frequency of the units whose odds differ, from counts by word of the bounded sample."""
    n = counts.agg(F.sum("clean"), F.sum("toxic")).first()
    none = np.zeros(0, np.uint64), np.zeros(0), np.zeros(0)
    if not n[0] or not n[1]:
        return none
    a, b = float(n[0]), float(n[1])
    prior, weight = (F.col("clean") + F.col("toxic")) * PRIOR, (a + b) * PRIOR
    t, c = F.col("toxic") + prior, F.col("clean") + prior
    odds = F.log(t / (b + weight - t)) - F.log(c / (a + weight - c))
    rows = (
        counts.select("h", odds.alias("odds"), (F.col("clean") / a).alias("p"), (odds / F.sqrt(1 / t + 1 / c)).alias("z"))
        .where((F.abs("z") >= LEAST_Z) & (F.abs("odds") > COST))
        .collect()
    )
    h = np.array([r.h for r in rows], np.int64).view(np.uint64)
    order = np.argsort(h)
    odds, p = np.array([r.odds for r in rows]), np.array([r.p for r in rows])
    return h[order], odds[order] - COST * (odds[order] < 0), p[order]


def solve_rate(scores: np.ndarray, p: np.ndarray) -> float:
    """The positive lambda at which sum p exp(lambda s) is 1, all other words costing COST."""
    rest = max(0.0, 1 - p.sum())
    f = lambda x: np.log((p * np.exp(np.minimum(x * scores, 600))).sum() + rest * np.exp(-COST * x))
    low, high = 1e-4, 1e-4
    if f(low) >= 0:
        return 0.05  # no negative drift to calibrate by
    while f(high) < 0 and high < 50:
        high *= 2
    for _ in range(80):
        low, high = ((low + high) / 2, high) if f((low + high) / 2) < 0 else (low, (low + high) / 2)
    return low


def fit(docs: DataFrame, labels: DataFrame, modulus: int = 5, remainder: int = 0, rows: int = SAMPLE_ROWS) -> Model:
    """Learns from at most `rows` labelled documents outside the fold crc32(doc_id) mod modulus = remainder."""
    bounded(docs.sparkSession)
    sample = labelled(docs, labels, "toxic", modulus, remainder, rows)
    counts = sample.mapInArrow(tidy(_count_words), "h long, clean long, toxic long").groupBy("h").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    words, scores, p = lexicon(counts)
    model = Model(words, scores, (0.0, 0.0), np.zeros(0))
    if not (scores > 0).any():
        return model
    rate = solve_rate(scores, p)

    def best(batches):
        for batch in batches:
            w = Words(batch.column("text"))
            s = token_scores(w, model)
            found = [[x for _, _, x in segments(s[a:b])] for a, b in zip(w.off[:-1], w.off[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("y"), pa.array(w.counts), pa.array(found, pa.list_(pa.float64()))], ["y", "n", "s"])

    got = sample.mapInArrow(tidy(best), "y int, n long, s array<double>").toArrow().to_pylist()
    clean = [(r["n"], max(r["s"], default=0.0)) for r in got if r["y"] == 0 and r["n"]]
    total = sum(n * np.exp(-rate * s) for n, s in clean)
    model.law = rate, len(clean) / total if total else 1.0
    x = np.array([features(*surprises([(0, 0, v) for v in r["s"]], r["n"], model.law)[:2]) for r in got])
    model.curve = logistic(x, np.array([r["y"] for r in got], float))
    return model


def features(best: float, sure: float) -> tuple[float, float, float]:
    return np.log1p(best), np.log1p(sure), min(best, 20.0) / 10


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score, n_tokens and the significant passages (first byte, byte past the last, score) of every document."""

    def run(batches):
        for batch in batches:
            for part in pieces(batch, "text"):
                w = Words(part.column("text"))
                s = token_scores(w, model)
                cum = np.concatenate([[0], np.cumsum(s > 0)])
                some = cum[w.off[1:]] > cum[w.off[:-1]]
                x, passages = np.zeros((len(some), 3)), [[] for _ in some]
                if len(model.curve):
                    for d in np.flatnonzero(some).tolist():
                        a, b = w.off[d], w.off[d + 1]
                        best, sure, kept = surprises(segments(s[a:b]), b - a, model.law)
                        x[d] = features(best, sure)
                        at = w.doc_off[d]
                        passages[d] = [{"first": int(w.start[a + i] - at), "past": int(w.end[a + j - 1] - at), "score": v} for i, j, v in kept]
                p = sigmoid(np.column_stack([x, np.ones(len(x))]) @ model.curve) if len(model.curve) else np.zeros(len(x))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(p), pa.array(w.counts), pa.array(passages, pa.list_(pa.struct([("first", pa.int32()), ("past", pa.int32()), ("score", pa.float64())])))],
                    ["doc_id", "score", "n_tokens", "passages"],
                )

    bounded(docs.sparkSession)
    schema = "doc_id long, score double, n_tokens long, passages array<struct<first:int,past:int,score:double>>"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(tidy(run), schema)


def keep_clean(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """The rows of docs whose score is under the threshold, with all their columns; nothing is shuffled."""

    def run(batches):
        for batch in batches:
            for part in pieces(batch, "text"):
                w = Words(part.column("text"))
                s = token_scores(w, model)
                cum = np.concatenate([[0], np.cumsum(s > 0)])
                x = np.zeros((part.num_rows, 3))
                for d in np.flatnonzero(cum[w.off[1:]] > cum[w.off[:-1]]).tolist():
                    a, b = w.off[d], w.off[d + 1]
                    x[d] = features(*surprises(segments(s[a:b]), b - a, model.law)[:2])
                yield part.filter(pa.array(sigmoid(np.column_stack([x, np.ones(len(x))]) @ model.curve) < threshold))

    if not len(model.curve):
        return docs
    bounded(docs.sparkSession)
    return docs.mapInArrow(tidy(run), docs.schema)


def query(spark, sf_dir: str) -> DataFrame:
    docs, labels = spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet")
    out = score(docs, fit(docs, labels))
    return out.select("doc_id", held_out("doc_id", 5, 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), F.size("passages").alias("n_passages"), "n_tokens")

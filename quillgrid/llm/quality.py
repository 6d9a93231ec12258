"""Quality by a factorisation machine over hashed words, structure statistics and metadata.

A document is a sparse vector: log counts of its words hashed into BUCKETS, scaled to unit length, then structure
statistics of the text and the logarithm of its declared length (the metadata column n_chars, where there is one).
The machine scores w0 + w.x + sum over pairs of <v_i, v_j> x_i x_j; the pairs cost linear time through
1/2 sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2). It is fitted on the driver with Adam on a bounded sample.

Cases: a null or empty text has only zeros but for the length; without labels of both kinds every score is the share
of label 1, or 0.5. Repeated rows are each scored alike. labels, lang, source and doc_id are never inputs.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillgrid.functions.batches import bounded

from ._labels import SAMPLE_ROWS, held_out, labelled, sigmoid
from ._store import tidy
from ._text import Words, pieces, sums

#: Hashed word features, rank of the interactions, and the number of structure statistics.
BUCKETS, RANK, STATISTICS = 4096, 8, 14
_SIZE = BUCKETS + STATISTICS
_DOCS = 256


@dataclass
class Machine:
    bias: float
    linear: np.ndarray
    factors: np.ndarray
    mean: np.ndarray
    scale: np.ndarray


def structure(w: Words, declared: np.ndarray) -> np.ndarray:
    """One row of statistics for each document: lengths, shares of kinds of bytes, and repetition of words and lines."""
    n, length = w.counts, np.diff(w.doc_off)
    safe_n, safe_l = np.maximum(n, 1), np.maximum(length, 1)
    share = lambda mask: sums(mask.astype(np.int64), w.doc_off) / safe_l
    d = w.data
    letters = ((d | 32) >= 97) & ((d | 32) <= 122)
    key = np.sort((w.docs().astype(np.uint64) << np.uint64(40)) | (w.hash >> np.uint64(24)))
    fresh = np.ones(len(key), bool)
    fresh[1:] = key[1:] != key[:-1]
    distinct = np.bincount((key[fresh] >> np.uint64(40)).astype(np.int64), minlength=len(n))
    sizes = (w.end - w.start).astype(float)
    lines, kept = np.ones(len(n)), np.ones(len(n))
    raw = d.tobytes()
    for i, (a, b) in enumerate(zip(w.doc_off[:-1].tolist(), w.doc_off[1:].tolist(), strict=True)):
        own = raw[a:b].split(b"\n")
        lines[i], kept[i] = len(own), len(set(own))
    mean = sums(sizes, w.off) / safe_n
    return np.column_stack(
        [
            np.log1p(n), np.log1p(declared), mean, np.sqrt(np.maximum(sums(sizes**2, w.off) / safe_n - mean**2, 0)),
            share((d >= 48) & (d <= 57)), share((d >= 65) & (d <= 90)), share(d >= 128), share(letters),
            share((d > 32) & (d < 128) & ~letters & ~((d >= 48) & (d <= 57))), share(d == 10),
            distinct / safe_n, kept / lines, np.log1p(lines), n / lines / 100,
        ]
    )


def hashed(w: Words, a: int, b: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Unit vectors of log counts over BUCKETS, for documents a to b: row, bucket and value of what is not 0."""
    cell = (w.hash[w.off[a] : w.off[b]] >> np.uint64(52)).astype(np.int64) & (BUCKETS - 1)
    key, n = np.unique(np.repeat(np.arange(b - a), w.counts[a:b]) * BUCKETS + cell, return_counts=True)
    row, x = key // BUCKETS, np.log1p(n)
    return row, key % BUCKETS, (x / np.sqrt(np.bincount(row, x * x, minlength=b - a))[row]).astype(np.float32)


def forward(x: np.ndarray, m: Machine) -> tuple[np.ndarray, np.ndarray]:
    """Scores before the logistic curve, and the sums x V that their gradient needs."""
    s = x @ m.factors
    return m.bias + x @ m.linear + 0.5 * ((s * s) - (x * x) @ (m.factors * m.factors)).sum(1), s


def sparse_forward(row: np.ndarray, at: np.ndarray, x: np.ndarray, stats: np.ndarray, m: Machine) -> np.ndarray:
    """forward() without the zeros: hashed words as row, bucket and value, and the statistics of every row; linear in what is not 0."""
    total = lambda v: np.bincount(row, v, minlength=len(stats))
    own, rest = m.factors[:BUCKETS].astype(float), m.factors[BUCKETS:].astype(float)
    s = np.column_stack([total(x * own[at, k]) for k in range(RANK)]) + stats @ rest
    squares = total(x * x * (own * own).sum(1)[at]) + (stats * stats) @ (rest * rest).sum(1)
    return m.bias + total(x * m.linear[at]) + stats @ m.linear[BUCKETS:] + 0.5 * ((s * s).sum(1) - squares)


def _declared(batch: pa.RecordBatch, w: Words) -> np.ndarray:
    own = np.diff(w.doc_off).astype(float)
    if "n_chars" not in batch.schema.names:
        return own
    given = batch.column("n_chars").cast(pa.float64()).to_numpy(zero_copy_only=False)
    return np.where(np.isnan(given) | (given < 0), own, given)


def _sparse(batches):
    for batch in batches:
        w = Words(batch.column("text"))
        stats = structure(w, _declared(batch, w))
        for a in range(0, batch.num_rows, _DOCS):
            b = min(a + _DOCS, batch.num_rows)
            row, col, x = hashed(w, a, b)
            off = pa.array(np.searchsorted(row, np.arange(b - a + 1)), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("y")[a:b],
                    pa.ListArray.from_arrays(off, pa.array(col, pa.int32())),
                    pa.ListArray.from_arrays(off, pa.array(x)),
                    pa.array(list(stats[a:b]), pa.list_(pa.float64())),
                ],
                ["y", "at", "x", "stats"],
            )


def fit(docs: DataFrame, labels: DataFrame, modulus: int = 4, remainder: int = 2, rows: int = SAMPLE_ROWS, passes: int = 12, seed: int = 7) -> Machine:
    """Fits on at most `rows` labelled documents outside the fold crc32(doc_id) mod modulus = remainder."""
    bounded(docs.sparkSession)
    got = labelled(docs, labels, "quality", modulus, remainder, rows).mapInArrow(tidy(_sparse), "y int, at array<int>, x array<float>, stats array<double>").toArrow().combine_chunks()
    y = got.column("y").to_numpy().astype(np.float32)
    share = float(np.clip(y.mean(), 1e-3, 1 - 1e-3)) if len(y) else 0.5
    rng = np.random.default_rng(seed)
    m = Machine(float(np.log(share / (1 - share))), np.zeros(_SIZE, np.float32), np.zeros((_SIZE, RANK), np.float32), np.zeros(STATISTICS), np.ones(STATISTICS))
    if len(set(y.tolist())) < 2:
        return m
    stats = np.vstack(got.column("stats").to_pylist())
    m.mean, m.scale = stats.mean(0), stats.std(0) + 1e-6
    stats = ((stats - m.mean) / m.scale).clip(-5, 5).astype(np.float32)
    at, x = got.column("at").combine_chunks(), got.column("x").combine_chunks()
    off, at, x = at.offsets.to_numpy(), at.flatten().to_numpy(), x.flatten().to_numpy()
    m.factors = rng.normal(0, 0.02, m.factors.shape).astype(np.float32)
    params = [m.linear, m.factors]
    first, second, t = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    for _ in range(passes):
        order = rng.permutation(len(y))
        for i in range(0, len(y), _DOCS):
            own = order[i : i + _DOCS]
            dense = np.zeros((len(own), _SIZE), np.float32)
            for k, d in enumerate(own.tolist()):
                dense[k, at[off[d] : off[d + 1]]] = x[off[d] : off[d + 1]]
            dense[:, BUCKETS:] = stats[own]
            z, s = forward(dense, m)
            g = ((sigmoid(z) - y[own]) / len(own)).astype(np.float32)
            grads = [dense.T @ g, dense.T @ (s * g[:, None]) - m.factors * ((dense * dense).T @ g)[:, None]]
            t += 1
            m.bias -= 0.02 * float(g.sum())
            for p, q, a, b in zip(params, grads, first, second, strict=True):
                q += 1e-5 * p
                a += 0.1 * (q - a)
                b += 0.001 * (q * q - b)
                p -= 0.01 * (a / (1 - 0.9**t)) / (np.sqrt(b / (1 - 0.999**t)) + 1e-8)
    return m


def score(docs: DataFrame, m: Machine) -> DataFrame:
    """doc_id, score and n_words of every document."""

    def run(batches):
        for batch in batches:
            for part in pieces(batch, "text"):
                w = Words(part.column("text"))
                stats = ((structure(w, _declared(part, w)) - m.mean) / m.scale).clip(-5, 5).astype(np.float32)
                out = sparse_forward(*hashed(w, 0, len(stats)), stats.astype(float), m)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(sigmoid(out)), pa.array(w.counts)], ["doc_id", "score", "n_words"])

    bounded(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), *[c for c in ("text", "n_chars") if c in docs.columns]).mapInArrow(tidy(run), "doc_id long, score double, n_words long")


def query(spark, sf_dir: str) -> DataFrame:
    docs, labels = spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet")
    out = score(docs, fit(docs, labels))
    return out.select("doc_id", held_out("doc_id", 4, 2).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"), "n_words")

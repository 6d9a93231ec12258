"""Approximate nearest neighbours by inner product: an inverted file of coarse centroids with product-quantised residuals.

Coarse centroids and, on residuals, one codebook for each of PARTS slices of the vector are fitted by k-means on a
bounded sample; every row is indexed. A query probes the lists of best centroids, scores their codes with asymmetric
distance tables (its slices against the codebooks), and reranks on the original vectors in double precision, so a
returned score is exact: first the best RERANK of each list, then every row whose code does not rule it out. A code's
score is off by at most the query's length times that of what the code leaves of the row, which is kept with the row,
so a probed list loses nothing, however coarse its codes are. How many lists are probed is measured on the rows that
are searched: so many that they hold the share COVERED of the true neighbours, among all rows, of TRIALS of the
queries; isotropic vectors need far more than clustered ones. Ties, also among codes, go to the smaller id.

A list is dealt into chunks of about CHUNK rows and its queries into blocks of about QUERIES, by hashes of their ids
and counts by list, so a list that holds a third of all rows is searched by many tasks.

Cases: vectors that are null, zero, of another length than most of the sample, or that hold null or non-finite
components take no part; null ids neither. Rows of one id count once, with the smallest vector. With fewer than k
candidates in the probed lists, more lists are probed, so that k or all candidates are returned.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillgrid.functions.batches import bounded

from ._store import Tables, tidy

#: Fixed parameters: rows that fit the centroids, most lists, share of true neighbours that probed lists are to hold, queries
#: that measure it, fewest lists probed, slices, codes of a slice, rows of a list chunk reranked first, rows of a chunk,
#: queries of a block.
SAMPLE, MOST_LISTS, COVERED, TRIALS, PROBES, PARTS, CODES, RERANK, CHUNK, QUERIES = 20_000, 4096, 0.97, 400, 8, 16, 256, 48, 4096, 2048
#: Far more than rounding takes, as a share of the lengths that enter a score.
ROUNDING = 1e-12


@dataclass
class Index:
    centroids: np.ndarray
    books: list[np.ndarray]  # one codebook a slice
    cuts: np.ndarray  # where slices begin and end


def k_means(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 12) -> np.ndarray:
    """At most k centroids; an emptied one moves to a row far from its own."""
    c = x[rng.choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(rounds):
        d = (c * c).sum(1) - 2 * (x @ c.T)
        own = d.argmin(1)
        n = np.bincount(own, minlength=len(c))
        total = np.zeros_like(c)
        np.add.at(total, own, x)
        c[n > 0] = total[n > 0] / n[n > 0, None]
        if (n == 0).any():
            far = np.argsort(-(d[np.arange(len(x)), own] + (x * x).sum(1)), kind="stable")[: int((n == 0).sum())]
            c[np.flatnonzero(n == 0)[: len(far)]] = x[far]
    return c


def nearest(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return ((c * c).sum(1) - 2 * (x @ c.T)).argmin(1)


def _matrix(col: pa.Array) -> np.ndarray:
    """Rows of a list column of one length."""
    return col.flatten().to_numpy(zero_copy_only=False).reshape(len(col), -1).astype(np.float64)


def valid(vectors: DataFrame, size: int | None = None) -> DataFrame:
    """vec_id and embedding (array<double>) of the rows that take part."""
    x = F.col("embedding").cast("array<double>")
    fine = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))) & F.exists(x, lambda v: v != 0)
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("embedding")).where(F.col("vec_id").isNotNull() & fine)
    return rows.where(F.size("embedding") == size) if size else rows


def _raw(col: pa.Array) -> np.ndarray:
    """Rows of a column of vectors as bytes."""
    return np.frombuffer(b"".join(col.to_pylist()), np.float64).reshape(len(col), -1)


def length(x: np.ndarray) -> np.ndarray:
    return np.sqrt((x * x).sum(1))


def largest(score: np.ndarray, k: int) -> np.ndarray:
    """Columns of the k largest of each row, in no order; of equal ones the earlier."""
    if score.shape[1] <= k:
        return np.tile(np.arange(score.shape[1]), (len(score), 1))
    top = np.argpartition(-score, k - 1, axis=1)[:, :k]
    floor = np.take_along_axis(score, top, 1).min(1)
    for i in np.flatnonzero((score >= floor[:, None]).sum(1) > k).tolist():
        over, even = np.flatnonzero(score[i] > floor[i]), np.flatnonzero(score[i] == floor[i])
        top[i] = np.concatenate([over, even[: k - len(over)]])
    return top


def enough_probes(stored: DataFrame, queries: DataFrame, centroids: np.ndarray, k: int) -> int:
    """So many lists that they hold the share COVERED of the k nearest of TRIALS queries, chosen by a hash, among all rows."""
    got = queries.orderBy(F.xxhash64("vec_id", F.lit("trial")), "vec_id").limit(TRIALS).toArrow()
    if not got.num_rows:
        return PROBES
    asker, q = got.column("vec_id").to_numpy(), _matrix(got.column("embedding").combine_chunks())
    place = np.empty((len(q), len(centroids)), np.int32)
    np.put_along_axis(place, np.argsort(-(q @ centroids.T), axis=1, kind="stable"), np.arange(len(centroids), dtype=np.int32)[None, :], 1)

    def nearest_of_task(batches):
        score, near, at = np.full((len(q), 0), 0.0), np.zeros((len(q), 0), np.int64), np.zeros((len(q), 0), np.int32)
        for batch in batches:
            ids = batch.column("vec_id").to_numpy()
            s = q @ _raw(batch.column("vec")).T
            s[asker[:, None] == ids[None, :]] = -np.inf
            top = largest(s, k)
            score, near = np.hstack([score, np.take_along_axis(s, top, 1)]), np.hstack([near, ids[top]])
            at = np.hstack([at, np.take_along_axis(place, batch.column("list").to_numpy()[top], 1)])
            order = np.lexsort((near, -score), axis=-1)[:, :k]
            score, near, at = (np.take_along_axis(v, order, 1) for v in (score, near, at))
        real = score > -np.inf
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(asker, real.sum(1))), pa.array(near[real]), pa.array(score[real]), pa.array(at[real])], ["query_id", "vec_id", "score", "place"])

    found = stored.select("list", "vec_id", "vec").mapInArrow(tidy(nearest_of_task), "query_id long, vec_id long, score double, place int")
    nearer = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    true = found.withColumn("rank", nearer).where(F.col("rank") <= k)
    held = np.zeros(len(centroids), np.int64)
    for r in true.groupBy("place").count().collect():  # at most MOST_LISTS numbers
        held[r["place"]] = r["count"]
    return max(PROBES, int(np.searchsorted(held.cumsum(), COVERED * held.sum())) + 1)


def fit(rows: DataFrame, seed: int = 11) -> Index | None:
    """Centroids and codebooks from at most SAMPLE rows, chosen by a hash of the id."""
    got = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("embedding").toArrow().column(0).combine_chunks()
    if not len(got):
        return None
    sizes = got.value_lengths().to_numpy()
    size = int(np.bincount(sizes).argmax())
    x = _matrix(got.filter(pa.array(sizes == size)))
    rng = np.random.default_rng(seed)
    c = k_means(x, int(min(MOST_LISTS, max(1, np.sqrt(rows.count()) / 4))), rng)
    own = nearest(x, c)
    rest = x - c[own]
    cuts = np.linspace(0, size, min(PARTS, size) + 1).astype(int)
    return Index(c, [k_means(rest[:, a:b], CODES, rng) for a, b in zip(cuts[:-1], cuts[1:], strict=True)], cuts)


def search(vectors: DataFrame, queries: DataFrame, k: int = 20) -> DataFrame:
    """query_id, rank, vec_id and score of the k nearest found of each query (vec_id, embedding) among vectors, itself excepted."""
    spark = bounded(vectors.sparkSession)
    tables = Tables(spark, "ann")
    index = fit(valid(vectors))
    if index is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    size, books, cuts = index.centroids.shape[1], index.books, index.cuts
    once = lambda df: valid(df, size).groupBy("vec_id").agg(F.min("embedding").alias("embedding"))

    def assign(batches):
        for batch in batches:
            x = _matrix(batch.column("embedding"))
            own = nearest(x, index.centroids)
            rest = x - index.centroids[own]
            codes = np.column_stack([nearest(rest[:, a:b], book) for a, b, book in zip(cuts[:-1], cuts[1:], books, strict=True)]).astype(np.uint8)
            coded = np.hstack([book[codes[:, s]] for s, book in enumerate(books)])
            off = length(rest - coded) + ROUNDING * (length(x) + length(index.centroids)[own] + length(coded))
            raw = [pa.array([r.tobytes() for r in v], pa.binary()) for v in (codes, x)]
            yield pa.RecordBatch.from_arrays([pa.array(own, pa.int32()), batch.column("vec_id"), raw[0], pa.array(off), raw[1]], ["list", "vec_id", "code", "off", "vec"])

    stored = tables.keep(once(vectors).mapInArrow(tidy(assign), "list int, vec_id long, code binary, off double, vec binary"))
    probed = enough_probes(stored, once(queries), index.centroids, k)
    sizes = np.zeros(len(index.centroids), np.int64)
    for r in stored.groupBy("list").count().collect():  # at most MOST_LISTS numbers
        sizes[r["list"]] = r["count"]

    def probe(batches):
        for batch in batches:
            x = _matrix(batch.column("embedding"))
            base = x @ index.centroids.T
            order = np.argsort(-base, axis=1, kind="stable")
            held = np.cumsum(sizes[order], axis=1)
            need = np.minimum(np.maximum(probed, (held <= k).sum(1) + 1), len(sizes))
            row = np.repeat(np.arange(len(x)), need)
            at = np.concatenate([o[:n] for o, n in zip(order, need.tolist(), strict=True)]) if len(x) else np.zeros(0, np.int64)
            use = sizes[at] > 0
            row, at = row[use], at[use]
            raw = pa.array([r.tobytes() for r in x], pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), batch.column("vec_id").take(pa.array(row)), pa.array(base[row, at]), raw.take(pa.array(row))], ["list", "query_id", "base", "vec"])

    probes = tables.keep(once(queries).mapInArrow(tidy(probe), "list int, query_id long, base double, vec binary"))
    asked = {r["list"]: r["count"] for r in probes.groupBy("list").count().collect()}
    parts = F.broadcast(spark.createDataFrame([(i, int(-(-int(n) // CHUNK)), -(-asked.get(i, 0) // QUERIES)) for i, n in enumerate(sizes.tolist()) if n and asked.get(i)], "list int, chunks int, blocks int"))
    left = stored.join(parts, "list").select("list", F.pmod(F.xxhash64("vec_id"), "chunks").cast("int").alias("chunk"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "vec_id", "code", "off", "vec")
    right = probes.join(parts, "list").select("list", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"), F.pmod(F.xxhash64("query_id"), "blocks").cast("int").alias("block"), "query_id", "base", "vec")

    def best(rows: pa.Table, asks: pa.Table) -> pa.Table:
        out = ([], [], [])
        if rows.num_rows and asks.num_rows:
            ids = rows.column("vec_id").to_numpy()
            order = np.argsort(ids, kind="stable")  # equal scores then come by id
            ids = ids[order]
            code = np.frombuffer(b"".join(rows.column("code").to_pylist()), np.uint8).reshape(len(ids), -1)[order]
            off, x = rows.column("off").to_numpy()[order], _raw(rows.column("vec"))[order]
            far = length(x)
            qid, base, q = asks.column("query_id").to_numpy(), asks.column("base").to_numpy(), _raw(asks.column("vec"))
            for a in range(0, len(qid), 128):
                own, asker = q[a : a + 128], qid[a : a + 128]
                guess = np.zeros((len(ids), len(own)))
                for s, book in enumerate(books):
                    guess += (book @ own[:, cuts[s] : cuts[s + 1]].T)[code[:, s]]
                guess = np.ascontiguousarray(guess.T) + base[a : a + 128, None]
                itself = asker[:, None] == ids[None, :]
                guess[itself] = -np.inf
                top = largest(guess, RERANK)
                exact = (x[top] * own[:, None, :]).sum(-1)
                exact[np.take_along_axis(itself, top, 1)] = -np.inf
                # the k-th best so far: what is surely below it is no neighbour
                floor = -np.partition(-exact, k - 1, axis=1)[:, k - 1, None] if top.shape[1] >= k else np.full((len(own), 1), -np.inf)
                wide = length(own)[:, None]
                may = (guess + wide * off >= floor) & ~itself
                left = np.flatnonzero(may.any(0))
                i, j = np.nonzero(may[:, left] & (own @ x[left].T >= floor - ROUNDING * wide * far[left]))
                j = left[j]
                exact = np.concatenate([np.zeros(0), *[(x[j[b : b + 8192]] * own[i[b : b + 8192]]).sum(-1) for b in range(0, len(j), 8192)]])
                order = np.lexsort((ids[j], -exact, i))
                n = np.bincount(i, minlength=len(own))
                order = order[np.arange(len(i)) - np.repeat(n.cumsum() - n, n) < k]
                out[0].append(asker[i[order]])
                out[1].append(ids[j[order]])
                out[2].append(exact[order])
        whole = [np.concatenate(v) if v else np.zeros(0) for v in out]
        return pa.table([pa.array(whole[0].astype(np.int64)), pa.array(whole[1].astype(np.int64)), pa.array(whole[2].astype(np.float64))], names=["query_id", "vec_id", "score"])

    keys = ["list", "chunk", "block"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(best, "query_id long, vec_id long, score double")
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", place.cast("int")).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def query(spark, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return search(vectors, vectors.where("vec_id % 20 = 0"))

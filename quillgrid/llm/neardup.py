"""Near-duplicate groups by MinHash bands, odd sketches and exact confirmation.

A document is its set of 5-word shingles (64-bit hashes). Equal sets form one class, a node with a number of its own.
Nodes share a bucket where all ROWS minima of one of BANDS bands agree; a pair of similarity 0.75 escapes all of them
with probability (1 - 0.75^4)^40 = 2.4e-7. The verification sketch folds samples of a set into a parity bitmap of BITS
bits (an odd sketch). For sets of up to SMALL shingles every shingle is a sample; the population count of the XOR of two
bitmaps is then never more than the shingles that differ, so the sketch rejects only pairs that are surely no links.
Larger sets keep one MinHash sample for each of SAMPLES bins of the hash space, and pairs estimated under DOUBT, five
standard errors below the threshold, go. All others are confirmed on full sets.

Only links that join different groups matter, so buckets are never expanded into their pairs:
1. Twice, every group tries one link to the smallest group that it meets, that of most shared buckets, so the number of tries is at most
   that of nodes, and confirmed links contract the groups.
2. In buckets that still hold several groups, members of different groups are compared sketch by sketch inside blocks of
   at most BLOCK, and a block tells a forest: at most one link fewer than it has groups. Members of the bucket's largest
   group are compared with the others only. A block of which a link is refuted tells all its likely pairs.
Links become components by alternating large-star and small-star steps, each written to the shared folder.

Cases: null and empty texts, and texts without words, have the empty set and are linked with nothing; a text of fewer
words is one shingle. Rows of one id are one document: it is linked with all that any of its texts is linked with. A null
id takes no part and stays (component null, kept true).
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillgrid.functions.batches import bounded

from ._store import Tables, tidy
from ._text import Words, mix, pieces

#: Fixed parameters. LEAST over WHOLE is the least similarity of a link.
BANDS, ROWS, SAMPLES, BITS, SMALL, DOUBT, BLOCK, WORDS, LEAST, WHOLE = 40, 4, 1024, 2048, 2048, 0.65, 1024, 5, 75, 100
_rng = np.random.default_rng(75)
_A = _rng.integers(1, 2**32, BANDS * ROWS, dtype=np.uint32) | np.uint32(1)
_B = _rng.integers(1, 2**32, BANDS * ROWS, dtype=np.uint32) | np.uint32(1)
_GROUP = 128


def sets(col: pa.Array, k: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each document, one after another, and their offsets."""
    s, off = Words(col).shingles(k)
    own = [np.unique(s[a:b]) for a, b in zip(off[:-1], off[1:], strict=True)]
    return np.concatenate([np.zeros(0, np.uint64), *own]), np.concatenate([[0], np.cumsum([len(x) for x in own])]).astype(np.int64)


def band_keys(u: np.ndarray, off: np.ndarray) -> np.ndarray:
    """A 64-bit key for each band of each document of which off has the (non-empty) set."""
    x, heads = (u >> np.uint64(32)).astype(np.uint32), off[:-1]
    minima = np.empty((len(heads), BANDS * ROWS), np.uint32)
    for k in range(BANDS * ROWS):
        v = x * _A[k]
        v ^= v >> np.uint32(16)
        v *= _B[k]
        minima[:, k] = np.minimum.reduceat(v, heads)
    m = minima.reshape(len(heads), BANDS, ROWS).astype(np.uint64)
    key = np.arange(BANDS, dtype=np.uint64)[None, :] * np.uint64(0x9E3779B97F4A7C15)
    for r in range(ROWS):
        key = mix(key + m[:, :, r] + np.uint64(r + 1))
    return key


def _parity(doc: np.ndarray, items: np.ndarray, n: int) -> np.ndarray:
    held = (mix(items) & np.uint64(BITS - 1)).astype(np.int64)
    return (np.bincount(doc * BITS + held, minlength=n * BITS) & 1).astype(bool).reshape(n, BITS)


def odd_sketch(u: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Parity bitmap of all shingles (0 for sets that are not small), parity bitmap of the samples, and the bitmap of the bins that have one, as bytes."""
    n, sizes = len(off) - 1, np.diff(off)
    doc, place = np.repeat(np.arange(n), sizes), (u >> np.uint64(64 - (SAMPLES.bit_length() - 1))).astype(np.int64)
    small = (sizes <= SMALL)[doc]
    every = _parity(doc[small], u[small], n)
    first = np.ones(len(u), bool)
    first[1:] = (place[1:] != place[:-1]) | (doc[1:] != doc[:-1])  # sets are sorted, so this is each bin's minimum
    doc, place, held = doc[first], place[first], u[first]
    bins = np.zeros((n, SAMPLES), bool)
    bins[doc, place] = True
    return np.packbits(np.hstack([every, _parity(doc, held, n), bins]), axis=1)


def similarity(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Estimated similarities from the samples of sketches as rows of 64-bit words; a and b broadcast."""
    k = BITS // 64
    apart = np.bitwise_count(a[..., k : 2 * k] ^ b[..., k : 2 * k]).sum(-1, dtype=np.int64)
    either = np.bitwise_count(a[..., 2 * k :] | b[..., 2 * k :]).sum(-1, dtype=np.int64)
    both = np.bitwise_count(a[..., 2 * k :]).sum(-1, dtype=np.int64) + np.bitwise_count(b[..., 2 * k :]).sum(-1, dtype=np.int64)
    differ = -BITS / 2 * np.log(np.maximum(1 - 2 * apart / BITS, 1e-3))
    return (both - differ) / 2 / np.maximum(either, 1)


def possible(n: np.ndarray, a: np.ndarray, m: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether sizes and sketches leave pairs a chance; n and a, and m and b, broadcast."""
    ok = WHOLE * np.minimum(n, m) >= LEAST * np.maximum(n, m)
    apart = np.bitwise_count(a[..., : BITS // 64] ^ b[..., : BITS // 64]).sum(-1, dtype=np.int64)
    fine = (WHOLE + LEAST) * apart <= (WHOLE - LEAST) * (n + m)
    large = np.maximum(n, m) > SMALL
    return ok & np.where(large, similarity(a, b) >= DOUBT, fine) if large.any() else ok & fine


def _sketches(batches):
    for batch in batches:
        for part in pieces(batch, "text"):
            u, off = sets(part.column("text"))
            for a in range(0, part.num_rows, _GROUP):
                b = min(a + _GROUP, part.num_rows)
                n = np.diff(off[a : b + 1])
                some = np.flatnonzero(n)
                own, sizes = u[off[a] : off[b]], np.concatenate([[0], np.cumsum(n[some])])
                keys, bits, digest = [None] * (b - a), [None] * (b - a), [None] * (b - a)
                if len(some):
                    k, s = band_keys(own, sizes).view(np.int64), odd_sketch(own, sizes)
                    for j, d in enumerate(some.tolist()):
                        keys[d], bits[d] = k[j], s[j].tobytes()
                        digest[d] = hashlib.blake2b(own[sizes[j] : sizes[j + 1]].tobytes(), digest_size=16).digest()
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id")[a:b], pa.array(n), pa.array(digest, pa.binary()), pa.array(keys, pa.list_(pa.int64())), pa.array(bits, pa.binary())],
                    ["doc_id", "n_shingles", "digest", "bands", "sketch"],
                )


def _words64(col: pa.Array) -> np.ndarray:
    return np.array([np.frombuffer(x, np.uint64) for x in col.to_pylist()]).reshape(len(col), -1)


def _likely(batches):
    """Pairs whose sizes and sketches leave them a chance."""
    for batch in batches:
        if batch.num_rows:
            n, m = (batch.column(x).to_numpy() for x in ("n_a", "n_b"))
            yield batch.select(["a", "b"]).filter(pa.array(possible(n, _words64(batch.column("sketch_a")), m, _words64(batch.column("sketch_b")))))


def block_pairs(node: np.ndarray, comp: np.ndarray, n: np.ndarray, side: np.ndarray, x: np.ndarray, whole: bool):
    """Likely pairs of one block, of members of different groups: all of them, or a forest over the groups.

    Sides 0 and 1 are compared with each other, side 2 within itself.
    """
    own = comp.copy()
    for i in range(len(node) - 1):
        j = np.flatnonzero((own[i + 1 :] != own[i]) & ((side[i + 1 :] != side[i]) | (side[i] == 2))) + i + 1
        if not len(j):
            continue
        for k in j[possible(n[i], x[i], n[j], x[j])].tolist():
            if whole or own[k] != own[i]:
                yield min(node[i], node[k]), max(node[i], node[k])
            if not whole:
                own[own == own[k]] = own[i]


def _told(whole: bool):
    """A batch function over runs of equal g (sorted), each a block."""

    def pairs(rows: pa.Table):
        node, comp, n, side = (rows.column(x).to_numpy() for x in ("node", "comp", "n", "side"))
        return [(rows.column("g")[0].as_py(), *p) for p in block_pairs(node, comp, n, side, _words64(rows.column("sketch").combine_chunks()), whole)]

    def out(found: list):
        cols = list(zip(*found, strict=True)) if found else [(), (), ()]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["g", "a", "b"])

    def run(batches):
        rest = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = pa.concat_tables([rest, table]) if rest is not None else table
            g = table.column("g").to_numpy()
            if not len(g):
                continue
            cut, at = np.append(np.flatnonzero(g[1:] != g[:-1]) + 1, len(g)), 0
            for to in cut[:-1].tolist():
                yield out(pairs(table.slice(at, to - at)))
                at = to
            rest = table.slice(at)
        if rest is not None:
            yield out(pairs(rest))

    return run


def _as_sets(batches):
    for batch in batches:
        for part in pieces(batch, "text"):
            u, off = sets(part.column("text"))
            own = [u[a:b].tobytes() for a, b in zip(off[:-1], off[1:], strict=True)]
            digest = [hashlib.blake2b(x, digest_size=16).digest() for x in own]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(digest, pa.binary()), pa.array(own, pa.binary())], ["doc_id", "digest", "items"])


def as_sets(docs: DataFrame) -> DataFrame:
    """doc_id, digest and items (the sorted shingle hashes) of docs (doc_id, text)."""
    return docs.mapInArrow(tidy(_as_sets), "doc_id long, digest binary, items binary")


def _confirmed(batches):
    for batch in batches:
        ok = []
        for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist(), strict=True):
            x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            both = np.sort(np.concatenate([x, y]))
            same = int((both[1:] == both[:-1]).sum())
            ok.append(WHOLE * same >= LEAST * (len(x) + len(y) - same))
        yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))


def confirm(own: DataFrame, pairs: DataFrame, tables: Tables) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough. own: node and items, a table with one row for each node of the pairs at least."""
    side = lambda k, v: own.select(F.col("node").alias(k), F.col("items").alias(v)).hint("merge")
    return tables.keep(pairs.join(side("a", "x"), "a").join(side("b", "y"), "b").select("a", "b", "x", "y").mapInArrow(tidy(_confirmed), "a long, b long"))


def components(links: DataFrame, tables: Tables) -> DataFrame:
    """(doc, comp): the smallest id reachable from every id in the links (a, b), ids alone in none left out."""
    at = links.where("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct()
    at, before = tables.keep(at), None
    state = lambda e: tuple(e.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first())
    now = state(at)
    while now != before:
        both = at.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(at.select("lo", "hi"))
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()
        least = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(least, "hi").select(F.explode(F.array(F.struct("hi", F.col("m").alias("lo")), F.struct(F.col("lo").alias("hi"), F.col("m").alias("lo")))).alias("e")).select("e.*").where("hi <> lo").distinct()
        new = tables.keep(small)
        tables.drop(at)
        at, before, now = new, now, state(new)
    return at.select(F.col("hi").alias("doc"), F.col("lo").alias("comp")).union(at.select("lo", "lo").distinct())


def open_buckets(placed: DataFrame) -> DataFrame:
    """Members (key, node, comp) of buckets that hold several groups."""
    mixed = placed.groupBy("key").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).where("low <> high").select("key")
    return placed.join(mixed, "key")


def tries(placed: DataFrame) -> DataFrame:
    """One pair (a, b) of nodes for each group that meets a smaller one: of the smallest groups of its buckets the one met most often."""
    least = placed.groupBy("key").agg(F.min(F.struct("comp", "node")).alias("first"))
    met = placed.join(least, "key").where("comp <> first.comp").groupBy("comp", F.col("first.comp").alias("to")).agg(F.count("*").alias("n"), F.min(F.struct(F.col("first.node").alias("a"), F.col("node").alias("b"))).alias("pair"))
    return met.groupBy("comp").agg(F.max_by("pair", F.struct("n", -F.col("to"))).alias("pair")).select("pair.*")


def blocks(opened: DataFrame) -> DataFrame:
    """g, node, comp and side of the blocks in which members of open buckets (key, node, comp) are compared.

    A bucket of up to BLOCK members is one block. In a larger one all pairs of blocks of the members outside its largest group meet, and
    each of those blocks meets each block of the largest group.
    """
    each = opened.groupBy("key", "comp").agg(F.count("*").alias("n"))
    size = each.groupBy("key").agg(F.sum("n").alias("size"), F.max(F.struct("n", "comp")).alias("most"))
    one = F.col("size") <= BLOCK
    sized = size.select(
        "key", F.when(~one, F.col("most.comp")).alias("most"), F.when(one, 1).otherwise(F.ceil((F.col("size") - F.col("most.n")) / BLOCK)).cast("int").alias("others"), F.when(one, 0).otherwise(F.ceil(F.col("most.n") / BLOCK)).cast("int").alias("parts")
    )
    inside = F.coalesce(F.col("comp") == F.col("most"), F.lit(False))
    placed = opened.join(sized, "key").select("key", "node", "comp", "others", "parts", inside.alias("inside"), F.pmod(F.xxhash64("node"), F.when(inside, F.col("parts")).otherwise(F.col("others"))).cast("int").alias("own"))
    to = lambda n: F.sequence(F.lit(0), n - 1)
    place = lambda i, j, kind, side: F.struct(F.xxhash64("key", i, j, F.lit(kind)).alias("g"), side.cast("int").alias("side"))
    own = F.col("own")
    among = F.transform(to(F.col("others")), lambda k: place(F.least(own, k), F.greatest(own, k), "among", F.when(own == k, 2).otherwise((own > k).cast("int"))))
    with_most = F.when(F.col("parts") > 0, F.transform(to(F.col("parts")), lambda k: place(own, k, "most", F.lit(0)))).otherwise(F.array())
    at = F.when(F.col("inside"), F.transform(to(F.col("others")), lambda k: place(k, own, "most", F.lit(1)))).otherwise(F.concat(among, with_most))
    return placed.select("node", "comp", F.inline(at))


def groups(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for every row of docs (doc_id, text; other columns are ignored)."""
    spark = bounded(docs.sparkSession)
    tables = Tables(spark, "neardup")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    every = tables.keep(docs.mapInArrow(tidy(_sketches), "doc_id long, n_shingles long, digest binary, bands array<long>, sketch binary"))
    some = every.where("n_shingles > 0 and doc_id is not null")
    # a number of its own for each class, which holds once the table is written
    classes = tables.keep(some.groupBy("digest").agg(F.min("doc_id").alias("rep")).withColumn("node", F.monotonically_increasing_id()))
    rows = tables.keep(every.select("doc_id", "n_shingles", "digest").join(classes.select("digest", "node"), "digest", "left").select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.col("node")).alias("node")))
    reps = some.join(classes.select("digest", F.col("rep").alias("doc_id"), "node"), ["digest", "doc_id"])

    band = reps.select(F.explode("bands").alias("key"), "node")
    members = tables.keep(band.join(band.groupBy("key").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low <> high").select("key"), "key"))
    near = tables.keep(reps.select("node", F.col("n_shingles").alias("n"), "sketch").join(members.select("node").distinct(), "node", "left_semi").dropDuplicates(["node"]))
    # ids that have several texts, and the first of their nodes
    several = tables.keep(rows.where("doc_id is not null").groupBy("doc_id").agg(F.min("node").alias("lo"), F.max("node").alias("hi"), F.count_if(F.col("node").isNull()).alias("empty")).where("lo <> hi or (empty > 0 and lo is not null)").select("doc_id", "lo"))
    known = spark.createDataFrame([], "doc long, comp long")
    if not several.isEmpty():
        known = tables.keep(components(rows.join(several, "doc_id").where("node <> lo").select(F.col("lo").alias("a"), F.col("node").alias("b")), tables))
    # full sets of nodes that share a bucket; texts are shuffled once to meet them, at every size alike
    ends = near.select("node").join(classes, "node")
    texts = docs.join(ends.select(F.col("rep").alias("doc_id")).distinct().hint("merge"), "doc_id", "left_semi")
    full_sets = tables.keep(as_sets(texts).join(ends.select("digest", "node"), "digest").select("node", "items").dropDuplicates(["node"]))

    def grown(links: DataFrame) -> DataFrame:
        return known if links.isEmpty() else tables.keep(components(known.select(F.col("doc").alias("a"), F.col("comp").alias("b")).union(links), tables))

    def placed() -> DataFrame:
        return members.join(known.select(F.col("doc").alias("node"), "comp"), "node", "left").select("key", "node", F.coalesce("comp", "node").alias("comp"))

    side = lambda x: near.select(F.col("node").alias(x), F.col("n").alias(f"n_{x}"), F.col("sketch").alias(f"sketch_{x}"))
    for _ in range(2):
        tried = tables.keep(tries(placed()))
        known = grown(confirm(full_sets, tables.keep(tried.join(side("b"), "b").join(side("a"), "a").mapInArrow(tidy(_likely), "a long, b long")), tables))

    work = tables.keep(blocks(open_buckets(placed())))
    for whole in (False, True):
        full = work.join(near, "node").select("g", "node", "comp", "side", "n", "sketch")
        told = tables.keep(full.repartition("g").sortWithinPartitions("g", "node").mapInArrow(tidy(_told(whole)), "g long, a long, b long"))
        pairs = tables.keep(told.select("a", "b").distinct())
        found = confirm(full_sets, pairs, tables)
        known = grown(found)
        refuted = told.join(found, ["a", "b"], "left_anti").select("g").distinct()
        if whole or refuted.isEmpty():
            break
        # blocks with a refuted link are looked at again, with the groups as they are now
        again = work.drop("comp").join(refuted, "g").join(known.select(F.col("doc").alias("node"), "comp"), "node", "left")
        work = tables.keep(again.select("g", "node", F.coalesce("comp", "node").alias("comp"), "side"))

    named = known.join(classes.select(F.col("node").alias("doc"), "rep"), "doc").select(F.col("doc").alias("node"), "comp", "rep")
    named = named.join(named.groupBy("comp").agg(F.min("rep").alias("component")), "comp").select("node", "component")
    named = classes.select("node", "rep").join(named, "node", "left").select("node", F.coalesce("component", "rep").alias("component"))
    empty = rows.where("node is null").drop("node").join(several, "doc_id", "left").select("doc_id", "n_shingles", F.col("lo").alias("node"))
    out = rows.where("node is not null").unionByName(empty).join(named, "node", "left").select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def keep_first(docs: DataFrame) -> DataFrame:
    """The rows of docs whose id is the smallest of its group, with all their columns."""
    gone = groups(docs).where(~F.col("kept")).select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*[f"`{c}`" for c in docs.columns])


def query(spark, sf_dir: str) -> DataFrame:
    return groups(spark.read.parquet(f"{sf_dir}/documents.parquet"))

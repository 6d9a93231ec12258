"""Line dedup by pairs of neighbouring lines, long lines, and content-defined chunks of lines.

A passage is two neighbouring lines or more, not all empty, or a line of LONG bytes or more. Every pair of neighbouring lines and every
long line is a chunk, so no passage is missed; longer chunks let a long passage travel in few pieces.
Lines are hashed, and a rolling hash over WINDOW line hashes is taken at each line. A line begins a chunk where its
rolling hash is smaller than those of both neighbours, so a boundary depends on a few lines around it only, equal
passages are cut alike wherever they stand, and every chunk within a text has at least two lines. SEEDS such
chunkings, of differently seeded hashes, are taken. Chunks that occur in several documents, or again in one, stay in the first
place (smallest doc_id, then row, then line) and go elsewhere, once their bytes equal the first's; a chunk that overlaps its own
first place is no repeat of it. While the neighbouring lines (AROUND at each side) are equal as well, they go too, so a passage that begins or
ends between boundaries is removed to its ends.

Only chunk hashes are gathered over the corpus; bytes travel for repeated chunks alone, and of several repeated
chunks over the same lines only as many as cover them. Both joins are plain equi-joins that Spark may split where a
chunk or a document is hot.

Cases: a null or empty text has no chunk and stays; a text that loses every line becomes empty, and drop_repeats()
drops its row; rows equal in id and text are one document, treated alike; null ids sort first. Lines end at "\\n" alone;
a line under LONG bytes is never a chunk by itself.

With leave_revisions, a document that is a near copy of an earlier one keeps its text, so that near-duplicate detection, which would
no longer know its remains, can remove it whole. A document is tried if it goes line by line with one earlier document (as many
lines, and chunks first met there at the same lines that make up two fifths of it), and left if its whole text and what
that document keeps have the similarity that near-duplicate detection asks for. Documents that are left are no such earlier
document, nor are rows of the same or of a null id, which that detection does not remove. All others lose their passages.
"""

from __future__ import annotations

from itertools import takewhile

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quillgrid.functions.batches import bounded

from . import neardup
from ._store import Tables, tidy
from ._text import buffers, mix, pieces, powers

#: Fixed parameters: lines of the rolling hash, chunkings, neighbouring lines compared at each side, bytes of a line that is a chunk.
WINDOW, SEEDS, AROUND, LONG = 2, 6, 3, 200
_rng = np.random.default_rng(44)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_SEED = _rng.integers(1, 2**63, (SEEDS, WINDOW), dtype=np.uint64) | np.uint64(1)
_PART = np.uint64(0x9E3779B97F4A7C15)


class Lines:
    """The lines of a batch: first byte and byte past the last of each (its newline left out), hash, and off, the first line of each document."""

    def __init__(self, col: pa.Array):
        self.data, self.doc_off = buffers(col)
        breaks = np.flatnonzero(self.data == 10)
        some = np.flatnonzero(np.diff(self.doc_off) > 0)
        start = np.concatenate([self.doc_off[some], breaks + 1])
        doc = np.concatenate([some, np.searchsorted(self.doc_off, breaks, "right") - 1])
        order = np.lexsort((start, doc))  # a newline that ends a document begins an empty line at the next one's first byte
        self.start, self.doc = start[order], doc[order]
        self.past = np.empty_like(self.start)
        if len(self.start):
            last = np.append(self.doc[1:] != self.doc[:-1], True)
            self.past[:-1] = self.start[1:] - 1
            self.past[last] = self.doc_off[self.doc[last] + 1]
        self.off = np.searchsorted(self.doc, np.arange(len(self.doc_off)))
        self.hash = np.zeros(len(self.start), np.uint64)
        at = 0
        while at < len(self.start):  # windows of about a megabyte bound the memory of the prefix sums
            to = max(at + 1, int(np.searchsorted(self.start, self.start[at] + (1 << 20))))
            a, b = int(self.start[at]), int(self.past[to - 1])
            total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTE[self.data[a:b]] * powers(b - a + 1)[: b - a], dtype=np.uint64)])
            s, e = self.start[at:to] - a, self.past[at:to] - a
            held = (total[e] - total[s]) * inverse_powers(b - a + 1)[s]
            self.hash[at:to] = mix(held + (e - s).astype(np.uint64) * _PART)
            at = to


_inverse = np.ones(1, np.uint64)


def inverse_powers(n: int) -> np.ndarray:
    """The inverses, modulo 2^64, of the powers that a prefix has too much: they make a line's hash independent of its place."""
    global _inverse
    if len(_inverse) < n:
        base = np.uint64(pow(int(powers(1)[0]), -1, 1 << 64))
        _inverse = np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(1 << int(n).bit_length(), base, np.uint64)]))
    return _inverse


def chunks(h: np.ndarray, doc: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each chunking, the first line of each chunk and the line past its last."""
    new = np.append(True, doc[1:] != doc[:-1])
    out = []
    for seed in _SEED:
        roll = np.zeros(len(h), np.uint64)
        for k in range(WINDOW):
            shifted = np.zeros(len(h), np.uint64)
            same = np.zeros(len(h), bool)
            same[: len(h) - k] = doc[k:] == doc[: len(h) - k]
            shifted[: len(h) - k] = h[k:]
            roll += np.where(same, shifted, np.uint64(0)) * seed[k]
        roll = mix(roll)
        low = np.zeros(len(h), bool)
        low[1:-1] = (roll[1:-1] < roll[:-2]) & (roll[1:-1] < roll[2:]) & (doc[2:] == doc[1:-1])
        first = np.flatnonzero(low | new)
        out.append((first, np.append(first[1:], len(h))))
    return out


def spans(lines: Lines) -> tuple[np.ndarray, np.ndarray]:
    """First line of each distinct chunk and the line past its last: pairs of neighbouring lines, long lines, and the chunkings' chunks."""
    size = lines.past - lines.start
    pair = np.flatnonzero((lines.doc[1:] == lines.doc[:-1]) & (size[1:] + size[:-1] > 0))
    one = np.flatnonzero(size >= LONG)
    found = [(pair, pair + 2), (one, one + 1), *((a[b - a >= 2], b[b - a >= 2]) for a, b in chunks(lines.hash, lines.doc))]
    both = np.unique(np.concatenate([a << 32 | b for a, b in found]))
    a, b = both >> 32, both & 0xFFFFFFFF
    some = np.concatenate([[0], np.cumsum(size)])
    text = some[b] > some[a]  # a run of empty lines is no passage
    return a[text], b[text]


def _chunk_rows(batches):
    for batch in batches:
        for part in pieces(batch, "text"):
            lines = Lines(part.column("text"))
            if not len(lines.start):
                continue
            total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(lines.hash * powers(len(lines.hash) + 1)[: len(lines.hash)], dtype=np.uint64)])
            a, b = spans(lines)
            key = mix((total[b] - total[a]) * inverse_powers(len(lines.hash) + 1)[a] + (b - a).astype(np.uint64) * _PART)
            own = pa.array(lines.doc[a])
            first, total_lines = a - lines.off[lines.doc[a]], np.bincount(lines.doc, minlength=part.num_rows)[lines.doc[a]]
            yield pa.RecordBatch.from_arrays([part.column("doc_id").take(own), part.column("row").take(own), pa.array(key.view(np.int64)), pa.array(first.astype(np.int32)), pa.array((first + b - a).astype(np.int32)), pa.array(total_lines.astype(np.int32))], ["doc_id", "row", "key", "first", "past", "lines"])


def cover(spans: list[dict]) -> list[dict]:
    """Spans, the longest first, leaving out those whose lines are all covered by earlier ones."""
    held, out = set(), []
    for s in sorted(spans, key=lambda s: (s["first"] - s["past"], s["first"], s["key"])):
        own = range(s["first"], s["past"])
        if not held.issuperset(own):
            held.update(own)
            out.append(s)
    return out


def _covers(batches):
    """For each document, as few of its repeated chunks as cover their lines."""
    for batch in batches:
        rows = [
            (row, s["key"], s["first"], s["past"])
            for row, spans in zip(batch.column("row").to_pylist(), batch.column("spans").to_pylist(), strict=True)
            for s in cover(spans)
        ]
        cols = list(zip(*rows, strict=True)) or [(), (), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int32(), pa.int32()), strict=True)], ["row", "key", "first", "past"])


def _bytes_of(batches):
    """For each document, the bytes of its listed chunks and the neighbouring lines that no listed chunk has."""
    kinds = (pa.int64(), pa.int64(), pa.bool_(), pa.int32(), pa.binary(), pa.list_(pa.binary()), pa.list_(pa.binary()))
    for batch in batches:
        for part in pieces(batch, "text"):
            cols = [[] for _ in kinds]
            for row, text, spans in zip(part.column("row").to_pylist(), part.column("text").to_pylist(), part.column("spans").to_pylist(), strict=True):
                lines = text.encode().split(b"\n")
                gone = {k for s in spans if not s["stays"] for k in range(s["first"], s["past"])}
                for s in spans:
                    a, b = s["first"], s["past"]
                    before, after = range(a - 1, max(-1, a - 1 - AROUND), -1), range(b, min(len(lines), b + AROUND))
                    if not s["stays"]:
                        before, after = (list(takewhile(lambda k: k not in gone, side)) for side in (before, after))
                    for c, v in zip(cols, (s["key"], row, s["stays"], a, b"\n".join(lines[a:b]), [lines[k] for k in before], [lines[k] for k in after]), strict=True):
                        c.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], ["key", "row", "stays", "first", "bytes", "before", "after"])


def candidates(docs: DataFrame, tables: Tables, leave_revisions: bool = False) -> tuple[DataFrame, DataFrame | None]:
    """row, spans (the chunks of each document to compare, those that may go and those that stay) and tried (whether it is in a
    pair that follows); with leave_revisions, pairs row and home_row of documents that may be near copies. docs: row, doc_id, text."""
    found = tables.keep(docs.where("text IS NOT NULL").mapInArrow(tidy(_chunk_rows), "doc_id long, row long, key long, first int, past int, lines int"))
    place = F.struct("doc_id", "row", "first", "lines")
    often = found.groupBy("key").agg(F.min(place).alias("home"), F.max(place).alias("other")).where("home <> other").select("key", "home")
    again = found.join(often, "key").where(place != F.col("home")).where("row <> home.row OR first >= home.first + past - first").select("row", "key", "first", "past", "lines", F.col("home.row").alias("home_row"), F.col("home.first").alias("home_first"), F.col("home.lines").alias("home_lines"), F.coalesce(F.col("doc_id") != F.col("home.doc_id"), F.lit(False)).alias("apart"))
    again = tables.keep(again.dropDuplicates(["row", "key", "first"]))
    tables.drop(found)
    own = again.groupBy("row").agg(F.collect_list(F.struct("key", "first", "past")).alias("spans"))  # bounded by a document's own lines
    mine = tables.keep(own.mapInArrow(tidy(_covers), "row long, key long, first int, past int"))
    homes = again.join(mine.select("key").distinct(), "key", "left_semi").groupBy("key").agg(F.first("home_row").alias("row"), F.first("home_first").alias("first"), F.first(F.col("past") - F.col("first")).alias("n"))
    span = lambda stays: F.struct("key", "first", "past", F.lit(stays).alias("stays"))
    listed = mine.select("row", span(False).alias("s")).union(homes.select("row", "key", "first", (F.col("first") + F.col("n")).alias("past")).select("row", span(True).alias("s")))
    listed, copies = listed.withColumn("tried", F.lit(False)), None
    if leave_revisions:
        # pairs of lines and long lines are all the equal lines that a passage can have, so longer chunks add none
        same = again.where("apart AND first = home_first AND lines = home_lines AND past - first <= 2").groupBy("row", "home_row")
        held = F.size(F.array_distinct(F.flatten(F.collect_list(F.sequence("first", F.col("past") - 1)))))
        copies = tables.keep(same.agg(held.alias("held"), F.max("lines").alias("lines")).where("5 * held >= 2 * lines").select("row", "home_row"))
        ends = copies.select("row").union(copies.select("home_row")).distinct()
        listed = listed.union(ends.select("row", F.lit(None).cast(listed.schema["s"].dataType), F.lit(True)))
    out = tables.keep(listed.groupBy("row").agg(F.collect_list("s").alias("spans"), F.max("tried").alias("tried")))
    tables.drop(again, mine)
    return out, copies


def repeats(held: DataFrame, tables: Tables) -> DataFrame:
    """row, first and past of the lines that repeat what an earlier place holds. held: row, text and spans of candidates()."""
    parts = tables.keep(held.mapInArrow(tidy(_bytes_of), "key long, row long, stays boolean, first int, bytes binary, before array<binary>, after array<binary>"))
    there = parts.where("stays").select("key", F.col("bytes").alias("b"), F.col("before").alias("b0"), F.col("after").alias("b1")).dropDuplicates(["key"])
    equal = parts.where("NOT stays").join(there, "key").where(F.col("bytes") == F.col("b"))

    def run(x: str, y: str):
        """How many neighbouring lines are equal before one differs."""
        both = F.transform(F.slice(x, 1, F.least(F.size(x), F.size(y))), lambda p, i: p == F.col(y)[i])
        stop = F.array_position(both, False).cast("int")
        return F.when(stop == 0, F.size(both)).otherwise(stop - 1)

    n = F.size(F.split(F.col("bytes").cast("string"), "\n", -1))
    return equal.select("row", (F.col("first") - run("before", "b0")).alias("first"), (F.col("first") + n + run("after", "b1")).alias("past"))


def _without(batches):
    """Texts without the lines of their spans; n_lines and n_removed."""
    for batch in batches:
        col, texts, total, gone = batch.column("gone").to_pylist(), batch.column("text").to_pylist(), [], []
        for i, (spans, text) in enumerate(zip(col, texts, strict=True)):
            if not spans or text is None:
                total.append(text.count("\n") + 1 if text else 0)
                gone.append(0)
                continue
            lines, out = text.split("\n"), set()
            for s in spans:
                out.update(range(s["first"], s["past"]))
            total.append(len(lines))
            gone.append(len(out))
            texts[i] = "\n".join(x for k, x in enumerate(lines) if k not in out)
        yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("own"), pa.array(texts, pa.string()), pa.array(total, pa.int64()), pa.array(gone, pa.int64())], ["row", "own", "text", "n_lines", "n_removed"])


def without(docs: DataFrame) -> DataFrame:
    """row, own, text, n_lines and n_removed of docs (row, own, text, gone)."""
    schema = StructType([docs.schema["row"], docs.schema["own"]]).add("text", "string").add("n_lines", "long").add("n_removed", "long")
    return docs.select("row", "own", "text", "gone").mapInArrow(tidy(_without), schema)


def revisions(docs: DataFrame, copies: DataFrame, tables: Tables) -> DataFrame:
    """row of each document that is a near copy of what an earlier one keeps. docs: row, own, text and gone; copies: row and home_row, the pairs to try."""
    kept = lambda row: F.xxhash64(row, F.lit("kept"))
    both = docs.select(F.col("row").alias("doc_id"), "text").union(without(docs).select(kept("row"), "text"))
    worded = both.where(F.col("text").rlike("[^ \\t-\\r]"))  # texts without words are linked with nothing
    pairs = copies.select(kept("home_row").alias("a"), F.col("row").alias("b"))
    ends = pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct()
    own = neardup.as_sets(worded.join(ends, "doc_id", "left_semi")).select(F.col("doc_id").alias("node"), "items").dropDuplicates(["node"])
    sure = neardup.confirm(tables.keep(own), pairs, tables).withColumnRenamed("b", "row")
    # an earlier document that is left itself does not keep less, and is no place that stays
    return sure.join(sure.select(kept("row").alias("a")).distinct(), "a", "left_anti").select("row").distinct()


def _removed(docs: DataFrame, leave_revisions: bool) -> DataFrame:
    """own (a struct of the other columns of docs, so that no name of theirs can clash), text, n_lines and n_removed."""
    bounded(docs.sparkSession)
    tables = Tables(docs.sparkSession, "linededup")
    keyed = docs.select(F.xxhash64(F.col("doc_id").cast("string"), "text").alias("row"), F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("own"), "text")
    base = keyed.select("row", F.col("own.doc_id").cast("long").alias("doc_id"), "text")
    # texts are shuffled once to meet their candidates; after that only documents that have some are moved
    listed, copies = candidates(base, tables, leave_revisions)
    met = tables.keep(keyed.join(listed, "row", "left"))
    spans = tables.keep(repeats(met.where("spans IS NOT NULL").select("row", "text", "spans"), tables))
    gone = spans.groupBy("row").agg(F.collect_set(F.struct("first", "past")).alias("gone"))
    if leave_revisions:
        gone = tables.keep(gone)
        tried = met.where("tried").select("row", "own", "text").join(gone, "row", "left")
        gone = gone.join(tables.keep(revisions(tried, copies, tables)), "row", "left_anti")
    some, rest = (met.where(f"spans IS {x}NULL").select("row", "own", "text") for x in ("NOT ", ""))
    return without(some.join(gone, "row", "left").unionByName(rest, allowMissingColumns=True))


def _columns(docs: DataFrame) -> list:
    """The columns of docs from those of _removed(); n_chars follows text."""
    out = []
    for c in docs.columns:
        was = F.col("text") if c == "text" else F.col(f"own.`{c}`")
        out.append((F.when(F.col("n_removed") > 0, F.length("text")).otherwise(was).cast(docs.schema[c].dataType) if c == "n_chars" else was).alias(c))
    return out


def remove(docs: DataFrame, leave_revisions: bool = False) -> DataFrame:
    """docs with their repeated passages removed from text (n_chars follows, where there is one), and n_lines and n_removed, which take the place of columns so named."""
    new = ("n_lines", "n_removed")
    return _removed(docs, leave_revisions).select(*[c for c, name in zip(_columns(docs), docs.columns, strict=True) if name not in new], *new)


def drop_repeats(docs: DataFrame, leave_revisions: bool = False) -> DataFrame:
    """remove(), without the rows that have lost every line, and with the columns of docs alone."""
    return _removed(docs, leave_revisions).where("n_removed = 0 OR n_removed < n_lines").select(*_columns(docs))


def query(spark, sf_dir: str) -> DataFrame:
    out = remove(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("text_sha256"))

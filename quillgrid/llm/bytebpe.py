"""Byte-level BPE: merges folded by Spark's higher-order functions over the byte arrays of distinct words.

The pre-tokenising pattern runs in the JVM. A Python step numbers the words of a task, so that each distinct word of
the task (or of a generation of GENERATION words, which bounds memory) is encoded once, and hands on its bytes as an
array of byte ids, each with the rank of the pair that it begins. Encoding is a fold: each step
merges the leftmost pair of least rank, whose rank is the id of the merged piece. Ranks come from one literal map from
pairs of ids to ranks. Spark would walk a MAP to find a key, so the literal is an array in which a pair has two possible
places (cuckoo hashing). Decoding takes each id's binary piece and concatenates them. No row is shuffled, and nothing
is collected.

A word that is itself in the vocabulary is one token, as in the library. The array fold is quadratic in a word's length,
so words of more than LONGEST bytes have the same merges folded over a linked list by a heap of ranks. Texts with code
points that the JVM's Unicode tables do not know are split by the regex module instead.

Cases: a null text is empty; an empty text has no ids and both digests are of nothing. Nulls in doc_id stay. Repeated
rows are each encoded; other columns are ignored. The vocabulary file is a parameter and is read on the driver.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import json

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillgrid.functions.batches import bounded

from ._store import tidy
from ._text import buffers, mix, powers

#: The code points of white space beyond ASCII and Latin-1, the pre-tokenising pattern with white space
#: spelt out for Java, and its original for the regex module.
_WIDE = ((0x1680, 0x1680), (0x2000, 0x200A), (0x2028, 0x2029), (0x202F, 0x202F), (0x205F, 0x205F), (0x3000, 0x3000))
_SPACE = r"\t-\r \x85\xa0" + "".join(rf"\x{{{a:x}}}-\x{{{b:x}}}" for a, b in _WIDE)
PATTERN = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{_SPACE}\p{{L}}\p{{N}}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+"
ORIGINAL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Bits of an id, bytes of a word that is folded over arrays, distinct words that a task remembers, no rank, and an id that no piece has.
BITS, LONGEST, GENERATION, NONE, END = 20, 192, 400_000, 1 << 30, (1 << 20) - 1


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def _prime(n: int) -> int:
    while any(n % k == 0 for k in range(2, int(n**0.5) + 1)):
        n += 1
    return n


def rank_table(ranks: dict[bytes, int]) -> tuple[list[int], int, int]:
    """The pairs of ids whose pieces together are a piece, as a cuckoo table: entry (pair << BITS | rank) is at pair mod p, or at p + pair mod q."""
    pairs = [(ranks[w[:i]] << BITS | ranks[w[i:]], rank) for w, rank in ranks.items() for i in range(1, len(w)) if w[:i] in ranks and w[i:] in ranks]
    size = max(11, int(1.3 * len(pairs)))
    while True:
        p = _prime(size)
        q = _prime(p + 2)
        table, key = [-1] * (p + q), [-1] * (p + q)
        for k, rank in pairs:
            entry, at = (k << BITS) | rank, k % p
            for _ in range(200):
                table[at], entry = entry, table[at]
                key[at], k = k, key[at]
                if entry < 0:
                    break
                at = p + k % q if at == k % p else k % p
            else:
                break
        else:
            return table, p, q
        size = int(1.2 * size)


def rank_literal(ranks: dict[bytes, int]) -> tuple[Column, int, int]:
    """The table as a column that the optimizer folds to one literal, and its two moduli."""
    if max(ranks.values()) >= END:
        raise ValueError(f"ids must be under {END}")
    table, p, q = rank_table(ranks)
    return F.from_json(F.lit(json.dumps(table, separators=(",", ":"))), "array<bigint>"), p, q


def _let(value: Column, body) -> Column:
    """body of a value that is computed once.

    A fold over no elements whose last step is the body: the interpreter then never derives the body's type, which an element taken
    of a transformed array makes it do at every evaluation, down to the leaves.
    """
    return F.aggregate(F.array().cast("array<int>"), value, lambda acc, _: acc, body)


def encode_word(pieces: Column, table: Column, p: int, q: int) -> Column:
    """The ids of one word by folding merges over its bytes, laid out as byte_arrays() does: each piece as the rank of the pair
    that it begins, then its id. The state's first element tells whether merges are left."""
    long = lambda v: F.lit(v).cast("bigint")
    mask = long((1 << BITS) - 1)

    def piece(a: Column, b: Column) -> Column:
        """Id a as it stands before id b."""

        def find(k: Column) -> Column:
            one, two = table[(k % p).cast("int")], table[(k % q + p).cast("int")]
            rank = F.when(F.shiftright(one, BITS) == k, one.bitwiseAND(mask)).when(F.shiftright(two, BITS) == k, two.bitwiseAND(mask)).otherwise(long(NONE))
            return F.shiftleft(rank, BITS).bitwiseOR(a)

        return _let(F.shiftleft(a, BITS).bitwiseOR(b), find)

    def merge(s: Column, m: Column, i: Column) -> Column:
        new = F.shiftright(m, BITS)
        some = F.array(piece(s[i - 2].bitwiseAND(mask), new), piece(new, s[i + 1].bitwiseAND(mask)))
        return _let(F.array(F.slice(s, 1, i - 2), some, F.slice(s, i + 2, F.size(s))), F.flatten)

    def step(s: Column, _: Column) -> Column:
        # the least element begins the pair of least rank, and equal elements begin equal pairs, so the first of them is the leftmost
        done = lambda: _let(F.array(F.array(long(-1)), F.slice(s, 2, F.size(s))), F.flatten)
        return F.when(s[0] < 0, s).otherwise(_let(F.array_min(s), lambda m: F.when(m >= long(NONE << BITS), done()).otherwise(_let(F.array_position(s, m).cast("int"), lambda i: merge(s, m, i)))))

    ids = lambda s: F.transform(F.slice(s, 2, F.size(s) - 2), lambda x: x.bitwiseAND(mask).cast("int"))
    return F.when(F.size(pieces) < 2, pieces.cast("array<int>")).otherwise(F.aggregate(F.slice(pieces, 4, F.size(pieces)), pieces, step, ids))


def fold_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ids of one word by the same merges, the least rank (the leftmost of equal ones) first, over a linked list."""
    part: list[bytes | None] = [word[i : i + 1] for i in range(len(word))]
    before, after = list(range(-1, len(word) - 1)), list(range(1, len(word) + 1))
    heap = [(ranks[word[i : i + 2]], i) for i in range(len(word) - 1) if word[i : i + 2] in ranks]
    heapq.heapify(heap)
    while heap:
        rank, i = heapq.heappop(heap)
        j = after[i]
        if part[i] is None or j == len(word) or ranks.get(part[i] + part[j]) != rank:
            continue  # one of the pair has been merged since
        part[i], part[j], after[i] = part[i] + part[j], None, after[j]
        if after[i] < len(word):
            before[after[i]] = i
        for a, b in ((before[i], i), (i, after[i])):
            if a >= 0 and b < len(word) and (new := ranks.get(part[a] + part[b])) is not None:
                heapq.heappush(heap, (new, a))
    return [ranks[x] for x in part if x is not None]


def vocabulary(ranks: dict[bytes, int]) -> pa.Array:
    """The piece of each id, null where an id has none."""
    pieces: list[bytes | None] = [None] * (max(ranks.values()) + 1)
    for w, rank in ranks.items():
        pieces[rank] = w
    return pa.array(pieces, pa.binary())


def byte_pairs(ranks: dict[bytes, int]) -> np.ndarray:
    """The ranks of all pairs of bytes."""
    return np.array([[ranks.get(bytes([a, b]), NONE) for b in range(256)] for a in range(256)], np.int64)


def byte_arrays(words: pa.Array, pieces: pa.Array, byte_id: np.ndarray, pair_rank: np.ndarray) -> pa.ListArray:
    """For each word (binary) its bytes between two ENDs, each the rank of the pair that it begins, then its id; the word's own id
    alone if it is in the vocabulary; nothing if it is too long for the array fold."""
    raw, off = buffers(words)
    sizes, whole = np.diff(off), pc.fill_null(pc.index_in(words, pieces), -1).to_numpy(zero_copy_only=False)
    whole = np.where((sizes > LONGEST) & (whole < 0), -2, whole)
    kept = np.where(whole >= 0, 1, np.where(whole == -1, sizes + 2, 0))
    start = np.concatenate([[0], np.cumsum(kept)])
    out = np.full(start[-1], NONE << BITS | END, np.int64)
    out[start[:-1][whole >= 0]] = whole[whole >= 0]
    at = np.flatnonzero(np.repeat(whole == -1, sizes))
    word = np.repeat(np.arange(len(sizes)), sizes)[at]
    rank = np.full(len(raw), NONE, np.int64)
    rank[:-1] = pair_rank[raw[:-1], raw[1:]]
    rank[off[1:][sizes > 0] - 1] = NONE
    out[start[word] + 1 + at - off[word]] = rank[at] << BITS | byte_id[raw[at]]
    return pa.ListArray.from_arrays(pa.array(start.astype(np.int32)), pa.array(out))


_BYTE = np.random.default_rng(7).integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)


def hashes(words: pa.Array) -> np.ndarray:
    """64-bit hashes of non-empty words."""
    raw, off = buffers(words)
    if not len(raw):
        return np.zeros(len(words), np.uint64)
    sizes = np.diff(off)
    held = _BYTE[raw] * powers(int(sizes.max()) + 1)[np.arange(len(raw)) - np.repeat(off[:-1], sizes)]
    return mix(np.add.reduceat(held, off[:-1]) + sizes.astype(np.uint64))


class Numbers:
    """Numbers of words, by sorted hashes whose hits are compared with the words themselves.

    Words stand in runs, each as long as all that came after it at least, so that adding a batch costs little however many are known.
    """

    def __init__(self):
        self.runs, self.n = [], 0

    def look_up(self, words: pa.Array, h: np.ndarray) -> np.ndarray:
        """The numbers of words, -1 for those not known."""
        out = np.full(len(words), -1, np.int32)
        for base, known, order, by_hash in self.runs:
            k = np.minimum(np.searchsorted(by_hash, h), len(by_hash) - 1)
            hit = np.flatnonzero((by_hash[k] == h) & (out < 0))
            at = order[k[hit]]
            same = pc.equal(words.take(pa.array(hit)), known.take(pa.array(at))).to_numpy(zero_copy_only=False)
            out[hit[same]] = base + at[same]
        return out

    def add(self, words: pa.Array, h: np.ndarray) -> None:
        if not len(words):
            return
        base, parts, own = self.n, [words], [h]
        self.n += len(words)
        while self.runs and len(self.runs[-1][1]) <= sum(map(len, parts)):
            base, known, order, by_hash = self.runs.pop()
            back = np.empty_like(by_hash)
            back[order] = by_hash
            parts.insert(0, known)
            own.insert(0, back)
        h = np.concatenate(own)
        order = np.argsort(h, kind="stable").astype(np.int32)
        self.runs.append((base, pa.concat_arrays(parts), order, h[order]))


def split(text: Column) -> tuple[Column, Column]:
    """The pre-tokens of a text, null if the JVM cannot tell them, and the text if so."""
    odd = (F.length(text) != F.octet_length(text)) & text.rlike(r"\p{Cn}")
    return F.when(~odd, F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0))), F.when(odd, text)


def encode(docs: DataFrame, path: str | None = None, with_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every row; with_ids adds ids (array<int>) and decoded (binary)."""
    ranks = read_ranks(path or default_path())
    bounded(docs.sparkSession)
    byte_id, pair_rank, pieces = np.array([ranks[bytes([b])] for b in range(256)], np.int64), byte_pairs(ranks), vocabulary(ranks)
    table, p, q = rank_literal(ranks)
    fold = _let(table, lambda t: F.transform("fresh", lambda w: encode_word(w, t, p, q))).alias("ids")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")

    def number(batches):
        """Each batch of texts as word numbers of its task, with the words that have not come before in the generation."""
        import regex

        seen, generation, cut, own_ranks = Numbers(), 0, regex.compile(ORIGINAL), {}
        for batch in batches:
            words, text = batch.column("words"), batch.column("text")
            if words.null_count:  # a null text, or one to be split here
                words = pa.array([cut.findall(t or "") if w is None else w for w, t in zip(words.to_pylist(), text.to_pylist(), strict=True)], pa.list_(pa.string()))
            flat = pc.dictionary_encode(words.flatten())
            if seen.n > GENERATION:
                seen, generation = Numbers(), generation + 1
            h = hashes(flat.dictionary)
            at = seen.look_up(flat.dictionary, h)
            new = np.flatnonzero(at < 0)
            at[new] = seen.n + np.arange(len(new))
            fresh = flat.dictionary.take(pa.array(new))
            seen.add(fresh, h[new])
            fresh = fresh.cast(pa.binary())
            arrays = byte_arrays(fresh, pieces, byte_id, pair_rank)
            long = fresh.filter(pc.equal(arrays.value_lengths(), 0)).to_pylist()
            if long and not own_ranks:
                own_ranks = {w: k for k, w in enumerate(pieces.to_pylist()) if w is not None}
            idx = at[flat.indices.to_numpy()] if len(flat) else at
            one = lambda x, t: pa.array([x], pa.list_(t))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([generation], pa.int32()), one(batch.column("doc_id").to_pylist(), pa.int64()), one(words.value_lengths().to_numpy(), pa.int32()), one(idx, pa.int32()),
                    pa.ListArray.from_arrays(pa.array([0, len(fresh)], pa.int32()), arrays), one([fold_long(w, own_ranks) for w in long], pa.list_(pa.int32())),
                ],
                ["generation", "doc_id", "lens", "idx", "fresh", "long"],
            )

    def assemble(batches):
        generation = -1

        def spell(ids: pa.ListArray) -> tuple[pa.Array, pa.Array, pa.ListArray]:
            """Each word's ids in decimal, its bytes, and its ids."""
            off = pa.array(np.concatenate([[0], np.cumsum(ids.value_lengths().to_numpy())]).astype(np.int32))
            flat = ids.flatten()
            again = lambda x: pa.ListArray.from_arrays(off, x)
            return pc.binary_join(again(flat.cast(pa.string())), " "), pc.binary_join(again(pieces.take(flat)), b""), again(flat)

        for batch in batches:
            for k in range(batch.num_rows):
                g, doc_id, lens, idx, new, rest = (batch.column(x)[k] for x in ("generation", "doc_id", "lens", "idx", "ids", "long"))
                new = new.values
                if len(rest.values):
                    todo = iter(rest.as_py())
                    new = pa.array([x or next(todo) for x in new.to_pylist()], pa.list_(pa.int32()))
                if g.as_py() != generation:
                    generation, known = g.as_py(), spell(new)
                elif len(new):
                    known = tuple(pa.concat_arrays([x, y]) for x, y in zip(known, spell(new), strict=True))
                idx, edge = idx.values, np.concatenate([[0], np.cumsum(lens.values.to_numpy())])
                lists = lambda x, e=edge: pa.ListArray.from_arrays(pa.array(e.astype(np.int32)), x)
                spoken = pc.binary_join(lists(known[0].take(idx)), " ").to_pylist()
                joined = pc.binary_join(lists(known[1].take(idx)), b"").to_pylist()
                total = np.concatenate([[0], np.cumsum(known[2].value_lengths().to_numpy()[idx.to_numpy()])])
                cols = [doc_id.values, pa.array(total[edge[1:]] - total[edge[:-1]], pa.int64()), pa.array([hashlib.sha256(x.encode()).hexdigest() for x in spoken]), pa.array([hashlib.sha256(x).hexdigest() for x in joined])]
                names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
                if with_ids:
                    cols += [pa.ListArray.from_arrays(pa.array(total[edge].astype(np.int32)), known[2].take(idx).flatten()), pa.array(joined, pa.binary())]
                    names += ["ids", "decoded"]
                yield pa.RecordBatch.from_arrays(cols, names)

    words, odd = split(F.col("text"))
    numbered = docs.select("doc_id", odd.alias("text"), words.alias("words")).mapInArrow(tidy(number), "generation int, doc_id array<long>, lens array<int>, idx array<int>, fresh array<array<bigint>>, long array<array<int>>")
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids array<int>, decoded binary" if with_ids else "")
    return numbered.select("generation", "doc_id", "lens", "idx", fold, "long").mapInArrow(tidy(assemble), schema)


def query(spark, sf_dir: str) -> DataFrame:
    return encode(spark.read.parquet(f"{sf_dir}/documents.parquet"))

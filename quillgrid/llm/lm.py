"""Language-model scores by a log-bilinear neural model trained with noise-contrastive estimation.

Tokens are words (see _text) and one end for each document. The outputs of the model are the end, each of the at most
WORDS most frequent training words, and an ending (a hash of the last two bytes) for every other word. A context is the
two tokens before, by input vectors of their classes: the end, the HEADS most frequent words, or an ending.

    p(w | a, b) = softmax over outputs of (r_a A + r_b B) . q + bias, at output(w), times (c(w) + 0.5) / (S(ending) + 0.5)

The second factor is 1 for words with an output of their own. S sums c + 0.5 over the ending's other training words, so each
ending keeps 0.5 for a word never seen and all sums to one. Scoring normalises by batched matrix products over the
distinct contexts of a block.

Training has two stages, both over all training tokens. First the class trigrams, at most CLASSES^3 numbers, are gathered
whole, and each step takes the exact expectation over data and noise; every word then starts from its class. Then each
task goes over the tokens of its blocks with noise words drawn for each of its steps, and the tasks' parameters are averaged by their
tokens, ROUNDS times. What this gathers is one set of parameters a task, so it grows with the input.

Texts are cut once into blocks of whole documents, stored as word numbers with the block's distinct words. Only those
words (hash, place, training count) are shuffled to be counted over the corpus, and their counts go back to the
block by an equi-join that Spark may split where a word is in very many blocks. Words are known by 64-bit hashes.

Cases: a null or empty text is its end alone; a null doc_id is no held-out row; repeated rows count and are scored each;
without training rows every count is 0, and the model is uniform over its outputs. Other columns are ignored. A block of 2^24 distinct words
and more (one text of over 100 MB), and a partition of 2^12 blocks and more (48 GB), raise an error.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillgrid.functions.batches import bounded

from ._labels import held_out
from ._store import Tables, tidy
from ._text import Words, mix, pieces

#: Fixed parameters: classes of words, bytes of text in a block, width of the vectors, noise words per word, steps.
HEADS, ENDINGS, BLOCK_BYTES, WIDTH, NOISE, STEPS = 63, 64, 12 << 20, 24, 10, 200
CLASSES = 1 + HEADS + ENDINGS
#: Words with an output of their own and the least count of one, rounds of averaging, pairs of a step, noise words drawn for it, rate.
WORDS, LEAST, ROUNDS, BATCH, DRAWN, RATE = 4095, 10, 2, 4096, 128, 0.015
END = 1


def endings(w: Words, at: np.ndarray) -> np.ndarray:
    """A class from the last two bytes of each of the words at."""
    last = w.data[w.end[at] - 1].astype(np.uint64)
    before = np.where(w.end[at] - w.start[at] > 1, w.data[np.maximum(w.end[at] - 2, 0)], 0).astype(np.uint64)
    return (mix((before | np.uint64(32)) * np.uint64(257) + (last | np.uint64(32))) & np.uint64(ENDINGS - 1)).astype(np.int8)


def _blocks(batches):
    """One row a block. Token 0 of a block is the end of a document."""
    part_id, n, held = TaskContext.get().partitionId() << 12, 0, []

    def row():
        ids, out, lens, idx = [], [], [], []
        hashes = np.concatenate([np.zeros(0, np.uint64), *[h[0] for h in held]])
        kinds = np.concatenate([np.zeros(0, np.int8), *[h[1] for h in held]])
        uniq, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        if len(uniq) >> 24 or n >> 12:
            raise ValueError("a block holds fewer than 2^24 distinct words, a partition fewer than 2^12 blocks")
        tf, at, ends = np.zeros(len(uniq) + 1, np.int64), 0, 0
        for h, _, counts, doc_id, out_fold in held:
            own = inverse[at : at + len(h)] + 1
            at += len(h)
            cut = np.cumsum(counts)
            idx.append(np.insert(own, cut, 0))
            lens.append(counts + 1)
            ids += doc_id
            out.append(out_fold)
            tf += np.bincount(own[np.repeat(~out_fold, counts)], minlength=len(tf))
            ends += int((~out_fold).sum())
        tf[0] = ends
        lists = [ids, np.concatenate(out), np.concatenate(lens).astype(np.int32), np.concatenate(idx).astype(np.int32), np.concatenate([[END], uniq.view(np.int64)]), tf.astype(np.int32), np.concatenate([np.zeros(1, np.int8), kinds[first]])]
        return pa.RecordBatch.from_arrays([pa.array([part_id + n]), *[pa.array([x], pa.list_(t)) for x, t in zip(lists, (pa.int64(), pa.bool_(), pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int8()), strict=True)]], ["block", "doc_id", "held_out", "lens", "idx", "words", "tf", "ending"])

    size = 0
    for batch in batches:
        for part in pieces(batch, "text"):
            w = Words(part.column("text"))
            if held and size + len(w.data) > BLOCK_BYTES:
                yield row()
                n, size, held = n + 1, 0, []
            size += len(w.data)
            held.append((w.hash, endings(w, np.arange(len(w.hash))), w.counts, part.column("doc_id").to_pylist(), part.column("held_out").to_numpy(zero_copy_only=False).astype(bool)))
    if held:
        yield row()


def classes(words: np.ndarray, ending: np.ndarray, heads: np.ndarray) -> np.ndarray:
    """The class of each word; heads: sorted hashes of the most frequent."""
    out = 1 + HEADS + ending.astype(np.int32)
    if len(heads):
        k = np.minimum(np.searchsorted(heads, words), len(heads) - 1)
        out = np.where(heads[k] == words, 1 + k, out)
    return np.where(words == END, 0, out).astype(np.int32)


def contexts(seq: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """CLASSES times the class two tokens before plus the class before; before its first token a document has ends."""
    start = np.concatenate([[0], np.cumsum(lens)])[:-1]
    one, two = np.zeros_like(seq), np.zeros_like(seq)
    one[1:], two[2:] = seq[:-1], seq[:-2]
    one[start] = 0
    two[start] = 0
    two[start[lens > 1] + 1] = 0
    return two * CLASSES + one


def train(trigrams: np.ndarray, seed: int = 5) -> dict[str, np.ndarray]:
    """Parameters from the counts of (context, class), by full-batch noise-contrastive estimation with Adam."""
    rng = np.random.default_rng(seed)
    p = {
        "r": rng.normal(0, 0.1, (CLASSES, WIDTH)), "q": rng.normal(0, 0.1, (CLASSES, WIDTH)),
        "A": np.eye(WIDTH) * 0.5, "B": np.eye(WIDTH), "bias": np.zeros(CLASSES),
    }
    p = {k: v.astype(np.float32) for k, v in p.items()}
    used = np.flatnonzero(trigrams.sum(1))
    if not len(used):
        return p | {k: np.zeros_like(p[k]) for k in ("r", "q")}
    data = (trigrams[used] / trigrams.sum()).astype(np.float32)
    share = data.sum(1, keepdims=True)
    noise = (data.sum(0) + 1e-9) / (1 + CLASSES * 1e-9)
    p["bias"] = np.log(noise).astype(np.float32)
    two, one = used // CLASSES, used % CLASSES
    shift, expected = np.log(NOISE * noise).astype(np.float32), (NOISE * share * noise).astype(np.float32)
    first, second = ({k: np.zeros_like(v) for k, v in p.items()} for _ in range(2))
    for t in range(1, STEPS + 1):
        ra, rb = p["r"][two], p["r"][one]
        guess = ra @ p["A"] + rb @ p["B"]
        real = 1 / (1 + np.exp(np.clip(shift - guess @ p["q"].T - p["bias"], -30, 30)))
        g = expected * real - data * (1 - real)
        back = g @ p["q"]
        r = np.zeros_like(p["r"])
        np.add.at(r, two, back @ p["A"].T)
        np.add.at(r, one, back @ p["B"].T)
        grads = {"q": g.T @ guess, "bias": g.sum(0), "A": ra.T @ back, "B": rb.T @ back, "r": r}
        for k, v in grads.items():
            first[k] += 0.1 * (v - first[k])
            second[k] += 0.01 * (v * v - second[k])
            p[k] -= 0.05 * min(1, 2 - 2 * t / (STEPS + 1)) * (first[k] / (1 - 0.9**t)) / (np.sqrt(second[k] / (1 - 0.99**t)) + 1e-9)
    return p


def log_probabilities(p: dict[str, np.ndarray], ctx: np.ndarray) -> np.ndarray:
    """Normalised log10 probabilities of all outputs in each context."""
    s = (p["r"][ctx // CLASSES] @ p["A"] + p["r"][ctx % CLASSES] @ p["B"]) @ p["q"].T + p["bias"]
    s -= s.max(1, keepdims=True)
    return (s - np.log(np.exp(s).sum(1, keepdims=True))) / np.float32(np.log(10))


@dataclass
class Model:
    heads: np.ndarray  # sorted hashes of the HEADS most frequent words
    words: np.ndarray  # sorted hashes of the words with an output of their own
    mass: np.ndarray  # S of each ending
    total: int  # training tokens
    distinct: int  # different ones
    share: np.ndarray  # of each output in the training tokens
    p: dict[str, np.ndarray]


def outputs(words: np.ndarray, ending: np.ndarray, own: np.ndarray) -> np.ndarray:
    """The output of each word; own: sorted hashes of the words that have one."""
    out = 1 + len(own) + ending.astype(np.int32)
    if len(own):
        k = np.minimum(np.searchsorted(own, words), len(own) - 1)
        out = np.where(own[k] == words, 1 + k, out)
    return np.where(words == END, 0, out).astype(np.int32)


def refine(p: dict[str, np.ndarray], share: np.ndarray, context: np.ndarray, output: np.ndarray, n: np.ndarray, rng: np.random.Generator) -> dict[str, np.ndarray]:
    """Parameters after one pass over pairs of context and output, each n times, against noise drawn by share (AdaGrad, falling rate)."""
    p = {k: v.copy() for k, v in p.items()}
    seen = {k: np.full_like(v, 1e-6) for k, v in p.items()}
    cdf, shift = np.cumsum(share), np.log(DRAWN * share).astype(np.float32)
    real_or_not = lambda x: 1 / (1 + np.exp(-np.clip(x, -30, 30)))
    order = rng.permutation(len(context))
    for at in range(0, len(order), BATCH):
        i = order[at : at + BATCH]
        two, one, y, weight = context[i] // CLASSES, context[i] % CLASSES, output[i], (n[i] / n[i].sum()).astype(np.float32)
        z = np.minimum(np.searchsorted(cdf, rng.random(DRAWN) * cdf[-1]), len(share) - 1)
        ra, rb, qy, qz = p["r"][two], p["r"][one], p["q"][y], p["q"][z]
        guess = ra @ p["A"] + rb @ p["B"]
        dy = (real_or_not((guess * qy).sum(1) + p["bias"][y] - shift[y]) - 1) * weight
        dz = real_or_not(guess @ qz.T + p["bias"][z] - shift[z]) * weight[:, None]
        back = dy[:, None] * qy + dz @ qz
        grads = {k: np.zeros_like(p[k]) for k in ("q", "bias", "r")} | {"A": ra.T @ back, "B": rb.T @ back}
        by = np.argsort(y, kind="stable")
        first = np.flatnonzero(np.append(True, np.diff(y[by]) != 0))
        grads["q"][y[by][first]], grads["bias"][y[by][first]] = np.add.reduceat((dy[:, None] * guess)[by], first), np.add.reduceat(dy[by], first)
        np.add.at(grads["q"], z, dz.T @ guess)
        np.add.at(grads["bias"], z, dz.sum(0))
        for own, mix_ in ((two, "A"), (one, "B")):
            chosen = np.zeros((CLASSES, len(i)), np.float32)
            chosen[own, np.arange(len(i))] = 1
            grads["r"] += chosen @ (back @ p[mix_].T)
        for k, v in grads.items():
            seen[k] += v * v
            p[k] -= (RATE * (1 - at / len(order)) * v / np.sqrt(seen[k])).astype(np.float32)
    return p


def packed(p: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([p[k].ravel() for k in sorted(p)])


def unpacked(flat: np.ndarray, like: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    ends = np.cumsum([like[k].size for k in sorted(like)])
    return {k: x.reshape(like[k].shape).astype(np.float32) for k, x in zip(sorted(like), np.split(flat, ends[:-1]), strict=True)}


def _lists(batch: pa.RecordBatch, row: int, *names: str) -> list[np.ndarray]:
    return [batch.column(x)[row].values.to_numpy(zero_copy_only=False) for x in names]


def fit(docs: DataFrame, modulus: int = 5, remainder: int = 1) -> tuple[Model, DataFrame, DataFrame]:
    """The model, the blocks of docs, and the training count of every word of a block (place, c)."""
    spark = bounded(docs.sparkSession)
    tables = Tables(spark, "lm")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out("doc_id", modulus, remainder).alias("held_out"), "text")
    blocks = tables.keep(rows.mapInArrow(tidy(_blocks), "block long, doc_id array<long>, held_out array<boolean>, lens array<int>, idx array<int>, words array<long>, tf array<int>, ending array<tinyint>"), rows_per_file=4)

    places = blocks.select("block", F.posexplode(F.arrays_zip("words", "tf", "ending")).alias("k", "w")).select(F.col("w.words").alias("h"), F.shiftleft("block", 24).bitwiseOR(F.col("k")).alias("place"), F.col("w.tf").alias("tf"), F.col("w.ending").alias("ending"))
    known = tables.keep(places.where("tf > 0").groupBy("h").agg(F.sum("tf").alias("c"), F.max("ending").alias("ending")))
    counted = tables.keep(places.select("h", "place").join(known.select("h", "c"), "h").select("place", "c"))
    total, distinct, ends = known.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*"), F.coalesce(F.sum(F.when(F.col("h") == END, F.col("c"))), F.lit(0))).first()
    top = known.where(F.col("h") != END).orderBy(F.desc("c"), "h").limit(max(WORDS, HEADS)).collect()
    heads = np.sort(np.array([r.h for r in top[:HEADS]], np.int64))
    top = sorted((r for r in top[:WORDS] if r.c >= LEAST), key=lambda r: r.h)
    own = np.array([r.h for r in top], np.int64)
    tail = known.where(F.col("h") != END)
    if top:
        tail = tail.join(F.broadcast(spark.createDataFrame([(r.h,) for r in top], "h long")), "h", "left_anti")  # at most WORDS rows
    mass = np.full(ENDINGS, 0.5)
    for r in tail.groupBy("ending").agg(F.sum(F.col("c") + F.lit(0.5)).alias("s")).collect():
        mass[r.ending] += r.s

    def trigrams(batches):
        seen = np.zeros(CLASSES**3, np.int64)
        for batch in batches:
            for row in range(batch.num_rows):
                words, ending, idx, lens, out = _lists(batch, row, "words", "ending", "idx", "lens", "held_out")
                seq = classes(words, ending, heads)[idx]
                use = np.repeat(~out.astype(bool), lens)
                seen += np.bincount(contexts(seq, lens)[use] * CLASSES + seq[use], minlength=CLASSES**3)
        code = np.flatnonzero(seen)
        for a in range(0, len(code), 1 << 16):
            yield pa.RecordBatch.from_arrays([pa.array(code[a : a + (1 << 16)], pa.int32()), pa.array(seen[code[a : a + (1 << 16)]])], ["code", "n"])

    texts = blocks.select("block", "words", "ending", "idx", "lens", "held_out")
    got = texts.mapInArrow(tidy(trigrams), "code int, n long").groupBy("code").agg(F.sum("n").alias("n")).toArrow()
    whole = np.zeros(CLASSES**3)
    whole[got.column("code").to_numpy()] = got.column("n").to_numpy()
    del got
    p = train(whole.reshape(CLASSES**2, CLASSES))

    # every output starts from its class, so the model begins as that of classes
    count = np.concatenate([[ends], [r.c for r in top], mass]) + 0.5
    share = count / count.sum()
    of = np.concatenate([[0], classes(own, np.array([r.ending for r in top], np.int8), heads), 1 + HEADS + np.arange(ENDINGS)]).astype(np.int64)
    held = np.bincount(of, weights=share, minlength=CLASSES)
    p = p | {"q": p["q"][of], "bias": (p["bias"][of] + np.log(share / held[of])).astype(np.float32)}

    for k in range(ROUNDS if total else 0):

        def one_pass(batches, p=p, k=k):
            now, tokens = p, 0
            for batch in batches:
                for row in range(batch.num_rows):
                    words, ending, idx, lens, out = _lists(batch, row, "words", "ending", "idx", "lens", "held_out")
                    use = np.repeat(~out.astype(bool), lens)
                    pair = contexts(classes(words, ending, heads)[idx], lens)[use] * len(share) + outputs(words, ending, own)[idx][use]
                    if len(pair):
                        code, n = np.unique(pair, return_counts=True)
                        now = refine(now, share, code // len(share), code % len(share), n, np.random.default_rng([k, batch.column("block")[row].as_py()]))
                        tokens += len(pair)
            if tokens:
                yield pa.RecordBatch.from_arrays([pa.array([float(tokens)]), pa.array([packed(now)], pa.list_(pa.float32()))], ["tokens", "p"])

        each = texts.mapInArrow(tidy(one_pass), "tokens double, p array<float>").select("tokens", F.posexplode("p").alias("at", "x"))
        mean = each.groupBy("at").agg((F.sum(F.col("x") * F.col("tokens")) / F.sum("tokens")).alias("x")).toArrow().sort_by("at")
        p = unpacked(mean.column("x").to_numpy(), p)
    return Model(heads, own, mass, total, distinct, share, p), blocks, counted


def score(model: Model, blocks: DataFrame, counted: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row."""
    p, own, mass, total, distinct = model.p, model.words, model.mass, model.total, model.distinct

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        words, ending, idx, lens, out = (left.column(x)[0].values.to_numpy(zero_copy_only=False) for x in ("words", "ending", "idx", "lens", "held_out"))
        count = np.zeros(len(words), np.int64)
        count[right.column("place").to_numpy() & ((1 << 24) - 1)] = right.column("c").to_numpy()
        base = np.log10((count + 0.5) / (total + 0.5 * (distinct + 1)))
        to = outputs(words, ending, own)
        share = np.where(to > len(own), np.log10((count + 0.5) / mass[np.maximum(to - 1 - len(own), 0)]), 0.0).astype(np.float32)
        at = contexts(classes(words, ending, model.heads)[idx], lens)
        used = np.flatnonzero(np.bincount(at, minlength=CLASSES**2))
        at = np.searchsorted(used, at).astype(np.int16)  # CLASSES^2 is 2^14
        order, token, seq = np.argsort(at, kind="stable").astype(np.int32), np.empty(len(idx), np.float32), to[idx]
        edges = np.searchsorted(at[order], np.arange(0, len(used) + 512, 512))
        for k, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
            rows = order[a:b]
            token[rows] = log_probabilities(p, used[512 * k : 512 * (k + 1)])[at[rows] - 512 * k, seq[rows]]
        token += share[idx]
        edge = np.concatenate([[0], np.cumsum(lens)])[:-1]
        each = lambda x: np.add.reduceat(x, edge)  # noqa: E731  every document has its end
        n = len(lens)
        return pa.table([left.column("doc_id")[0].values, pa.array(out.astype(bool)), pa.array(lens.astype(np.int64)), pa.array(each((count[idx] > 0).astype(np.int64))), pa.array(np.full(n, total)), pa.array(each(base[idx])), pa.array(np.add.reduceat(token, edge, dtype=np.float64))], names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    back = counted.select(F.shiftright("place", 24).alias("block"), "place", "c")
    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return blocks.drop("tf").groupBy("block").cogroup(back.groupBy("block")).applyInArrow(run, schema)


def scores(docs: DataFrame, modulus: int = 5, remainder: int = 1) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row, learnt from the rest."""
    return score(*fit(docs, modulus, remainder))


def query(spark, sf_dir: str) -> DataFrame:
    return scores(spark.read.parquet(f"{sf_dir}/documents.parquet"))

import collections
import math
import zlib

import numpy as np
import pyarrow as pa
import pytest

from quillgrid.llm import lm
from quillgrid.llm._text import Words

from .helpers import ODD, documents, words


def held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 5 == 1


@pytest.mark.parametrize("size", [200, 12 << 20])
def test_counts_against_brute_force(spark, sf, monkeypatch, size):
    monkeypatch.setattr(lm, "BLOCK_BYTES", size)
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").limit(80).collect()] + [(90_000 + (i or 0), t) for i, t in ODD] + [(None, "the words")]
    got = collections.Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in lm.scores(documents(spark, rows)).collect())
    docs = [(i, [*words(t), None]) for i, t in rows]
    c = collections.Counter(w for i, ws in docs if not held(i) for w in ws)
    n, v = sum(c.values()), len(c)
    base = lambda ws: sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws)
    assert got == collections.Counter((i, held(i), len(ws), sum(c[w] > 0 for w in ws), n, round(base(ws), 6)) for i, ws in docs)


def test_model_probabilities_sum_to_one_and_beat_the_base(spark, sf):
    rng = np.random.default_rng(0)
    counts = rng.integers(0, 50, (lm.CLASSES**2, lm.CLASSES)) * (rng.random((lm.CLASSES**2, 1)) < 0.02)
    p = lm.train(counts.astype(float))
    assert np.allclose((10.0 ** lm.log_probabilities(p, np.arange(0, lm.CLASSES**2, 37))).sum(1), 1, atol=1e-4)
    r = lm.scores(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).where("held_out").selectExpr("sum(score) s", "sum(base_score) b").first()
    assert r.s > r.b


@pytest.mark.parametrize("words_of_their_own", [3, 4095])
def test_scores_against_brute_force(spark, monkeypatch, words_of_their_own):
    monkeypatch.setattr(lm, "WORDS", words_of_their_own)
    rows = [(i, " ".join(["ab", "cd", "ef", "gh", "ab", f"w{i * k % 90}"][(i * k) % 6] for k in range(i % 19))) for i in range(160)] + [(161, None), (162, "never seen")]
    model, blocks, counted = lm.fit(documents(spark, rows))
    got = {r.doc_id: r.score for r in lm.score(model, blocks, counted).collect()}
    c = collections.Counter(w for i, t in rows if not held(i) for w in [*words(t), None])
    hashes = lambda ws: Words(pa.array([" ".join(ws)])).hash.view(np.int64)
    kinds = lambda ws: lm.endings(Words(pa.array([" ".join(ws)])), np.arange(len(ws)))
    top = sorted((w for w in c if w is not None), key=lambda w: (-c[w], int(hashes([w])[0])))
    own = [w for w in top[:words_of_their_own] if c[w] >= lm.LEAST]
    assert sorted(int(hashes([w])[0]) for w in own) == model.words.tolist() and model.heads.tolist() == sorted(int(hashes([w])[0]) for w in top[: lm.HEADS])
    mass = np.full(lm.ENDINGS, 0.5)
    for w in c:
        if w is not None and w not in own:
            mass[kinds([w])[0]] += c[w] + 0.5
    assert np.allclose(mass, model.mass)
    order = sorted(int(hashes([w])[0]) for w in own)
    cls = lambda w: 0 if w is None else 1 + model.heads.tolist().index(int(hashes([w])[0])) if w in top[: lm.HEADS] else 1 + lm.HEADS + int(kinds([w])[0])
    out = lambda w: 0 if w is None else 1 + order.index(int(hashes([w])[0])) if w in own else 1 + len(own) + int(kinds([w])[0])
    q = {k: v.astype(float) for k, v in model.p.items()}

    def log10(a, b, w):
        x = q["q"] @ (q["r"][cls(a)] @ q["A"] + q["r"][cls(b)] @ q["B"]) + q["bias"]
        share = 1.0 if w is None or w in own else (c[w] + 0.5) / mass[kinds([w])[0]]
        return (x[out(w)] - np.log(np.exp(x).sum())) / np.log(10) + np.log10(share)

    for i, t in rows:
        ws = [None, None, *words(t), None]
        assert abs(got[i] - sum(log10(ws[k - 2], ws[k - 1], ws[k]) for k in range(2, len(ws)))) < 1e-3, i


def test_classes_and_contexts():
    w = Words(pa.array(["cat hat", "at"]))
    e = lm.endings(w, np.arange(3))
    assert e[0] == e[1] == e[2]
    assert lm.contexts(np.array([5, 6, 0, 7, 0, 0]), np.array([3, 2, 1])).tolist() == [0, 5, 5 * lm.CLASSES + 6, 0, 7, 0]


def test_tables_without_training_rows(spark):
    assert lm.scores(documents(spark, [])).count() == 0
    only = [i for i in range(100) if held(i)][:3]
    out = lm.scores(documents(spark, [(i, "a b") for i in only])).collect()
    assert [(r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in out] == [(3, 0, 0, 0.0)] * 3 and all(r.score < 0 for r in out)

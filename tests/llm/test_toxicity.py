import random

import numpy as np
import pyarrow as pa

from quillgrid.llm import toxicity
from quillgrid.llm._labels import held_out
from quillgrid.llm._text import Words

from .helpers import ODD, documents


def maximal(scores):
    """All maximal scoring segments by their definition: best, then best of what is left on either side."""
    def best(a, b):
        top = None
        for i in range(a, b):
            s = 0
            for j in range(i, b):
                s += scores[j]
                if s > 1e-12 and (top is None or s > top[2] + 1e-12 or abs(s - top[2]) <= 1e-12 and j + 1 - i < top[1] - top[0]):
                    top = (i, j + 1, s)
        return [] if top is None else best(a, top[0]) + [top] + best(top[1], b)

    return best(0, len(scores))


def test_segments_are_all_maximal_ones():
    rng = random.Random(3)
    for _ in range(200):
        scores = np.array([rng.choice([-1.37, -0.41, 0.73, 2.19, -0.4]) + rng.random() / 100 for _ in range(rng.randrange(0, 14))])
        got, expected = toxicity.segments(scores), maximal(scores.tolist())
        assert [x[:2] for x in got] == [x[:2] for x in expected]
        assert np.allclose([x[2] for x in got], [x[2] for x in expected])


def test_rate_solves_its_equation():
    s, p = np.array([4.0, 2.0, -1.0]), np.array([0.001, 0.01, 0.2])
    x = toxicity.solve_rate(s, p)
    assert abs((p * np.exp(x * s)).sum() + (1 - p.sum()) * np.exp(-toxicity.COST * x) - 1) < 1e-6


def planted(n=400):
    rng = random.Random(5)
    common, bad = [f"word{k}" for k in range(300)], ["vilefoo", "vilebar", "nastybaz"]
    rows, labels = [], []
    for i in range(n):
        ws = [rng.choice(common) for _ in range(rng.randrange(20, 200))]
        if i % 5 == 0:
            at = rng.randrange(len(ws))
            ws[at:at] = [rng.choice(bad) for _ in range(3)]
        rows.append((i, " ".join(ws)))
        labels.append((i, 1, int(i % 5 == 0)))
    return rows, labels


def test_planted_words_are_found_in_held_out_rows(spark):
    rows, labels = planted()
    docs = documents(spark, rows + [(9000 + k, t) for k, (_, t) in enumerate(ODD)] + [(None, "vilefoo vilefoo vilefoo nastybaz")])
    model = toxicity.fit(docs, spark.createDataFrame(labels + [(None, 1, 1), (3, None, None), (0, 1, 1)], "doc_id long, quality int, toxic int"))
    out = toxicity.score(docs, model).withColumn("held", held_out("doc_id", 5, 0)).collect()
    assert len(out) == len(rows) + len(ODD) + 1
    truth = {i: t for i, _, t in labels}
    assert all((r.score >= 0.5) == bool(truth.get(r.doc_id, r.doc_id is None and r.n_tokens == 4)) for r in out if r.doc_id is None or r.doc_id < 9000 or r.n_tokens < 3)
    assert all(0 <= r.score <= 1 for r in out) and any(r.held for r in out)
    text = dict(rows)
    for r in out:
        for p in r.passages:
            if r.doc_id in text:
                assert any(w in text[r.doc_id][p.first : p.past] for w in ("vilefoo", "vilebar", "nastybaz"))
    kept = toxicity.keep_clean(docs, model)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.select("doc_id").where("doc_id < 9000").collect()) == [i for i, _, t in labels if not t]


def test_scores_against_brute_force(spark):
    import math

    rows, labels = planted(200)
    docs = documents(spark, rows)
    model = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    known = dict(zip(model.words.tolist(), model.scores.tolist(), strict=True))
    got = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    rate, k = model.law
    for i, t in rows[:40]:
        w = Words(pa.array([t]))
        begun = {n: w.prefixes(n).tolist() for n in toxicity.BEGINNINGS}
        own = [next((known[h] for h in (full, *(begun[n][j] for n in reversed(toxicity.BEGINNINGS))) if h in known), -toxicity.COST) for j, full in enumerate(w.hash.tolist())]
        e = [k * len(own) * math.exp(-rate * s) for _, _, s in maximal(own)]
        best = -math.log(-math.expm1(-min(e))) if e else 0.0
        sure = sum(-math.log(x) for x in e if x < toxicity.SIGNIFICANT)
        z = float(np.dot([math.log1p(best), math.log1p(sure), min(best, 20) / 10, 1], model.curve))
        assert abs(got[i] - 1 / (1 + math.exp(-z))) < 1e-6, i


def test_nothing_to_learn(spark):
    docs = documents(spark, ODD)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = toxicity.fit(docs, none)
    assert {r.score for r in toxicity.score(docs, model).collect()} == {0.0}
    assert toxicity.keep_clean(docs, model).count() == len(ODD)
    empty = documents(spark, [])
    assert toxicity.score(empty, toxicity.fit(empty, none)).count() == 0


def test_the_scan_is_linear():
    import time

    import numpy as np

    def seconds(n):
        scores = np.where(np.arange(n) % 2 == 0, 1.0, -1.5) + np.linspace(0, 0.4, n)
        began = time.process_time()
        toxicity.segments(scores)
        return time.process_time() - began

    assert seconds(80_000) < 2.0
    falling = np.tile([1.0, -1.01], 40_000)
    began = time.process_time()
    assert len(toxicity.segments(falling)) == 40_000 and time.process_time() - began < 2.0

import numpy as np

from quillgrid.llm import quality
from quillgrid.llm._labels import held_out

from .helpers import ODD, documents


def test_linear_time_identity():
    rng = np.random.default_rng(1)
    m = quality.Machine(0.3, rng.normal(size=7), rng.normal(size=(7, 3)), None, None)
    x = rng.normal(size=(5, 7))
    pairs = [m.bias + r @ m.linear + sum(m.factors[i] @ m.factors[j] * r[i] * r[j] for i in range(7) for j in range(i)) for r in x]
    assert np.allclose(quality.forward(x, m)[0], pairs)


def test_scores_against_brute_force(spark):
    import collections
    import math
    import random

    import pyarrow as pa

    from quillgrid.llm._text import Words

    rng = random.Random(4)
    rows = [(i, " ".join(rng.choice(["good", "fine", "junk", "spam"][2 * (i % 2) :] + [f"w{k}" for k in range(30)]) for _ in range(rng.randrange(1, 60)))) for i in range(80)]
    docs = documents(spark, rows + [(500 + k, t) for k, (_, t) in enumerate(ODD)])
    m = quality.fit(docs, spark.createDataFrame([(i, 1 - i % 2, 0) for i, _ in rows], "doc_id long, quality int, toxic int"))
    got = {r.doc_id: r.score for r in quality.score(docs, m).collect()}
    for i, t in rows[:12] + [(501, "")]:
        w = Words(pa.array([t]))
        counts = collections.Counter(int(h >> 52) % quality.BUCKETS for h in w.hash.tolist())
        x = {c: math.log1p(n) for c, n in counts.items()}
        norm = math.sqrt(sum(v * v for v in x.values()))
        stats = ((quality.structure(w, np.array([float(len(t))]))[0] - m.mean) / m.scale).clip(-5, 5)
        x = {c: v / norm for c, v in x.items()} | {quality.BUCKETS + k: v for k, v in enumerate(stats.tolist())}
        z = m.bias + sum(float(m.linear[c]) * v for c, v in x.items())
        own = list(x.items())
        z += sum(float(m.factors[a].astype(float) @ m.factors[b].astype(float)) * u * v for k, (a, u) in enumerate(own) for b, v in own[:k])
        assert abs(got[i] - 1 / (1 + math.exp(-z))) < 1e-5


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    out = quality.score(docs, quality.fit(docs, labels)).join(labels, "doc_id").where(held_out("doc_id", 4, 2)).select("score", "quality").collect()
    right = sum((r.score >= 0.7) == (r.quality == 1) for r in out)
    assert len(out) > 500 and right / len(out) > 0.97


def test_odd_rows(spark):
    docs = documents(spark, ODD)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    out = quality.score(docs, quality.fit(docs, none)).collect()
    assert len(out) == len(ODD) and {round(r.score, 6) for r in out} == {0.5}
    some = spark.createDataFrame([(i, i % 2, 0) for i in range(1, 9)] + [(None, 1, 0), (2, None, 0)], "doc_id long, quality int, toxic int")
    out = quality.score(docs, quality.fit(docs, some)).collect()
    assert len(out) == len(ODD) and all(0 <= r.score <= 1 for r in out)
    assert quality.score(documents(spark, []), quality.fit(docs, some)).count() == 0

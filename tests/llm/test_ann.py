import numpy as np
from pyspark.sql import functions as F

from quillgrid.llm import ann


def table(spark, rows, kind="float"):
    return spark.createDataFrame([(i, v, 7, 1.0) for i, v in rows], f"vec_id long, embedding array<{kind}>, rank int, score double")


def brute(rows, k):
    x = {i: np.array(v, np.float32).astype(float) for i, v in rows}
    out = {}
    for q in x:
        if q % 20 == 0:
            near = sorted((-(v * x[q]).sum(), i) for i, v in x.items() if i != q)[:k]
            out[q] = [i for _, i in near]
    return out


def found(out):
    got = {}
    for r in sorted(out.collect(), key=lambda r: (r.query_id, r.rank)):
        got.setdefault(r.query_id, []).append(r.vec_id)
    return got


def test_recall_and_exact_scores(spark, monkeypatch):
    monkeypatch.setattr(ann, "CHUNK", 64)
    monkeypatch.setattr(ann, "QUERIES", 16)
    rng = np.random.default_rng(4)
    x = rng.normal(size=(1500, 16)) + 2 * rng.normal(size=(12, 16))[rng.integers(0, 12, 1500)]
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    df = table(spark, rows)
    out = ann.search(df, df.where("vec_id % 20 = 0"))
    got, expected = found(out), brute(rows, 20)
    assert got.keys() == expected.keys() and all(len(v) == 20 for v in got.values())
    assert sum(len(set(got[q]) & set(expected[q])) for q in got) >= 0.9 * 20 * len(got)
    y = x.astype(np.float32).astype(float)
    assert all(abs(r.score - float(y[r.query_id] @ y[r.vec_id])) < 1e-12 for r in out.collect())


def test_ties_repeats_and_rows_that_take_no_part(spark):
    bad = [(101, None), (102, [0.0] * 4), (103, [1.0, None, 0.0, 0.0]), (104, [float("nan")] * 4), (105, [float("inf"), 0.0, 0.0, 0.0]), (106, [1.0]), (None, [1.0] * 4), (120, [0.0] * 4)]
    rows = [(i, [1.0, 2.0, 3.0, 4.0]) for i in range(0, 90)] + [(i, [4.0, 3.0, 2.0, float(i)]) for i in range(200, 260)]
    df = table(spark, rows + bad + rows[:5])
    got, expected = found(ann.search(df, df.where("vec_id % 20 = 0"))), brute(rows, 20)
    assert got == expected


def test_fewer_candidates_than_asked_for(spark):
    rows = [(0, [1.0, 0.0]), (3, [0.5, 0.5]), (4, [-1.0, 0.0])]
    df = table(spark, rows, "double")
    assert found(ann.search(df, df.where("vec_id % 20 = 0"))) == {0: [3, 4]}
    assert ann.search(df.limit(0), df).count() == 0
    assert ann.search(df, df.where(F.lit(False))).count() == 0
    alone = table(spark, [(0, [1.0, 0.0])])
    assert ann.search(alone, alone).count() == 0


def test_recall_on_other_rows(spark, tmp_path):
    rng = np.random.default_rng(5)
    c = rng.normal(size=(40, 64))
    tight = c[rng.integers(0, 40, 3000)] + 0.02 * rng.normal(size=(3000, 64))
    apart = rng.normal(size=(3000, 64))
    apart[::20] = 0.1 * rng.normal(size=(150, 64)) + c[0]
    large = 1e30 * rng.normal(size=(3000, 64))
    one = rng.normal(size=(3000, 64))
    one[7] *= 1e20
    for name, x in {"tight": tight, "apart": apart, "large": large, "one": one}.items():
        rows = [(i, v.tolist()) for i, v in enumerate(x)]
        table(spark, rows).write.parquet(str(tmp_path / name))
        df = spark.read.parquet(str(tmp_path / name))
        y = x.astype(np.float32).astype(float)
        s = y[::20] @ y.T
        s[np.arange(150), np.arange(0, 3000, 20)] = -np.inf
        expected = dict(zip(range(0, 3000, 20), np.argsort(-s, axis=1)[:, :20].tolist(), strict=True))
        got = found(ann.search(df, df.where("vec_id % 20 = 0")))
        assert got.keys() == expected.keys() and all(len(v) == 20 for v in got.values())
        assert sum(len(set(got[q]) & set(expected[q])) for q in got) >= 0.95 * 20 * len(got), name

import collections
import random

import numpy as np
import pytest

from quillgrid.llm import neardup
from quillgrid.llm._store import Tables

from .helpers import ODD, documents, words


def shingles(text):
    w = words(text)
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def brute(rows):
    sets = collections.defaultdict(list)
    for i, t in rows:
        if i is not None:
            sets[i].append(shingles(t))
    flat = [(i, s) for i, own in sets.items() for s in own if s]
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, (i, s) in enumerate(flat):
        for j, u in flat[:k]:
            if 100 * len(s & u) >= 75 * len(s | u):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return collections.Counter((i, len(shingles(t)), None if i is None else find(i)) for i, t in rows)


def near_copies(n=120, seed=1):
    rng = random.Random(seed)
    word = lambda: "w" + str(rng.randrange(3000))
    passage = [word() for _ in range(40)]
    rows, bases = [], [[word() for _ in range(rng.randrange(20, 160))] for _ in range(6)]
    for i in range(n):
        kind = rng.random()
        ws = list(rng.choice(bases)) if kind < 0.6 else [word() for _ in range(60)] + passage if kind < 0.8 else [word() for _ in range(rng.randrange(1, 30))]
        for _ in range(rng.randrange(0, 6)):
            ws[rng.randrange(len(ws))] = word()
        rows.append((i * 3 % 401, " ".join(ws)))
    return rows


@pytest.mark.parametrize("block", [4096, 4])
def test_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(neardup, "BLOCK", block)  # small blocks take the refined and dealt-out path
    rows = near_copies() + [(5000 + k, t) for k, (_, t) in enumerate(ODD)] + [(None, "no id"), (None, "no id"), (5003, "one")]
    got = neardup.groups(documents(spark, rows)).collect()
    assert collections.Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute(rows)
    assert all(r.kept == (r.doc_id is None or r.doc_id == r.component_id) for r in got)


def test_texts_of_one_id_are_one_document(spark):
    a, b = " ".join(f"a{k}" for k in range(60)), " ".join(f"b{k}" for k in range(60))
    rows = [(1, a), (1, b), (2, a + " x"), (3, b + " y"), (4, ""), (4, "lone words here"), (5, "Lone words here"), (6, None), (1, a)]
    got = neardup.groups(documents(spark, rows)).collect()
    assert collections.Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute([r for r in rows])
    assert {r.doc_id: r.component_id for r in got} == {1: 1, 2: 1, 3: 1, 4: 4, 5: 4, 6: 6}


def test_small_sets_are_rejected_only_if_surely_apart():
    rng = np.random.default_rng(5)
    for n, m, both in ((100, 100, 86), (100, 100, 85), (1000, 1000, 860), (2000, 2000, 1600), (60, 60, 30)):
        x = rng.integers(0, 2**64, n + m - both, dtype=np.uint64)
        own = [np.sort(x[:n]), np.sort(x[n - both :])]
        bits = [np.frombuffer(b.tobytes(), np.uint64) for b in neardup.odd_sketch(np.concatenate(own), np.array([0, n, n + m]))]
        kept = bool(neardup.possible(np.int64(n), bits[0], np.int64(m), bits[1]))
        assert kept or 100 * both < 75 * (n + m - both)
        if both * 4 <= 2 * (n + m - both):
            assert not kept


def test_a_block_tells_a_forest():
    rng = np.random.default_rng(6)
    own = np.sort(rng.integers(0, 2**64, 80, dtype=np.uint64))
    sketch = np.frombuffer(neardup.odd_sketch(own, np.array([0, 80])).tobytes(), np.uint64)
    k = 50
    told = lambda whole: list(neardup.block_pairs(np.arange(k), np.arange(k), np.full(k, 80), np.full(k, 2), np.tile(sketch, (k, 1)), whole))
    assert len(told(False)) == k - 1 and len(told(True)) == k * (k - 1) // 2


def test_keep_first_keeps_columns_and_unlinked_rows(spark):
    docs = documents(spark, [(3, "a b c d e f"), (1, "A b c d e f"), (2, "other words"), (4, None), (None, "a b c d e f")])
    out = neardup.keep_first(docs)
    assert out.columns == docs.columns and sorted(str(r.doc_id) for r in out.collect()) == ["1", "2", "4", "None"]


def test_empty_table(spark):
    assert neardup.groups(documents(spark, [])).count() == 0


def test_components_of_a_long_path(spark):
    links = spark.createDataFrame([(k, k + 1) for k in range(0, 60)] + [(100, 101), (7, 7)], "a long, b long")
    got = {r.doc: r.comp for r in neardup.components(links, Tables(spark, "t")).collect()}
    assert got == {**{k: 0 for k in range(61)}, 100: 100, 101: 100}


def test_sketches_estimate_similarity():
    rng = np.random.default_rng(2)
    for n, share in ((300, 0.9), (5000, 0.75), (40, 0.8)):
        fresh = lambda k: rng.integers(0, 2**64, int(k), dtype=np.uint64)
        both = fresh(n * share)
        sets = [np.unique(np.concatenate([both, fresh(n * (1 - share) / 2)])) for _ in range(2)]
        true = len(np.intersect1d(*sets)) / len(np.union1d(*sets))
        bits = neardup.odd_sketch(np.concatenate(sets), np.cumsum([0, *map(len, sets)]))
        x = [np.frombuffer(b.tobytes(), np.uint64) for b in bits]
        assert abs(float(neardup.similarity(x[0], x[1])) - true) < 0.09

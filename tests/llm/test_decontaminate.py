import collections
import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from quillgrid.llm import decontaminate

from .helpers import LOW, ODD, documents

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(t):
    return WORD.findall((t or "").translate(LOW))


def brute(docs, items):
    windows = collections.defaultdict(set)
    for i, t in items:
        w = words(t)
        for s in range(max(1, len(w) - 9) if w else 0):
            windows[tuple(w[s : s + 10])].add(i)
    out = collections.Counter()
    for d, t in docs:
        w, hit, ids = words(t), set(), set()
        for n in {len(x) for x in windows}:
            for s in range(len(w) - n + 1):
                if (own := tuple(w[s : s + n])) in windows:
                    hit.update(range(s, s + n))
                    ids |= windows[own]
        out[d, len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(map(str, ids))).encode()).hexdigest(), bool(hit)] += 1
    return out


@pytest.mark.parametrize("few", [200_000, 0])
def test_against_brute_force(spark, monkeypatch, few):
    monkeypatch.setattr(decontaminate, "BROADCAST_TERMS", few)
    rng = random.Random(7)
    word = lambda: rng.choice(["the", "of", "Éa", "x1", *[f"t{k}" for k in range(40)]])
    items = [(k, " ".join(word() for _ in range(rng.randrange(1, 40)))) for k in range(30)] + [(100, None), (101, ""), (102, "..."), (3, "again the same id of t1"), (None, "null item id here now"), (5, "the the the the the the the the the the the the")]
    docs = []
    for d in range(80):
        ws = [word() for _ in range(rng.randrange(0, 80))]
        if d % 3 == 0:
            own = words(rng.choice(items)[1])
            a = rng.randrange(len(own) + 1)
            ws[5:5] = own[a : a + rng.randrange(1, 30)]
        docs.append((d, ", ".join(ws).upper() if d % 2 else "-".join(ws)))
    docs += [(1000 + k, t) for k, (_, t) in enumerate(ODD)] + [docs[0], docs[3], (3, "another text the of"), (None, docs[6][1]), (2000, "the " * 50)]
    table = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.report(documents(spark, docs), table).collect()
    named = [(i, t) for i, t in items if i is not None]  # an item without an id is matched, and not listed
    every, listed = brute(docs, items), brute(docs, named)
    assert collections.Counter(tuple(r)[:3] for r in got) == collections.Counter(k[:3] for k in every.elements())
    assert collections.Counter((r.doc_id, r.n_words, r.items_sha256) for r in got) == collections.Counter((k[0], k[1], k[4]) for k in listed.elements())
    assert collections.Counter((r.doc_id, r.contaminated) for r in got) == collections.Counter((k[0], k[5]) for k in every.elements())
    kept = decontaminate.drop_contaminated(documents(spark, docs), table)
    clean = collections.Counter()
    for k, n in brute(docs, items).items():
        clean[k[0]] += n * (not k[5])
    assert collections.Counter(r.doc_id for r in kept.collect()) == +clean and kept.columns == documents(spark, docs).columns


def test_proximity(spark):
    rng = random.Random(3)
    docs = [(d, " ".join(rng.choice("abcdefghij") for _ in range(60))) for d in range(20)]
    df = documents(spark, docs)
    terms = spark.createDataFrame([(x,) for x in "abcdefghij"], "w string").selectExpr("xxhash64(w) AS term")
    index = decontaminate.build_index(df, terms, 10)
    queries = [(1, ["a", "b", "c"]), (2, ["d", "e"]), (3, ["a", "zz"])]
    got = decontaminate.proximity(index, spark.createDataFrame(queries, "query int, words array<string>"), 4).collect()
    n = collections.Counter(w for _, t in docs for w in t.split())
    expected = set()
    for q, ws in queries:
        if not all(n[w] for w in ws):
            continue
        for d, t in docs:
            own = t.split()
            for p, w in enumerate(own):
                if n[w] == min(n[x] for x in ws) and w in ws and all(any(own[k] == x for k in range(max(0, p - 4), min(len(own), p + 5))) for x in ws):
                    expected.add((q, d, p))
    assert {(r.query, r.row.doc_id, r.pos) for r in got} == expected


def test_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    out = decontaminate.report(documents(spark, ODD), none).collect()
    assert len(out) == len(ODD) and not any(r.contaminated for r in out)
    assert decontaminate.report(documents(spark, []), none).count() == 0


def test_columns_whose_names_clash_are_kept(spark):
    from pyspark.sql import functions as F

    names = ["_row", "row", "own", "found", "term", "pos", "phrase", "item_id"]
    docs = documents(spark, [(1, "nothing here"), (2, "a b c d e f g h i j k"), (None, "x")], extra=False).select("*", *[F.lit(f"v {n}").alias(n) for n in names])
    items = spark.createDataFrame([("i", "b c d e f g h i j k l"), ("k", "b c d e f g h i j k")], "item_id string, text string")
    out = decontaminate.drop_contaminated(docs, items)
    assert out.columns == docs.columns
    got = out.collect()
    assert sorted(str(r.doc_id) for r in got) == ["1", "None"] and all(r[n] == f"v {n}" for r in got for n in names)


def test_repetitive_texts_and_items(spark):
    docs = documents(spark, [(1, "la " * 3000), (2, "la " * 9), (3, "la di " * 500)])
    items = spark.createDataFrame([("many", "la " * 300), ("again", "la " * 40), ("one", "la"), ("two", "di la")], "item_id string, text string")
    got = {r.doc_id: (r.n_words, r.n_hit, r.n_items) for r in decontaminate.report(docs, items).collect()}
    assert got == {1: (3000, 3000, 3), 2: (9, 9, 1), 3: (1000, 999, 2)}


def shuffled(spark):
    """Bytes that the session has shuffled."""
    sc = spark.sparkContext._jsc.sc()
    sc.listenerBus().waitUntilEmpty()
    held = sc.statusStore().executorList(False)
    return sum(held.apply(k).totalShuffleWrite() for k in range(held.size()))


def test_texts_without_candidates_are_not_shuffled(spark):
    rng = random.Random(5)
    docs = [(d, "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=20_000))) for d in range(200)] + [(200, "x a b c d e f g h i j"), (None, "a b c d e f g h i j")]
    items = spark.createDataFrame([("i", "a b c d e f g h i j k")], "item_id string, text string")
    table = documents(spark, docs).repartition(4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as if the rows that are met were too many to broadcast
    try:
        table.write.mode("overwrite").parquet(at := decontaminate.Tables(spark, "test").root + "/docs")
        stored, before = spark.read.parquet(at), shuffled(spark)
        got = {r.doc_id: r.n_hit for r in decontaminate.report(stored, items).collect() if r.contaminated}
        middle = shuffled(spark)
        kept = decontaminate.drop_contaminated(stored, items).select("doc_id", F.length("text")).collect()
        after = shuffled(spark)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert got == {200: 10, None: 10} and sorted(map(tuple, kept)) == [(d, 20_000) for d in range(200)]
    assert middle - before < 500_000 and after - middle < 500_000


def test_rows_are_sifted_at_any_size_of_the_bitmap(spark, monkeypatch):
    docs = decontaminate.row_key(documents(spark, [(d, f"t {d}") for d in range(2000)] + [(None, None), (3, "other")]))
    some = docs.where("row.doc_id % 37 = 0 OR row.doc_id IS NULL").select("row")
    for most in (1 << 26, 1 << 6):
        monkeypatch.setattr(decontaminate, "MOST_BITS", most)
        maybe, clean = decontaminate.sift(docs, some)
        assert maybe.count() + clean.count() == 2002 and clean.join(some, "row").count() == 0 and maybe.join(some, "row").count() == some.count()
    maybe, clean = decontaminate.sift(docs, some.limit(0))
    assert maybe.count() == 0 and clean.count() == 2002

import random

import corpus_pipeline
from quillgrid.llm import bytebpe
from quillgrid.llm._store import Tables


def test_planted_cases(spark, tmp_path):
    rng = random.Random(12)
    word = lambda: f"w{rng.randrange(4000)}"
    line = lambda: " ".join(word() for _ in range(12))
    docs = {i: "\n".join(line() for _ in range(rng.randrange(3, 9))) for i in range(300)}
    labels = [(i, 1, int(i % 6 == 0)) for i in range(300)]
    for i in range(0, 300, 6):
        docs[i] += " vileword vileword otherbad vileword"
    docs[301] = docs[7]  # exact copy
    near = docs[11].split(" ")
    near[3] = "changed"
    docs[302] = " ".join(near)
    passage = [line() for _ in range(7)]
    docs[303], docs[304] = "\n".join([line(), line(), *passage]), "\n".join([line(), *passage, line(), line()])
    item = line() + " " + line()
    docs[305] = line() + "\n" + line() + " " + item
    docs[306], docs[307] = None, ""
    rows = [(i, t, "en", "s", len(t or "")) for i, t in docs.items()]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    own, tables = spark.read.parquet(f"{tmp_path}/documents.parquet"), Tables(spark, "test")
    columns = own.columns
    for _, stage in corpus_pipeline.STAGES[:-1]:
        own = tables.keep(stage(spark, own, str(tmp_path)))
        assert own.columns == columns
    kept = {r.doc_id: r.text for r in own.collect()}
    assert set(range(300)) - set(kept) == set(range(0, 300, 6))
    assert 301 not in kept and 302 not in kept and 305 not in kept and {303, 304, 306, 307} <= set(kept)
    assert sum(all(x in kept[i].split("\n") for x in passage) for i in (303, 304)) == 1
    out = {r.doc_id: r.ids for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert out.keys() == kept.keys()
    piece = {v: k for k, v in bytebpe.read_ranks(bytebpe.default_path()).items()}
    assert all(b"".join(piece[i] for i in out[d]).decode() == (t or "") for d, t in kept.items())


def test_against_brute_force(spark, tmp_path):
    """Each stage's rows against a plain version of it on the rows before; no near copy here has equal lines at equal places."""
    import hashlib

    import pytest

    from quillgrid.llm import toxicity

    from . import test_decontaminate, test_linededup, test_neardup

    tiktoken = pytest.importorskip("tiktoken")
    rng = random.Random(21)
    word = lambda: f"w{rng.randrange(900)}"
    rows = []
    for i in range(160):
        lines = [" ".join(word() for _ in range(rng.randrange(6, 15))) for _ in range(rng.randrange(2, 8))]
        if i % 5 == 0:
            lines[0] += " vileword otherbad vileword vileword"
        if i % 7 == 3:
            own = rows[rng.randrange(len(rows))][1].split("\n")
            lines = [word() + " alone here", *own[: rng.randrange(2, 4)], *lines]  # a passage at other places
        if i % 11 == 6:
            ws = rows[rng.randrange(len(rows))][1].split()
            ws[rng.randrange(len(ws))] = word()
            lines = [" ".join(ws)]  # a near copy in one line
        rows.append((i, "\n".join(lines)))
    labels = [(i, 1, int("vileword" in t)) for i, t in rows]
    items = [(k, " ".join(rows[k * 9][1].split()[2:14])) for k in range(1, 8)]
    spark.createDataFrame([(i, t, "en", "s", len(t), "x") for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long, _row string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    model = toxicity.fit(docs, spark.read.parquet(f"{tmp_path}/labels.parquet"))
    score = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}  # held against brute force in test_toxicity
    own = [(i, t) for i, t in rows if score[i] < 0.5]
    assert {i for i, t in rows if "vileword" in t} <= {i for i, _ in rows} - {i for i, _ in own}
    text = test_linededup.brute(own)
    own = [(i, text[i]) for i, t in own if text[i]]
    kept = {k[0] for k in test_neardup.brute(own) if k[0] == k[2]}
    own = [(i, t) for i, t in own if i in kept]
    clean = {k[0] for k in test_decontaminate.brute(own, items) if not k[5]}
    own = [(i, t) for i, t in own if i in clean]
    known = tiktoken.Encoding("own", pat_str=bytebpe.ORIGINAL, mergeable_ranks=bytebpe.read_ranks(bytebpe.default_path()), special_tokens={})
    expected = {i: hashlib.sha256(" ".join(map(str, known.encode_ordinary(t))).encode()).hexdigest() for i, t in own}
    assert len(expected) < len(rows) and {r.doc_id: r.ids_sha256 for r in corpus_pipeline.run(spark, str(tmp_path)).collect()} == expected


def test_odd_rows_and_empty_tables(spark, tmp_path):
    from .helpers import ODD

    schema = "doc_id long, text string, lang string, source string, n_chars long, row string, _row string, gone string, n_lines string, comp string"
    odd = [(i, t, None, None, None, "a", "b", "c", "d", "e") for i, t in ODD]
    for name, rows in (("odd", odd), ("none", [])):
        at = f"{tmp_path}/{name}"
        spark.createDataFrame(rows, schema).write.parquet(f"{at}/documents.parquet")
        spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
        spark.createDataFrame([], "item_id long, text string").write.parquet(f"{at}/benchmark.parquet")
        out = corpus_pipeline.run(spark, at).collect()
        # without labels, items or shared lines only copies could go, and rows of one id are no copies of each other
        assert sorted(str(r.doc_id) for r in out) == sorted(str(r[0]) for r in rows)

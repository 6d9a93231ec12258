import random

import pyarrow as pa

from quillgrid.llm import linededup

from .helpers import ODD, documents


def corpus(seed=2):
    rng = random.Random(seed)
    line = lambda: " ".join(f"w{rng.randrange(5000)}" for _ in range(rng.randrange(3, 14)))
    passages = [[line() for _ in range(k)] for k in (6, 8, 12)]
    rows, holds = [], {}
    for i in range(60):
        lines = [line() for _ in range(rng.randrange(1, 25))]
        if i % 2:
            p = i % 3
            at = rng.randrange(len(lines) + 1)
            lines[at:at] = passages[p]
            holds.setdefault(p, []).append(i)
        rows.append((i, "\n".join(lines)))
    return rows, passages, holds


def test_repeated_passages_stay_once(spark):
    rows, passages, holds = corpus()
    docs = documents(spark, rows)
    out = {r.doc_id: r for r in linededup.remove(docs).collect()}
    text = dict(rows)
    for p, ids in holds.items():
        whole = "\n".join(passages[p])
        assert whole in out[min(ids)].text
        for i in ids[1:]:
            left = [x for x in passages[p] if x in out[i].text.split("\n")]
            assert len(left) <= 2
            assert [x for x in text[i].split("\n") if x not in passages[p]] == [x for x in out[i].text.split("\n") if x and x not in passages[p]]
    assert all(out[i].text == t and out[i].n_removed == 0 for i, t in rows if not i % 2)
    assert all(r.n_removed == r.n_lines - (len(r.text.split("\n")) if r.text or r.n_removed < r.n_lines else 0) for r in out.values())
    assert all(r.n_chars == len(r.text) for r in out.values())


def test_copies_lose_all_lines_and_go(spark):
    text = "\n".join(f"line number {k} of it" for k in range(9))
    rows = [(5, text), (3, text), (9, text + "\nmore"), (8, "only line"), (2, "only line"), (4, "single\nother")]
    docs = documents(spark, rows + [(6, None), (7, ""), (None, text)])
    out = linededup.drop_repeats(docs)
    assert out.columns == docs.columns
    got = {r.doc_id: r.text for r in out.collect()}
    assert got[None] == text  # null ids come first
    assert 3 not in got and 5 not in got and got[9] in ("more", "line number 8 of it\nmore")
    assert got[8] == got[2] == "only line" and got[4] == "single\nother" and got[6] is None and got[7] == ""


def test_equal_rows_are_one_document(spark):
    text = "\n".join(f"l{k} x" for k in range(7))
    got = linededup.remove(documents(spark, [(1, text), (1, text)])).collect()
    assert [r.n_removed for r in got] == [0, 0]


def test_odd_rows(spark):
    got = linededup.remove(documents(spark, ODD)).collect()
    assert len(got) == len(ODD) and all(r.n_removed == 0 for r in got)
    assert linededup.remove(documents(spark, [])).count() == 0


def test_lines_and_chunks():
    texts = ["a\nb\n", "", None, "\n", "c", "a\nb\n"]
    x = linededup.Lines(pa.array(texts))
    raw = x.data.tobytes()
    got = [[raw[a:b].decode() for a, b in zip(x.start[p:q], x.past[p:q])] for p, q in zip(x.off, [*x.off[1:], len(x.start)])]
    assert got[:6] == [["a", "b", ""], [], [], ["", ""], ["c"], ["a", "b", ""]]
    assert x.hash[:3].tolist() == x.hash[-3:].tolist()
    rng = random.Random(1)
    long = [str(rng.random()) for _ in range(200)]
    cuts = []
    for shift in (0, 5):
        y = linededup.Lines(pa.array(["\n".join(["other"] * shift + long)]))
        cuts.append([set((first[1:-1] - shift).tolist()) for first, past in linededup.chunks(y.hash, y.doc) if (past - first)[1:].min() >= 2])
    assert len(cuts[0]) == linededup.SEEDS
    for a, b in zip(*cuts):
        assert {c for c in a if c > 2} == {c for c in b if c > 2}


def test_short_passages_are_always_met(spark):
    rng = random.Random(5)
    line = lambda: " ".join(f"w{rng.randrange(5000)}" for _ in range(8))
    rows, planted = [], {}
    for k in range(120):
        passage = [line() for _ in range(2 + k % 3)] if k % 4 else [" ".join(line() for _ in range(8))]
        for i in (2 * k, 2 * k + 1):
            rows.append((i, "\n".join([*(line() for _ in range(rng.randrange(1, 6))), *passage, *(line() for _ in range(rng.randrange(1, 6)))])))
        planted[2 * k + 1] = passage
    out = {r.doc_id: r for r in linededup.remove(documents(spark, rows)).collect()}
    assert all(out[i].text == t and out[i].n_removed == 0 for i, t in rows if i not in planted)
    for i, passage in planted.items():
        assert out[i].text.split("\n") == [x for x in dict(rows)[i].split("\n") if x not in passage]


def test_a_run_of_equal_or_empty_lines(spark):
    rows = [(1, "a\na\na"), (2, "b\nb\nb\nb"), (3, "x\n\n\ny"), (4, "z\n\n\n\n\nv"), (5, "c d\nc e\nc d\nc e\nc d")]
    got = {r.doc_id: r.text for r in linededup.remove(documents(spark, rows)).collect()}
    assert got == {1: "a\na\na", 2: "b\nb", 3: "x\n\n\ny", 4: "z\n\n\n\n\nv", 5: "c d\nc e"}


def test_only_near_copies_are_left(spark):
    rng = random.Random(8)
    line = lambda: " ".join(f"w{rng.randrange(5000)}" for _ in range(12))
    passage, base, other = ([line() for _ in range(7)] for _ in range(3))
    texts = {
        1: [*(line() for _ in range(3)), *passage],
        2: [*(line() for _ in range(3)), *passage],  # equal lines at equal places of an equally long document, similarity about 0.54
        3: base,
        4: [*base[:6], base[6] + " more"],  # a near copy
        5: [*other, *passage],
        6: [*other[:6], line(), *passage],  # a near copy of 5, but not of what 5 keeps
        None: [*(line() for _ in range(6)), "end of null"],
    }
    texts[7] = [*texts[None][:6], line()]  # null ids take no part in near-duplicate detection
    rows = [(i, "\n".join(t)) for i, t in texts.items()]
    got = {r.doc_id: r.text.split("\n") for r in linededup.remove(documents(spark, rows), leave_revisions=True).collect()}
    assert got[1] == texts[1] and got[2] == texts[2][:3]
    assert got[3] == base and got[4] == texts[4]
    assert got[5] == other and got[6] == [texts[6][6]]
    assert got[None] == texts[None] and got[7] == texts[7][6:]


def test_columns_whose_names_clash(spark):
    from pyspark.sql import functions as F

    text = "one line here\nand another line\nand a third"
    docs = documents(spark, [(1, text), (2, "own\n" + text)], extra=False)
    names = ["gone", "_spans", "spans", "_row", "row", "own", "_tried", "tried", "n_lines", "n_removed", "key", "first"]
    docs = docs.select("*", *[F.lit(f"v {n}").alias(n) for n in names])
    out = linededup.drop_repeats(docs, leave_revisions=True)
    assert out.columns == docs.columns
    got = {r.doc_id: r for r in out.collect()}
    assert got[2].text == "own" and got[1].text == text
    assert all(r[n] == f"v {n}" for r in got.values() for n in names)
    full = linededup.remove(docs)
    assert full.columns == [c for c in docs.columns if c not in ("n_lines", "n_removed")] + ["n_lines", "n_removed"]
    assert {r.doc_id: r.n_removed for r in full.collect()} == {1: 0, 2: 3}


def brute(rows):
    """Text by row: pairs of neighbouring lines and long lines stay where they come first, and go elsewhere. For texts without empty lines."""
    first, gone = {}, {}
    for i, t in sorted(rows, key=lambda r: r[0]):
        lines, out = t.split("\n"), set()
        for n in (1, 2):
            for k in range(len(lines) - n + 1):
                own = tuple(lines[k : k + n])
                if n == 1 and len(own[0].encode()) < linededup.LONG:
                    continue
                home = first.setdefault(own, (i, k))
                if home[0] != i or k >= home[1] + n:
                    out.update(range(k, k + n))
        gone[i] = "\n".join(x for k, x in enumerate(lines) if k not in out)
    return gone


def test_against_brute_force(spark):
    rng = random.Random(9)
    line = lambda: rng.choice([f"common {rng.randrange(12)}", f"rare {rng.randrange(400)}", f"rare {rng.randrange(400)}", "long " * 50 + str(rng.randrange(8)), f"é{rng.randrange(300)}"])
    rows = []
    for i in range(150):
        lines = [line() for _ in range(rng.randrange(1, 14))]
        if i % 4 == 0 and rows:
            own = rng.choice(rows)[1].split("\n")
            a = rng.randrange(len(own))
            lines[1:1] = own[a : a + rng.randrange(1, 9)]
        rows.append((i, "\n".join(lines)))
    got = {r.doc_id: r.text for r in linededup.remove(documents(spark, rows)).collect()}
    assert got == brute(rows)

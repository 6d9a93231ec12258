import random

from quillgrid.llm import preference


def brute(chosen, rejected):
    key = lambda t: tuple((x is not None, x) for x in t)
    a, b = sorted(chosen, key=key), sorted(rejected, key=key)
    n = 0
    while n < min(len(a), len(b)) and a[n][1:] == b[n][1:]:
        n += 1
    say = lambda ts: "".join(f"<|{r or ''}|>\n{t or ''}\n" for _, r, t in ts)

    def spans(ts):
        out, at = [], 0
        for _, r, t in ts:
            start = at + len(f"<|{r or ''}|>\n")
            at = start + len(t or "") + 1
            if r == "assistant":
                out.append((start, start + len(t or "")))
        return out

    return n, say(a[:n]), say(a[n:]), say(b[n:]), spans(a[n:]), spans(b[n:])


def test_against_brute_force(spark):
    rng = random.Random(6)
    turns = {}
    for c in range(40):
        shared = rng.random() < 0.6 and c % 2
        base = list(turns.get(c - 1, []))[: rng.randrange(0, 4)] if shared else []
        turns[c] = base + [(k, rng.choice(["user", "assistant", "system", None]), rng.choice(["hi", "é\n", None, "", "long text"])) for k in range(len(base), rng.randrange(len(base), 7))]
    turns[41] = []
    rows = [(c, t, r, x, "pair", 1) for c, ts in turns.items() for t, r, x in ts] + [(None, 0, "user", "lost", "q", 2), (3, None, "user", "first", "q", 2)]
    turns[3] = turns[3] + [(None, "user", "first")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, prompt string, n int")
    pairs = [(k, 2 * k, 2 * k + 1) for k in range(22)] + [(99, 4, 4)]
    out = preference.format_pairs(df, spark.createDataFrame(pairs, "pair_id long, chosen_id long, rejected_id long")).collect()
    assert len(out) == len(pairs)
    expected = {p: brute(turns.get(a, []), turns.get(b, [])) for p, a, b in pairs}
    for r in out:
        assert (r.n_prompt_turns, r.prompt, r.chosen, r.rejected, [tuple(s) for s in r.chosen_spans], [tuple(s) for s in r.rejected_spans]) == expected[r.pair_id]
        assert r.chosen == r.rejected == "" if r.pair_id == 99 else True


def test_empty_table(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert preference.format_pairs(none, spark.createDataFrame([(1, 2, 3)], "pair_id long, chosen_id long, rejected_id long")).first().prompt == ""

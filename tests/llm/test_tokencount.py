import random

import pytest

from quillgrid.llm import tokencount

from .helpers import ODD, documents

tokenizers = pytest.importorskip("tokenizers")


def test_equal_to_the_library(spark, sf, monkeypatch):
    monkeypatch.setattr(tokencount, "REMEMBERED", 300)
    rng = random.Random(9)
    odd = ["Don't STOP it'll", "ÀÉÎõü ß ÿ Ÿ ǅ Ȿ", "İstanbul ı", "<|startoftext|> a <|endoftext|>b", "é Å", "ΣΊΣΥΦΟΣ", "日本 😀", "a b\x85c\x1cd", "x1y22z333", "---'s 're", "".join(chr(rng.randrange(1, 0x250)) for _ in range(3000)), "z" * 5000]
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").limit(60).collect()] + [(70_000 + k, t) for k, t in enumerate(odd)] + [(80_000 + k, t) for k, (_, t) in enumerate(ODD)] + [(None, "null id")]
    known = tokenizers.Tokenizer.from_file(tokencount.default_path())
    out = {r.doc_id: r for r in tokencount.counts(documents(spark, rows)).collect()}
    for i, t in rows:
        n = len(known.encode(t or "", add_special_tokens=False).ids)
        assert (out[i].n_bytes, out[i].n_tokens, out[i].over_limit) == (len((t or "").encode()), n, n > 2048), (i, t)
    assert len(out) == len(rows) and tokencount.counts(documents(spark, [])).count() == 0


def test_proved_strings_are_one_token():
    known = tokenizers.Tokenizer.from_file(tokencount.default_path())
    whole = tokencount.proved_whole(tokencount.default_path())
    assert len(whole) > 20_000 and len(set(whole)) == len(whole)
    for w in random.Random(1).sample([w for w in whole if w.isascii() and w.isalpha()], 500):
        assert len(known.encode(w, add_special_tokens=False).ids) == 1

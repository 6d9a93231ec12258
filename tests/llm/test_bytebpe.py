import hashlib
import random

import pytest

from quillgrid.llm import bytebpe

from .helpers import ODD, documents

tiktoken = pytest.importorskip("tiktoken")


def sha(b):
    return hashlib.sha256(b).hexdigest()


def test_equal_to_the_library(spark, sf, monkeypatch):
    monkeypatch.setattr(bytebpe, "GENERATION", 500)
    rng = random.Random(8)
    odd = ["don't  stop\n\n  it'll ", "a b c　 d", "x" * 700, "日本語のテキスト 😀😀 ok", "١٢٣ ½ ²", " \t \r\n \x1c\x1f\x85", "<|endoftext|> hi", "é" * 300, "".join(chr(rng.randrange(1, 0x2FFF)) for _ in range(2000)), "\U0001faf6 Ᲊ \U00010d4e", "===== ----- ......", "1234567890" * 40]
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").limit(60).collect()] + [(70_000 + k, t) for k, t in enumerate(odd)] + [(80_000 + k, t) for k, (_, t) in enumerate(ODD)] + [(None, "null id")]
    known = tiktoken.Encoding("own", pat_str=bytebpe.ORIGINAL, mergeable_ranks=bytebpe.read_ranks(bytebpe.default_path()), special_tokens={})
    out = {r.doc_id: r for r in bytebpe.encode(documents(spark, rows), with_ids=True).collect()}
    assert len(out) == len(rows)
    for i, t in rows:
        ids, raw = known.encode_ordinary(t or ""), (t or "").encode()
        r = out[i]
        assert (r.ids, r.n_tokens, bytes(r.decoded)) == (ids, len(ids), raw), i
        assert (r.ids_sha256, r.decoded_sha256) == (sha(" ".join(map(str, ids)).encode()), sha(raw))


def test_another_vocabulary_and_an_empty_table(spark, tmp_path):
    import base64

    pieces = [bytes([b]) for b in range(256)] + [b"ab", b"bc", b"abc", b"abcd", b"aa", b"aaa"]
    path = tmp_path / "tiny.tiktoken"
    path.write_bytes(b"\n".join(base64.b64encode(p) + b" %d" % k for k, p in enumerate(pieces)))
    known = tiktoken.Encoding("tiny", pat_str=bytebpe.ORIGINAL, mergeable_ranks=bytebpe.read_ranks(str(path)), special_tokens={})
    rows = [(1, "abcd abc bcab aaaaaaa"), (2, "")]
    got = {r.doc_id: r.ids for r in bytebpe.encode(documents(spark, rows), str(path), with_ids=True).collect()}
    assert got == {i: known.encode_ordinary(t) for i, t in rows}
    assert bytebpe.encode(documents(spark, [])).count() == 0

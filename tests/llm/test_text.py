import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quillgrid.llm import _text

from .helpers import words


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="aAbB é\x85 \t\n \x0b", max_size=60)), max_size=8))
def test_words_are_those_of_the_pattern(texts):
    w = _text.Words(pa.array(texts, pa.string()))
    expected = [words(t) for t in texts]
    assert w.counts.tolist() == [len(x) for x in expected]
    raw = w.data.tobytes()
    found = [raw[a:b].decode().translate(str.maketrans("AB", "ab")) for a, b in zip(w.start, w.end)]
    flat = [x for ws in expected for x in ws]
    assert found == flat
    ids = dict(zip(flat, w.hash.tolist()))
    assert [ids[x] for x in flat] == w.hash.tolist() and len(set(ids.values())) == len(ids)


def test_windows_and_slices_change_nothing(monkeypatch):
    texts = ["alpha beta " * 50, None, "", "gamma" * 100, "x y z"] * 20
    whole = _text.Words(pa.array(texts))
    monkeypatch.setattr(_text, "WINDOW", 64)
    small = _text.Words(pa.array(texts))
    assert whole.hash.tolist() == small.hash.tolist() and whole.off.tolist() == small.off.tolist()
    part = _text.Words(pa.array(texts).slice(3, 7))
    assert part.hash.tolist() == whole.hash[whole.off[3] : whole.off[10]].tolist()


@pytest.mark.parametrize("k", [1, 2, 5])
def test_shingles(k):
    texts = ["a b c d e f g", "a b c d e", "a b", "", None, "f g a b c d e f g"]
    s, off = _text.Words(pa.array(texts)).shingles(k)
    got, ids = [s[a:b].tolist() for a, b in zip(off[:-1], off[1:])], {}
    for own, t in zip(got, texts):
        w = words(t)
        expected = [tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))] if w else []
        assert len(own) == len(expected)
        for x, y in zip(expected, own):
            assert ids.setdefault(x, y) == y
    assert len(set(ids.values())) == len(ids)

import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from hexloom.llm import textvec as tv

texts = st.lists(st.one_of(st.none(), st.text(alphabet=" \t\n\x0b\x0c\r\x85\xa0abABé日#", max_size=60)), max_size=12)
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


@settings(max_examples=60, deadline=None)
@given(texts, st.integers(1, 4), st.booleans())
def test_words_and_shingles(values, k, lower):
    data, offsets = tv.flat(pa.array(values, pa.string()))
    w = tv.Words(data, offsets, lower)
    plain = [WORD.findall((v or "").translate(LOWER) if lower else (v or "")) for v in values]
    assert np.diff(w.per_doc).tolist() == [len(p) for p in plain]
    flat = [x for p in plain for x in p]
    assert [w.data[a:b].tobytes().decode() for a, b in zip(w.start, w.end)] == flat
    assert len(set(zip(flat, w.hash.tolist()))) == len(set(flat)) == len(set(w.hash.tolist()))
    doc, h, _ = tv.distinct(*w.shingles(k))
    sets = [{tuple(p[i : i + k]) for i in range(len(p) - k + 1)} if len(p) >= k else ({tuple(p)} if p else set()) for p in plain]
    assert np.bincount(doc, minlength=len(values)).tolist() == [len(s) for s in sets]
    assert len(set(h.tolist())) == len(set().union(*sets))


def test_pieces_of_long_texts(monkeypatch):
    text = " ".join(f"w{i}" for i in range(5000)) + "x" * 9000 + " end"
    data, offsets = tv.flat(pa.array([text, "", "b"]))
    whole = tv.Words(data, offsets)
    monkeypatch.setattr(tv, "BLOCK", 512)
    cut = tv.Words(data, offsets)
    assert (whole.hash == cut.hash).all() and (whole.start == cut.start).all()

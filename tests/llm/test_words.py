import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st

from varloom.llm import words as W

TEXTS = st.lists(st.one_of(st.none(), st.text("aB9 \n\t.é<ß'", max_size=60)), max_size=8)


@pytest.mark.parametrize("inside,pattern,lower", [(W.SPACED, rb"[^\x20\x09-\x0D]+", False), (W.ALNUM, rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", True)])
@pytest.mark.parametrize("piece", [3, 1 << 19])
@settings(max_examples=60, deadline=None)
@given(texts=TEXTS)
def test_words_are_the_patterns_matches(inside, pattern, lower, piece, texts):
    before, W.PIECE = W.PIECE, piece
    try:
        w = W.words(pa.array(texts, pa.string()), inside, lower)
    finally:
        W.PIECE = before
    small = lambda x: re.sub(rb"[A-Z]", lambda m: m[0].lower(), x) if lower else x
    want = [re.findall(pattern, small((t or "").encode())) for t in texts]
    data = w.data.tobytes()
    assert [small(data[a:b]) for a, b in zip(w.start, w.end)] == sum(want, [])
    assert w.counts().tolist() == [len(x) for x in want]
    by = {}
    assert all(by.setdefault(x, h) == h for x, h in zip(sum(want, []), w.hash.tolist())) and len(set(by.values())) == len(by)


@pytest.mark.parametrize("size", [1, 2, 3, 10, 35])
def test_windows(size):
    rng = np.random.default_rng(0)
    texts = [" ".join(f"w{x}" for x in rng.integers(0, 2, n)) for n in (0, 1, 9, 10, 36, 50, 120)]
    w = W.words(pa.array(texts), W.SPACED, False)
    first = W.whole_windows(w, size)
    parts = [t.split() for t in texts]
    want = [tuple(p[i:i + size]) for p in parts for i in range(len(p) - size + 1)]
    by = {}
    got = W.window_hashes(w.hash, size)[first].tolist()
    assert len(got) == len(want) and all(by.setdefault(x, h) == h for x, h in zip(want, got)) and len(set(by.values())) == len(by)
    mark = W.covered(len(w.hash), first, size)
    assert mark.sum() == sum(len(p) for p in parts if len(p) >= size)

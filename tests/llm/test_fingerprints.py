"""Winnowing and the meeting of neighbours against brute force."""

import hashlib
import random

import pytest
from hypothesis import given, settings, strategies as st

from varloom.llm import fingerprints as P


def brute(text):
    """Kept (position, hash) pairs by the definition, window after window, with the operator's hash of a single gram."""
    if not text:
        return []
    if len(text) < GRAM:
        return [(0, int.from_bytes(hashlib.blake2b(text.encode(), digest_size=5).digest(), "big"))]
    h = [int(P._hashes(P._points(text[i:i + GRAM]), GRAM)[0]) for i in range(len(text) - GRAM + 1)]
    kept = set()
    for i in range(max(1, len(h) - WINDOW + 1)):
        w = h[i:i + WINDOW]
        kept.add(i + max(j for j, x in enumerate(w) if x == min(w)))
    return [(i, h[i]) for i in sorted(kept)]


GRAM, WINDOW = 4, 6


@pytest.mark.parametrize("piece", [12, 1 << 19])
@settings(max_examples=80, deadline=None)
@given(texts=st.lists(st.text("abÜ漢😀", max_size=60), max_size=6))
def test_winnowing_is_the_rightmost_minimum_of_each_window(piece, texts):
    before, P.PIECE = P.PIECE, piece
    try:
        got = P.winnow(texts, GRAM, WINDOW)
    finally:
        P.PIECE = before
    assert [list(zip(a.tolist(), h.tolist())) for a, h in got] == [brute(t) for t in texts]
    assert [P.decode(P.encode(*m)) for m in got] == [brute(t) for t in texts]


def test_a_shared_passage_of_gram_and_window_keeps_a_hash_at_its_place():
    rng = random.Random(3)
    for _ in range(200):
        passage = "".join(rng.choice("abcdefgh") for _ in range(GRAM + WINDOW - 1))
        a, b = ("".join(rng.choice("xyzab") for _ in range(rng.randrange(40))) for _ in range(2))
        (pa, ha), (pb, hb) = P.winnow([a + passage + b, b + passage], GRAM, WINDOW)
        inside = lambda p, h, s: {(i - s, x) for i, x in zip(p.tolist(), h.tolist()) if s <= i <= s + len(passage) - GRAM}
        assert inside(pa, ha, len(a)) & inside(pb, hb, len(b))


def test_far_steps_survive_the_encoding():
    import numpy as np

    m = (np.array([3, 258, 600, 601, 2000]), np.array([1, 2, 3, (1 << 40) - 1, 0], np.uint64))
    assert P.decode(P.encode(*m)) == list(zip(m[0].tolist(), m[1].tolist()))


@pytest.mark.parametrize("size", [1, 3, 2000])
def test_edited(monkeypatch, docs, rows, nothing, size):
    monkeypatch.setattr(P, "RANGE", size)
    got = P.edited(docs, GRAM, WINDOW).collect()
    assert len(got) == len(rows)
    ids = [r[0] for r in rows]
    once = {r[0]: r[1] or "" for r in rows if r[0] is not None}  # the one repeated id has one text
    order = [r for r in sorted(once, reverse=True)]

    def like(a, b):
        a, b = {h for _, h in brute(a)}, {h for _, h in brute(b)}
        return len(a & b) / len(a | b) if a or b else 1.0

    for r in got:
        if r.doc_id is None or ids.count(r.doc_id) > 1 or len(once[r.doc_id]) > 2000:
            continue
        text, at = once[r.doc_id], order.index(r.doc_id)
        assert r.n_chars == len(text) and P.decode(r.fingerprint) == brute(text)
        if at + 1 < len(order):  # after the last id stand the rows without one
            after = once[order[at + 1]]
            new = text[:len(text) - len(text) // 2] + after[:len(text) // 2]
            assert r.edited_sha256 == hashlib.sha256(new.encode()).hexdigest()
            if len(after) < 2000:
                assert P.decode(r.edited_fingerprint) == brute(new)
                assert abs(r.near_edited - like(text, new)) < 1e-12 and abs(r.near_next - like(text, after)) < 1e-12
    lone = [r for r in got if r.doc_id is None]
    first = once[order[0]]
    texts = [t or "" for i, t, *_ in rows if i is None]
    # rows without an id stand last in the order read; the last of them meets the first id
    want = {hashlib.sha256((t[:len(t) - len(t) // 2] + n[:len(t) // 2]).encode()).hexdigest() for t in texts for n in [*texts, first]}
    assert len(lone) == 2 and {r.edited_sha256 for r in lone} <= want
    assert P.edited(nothing).count() == 0


def test_a_third_of_the_rows_of_one_id_and_the_plain_table(spark, monkeypatch):
    from pyspark.sql import functions as F

    monkeypatch.setattr(P, "RANGE", 10)
    d = spark.range(300).select(F.when(F.col("id") % 3 == 0, F.lit(50)).otherwise(1000 + F.col("id")).alias("doc_id"), F.lit("one text for all of them").alias("text"))
    ranges = P.in_ranges(d).filter("extra = 0").groupBy("rng").count().toPandas()
    assert ranges["count"].sum() == 300 and ranges["count"].max() <= 60
    got = P.edited(d)
    assert got.count() == 300 and got.select("fingerprint").distinct().count() == 1 and got.filter("near_next < 1").count() == 0
    assert P.fingerprints(d).select("fingerprint").distinct().count() == 1

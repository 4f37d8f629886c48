"""Fingerprints against exact Jaccard likeness and a plain rebuild, and on odd rows."""

from __future__ import annotations

import base64
import hashlib
import random
import re

import numpy as np
import pytest

from ledgerwright.llm import fingerprints as P

KIND = "doc_id long, text string, place string, part int"


def _prose(rng, n, vocabulary=900):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def _set(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    words = ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w) for w in words]
    padded = [None] * 4 + words + [None] * 4
    return {tuple(padded[k:k + 5]) for k in range(len(words) + 4)} if words else set()


def _jaccard(a, b):
    a, b = _set(a), _set(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def _texts():
    rng = random.Random(3)
    texts = [_prose(rng, rng.randrange(1, 900)) for _ in range(60)]
    texts += [texts[5], texts[5].upper(), "", None, " \t\n", "one", "one two", "é€😀 " * 300, "ab " * 2000, texts[7] + " more"]
    return texts


def _table(spark, rows):
    return spark.createDataFrame([(i, t, "mine", 1) for i, t in rows], KIND)


def _want(rows):
    rows = [(i, t or "") for i, t in rows]
    out = {}
    for k, (i, t) in enumerate(rows):
        nxt = rows[(k + 1) % len(rows)][1]
        quarter = len(t) // 4
        out[i] = (len(t), t[:len(t) - quarter] + nxt[:quarter], nxt, t)
    return out


@pytest.mark.parametrize("parts", [1, 4, 50])
def test_edited_texts_and_likeness(spark, parts):
    rows = list(enumerate(_texts()))
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        got = {r.doc_id: r for r in P.edited_likeness(_table(spark, rows).repartition(5)).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    want = _want(rows)
    assert set(got) == set(want)
    errors = []
    for i, (n, changed, nxt, own) in want.items():
        r = got[i]
        assert r.n_chars == n and r.edited_sha256 == hashlib.sha256(changed.encode()).hexdigest()
        assert [r.fingerprint, r.edited_fingerprint] == P.fingerprint_texts([own, changed])
        for near, other in ((r.near_edited, changed), (r.near_next, nxt)):
            assert 0 <= near <= 1
            errors.append(near - _jaccard(own, other))
    assert np.abs(errors).mean() < 0.03 and np.abs(errors).max() < 0.25
    assert got[5].fingerprint == got[60].fingerprint == got[61].fingerprint
    assert got[62].fingerprint == got[63].fingerprint == got[64].fingerprint == ""


def test_estimate_is_not_biased():
    rng = random.Random(9)
    for share in (0.0, 0.3, 0.8):
        exact, found = [], []
        for _ in range(60):
            own = _prose(rng, 600, 10**6)
            keep = own.split()[:int(600 * share)]
            other = " ".join([*keep, _prose(rng, 600 - len(keep), 10**6)])
            a, b = P.fingerprint_texts([own, other])
            exact.append(_jaccard(own, other))
            x, y = (np.frombuffer(base64.b64decode(v), np.uint8) for v in (a, b))
            same = 1 - np.unpackbits(x ^ y).reshape(P.BINS, P.BITS).any(axis=1).mean()
            found.append((same - 0.25) / 0.75)  # not cut to 0..1
        assert np.mean(found) == pytest.approx(np.mean(exact), abs=0.012)


def test_bins_equal_a_plain_rebuild():
    texts = _texts()[:12] + ["", "one", "two words"]
    texts = [t or "" for t in texts]
    low = P.bins(texts)
    for i, text in enumerate(texts):  # text by text gives what the block gives
        assert (P.bins([text])[0] == low[i]).all()
        assert (low[i] != P._EMPTY).sum() <= len(_set(text))
    full = P.densify(low)
    for before, after in zip(low, full):
        filled = before != P._EMPTY
        assert (after[filled] == before[filled]).all()
        assert not filled.any() and (after == P._EMPTY).all() or set(after) == set(before[filled])


def test_very_long_text_and_blocks(monkeypatch):
    rng = random.Random(1)
    texts = [_prose(rng, 60_000), "short", _prose(rng, 10), _prose(rng, 60_000)]
    whole = P.fingerprint_texts(texts)
    monkeypatch.setattr(P, "BLOCK_CHARS", 10)
    assert P.fingerprint_texts(texts) == whole
    assert P.likeness(whole[:1], whole[3:]) < 0.1


def test_odd_tables(spark):
    assert P.edited_likeness(_table(spark, [])).collect() == []
    one = P.edited_likeness(_table(spark, [(3, "abcdefgh ij")])).collect()
    assert len(one) == 1 and one[0].near_next == 1.0
    assert one[0].edited_sha256 == hashlib.sha256(b"abcdefgh ab"[:9] + b"ab").hexdigest()
    rows = [(None, "a b c d")] * 40 + [(None, "x y z")] * 3 + [(1, "p q r s t")] * 30 + [(2, None)]
    got = P.edited_likeness(_table(spark, rows)).collect()
    assert len(got) == 74 and sum(r.doc_id is None for r in got) == 43
    assert sum(r.near_next == 1.0 for r in got) >= 39 + 2 + 29
    assert P.fingerprints(_table(spark, rows)).count() == 74

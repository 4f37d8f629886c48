"""Hard negatives against brute force, the tree's bounds, and odd rows."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pytest

from ledgerwright.llm import hard_negatives as H

KIND = "vec_id long, embedding array<float>, label int, score string"


def _rows(n, d, seed=4, labels=4, near=0.0):
    draw = np.random.default_rng(seed)
    centre = draw.standard_normal((labels, d)) * 0.3
    out = []
    for i in range(n):
        label = int(draw.integers(labels))
        v = centre[label] + draw.standard_normal(d) * 0.4
        out.append((i * 5, v.astype(np.float32).tolist(), label, "mine"))
    return out


def _brute(rows):
    """Rows as mined; a row is named by its place in the list."""
    use = []
    lengths = [len(v) for _, v, label, _ in rows if v is not None and label is not None
               and all(c is not None and math.isfinite(c) for c in v)]
    width = max(sorted(set(lengths)), key=lengths.count) if lengths else 0
    for i, v, label, _ in rows:
        if v is None or label is None or len(v) != width or not all(c is not None and math.isfinite(c) for c in v):
            continue
        if i is not None and i % 7 == 0:
            label = (label + 1) % 10
        use.append((i, label, [math.floor(256 * c) for c in v]))
    out = []
    order = lambda r: (-r[0], r[1] is None, r[1] or 0)
    for a, (i, label, x) in enumerate(use):
        if i is None or i % 100:
            continue
        scored = [(sum(p * q for p, q in zip(x, y)), j, lab, k) for k, (j, lab, y) in enumerate(use)]
        positives = sorted((r for r in scored if r[2] == label and r[3] != a), key=order)[:5]
        for p, pid, _, _ in positives:
            fit = sorted((r for r in scored if r[2] != label and 80 * p <= 100 * r[0] <= 100 * p), key=order)[:5]
            out += [(i, pid, rank, r[1], p, r[0]) for rank, r in enumerate(fit, 1)]
    return sorted(out, key=str)


def _got(spark, rows, parts=3):
    return sorted(map(tuple, H.mine(spark.createDataFrame(rows, KIND).repartition(parts)).collect()), key=str)


def test_equal_to_brute_force(spark):
    rows = _rows(900, 10)
    want = _brute(rows)
    assert len(want) > 100 and _got(spark, rows) == want


def test_a_share_of_the_leaves_first(spark, monkeypatch):
    real = H._two_passes
    monkeypatch.setattr(H, "_two_passes", lambda tables, leaves, share, *a: real(tables, leaves, 3, *a))
    monkeypatch.setattr(H, "DEALT", 100)
    rows = _rows(600, 5, seed=6, labels=3)
    assert _got(spark, rows) == _brute(rows)


@pytest.mark.parametrize("leaf,dealt,block", [(4, 60, 200), (7, 1 << 17, 16 << 20)])
def test_small_leaves_parts_and_blocks(spark, monkeypatch, leaf, dealt, block):
    monkeypatch.setattr(H, "DEALT", dealt)
    monkeypatch.setattr(H, "BLOCK_BYTES", block)  # several blocks of anchors
    monkeypatch.setattr(H, "RUN", 50)
    real = H.tiles
    monkeypatch.setattr(H, "tiles", lambda x, axes: real(x, axes, leaf))
    rows = _rows(420, 6, seed=8, labels=3)
    assert _got(spark, rows) == _brute(rows)


def test_ties_repeats_and_unusable_rows(spark):
    rows = _rows(200, 4, seed=2, labels=2)
    rows = [(i, [round(c * 4) / 4 for c in v], label, s) for i, v, label, s in rows]  # many equal scores
    rows += [(100, rows[20][1], rows[20][2], "again"), (100, rows[20][1], rows[20][2], "again")]
    rows += [(None, rows[21][1], rows[21][2], None), (None, rows[22][1], 1 - rows[22][2], None)]
    rows += [(200, None, 1, None), (300, [0.1, None, 0.2, 0.3], 1, None), (400, [0.1, float("nan"), 0.2, 0.3], 0, None),
             (500, [0.1, float("inf"), 0.2, 0.3], 0, None), (600, [0.5, 0.5, 0.5, 0.5], None, None), (700, [0.5], 1, None),
             (800, [], 1, None)]
    assert _got(spark, rows) == _brute(rows)


def test_one_vector_that_most_rows_share(spark, monkeypatch):
    monkeypatch.setattr(H, "DEALT", 64)
    rows = [(i, [0.5, 0.25, -0.5], i % 3, "x") for i in range(400)] + [(1000 + i, [0.45, 0.3, -0.4], i % 2, "x") for i in range(30)]
    assert _got(spark, rows) == _brute(rows)


def test_odd_tables(spark):
    assert _got(spark, [(1, None, None, None)]) == []
    assert H.mine(spark.createDataFrame([], KIND)).columns == [
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert _got(spark, [(100, [1.0], 1, "x")]) == []
    assert _got(spark, [(0, [1.0], 1, "x"), (1, [1.0], 2, "x"), (2, [1.0], 2, "x"), (3, [0.9], 1, "x")]) == [
        (0, 1, 1, 3, 65536, 256 * 230), (0, 2, 1, 3, 65536, 256 * 230)]


def test_boxes_bound_every_inner_product():
    x = np.random.default_rng(3).integers(-200, 200, (500, 8)).astype(np.int32)
    leaves = H.tiles(x, list(range(8)), 16)
    assert sorted(np.concatenate(leaves).tolist()) == list(range(500)) and max(map(len, leaves)) <= 16
    batch = pa.RecordBatch.from_pydict({
        "leaf": pa.array(range(len(leaves)), pa.int64()), "n": pa.array([len(t) for t in leaves], pa.int32()),
        "ids": [t.tolist() for t in leaves], "labels": [[0] * len(t) for t in leaves],
        "places": [list(range(len(t))) for t in leaves], "low": [x[t].min(axis=0).tobytes() for t in leaves],
        "high": [x[t].max(axis=0).tobytes() for t in leaves], "rows": [x[t].tobytes() for t in leaves]})
    boxes = H.Boxes(batch, 8)
    anchor = x[:1].astype(float)
    levels = boxes.bounds(anchor)
    scores = boxes.x @ anchor[0]
    for i in range(len(leaves)):
        own = scores[boxes.start[i]:boxes.start[i + 1]]
        assert levels[0][0][0][i] <= own.min() and own.max() <= levels[0][1][0][i]
    opened: set = set()
    own, every = [(low[0], high[0]) for low, high in levels], lambda rows: np.ones(500, bool)[rows]
    got, = boxes.search(own, anchor[0], every, [(-math.inf, math.inf, -math.inf)], 3, opened)
    assert sorted(s for s, _ in got) == sorted(scores)[-3:]
    high = sorted(scores)[-40]
    windows = [(high * 0.8, high, -math.inf), (0.0, high / 2, -math.inf), (high, 1e9, sorted(scores)[-2])]
    for (low, most, kth), found in zip(windows, boxes.search(own, anchor[0], every, windows, 3)):
        assert sorted(s for s, _ in found) == sorted(s for s in scores if max(low, kth) <= s <= most)[-3:]
    assert len(opened) < len(leaves)  # boxes were pruned

import math

import numpy as np
import pytest

from claimwright.llm import negatives as n


def brute(rows, every=100, k=5):
    """All scores with Python's integers."""
    seen = set()
    for i, label, v in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        seen.add((i, (label + 1) % 10 if i % 7 == 0 else label, tuple(math.floor(256 * x) for x in v)))
    out = []
    for a, label, v in seen:
        if a % every:
            continue
        scored = [(-sum(x * y for x, y in zip(v, w)), i, other) for i, other, w in seen if len(w) == len(v) and (i, other, w) != (a, label, v)]
        positives = sorted((s, i) for s, i, other in scored if other == label and i != a)[:k]
        for s, positive in positives:
            fits = sorted((t, i) for t, i, other in scored if other != label and 80 * -s <= 100 * -t <= 100 * -s)[:k]
            out += [(a, positive, rank, i, -s, -t) for rank, (t, i) in enumerate(fits, 1)]
    return sorted(out)


def got(frame, **options):
    return sorted(tuple(r) for r in n.mine_negatives(frame.sparkSession, frame, **options).collect())


SCHEMA = "vec_id long, embedding array<double>, label int, id long, v string"


def frame_of(spark, rows):
    return spark.createDataFrame([(i, v, label, 1, "x") for i, label, v in rows], SCHEMA).repartition(5)


def table(seed=0, size=8, count=900):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((12, size))
    rows = [(i, int(rng.integers(4)), [float(x) for x in (centres[rng.integers(12)] + rng.standard_normal(size) * 0.4) * rng.choice([0.1, 1, 3])]) for i in range(count)]
    rows += [(2000 + i, 1, rows[5][2]) for i in range(150)] + [(3000 + i, 2, rows[5][2]) for i in range(60)]  # copies that tie
    rows += [rows[100], rows[7], (5, 3, rows[6][2])]  # a repeated row, and an id with two contents
    rows += [(4000, None, [1.0] * size), (4100, 1, None), (4200, 1, [None] * size), (4300, 1, [float("nan")] + [1.0] * (size - 1)), (None, 1, [1.0] * size)]
    rows += [(5000, 1, [0.0] * size), (5001, 1, [0.0] * size), (5002, 2, [0.0] * size), (6000, 1, [1.0]), (6001, 1, [0.5]), (6002, 3, [0.45]), (6100, 1, []), (6101, 1, []), (6102, 4, [])]
    rows += [(-100, 2, [0.01] * size), (-7, 2, [0.3] * size)]
    return rows


def test_equals_brute_force_whatever_the_sizes(spark, monkeypatch):
    rows = table()
    want = brute(rows)
    frame = frame_of(spark, rows)
    assert want and got(frame) == want
    for name, value in (("BLOCK", 40), ("GROUP", 3), ("STRETCH", 7), ("MEMBERS", 2), ("SAMPLE", 6)):
        monkeypatch.setattr(n, name, value)
    assert got(frame) == want


def test_large_components_are_exact_within_64_bits(spark):
    rows = [(i, label, None if v is None else [None if x is None else x * 3e5 for x in v]) for i, label, v in table(1, 4, 250)]
    assert got(frame_of(spark, rows)) == brute(rows)
    beyond = got(frame_of(spark, [(0, 1, [1e300, 0.0]), (1, 1, [1e200, 1.0]), (2, 2, [1e200, 0.0])]))
    assert beyond == [(0, 2, 1, 1, 2**63 - 1, 2**63 - 1)]  # id 0 has label 2


def test_empty_tables_and_lonely_anchors(spark):
    assert got(frame_of(spark, [])) == []
    assert got(frame_of(spark, [(0, 1, [1.0, 0.0]), (1, 5, [1.0, 0.0])])) == []


def test_lists_end_early():
    """On clustered vectors a member walks a small part of a list, and what it finds is the best."""
    rng = np.random.default_rng(3)
    centres = rng.standard_normal((40, 32)) * 100
    vectors = np.floor(np.repeat(centres, 100, axis=0) + rng.standard_normal((4000, 32)) * 5).astype(np.int64)
    members, centre = vectors[:50], centres[:1] / np.linalg.norm(centres[:1])
    norms = n.norms_of(vectors)
    to_centre = n.angles(vectors, norms, centre)[:, 0]
    bounds = norms * np.cos(np.clip(to_centre - to_centre[:50].max() - n.SLACK, 0, np.pi))
    exact = members @ vectors.T
    assert (norms[:50, None] * bounds + 1e-3 >= exact).all()
    scored = []
    real = n._scores

    def counted(left, right):
        scored.append(len(left) * len(right))
        return real(left, right)

    needs = [[n.Best(5, None, None)] for _ in members]
    block = {"v": vectors, "id": np.arange(4000), "label": np.zeros(4000, int)}
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(n, "_scores", counted)
        patch.setattr(n, "STRETCH", 50)
        n.walk(members, norms[:50], np.zeros(50, int), needs, True, block, bounds, np.arange(50))
    assert sum(scored) < 0.1 * exact.size
    for m, (need,) in enumerate(needs):
        order = sorted((-int(s), i) for i, s in enumerate(exact[m]) if i != m)[:5]
        assert [(int(s), i) for s, i in need.found] == order

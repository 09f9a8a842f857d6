"""Hard negatives against a brute-force version; curve and bounds by themselves."""

import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.llm import hard_negatives as hn

SCHEMA = "vec_id long, label int, vector array<float>, rank int, score double, block long"


def brute(rows, is_anchor, k=5, m=5):
    """All rows of (anchor, positive, rank, negative, scores), straight from the rules."""
    sound = [(i, lab, [int(np.floor(256 * float(x))) for x in v]) for i, lab, v in rows if lab is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for a, (aid, alab, av) in enumerate(sound):
        if not is_anchor(aid):
            continue
        scored = [(sum(x * y for x, y in zip(av, v)), i, lab) for b, (i, lab, v) in enumerate(sound) if b != a]  # the shorter one is padded with zeros
        best = sorted(scored, key=lambda r: (-r[0], r[1] is None, r[1] or 0))
        for ps, pid, _ in [r for r in best if r[2] == alab][:k]:
            fit = [r for r in best if r[2] != alab and 80 * ps <= 100 * r[0] <= 100 * ps][:m]
            out += [(aid, pid, n + 1, nid, ps, ns) for n, (ns, nid, _) in enumerate(fit)]
    return sorted(out, key=str)


def mined(spark, rows, **kw):
    df = spark.createDataFrame([(*r, 9, 9.0, 9) for r in rows], SCHEMA).repartition(3)
    return sorted(map(tuple, hn.hard_negatives(df, F.col("vec_id") % 4 == 0, **kw).collect()), key=str)


def clustered(n, dims, groups, seed):
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=(groups, dims))
    return [(i, int(rng.integers(0, 3)), [float(x) for x in np.float32(centre[i % groups] + rng.normal(size=dims) * 0.1)]) for i in range(n)]


@pytest.fixture
def small(monkeypatch):
    for name, value in (("BLOCK", 8), ("BLOCKS", 2), ("ZONES", 3), ("ANCHORS", 20), ("BATCH", 4)):
        monkeypatch.setattr(hn, name, value)


def test_hilbert_neighbours_touch():
    for dims, bits in ((2, 4), (3, 3), (4, 2)):
        points = np.array(list(itertools.product(range(1 << bits), repeat=dims)))
        keys = [bytes(k) for k in hn.hilbert_keys(points, bits)]
        order = points[sorted(range(len(points)), key=keys.__getitem__)]
        assert len(set(keys)) == len(points)
        assert (np.abs(np.diff(order, axis=0)).sum(axis=1) == 1).all()


def test_equals_brute_force_with_odd_rows(spark, small):
    rows = clustered(150, 6, 5, 1)
    copy = rows[8][2]
    rows += [(1000 + i, i % 3, copy) for i in range(90)]  # a hot vector
    rows += [(2000, None, copy), (2001, 1, None), (2004, 1, [1.0, None]), (2008, 2, [float("nan")] * 6), (2012, 2, [float("inf"), 0.0]), (2016, 0, []), (2020, 1, copy[:3]), (None, 2, copy), (None, 2, rows[1][2])]
    rows += rows[:9]  # repeated rows, anchors among them
    got = mined(spark, rows)
    assert got == brute(rows, lambda i: i is not None and i % 4 == 0)
    assert got


def test_few_rows_and_none(spark, small):
    some = [(0, 1, [1.0, 0.0]), (1, 1, [1.0, 0.1]), (2, 0, [0.95, 0.0])]
    assert mined(spark, some) == brute(some, lambda i: i % 4 == 0)
    assert mined(spark, some, positives=1, negatives=1) == brute(some, lambda i: i % 4 == 0, 1, 1)
    assert mined(spark, some[:1]) == mined(spark, some[1:]) == mined(spark, []) == mined(spark, [(0, None, [1.0])]) == []


def test_large_components_are_exact_or_refused(spark, small):
    rows = [(i, i % 2, [3e5 + i, -1e5 * i, 0.5]) for i in range(12)]
    rows = [(i, lab, [float(np.float32(x)) for x in v]) for i, lab, v in rows]
    assert mined(spark, rows) == brute(rows, lambda i: i % 4 == 0)
    with pytest.raises(ArithmeticError):
        mined(spark, [(0, 1, [1e30]), (1, 1, [1.0])])


def test_bounds_leave_blocks_unread(spark, small, monkeypatch):
    """In well separated groups an anchor reads few of the blocks."""
    rows = clustered(400, 8, 10, 2)
    kept = {}
    real = hn.written

    def keep(df, name):
        kept[name] = out = real(df, name)
        return out

    monkeypatch.setattr(hn, "written", keep)
    monkeypatch.setattr(hn, "BLOCK", 20)
    got = mined(spark, rows, positives=2)
    blocks = kept["hilbert-blocks"].where("slot = -1").count()
    for name in ("positive-blocks", "negative-blocks"):
        read, anchors = kept[name].agg(F.sum(F.size("blocks")), F.countDistinct("home", "slot")).first()
        assert read < 0.5 * blocks * anchors
    assert got == brute(rows, lambda i: i % 4 == 0, 2)

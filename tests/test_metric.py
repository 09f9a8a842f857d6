"""The metric index against brute force; pruning; odd vectors."""

import numpy as np
import pytest

from quarry.operators import metric, prepare
from quarry.operators.metric import MetricIndex

SCHEMA = "vec_id long, embedding array<float>"


def cosines(rows, evals):
    """Greatest cosine of every row, None where there is none."""

    def unit(v):
        if v is None or any(x is None or not np.isfinite(x) for x in v):
            return None
        v = np.array([*v, *[0.0] * (16 - len(v))], dtype=np.float64)
        return v / np.linalg.norm(v) if v.any() else None

    es = [u for u in map(unit, evals) if u is not None]
    return [None if (u := unit(v)) is None or not es else max(float(u @ e) for e in es) for v in rows]


def vectors(n, groups, noise, seed):
    rng = np.random.default_rng(seed)
    centre = np.random.default_rng(99).normal(size=(40, 8))
    out = centre[rng.integers(0, groups, n)] + rng.normal(size=(n, 8)) * noise
    return [[float(x) for x in np.float32(v * rng.uniform(0.01, 50))] for v in out]  # any length


def frame(spark, rows):
    return spark.createDataFrame([(i, v) for i, v in enumerate(rows)], SCHEMA).repartition(4)


@pytest.fixture
def small(monkeypatch):
    for name, value in (("PIVOTS", 12), ("RINGS", 9), ("SAMPLE", 60), ("PIECE", 5), ("ASKED", 30), ("BATCH", 7)):
        monkeypatch.setattr(metric, name, value)


ODD = [None, [], [0.0] * 8, [1.0, None], [float("nan")] * 8, [float("inf"), 1.0], [1.0, 2.0], [1e38] * 8, [1e-30, 2e-30], [1.0] * 12, [-1.0, -2.0]]


@pytest.mark.parametrize("threshold", [0.999, 0.9, 0.3, -0.5])
def test_equals_brute_force(spark, small, threshold):
    train, evals = vectors(260, 30, 0.15, 1) + ODD, vectors(90, 40, 0.15, 2) + ODD
    train += train[:40] + [train[3]] * 120 + [[3 * x for x in train[5]]]  # repeated rows, a hot vector, one of another length
    best = cosines(train, evals)
    assert not any(b is not None and abs(b - threshold) < 1e-9 for b in best)
    kept = sorted(r.vec_id for r in prepare.decontaminate_embeddings(frame(spark, train), frame(spark, evals), threshold).collect())
    assert kept == [i for i, b in enumerate(best) if b is None or b < threshold]


def test_max_cosine_of_odd_vectors(spark, small):
    train, evals = vectors(50, 10, 0.3, 3) + ODD, ODD + vectors(20, 10, 0.3, 4)
    got = {r.vec_id: r.max_cosine for r in prepare.max_cosine(frame(spark, train), frame(spark, evals)).collect()}
    want = cosines(train, evals)
    assert len(got) == len(train)
    assert all((got[i] is None) == (w is None) and (w is None or abs(got[i] - w) < 1e-9) for i, w in enumerate(want))


def test_lengths_do_not_count(spark):
    """[3, 0] against [0.3, 0.95]: the cosine is 0.30, not 0.90."""
    one = frame(spark, [[3.0, 0.0]])
    other = frame(spark, [[0.3, 0.95]])
    assert abs(prepare.max_cosine(one, other).first().max_cosine - 0.3011) < 1e-3
    assert prepare.decontaminate_embeddings(one, other, 0.7).count() == 1


def test_no_eval_or_train_rows(spark):
    train, none = frame(spark, [[1.0, 0.0], None]), spark.createDataFrame([], SCHEMA)
    for evals in (none, frame(spark, [None, [0.0]])):
        assert prepare.decontaminate_embeddings(train, evals, 0.5).count() == 2
        assert [r.max_cosine for r in prepare.max_cosine(train, evals).collect()] == [None, None]
    assert prepare.decontaminate_embeddings(none, train, 0.5).count() == 0
    assert prepare.embedding_share(none, train, 0.5) == prepare.embedding_share(train, none, 0.5) == 0.0


def test_null_and_repeated_keys(spark):
    rows = [(None, [1.0, 0.0]), (None, [0.0, 1.0]), (5, [1.0, 0.1]), (5, [0.0, 1.0])]
    train = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA + ", ring string")
    kept = prepare.decontaminate_embeddings(train, frame(spark, [[2.0, 0.0]]), 0.9).collect()
    assert sorted((r.vec_id is None, r.embedding) for r in kept) == [(False, [0.0, 1.0]), (True, [0.0, 1.0])]
    assert kept[0].ring == "x"


def test_separated_groups_are_not_all_compared(spark, monkeypatch):
    train, evals = frame(spark, vectors(400, 40, 0.02, 5)), frame(spark, vectors(300, 40, 0.02, 6))
    index = MetricIndex(evals)
    assert 0 < index.share(train, "embedding", 0.99) < 0.15
    assert index.share(train, "embedding", -1.0) == 1.0

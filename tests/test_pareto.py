"""The Pareto front of many rows against the definition."""

import numpy as np
import pytest

from quarry.operators.experiments import pareto_front


@pytest.mark.parametrize("seed, spread", [(1, 8), (2, 60), (3, 10**6)])
def test_front_of_many_rows(spark, seed, spread):
    rng = np.random.default_rng(seed)
    pts = [(i, int(c), float(v)) for i, (c, v) in enumerate(rng.integers(0, spread, (700, 2)))]
    pts += pts[:20] + [(900, None, 1e9), (901, -5, None), (902, None, None)]
    df = spark.createDataFrame(pts, "model long, cost int, value double").repartition(5)
    got = sorted(r.model for r in pareto_front(df, "value", "cost").collect())
    full = [p for p in pts if None not in p]
    want = sorted(m for m, c, v in full if not any(oc <= c and ov >= v and (oc < c or ov > v) for _, oc, ov in full))
    assert got == want


def test_front_of_no_rows(spark):
    df = spark.createDataFrame([(1, None, 2.0)], "model long, cost int, value double")
    assert pareto_front(df, "value", "cost").count() == pareto_front(df.limit(0), "value", "cost").count() == 0

"""Exact ranks for keys of every type, ties and hot keys, against plain sorting."""

import datetime as dt
import decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.operators import prepare
from quarry.operators.ranks import RankTable

RNG = np.random.default_rng(3)
KEYS = {
    "string": [f"k{int(x):05d}é" for x in RNG.integers(0, 3000, 800)],
    "bigint": [(1 << 53) + int(x) for x in RNG.integers(0, 2000, 800)],
    "date": [dt.date(2020, 1, 1) + dt.timedelta(days=int(x)) for x in RNG.integers(0, 900, 800)],
    "timestamp": [dt.datetime(2021, 3, 28, 0, 30) + dt.timedelta(seconds=int(x)) for x in RNG.integers(0, 9000, 800)],
    "decimal(30,4)": [decimal.Decimal(int(x)).scaleb(-4) + 10**20 for x in RNG.integers(0, 3000, 800)],
    "double": [float(x) for x in RNG.normal(size=798)] + [float("inf"), float("-inf")],
    "binary": [bytes(RNG.integers(0, 256, 3).tolist()) for _ in range(800)],
}


@pytest.mark.parametrize("kind", KEYS)
def test_split_by_any_orderable_key(spark, kind):
    rows = [(k, i) for i, k in enumerate(KEYS[kind])] + [(None, -1), (None, -2)]
    df = spark.createDataFrame(rows, f"key {kind}, i int").repartition(5)
    got = {r.i: r.split for r in prepare.split_tail(df, 100, 50, key="key", ties=("i",)).collect()}
    order = [i for _, i in sorted(rows[:-2], key=lambda r: (r[0], r[1]))]
    want = {i: "test" for i in order[-100:]} | {i: "val" for i in order[-150:-100]} | {i: "train" for i in order[:-150]} | {-1: "train", -2: "train"}
    assert got == want


def test_find_every_rank(spark):
    keys = [int(x) for x in RNG.integers(0, 60, 500)]
    df = spark.createDataFrame([(k,) for k in keys], "k long").repartition(4)
    table = RankTable(df, "k")
    got = table.find(list(range(-1, 503)))
    assert sorted(got) == list(range(1, 501)) and table.n == 500
    values = spark.range(1).select(*(got[r][0].alias(f"r{r}") for r in (1, 2, 250, 499, 500))).first()
    assert list(values) == [sorted(keys)[r - 1] for r in (1, 2, 250, 499, 500)]
    assert all(got[r][1] == sum(x < sorted(keys)[r - 1] for x in keys) for r in range(1, 501))
    assert all(got[r][2] == keys.count(sorted(keys)[r - 1]) for r in range(1, 501))


def test_ties_beyond_all_columns(spark):
    """5,000 rows that agree in everything are still split by exact numbers, and none is lost."""
    df = spark.createDataFrame([("hot",)] * 5000 + [("a",)] * 10 + [("z",)] * 7, "key string").repartition(6)
    for n_test, n_val in ((100, 300), (7, 1), (5007, 5), (5010, 100), (0, 40), (9000, 1)):
        split = prepare.split_tail(df, n_test, n_val, key="key").groupBy("split", "key").count().collect()
        n = {}
        for r in split:
            n[r.split] = n.get(r.split, 0) + r["count"]
        test = min(n_test, 5017)
        val = min(n_val, 5017 - test)
        assert (n.get("test", 0), n.get("val", 0), n.get("train", 0)) == (test, val, 5017 - test - val)
        assert sum(r["count"] for r in split if r.key == "hot") == 5000
    parts = prepare.split_parts(df, 100, 300, key="key")
    assert {k: v.count() for k, v in parts.items()} == {"test": 100, "val": 300, "train": 4617}


def test_tied_rows_split_alike_in_any_layout(spark):
    rows = [("hot", i) for i in range(1000)] + [("a", 1), ("b", 2), (None, 3)]
    df = spark.createDataFrame(rows, "key string, x int")
    one, two = ({r.x for r in prepare.split_tail(d, 77, 200, key="key").where("split = 'test'").collect()} for d in (df.repartition(7), df.coalesce(1).orderBy(F.desc("x"))))
    assert one == two and len(one) == 77


def test_null_ties_come_first(spark):
    df = spark.createDataFrame([("k", None), ("k", 1), ("k", None), ("k", 2), ("k", 0)], "key string, t int")
    got = sorted(((r.t, r.split) for r in prepare.split_tail(df, 2, 1, key="key", ties=("t",)).collect()), key=str)
    assert got == sorted([(2, "test"), (1, "test"), (0, "val"), (None, "train"), (None, "train")], key=str)


def test_prefix_slices_edges(spark):
    df = spark.createDataFrame([(None,), (None,)] + [(f"s{i % 10}",) for i in range(100)], "key string").repartition(3)
    count = lambda ks: {r.k: r["count"] for r in prepare.prefix_slices(df, ks, key="key").groupBy("k").count().collect()}
    assert count([0]) == {} and count([]) == {}
    assert count([0, 7, 25, 0.5, 1.0, 400, 7]) == {7: 7, 25: 25, 50: 50, 100: 100, 400: 100}  # fractions of rows with a key
    nested = prepare.prefix_slices(df.withColumn("i", F.monotonically_increasing_id()), [15, 33, 60], key="key").collect()
    at = {k: {r.i for r in nested if r.k == k} for k in (15, 33, 60)}
    assert at[15] < at[33] < at[60]
    assert prepare.prefix_slices(df.limit(0), [3], key="key").count() == 0


def test_boundaries_reach_the_scan(spark, tmp_path):
    spark.range(0, 5000, 1, 4).withColumnRenamed("id", "example_id").write.parquet(str(tmp_path / "t"))
    parts = prepare.split_parts(spark.read.parquet(str(tmp_path / "t")), 500, 500)
    for name, n in (("test", 500), ("val", 500), ("train", 4000)):
        assert parts[name].count() == n
    plan = parts["test"]._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(example_id,4499)" in plan[plan.index("PushedFilters") :]

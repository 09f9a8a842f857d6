"""Plan properties the design relies on (checked on final adaptive plans)."""

import re

import pytest
from pyspark.sql import functions as F

from quarry.operators.validate import validate_outputs
from quarry.plans import queries
from quarry.plans.queries import QUERIES, q_curve_plateau, q_pareto_front
from quarry.plans.sizing import spread
from quarry.session import scratch_path


def _final_plan(df):
    """The final adaptive plan (the string also carries the initial plan)."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_evaluate_has_one_hash_exchange(spark, sf_small):
    """Generation, stub models and validation are narrow: the only hash
    exchange is the one between the partial and final aggregate."""
    plan = _final_plan(QUERIES["evaluate_models"](spark, sf_small))
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 1
    assert "partial_count" in plan
    assert "Join" not in plan


def test_ngram_and_embedding_joins_are_broadcast(spark, sf_small):
    for name in ("decontaminate_ngrams", "decontaminate_embeddings", "decontaminate_exact"):
        plan = _final_plan(QUERIES[name](spark, sf_small))
        assert "NestedLoop" not in plan and "Cartesian" not in plan, name
        assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan, name


def test_render_shuffles_once_by_conversation(spark, sf_small):
    plan = _final_plan(QUERIES["chat_render"](spark, sf_small))
    exchanges = re.findall(r"Exchange (\w+)\(([^)]*)\)", plan)
    assert len({e for e in exchanges}) == 1 and "conv_id" in exchanges[0][1]


def test_routing_has_no_join(spark, sf_small):
    """Side-by-side answers are routed by projection (no join, no union)."""
    plan = _final_plan(QUERIES["route_prescored"](spark, sf_small))
    assert "Join" not in plan and "Union" not in plan


def test_spread_bounds_the_rows_of_a_task(spark):
    path = scratch_path(spark, "t-spread")
    spark.range(250_000).coalesce(1).write.parquet(path)
    one = spark.read.parquet(path)
    got = spread(one, min_partitions=1)
    sizes = [r["n"] for r in got.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
    assert sum(sizes) == 250_000 and max(sizes) <= 100_000 and len(sizes) == 3
    assert spread(one, min_partitions=1, rows_per_task=250_000).rdd.getNumPartitions() == 1


@pytest.mark.parametrize("query", [q_curve_plateau, q_pareto_front])
def test_heavy_stage_is_dealt_by_rows(spark, tmp_path, monkeypatch, query):
    """Every generated and parsed row of a sweep or a curve is in a task of bounded size."""
    seen = []
    deal = queries.spread
    monkeypatch.setattr(queries, "spread", lambda df: seen.append(deal(df, 1, 100)) or seen[-1])
    spark.range(450).select(F.col("id").alias("o_orderkey")).coalesce(1).write.parquet(str(tmp_path / "orders.parquet"))
    assert query(spark, str(tmp_path)).count() > 0
    assert [df.rdd.getNumPartitions() for df in seen] == [5]


def test_parsed_object_is_walked_once(spark):
    """The contract's fields leave the parsed candidate in one step, not twice each."""
    v = validate_outputs(spark.createDataFrame([('{"order_id": "1"}',)], "raw string"), "raw")
    plan = str(v._jdf.queryExecution().optimizedPlan())
    assert len(re.findall(r"try_variant_get\(_v#", plan)) == 3 and "reverse(" not in plan

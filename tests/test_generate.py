"""Generator goldens and determinism (FIXTURES §4, SURVEY §2.10)."""

from pyspark.sql import functions as F

from quarry.functions.text import fill_order_id, vary
from quarry.operators.generate import generate_examples, ood_overlap


def _one(spark, col):
    return spark.range(1).select(col.alias("v")).first().v


def test_fill_without_id(spark):
    none = F.lit(None).cast("string")
    assert _one(spark, fill_order_id(F.lit("Order {oid} is late"), none)) == "Order my order is late"
    assert _one(spark, fill_order_id(F.lit("about order {oid}"), none)) == "about my order"
    assert _one(spark, fill_order_id(F.lit("on #{oid}"), none)) == "on my order"
    assert _one(spark, fill_order_id(F.lit("for {oid}"), none)) == "for my order"
    assert _one(spark, fill_order_id(F.lit("for {oid}"), F.lit("12345"))) == "for 12345"


def test_vary(spark):
    assert _one(spark, vary(F.lit("Hi, "), F.lit("Order 5"), F.lit(" Thanks."))) == "Hi, order 5 Thanks."
    assert _one(spark, vary(F.lit(""), F.lit("Order 5"), F.lit(" Thanks."))) == "Order 5 Thanks."


def test_partition_invariance(spark):
    def digest(parts):
        keys = spark.range(0, 3000, numPartitions=parts).withColumnRenamed("id", "k")
        g = generate_examples(keys, key="k", seed=7)
        h = F.pmod(F.xxhash64("example_id", "message", "ticket"), F.lit(2147483647))
        return g.select(F.sum(h).alias("h")).first().h

    assert digest(1) == digest(4) == digest(16)


def test_distribution(spark):
    g = generate_examples(spark.range(20000).withColumnRenamed("id", "k"), key="k", seed=7)
    r = g.agg(F.avg(F.col("ticket.order_id").isNull().cast("int")).alias("null_rate"),
              F.countDistinct("ticket.issue").alias("issues")).first()
    assert 0.36 < r.null_rate < 0.43  # 2/7 + 5/7 * 0.15 = 0.393
    assert r.issues == 7


def test_ood_wordings_disjoint(spark):
    assert ood_overlap(spark).count() == 0


def test_ood_set_every_wording_once_per_replica(spark):
    from quarry.functions.templates import GREETINGS
    from quarry.operators.generate import generate_ood, ood_rows

    keys = spark.range(5).withColumnRenamed("id", "c")
    rows = generate_ood(keys, key="c").collect()
    assert len(rows) == 5 * len(ood_rows())
    assert len({r.example_id for r in rows}) == len(rows)
    for r in rows:
        assert "{oid}" not in r.message and "my order" not in r.message
        assert not any(g and r.message.startswith(g) for g in GREETINGS)
        if r.ticket.order_id is not None:
            assert r.ticket.order_id in r.message


def test_diverse_pool_draws_both_pools(spark):
    from quarry.functions.templates import TEMPLATE_ROWS

    g = generate_examples(spark.range(20000).withColumnRenamed("id", "k"), key="k", seed=7, diverse=True)
    msgs = [r.message.lower() for r in g.select("message").collect()]
    diverse_markers = ["has circled the city", "without the vegan trays", "made the whole office laugh"]
    assert all(any(m_ in m for m in msgs) for m_ in diverse_markers)
    assert len(TEMPLATE_ROWS) == 20 + 2 * 14 + 9

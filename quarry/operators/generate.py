"""Labelled-example generation as a pure projection over any keyed table.

Every choice (issue, template, whether the message names an order, the id,
greeting, closing) is a hash draw on ``(seed, key, axis)``, so the result does
not depend on partitioning and the operator is one narrow stage: no shuffle,
no join. The template pool is a handful of literals folded into the plan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.contract import ISSUES
from quarry.functions import draws
from quarry.functions.templates import (
    CLOSINGS,
    DETAILED_SUMMARIES,
    GREETINGS,
    SUMMARIES,
    TEMPLATE_ROWS,
    pool_rows,
)
from quarry.functions.text import fill_order_id, vary

NO_ID_RATE = 0.15  # share of id-bearing templates rendered without the id


def _lit_array(values) -> Column:
    return F.array(*[F.lit(v) for v in values])


def _pick_lit(values, idx0: Column) -> Column:
    return F.element_at(_lit_array(values), (idx0 + 1).cast("int"))


def ticket_struct(order_id: Column, issue: Column, sentiment: Column, priority: Column, summary: Column) -> Column:
    return F.struct(
        order_id.cast("string").alias("order_id"),
        issue.alias("issue"),
        sentiment.alias("sentiment"),
        priority.alias("priority"),
        summary.alias("summary"),
    )


def summary_for(issue: Column, oid: Column, detailed: bool) -> Column:
    table = DETAILED_SUMMARIES if detailed else SUMMARIES
    s = _pick_lit([table[i] for i in ISSUES], F.array_position(_lit_array(ISSUES), issue) - 1)
    return fill_order_id(s, oid) if detailed else s


def generate_examples(
    keys: DataFrame,
    key: str = "example_id",
    seed: int = 7,
    diverse: bool = False,
    detailed_summary: bool = False,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """One labelled example per row of ``keys``: (example_id, message, ticket,
    …keep), where ``keep`` names input columns passed through unchanged."""
    rows = pool_rows(("base", "diverse") if diverse else ("base",))
    counts = [sum(1 for r in rows if r[1] == i) for i in ISSUES]
    offsets = [sum(counts[:j]) for j in range(len(ISSUES))]

    k = F.col(key)
    issue_idx = draws.pick(seed, k, "issue", len(ISSUES))
    n_tpl = F.element_at(_lit_array(counts), (issue_idx + 1).cast("int"))
    flat = F.element_at(_lit_array(offsets), (issue_idx + 1).cast("int")) + draws.pick(seed, k, "template", n_tpl)

    base = keys.select(
        k.cast("bigint").alias("example_id"),
        *[F.col(c) for c in keep],
        _pick_lit(ISSUES, issue_idx).alias("issue"),
        _pick_lit([r[3] for r in rows], flat).alias("template"),
        _pick_lit([r[4] for r in rows], flat).alias("sentiment"),
        _pick_lit([r[5] for r in rows], flat).alias("priority"),
        draws.below(seed, k, "has_oid", NO_ID_RATE).alias("_no_id"),
        (F.lit(10000) + draws.pick(seed, k, "oid", 90000)).cast("string").alias("_oid"),
        _pick_lit(GREETINGS, draws.pick(seed, k, "greeting", len(GREETINGS))).alias("_greeting"),
        _pick_lit(CLOSINGS, draws.pick(seed, k, "closing", len(CLOSINGS))).alias("_closing"),
    )
    oid = F.when(F.col("template").contains("{oid}") & ~F.col("_no_id"), F.col("_oid"))
    with_oid = base.withColumn("_oid", oid)
    return with_oid.select(
        "example_id",
        vary(F.col("_greeting"), fill_order_id(F.col("template"), F.col("_oid")), F.col("_closing")).alias("message"),
        ticket_struct(
            F.col("_oid"),
            F.col("issue"),
            F.col("sentiment"),
            F.col("priority"),
            summary_for(F.col("issue"), F.col("_oid"), detailed_summary),
        ).alias("ticket"),
        *[F.col(c) for c in keep],
    )


def ood_rows() -> list[tuple]:
    return [r for r in TEMPLATE_ROWS if r[0] == "ood"]


def generate_ood(keys: DataFrame, key: str, seed: int = 99, detailed_summary: bool = False) -> DataFrame:
    """Every out-of-distribution wording once per row of ``keys`` (a replica
    axis), no greeting or closing, the id always present when the wording has
    a slot. ``example_id = key * n_wordings + position``."""
    ood = ood_rows()
    n = len(ood)
    entries = F.array(
        *[
            F.struct(F.lit(i).alias("pos"), F.lit(r[1]).alias("issue"), F.lit(r[2]).alias("template"),
                     F.lit(r[3]).alias("sentiment"), F.lit(r[4]).alias("priority"))
            for i, r in enumerate(ood)
        ]
    )
    ex = keys.select(F.col(key).cast("bigint").alias("_k"), F.explode(entries).alias("t"))
    ex = ex.select(
        (F.col("_k") * n + F.col("t.pos")).alias("example_id"),
        "t.issue", "t.template", "t.sentiment", "t.priority",
    )
    oid = F.when(
        F.col("template").contains("{oid}"),
        (F.lit(10000) + draws.pick(seed, F.col("example_id"), "oid", 90000)).cast("string"),
    )
    ex = ex.withColumn("_oid", oid)
    return ex.select(
        "example_id",
        fill_order_id(F.col("template"), F.col("_oid")).alias("message"),
        ticket_struct(F.col("_oid"), F.col("issue"), F.col("sentiment"), F.col("priority"),
                      summary_for(F.col("issue"), F.col("_oid"), detailed_summary)).alias("ticket"),
    )


def templates_frame(spark) -> DataFrame:
    """The template dimension (pool, issue, template_idx, template, sentiment, priority)."""
    rows = []
    for p in ("base", "diverse", "ood"):
        rows += pool_rows((p,))
    return spark.createDataFrame(
        rows, "pool string, issue string, template_idx int, template string, sentiment string, priority string"
    )


def ood_overlap(spark) -> DataFrame:
    """OOD wordings that also occur in a training pool (must be empty)."""
    t = templates_frame(spark)
    train = t.filter(F.col("pool") != "ood").select("template")
    return t.filter(F.col("pool") == "ood").join(train, "template", "left_semi")


"""Validation, guard and gate operators over raw model output.

All stateless column expressions: they run unchanged on batch and streaming
DataFrames, inside whole-stage codegen, and never shuffle. The variant value
used for parsing is projected away before the result leaves the operator
(variant columns cannot be grouped or shuffled by key).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.contract import TICKET, Contract
from quarry.functions import parse
from quarry.functions.text import excerpt
from quarry.session import ensure_conf

GUARD_FAILED = "order_id_not_in_message"


def validate_outputs(
    df: DataFrame, raw_col: str = "raw", contract: Contract = TICKET, into: str = "ticket"
) -> DataFrame:
    """Add ``into`` (typed struct or null), ``is_valid``, ``reason_code`` and
    ``reason_detail`` for the raw text in ``raw_col``."""
    ensure_conf(df.sparkSession)
    d = df.withColumns(parse.candidate_columns(F.col(raw_col)))
    d = d.withColumns(parse.candidate_span_columns())
    d = d.withColumns(parse.decode_columns())
    d = d.withColumns(parse.object_columns(contract))
    d = d.withColumns(parse.field_columns(contract))
    d = d.withColumns(parse.schema_error_column(contract))
    code = parse.code_column()["reason_code"]
    res = parse.result_columns(contract, code)
    # The result leaves through a one-row ``inline`` generator: Catalyst pushes
    # filters below projections by substituting their expressions, which would
    # re-inline the parse once per reference; a filter on a generator's output
    # stays above it, so the parse runs once per row whatever follows. The
    # outer form keeps Catalyst from inferring (and pushing down) a size filter.
    out = F.struct(
        code.alias("reason_code"),
        res["reason_detail"].alias("reason_detail"),
        res["ticket"].alias(into),
        code.isNull().alias("is_valid"),
    )
    d = d.select(*[F.col(c) for c in d.columns], F.inline_outer(F.array(out)))
    return d.drop(*parse.temp_columns(contract))


def failures(validated: DataFrame, keep=("model", "example_id", "message")) -> DataFrame:
    """Rows that did not validate, with the first 200 characters of the raw text."""
    cols = [c for c in keep if c in validated.columns]
    return validated.filter(~F.col("is_valid")).select(
        *cols, "reason_code", "reason_detail", excerpt(F.col("raw"), 200).alias("raw_excerpt")
    )


def failure_histogram(validated: DataFrame, by: str = "reason_code", group=("model",)) -> DataFrame:
    """Counts of failures by reason (partial aggregation map-side)."""
    g = [c for c in group if c in validated.columns]
    return (
        validated.filter(~F.col("is_valid"))
        .groupBy(*g, by)
        .agg(F.count(F.lit(1)).alias("n_failures"))
    )


def grounded(value: Column, text: Column) -> Column:
    """A claimed value must occur in the text; a null claim passes."""
    return F.coalesce(F.contains(text, value), F.lit(True))


def order_id_guard(ticket_col: str = "ticket", message_col: str = "message") -> Column:
    return grounded(F.col(f"{ticket_col}.order_id"), F.col(message_col))


def gate(
    validated: DataFrame,
    guard: bool = True,
    ticket_col: str = "ticket",
    message_col: str = "message",
    tokens_col: str = "completion_tokens",
    on_fail: str = "escalate",
) -> DataFrame:
    """The tool result: ``ok``, ``ticket`` (or null), ``error`` and ``tokens``.

    Error precedence: the parse reason first, then the guard. With
    ``on_fail="null"`` a failed guard keeps the row ok and nulls the id.
    """
    guard_ok = order_id_guard(ticket_col, message_col) if guard else F.lit(True)
    d = validated.withColumn("_guard_ok", guard_ok)
    if on_fail == "null":
        fixed = F.col(ticket_col).withField("order_id", F.when(F.col("_guard_ok"), F.col(f"{ticket_col}.order_id")))
        return d.select(
            "*",
            F.col("is_valid").alias("ok"),
            F.when(F.col("is_valid"), fixed).alias("_t"),
            F.when(~F.col("is_valid"), F.col("reason_code")).alias("error"),
            F.col(tokens_col).alias("tokens"),
        ).drop(ticket_col, "_guard_ok").withColumnRenamed("_t", ticket_col)
    ok = F.col("is_valid") & F.col("_guard_ok")
    err = F.when(~F.col("is_valid"), F.col("reason_code")).when(~F.col("_guard_ok"), F.lit(GUARD_FAILED))
    return d.select(
        "*",
        ok.alias("ok"),
        err.alias("error"),
        F.col(tokens_col).alias("tokens"),
    ).withColumn(ticket_col, F.when(F.col("ok"), F.col(ticket_col))).drop("_guard_ok")


def guard_report(validated: DataFrame, cost_ratio: float = 20.0, group=("model",), ticket_col: str = "ticket",
                 message_col: str = "message") -> DataFrame:
    """Rows that parse but fail the order-id guard, and the routing cost
    ``(N + caught * ratio) / (N * ratio)`` rounded half-even to 2 places.
    Schema failures are not counted here."""
    g = [c for c in group if c in validated.columns]
    caught = F.count_if(F.col("is_valid") & ~order_id_guard(ticket_col, message_col))
    n = F.count(F.lit(1))
    r = F.lit(float(cost_ratio))
    return validated.groupBy(*g).agg(n.alias("n"), caught.alias("caught")).select(
        *g,
        "n",
        "caught",
        F.coalesce(F.try_divide(F.col("caught").cast("double"), F.col("n").cast("double")), F.lit(0.0)).alias("caught_rate"),
        F.bround(F.coalesce(F.try_divide(F.col("n") + F.col("caught") * r, F.col("n") * r), F.lit(1.0)), 2).alias("cost_vs_all_strong"),
    )


def gold_check(gold: DataFrame, ticket_col: str = "ticket", contract: Contract = TICKET) -> DataFrame:
    """Validate gold labels through the same contract: one row with the
    number of gold rows and how many of them are invalid."""
    as_json = gold.select(F.to_json(F.col(ticket_col), {"ignoreNullFields": "false"}).alias("raw"))
    v = validate_outputs(as_json, "raw", contract, into="_gold")
    return v.agg(F.count(F.lit(1)).alias("n_gold"), F.count_if(~F.col("is_valid")).alias("n_invalid_gold"))


def assert_valid_gold(gold: DataFrame, ticket_col: str = "ticket") -> int:
    """Raise if any gold label breaks the contract; returns the row count."""
    row = gold_check(gold, ticket_col).first()
    if row["n_invalid_gold"]:
        raise ValueError(f"{row['n_invalid_gold']} of {row['n_gold']} gold labels break the contract")
    return row["n_gold"]

"""Cheap-first routing and its economics.

``route_columns`` routes rows that carry both models' answers side by side
(a projection: it runs on batch and streaming DataFrames alike);
``route_prescored`` joins two prediction tables first.
``quarry.operators.infer.route`` runs the models and only calls the strong
one on the rows that need it. All produce the same ``routed`` shape
(``ROUTED_COLUMNS`` after the key), which ``routing_report`` summarises in one
aggregate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.contract import TICKET, Contract
from quarry.operators.validate import gate, validate_outputs

SERVED_CHEAP = "tuned_small"
SERVED_STRONG = "strong_fallback"

ROUTED_COLUMNS = ["ok", "ticket", "error", "tokens", "served_by", "escalation_reason"]


def served_cheap_rows(gated: DataFrame, key: str) -> DataFrame:
    return gated.filter(F.col("ok")).select(
        key,
        F.lit(True).alias("ok"),
        F.col("ticket"),
        F.lit(None).cast("string").alias("error"),
        F.col("tokens").cast("int").alias("tokens"),
        F.lit(SERVED_CHEAP).alias("served_by"),
        F.lit(None).cast("string").alias("escalation_reason"),
    )


def strong_rows(strong_validated: DataFrame, key: str, reason_col: str = "escalation_reason") -> DataFrame:
    """Escalated rows: the strong answer is parsed but not guarded, and
    carries no token count (as the reference's fallback result)."""
    return strong_validated.select(
        key,
        F.col("is_valid").alias("ok"),
        F.col("ticket"),
        F.when(~F.col("is_valid"), F.col("reason_code")).alias("error"),
        F.lit(None).cast("int").alias("tokens"),
        F.lit(SERVED_STRONG).alias("served_by"),
        F.col(reason_col).alias("escalation_reason"),
    )


def route_columns(
    df: DataFrame,
    cheap_raw: str,
    strong_raw: str,
    key: str = "example_id",
    message: str = "message",
    tokens: str = "completion_tokens",
    guard: bool = True,
    contract: Contract = TICKET,
) -> DataFrame:
    """Route rows that carry both models' raw answers side by side.

    The cheap answer is validated and gated; the strong answer is parsed
    (not guarded) only for escalated rows; one projection picks per row."""
    c = validate_outputs(
        df.select(key, message, F.col(cheap_raw).alias("_craw"), F.col(tokens).alias("_tok"), F.col(strong_raw).alias("_sraw")),
        "_craw", contract, into="_cheap",
    )
    g = gate(c, guard=guard, ticket_col="_cheap", tokens_col="_tok").select(
        key, "ok", "_cheap", "error", "tokens", F.when(~F.col("ok"), F.col("_sraw")).alias("_sraw")
    )
    sv = validate_outputs(g, "_sraw", contract, into="_strong")
    esc = ~F.col("ok")
    return sv.select(
        key,
        F.when(esc, F.col("is_valid")).otherwise(F.lit(True)).alias("ok"),
        F.when(esc, F.col("_strong")).otherwise(F.col("_cheap")).alias("ticket"),
        F.when(esc & ~F.col("is_valid"), F.col("reason_code")).alias("error"),
        F.when(~esc, F.col("tokens").cast("int")).alias("tokens"),
        F.when(esc, F.lit(SERVED_STRONG)).otherwise(F.lit(SERVED_CHEAP)).alias("served_by"),
        F.when(esc, F.col("error")).alias("escalation_reason"),
    )


def route_prescored(
    cheap: DataFrame,
    strong: DataFrame,
    key: str = "example_id",
    message: str = "message",
    guard: bool = True,
    contract: Contract = TICKET,
) -> DataFrame:
    """Route with both predictions given as separate tables
    ``(key, message, raw, completion_tokens, …)`` and ``(key, raw)``: a left
    join on the key, then ``route_columns``. (When both answers already sit
    in one table, call ``route_columns`` directly: no join.)"""
    c = cheap.select(key, message, F.col("raw").alias("_craw"), "completion_tokens")
    s = strong.select(F.col(key).alias("_skey"), F.col("raw").alias("_sraw_in"))
    j = c.join(s, F.col(key) == F.col("_skey"), "left")
    return route_columns(j, "_craw", "_sraw_in", key, message, "completion_tokens", guard, contract)


def routing_report(routed: DataFrame, cost_ratio: float = 20.0, with_map: bool = True) -> DataFrame:
    """One row: n, served_cheap, escalated, escalation_rate, (escalation_reasons
    map), cost_vs_all_strong, saving_vs_all_strong.

    routed cost = n + escalated * ratio (one cheap call each plus a strong call
    per escalation), naive cost = n * ratio. Empty input: rate 0, cost 1,
    saving 0. Reasons are pre-aggregated per (served_by, reason) map-side."""
    g = routed.groupBy("served_by", "escalation_reason").agg(F.count(F.lit(1)).alias("_c"))
    strong = F.col("served_by") == SERVED_STRONG
    agg = g.agg(
        F.coalesce(F.sum("_c"), F.lit(0)).cast("bigint").alias("n"),
        F.coalesce(F.sum(F.when(F.col("served_by") == SERVED_CHEAP, F.col("_c"))), F.lit(0)).cast("bigint").alias("served_cheap"),
        F.coalesce(F.sum(F.when(strong, F.col("_c"))), F.lit(0)).cast("bigint").alias("escalated"),
        F.collect_list(F.when(strong, F.struct(F.coalesce("escalation_reason", F.lit("unknown")).alias("k"), F.col("_c").alias("v")))).alias("_r"),
    )
    r = F.lit(float(cost_ratio))
    routed_cost = F.col("n") + F.col("escalated") * r
    naive = F.col("n") * r
    ratio = F.try_divide(routed_cost, naive)
    cols = [
        "n",
        "served_cheap",
        "escalated",
        F.coalesce(F.try_divide(F.col("escalated").cast("double"), F.col("n").cast("double")), F.lit(0.0)).alias("escalation_rate"),
    ]
    if with_map:
        cols.append(F.map_from_entries(F.col("_r")).alias("escalation_reasons"))
    cols += [
        F.coalesce(ratio, F.lit(1.0)).alias("cost_vs_all_strong"),
        F.coalesce(F.lit(1.0) - ratio, F.lit(0.0)).alias("saving_vs_all_strong"),
    ]
    return agg.select(*cols)


def escalation_reasons(routed: DataFrame) -> DataFrame:
    """(escalation_reason, n) over escalated rows (long form of the map)."""
    return (
        routed.filter(F.col("served_by") == SERVED_STRONG)
        .groupBy("escalation_reason")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def served_by(routed: DataFrame) -> DataFrame:
    """(served_by, n)."""
    return routed.groupBy("served_by").agg(F.count(F.lit(1)).alias("n"))

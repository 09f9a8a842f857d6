"""Scoring: alignment, per-model reports, field accuracy, comparison.

``evaluate`` is one grouped aggregate (partial aggregation map-side, then a
final aggregate over at most one row per group and partition), whatever the
number of predictions. Denominators follow the reference: validity and exact
match over all rows, field accuracy over valid rows (0.0 when none), latency
and tokens over all rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from quarry.contract import TICKET, Contract
from quarry.functions.text import py_strip
from quarry.operators.validate import validate_outputs


def align(preds: DataFrame, gold: DataFrame, key: str = "example_id", gold_col: str = "ticket") -> DataFrame:
    """Join predictions to gold on ``key``; gold's ticket becomes ``gold``.

    Use this when predictions and gold live in different tables (operators
    that pass gold columns through need no join). Call ``alignment_check``
    to assert completeness: an inner join silently drops unmatched rows.
    """
    g = gold.select(F.col(key), F.col(gold_col).alias("gold"), *[c for c in ("message",) if c in gold.columns])
    p = preds.drop(*[c for c in ("message", gold_col) if c in preds.columns])
    return p.join(g, key, "inner")


def alignment_check(preds: DataFrame, gold: DataFrame, key: str = "example_id", by: str = "model") -> DataFrame:
    """One row per model: gold rows without a prediction, predictions without
    gold, and duplicated prediction keys. All zero means aligned."""
    n_gold = gold.select(key).count()
    per_key = preds.groupBy(by, key).agg(F.count(F.lit(1)).alias("_np"))
    j = per_key.join(gold.select(key).withColumn("_g", F.lit(True)), key, "left")
    return j.groupBy(by).agg(
        (F.lit(n_gold) - F.count_if(F.col("_g").isNotNull())).alias("gold_without_pred"),
        F.count_if(F.col("_g").isNull()).alias("pred_without_gold"),
        F.count_if(F.col("_np") > 1).alias("duplicate_keys"),
    )


def assert_aligned(preds: DataFrame, gold: DataFrame, key: str = "example_id", by: str = "model") -> None:
    """Raise unless every model has exactly one prediction per gold row
    (the reference asserts equal lengths before zipping)."""
    bad = alignment_check(preds, gold, key, by).filter(
        (F.col("gold_without_pred") != 0) | (F.col("pred_without_gold") != 0) | (F.col("duplicate_keys") != 0)
    ).collect()
    if bad:
        raise ValueError(f"predictions and gold are not aligned: {[r.asDict() for r in bad]}")


FAULTS = ("repeated gold key", "invalid gold", "no prediction", "no gold", "repeated prediction")


def account(preds: DataFrame, gold: DataFrame, models: list[str], key: str = "example_id", gold_col: str = "ticket",
            by: str = "model", contract: Contract = TICKET) -> DataFrame:
    """Predictions beside their gold rows, every row of both kept (a full
    outer join on key and model, nulls matching nulls), with ``fault``: null,
    or the first of ``FAULTS`` that holds. Every gold row is expected once for
    each of ``models``; a prediction for another model has no gold."""
    once = Window.partitionBy(key)
    shown = [c for c in ("message",) if c in gold.columns]
    raw = gold.select(F.col(key).alias("_key"), F.col(gold_col).alias("gold"), *shown, F.count(F.lit(1)).over(once).alias("_copies"),
                      F.to_json(F.col(gold_col), {"ignoreNullFields": "false"}).alias("_json"))
    checked = validate_outputs(raw, "_json", contract, into="_parsed")
    wanted = checked.select("_key", "gold", *shown, "_copies", F.col("is_valid").alias("_good"), F.explode(F.array(*map(F.lit, models))).alias("_model"))
    given = preds.drop(*shown, gold_col).withColumn("_given", F.count(F.lit(1)).over(Window.partitionBy(key, by)))
    both = wanted.join(given, F.col("_key").eqNullSafe(F.col(key)) & F.col("_model").eqNullSafe(F.col(by)), "full_outer")
    tests = (F.col("_copies") > 1, ~F.col("_good"), F.col("_given").isNull(), F.col("_copies").isNull(), F.col("_given") > 1)
    fault = F.coalesce(*(F.when(t, F.lit(name)) for t, name in zip(tests, FAULTS, strict=True)))
    keep = [c for c in given.columns if c not in (key, by, "_given")]
    return both.select(F.coalesce(key, "_key").alias(key), F.coalesce(by, "_model").alias(by), *keep, "gold", *shown, fault.alias("fault"))


def alignment_faults(preds: DataFrame, gold: DataFrame, models: list[str], key: str = "example_id", gold_col: str = "ticket",
                     by: str = "model", contract: Contract = TICKET) -> DataFrame:
    """(model, fault, n) for every fault there is."""
    rows = account(preds, gold, models, key, gold_col, by, contract).where("fault is not null")
    return rows.groupBy(by, "fault").agg(F.count(F.lit(1)).alias("n"))


def align_complete(preds: DataFrame, gold: DataFrame, models: list[str], key: str = "example_id", gold_col: str = "ticket",
                   by: str = "model", contract: Contract = TICKET, observation: Observation | None = None) -> DataFrame:
    """``align`` that fails loudly, in the pass that uses its rows: the first
    fault (see ``account``) ends the job with an error that names it, the key
    and the model. With an ``observation`` the faulty rows are left out
    instead and counted there under the faults' names, besides ``rows``."""
    rows = account(preds, gold, models, key, gold_col, by, contract)
    seen = [F.count(F.lit(1)).alias("rows"), *(F.count_if(F.coalesce(F.col("fault") == f, F.lit(False))).alias(f) for f in FAULTS)]
    if observation is not None:
        return rows.observe(observation, *seen).where("fault is null").drop("fault")
    said = F.concat_ws(" ", F.lit("predictions and gold are not aligned:"), F.col("fault"), F.lit("for key"), F.coalesce(F.col(key).cast("string"), F.lit("null")),
                       F.lit("model"), F.coalesce(F.col(by), F.lit("null")))
    # The observation also keeps filters of later steps from being moved below the check.
    checked = rows.where(F.when(F.col("fault").isNull(), F.lit(True)).otherwise(F.raise_error(said).cast("boolean")))
    return checked.observe(Observation(), *seen[:1]).drop("fault")


def _norm_gold(gold: Column, contract: Contract) -> Column:
    return F.struct(
        *[
            (py_strip(gold[f.name]) if f.kind == "text" else gold[f.name]).alias(f.name)
            for f in contract.fields
        ]
    )


def _price_cols(prices, by_model: Column) -> tuple[Column, Column]:
    if prices is None:
        return F.lit(0.0), F.lit(0.0)
    if isinstance(prices, dict):
        pin = F.create_map(*[x for m, (i, _) in prices.items() for x in (F.lit(m), F.lit(float(i)))])
        pout = F.create_map(*[x for m, (_, o) in prices.items() for x in (F.lit(m), F.lit(float(o)))])
        return pin[by_model], pout[by_model]  # null for a model without a price: its cost is unknown, not 0
    i, o = prices
    return F.lit(float(i)), F.lit(float(o))


def evaluate(
    aligned: DataFrame,
    prices=None,
    by=("model",),
    gold_col: str = "gold",
    pred_col: str = "pred",
    contract: Contract = TICKET,
    with_map: bool = True,
) -> DataFrame:
    """Per-group report: n, schema_validity, exact_match, acc_<field>,
    mean_latency_s, mean_prompt_tokens, mean_completion_tokens,
    cost_per_1k_usd (and ``field_accuracy`` as a map when ``with_map``).

    ``prices``: ``{model: (in_price, out_price)}`` per token, a DataFrame
    ``(model, in_price, out_price)`` (joined to the per-model aggregate, so
    it never meets the predictions), one ``(in, out)`` pair for every group,
    or None for zero cost.
    """
    by = list(by)
    v = aligned if "is_valid" in aligned.columns else validate_outputs(aligned, "raw", contract, into=pred_col)
    v = v.withColumn("_gold_n", _norm_gold(F.col(gold_col), contract))
    valid = F.col("is_valid")
    exact = valid
    for f in contract.fields:
        exact = exact & F.col(pred_col)[f.name].eqNullSafe(F.col("_gold_n")[f.name])
    aggs = [
        F.count(F.lit(1)).alias("n"),
        F.count_if(valid).alias("_valid"),
        F.count_if(exact).alias("_exact"),
        F.avg("latency_s").alias("mean_latency_s"),
        F.avg("prompt_tokens").alias("mean_prompt_tokens"),
        F.avg("completion_tokens").alias("mean_completion_tokens"),
    ]
    for f in contract.scored_fields:
        aggs.append(F.count_if(valid & F.col(pred_col)[f].eqNullSafe(F.col("_gold_n")[f])).alias(f"_hit_{f}"))
    r = v.groupBy(*by).agg(*aggs)
    model_col = F.col("model") if "model" in by else F.lit(None).cast("string")
    if isinstance(prices, DataFrame):
        r = r.join(prices.select("model", F.col("in_price").alias("_pin"), F.col("out_price").alias("_pout")), "model", "left")
        pin, pout = F.col("_pin"), F.col("_pout")
    else:
        pin, pout = _price_cols(prices, model_col)
    acc = {
        f: F.coalesce(F.try_divide(F.col(f"_hit_{f}").cast("double"), F.col("_valid").cast("double")), F.lit(0.0))
        for f in contract.scored_fields
    }
    cols = [
        *by,
        "n",
        (F.col("_valid") / F.col("n")).alias("schema_validity"),
        (F.col("_exact") / F.col("n")).alias("exact_match"),
        *[acc[f].alias(f"acc_{f}") for f in contract.scored_fields],
        "mean_latency_s",
        "mean_prompt_tokens",
        "mean_completion_tokens",
        (F.lit(1000.0) * (F.col("mean_prompt_tokens") * pin + F.col("mean_completion_tokens") * pout)).alias(
            "cost_per_1k_usd"
        ),
    ]
    if with_map:
        cols.append(
            F.create_map(*[x for f in contract.scored_fields for x in (F.lit(f), acc[f])]).alias("field_accuracy")
        )
    return r.select(*cols)


def field_accuracy_long(report: DataFrame, by=("model",), contract: Contract = TICKET) -> DataFrame:
    """(…by, field, accuracy) long form of the per-field accuracy."""
    by = list(by)
    vals = [f"acc_{f}" for f in contract.scored_fields]
    long = report.select(*by, *vals).unpivot(by, vals, "field", "accuracy")
    return long.withColumn("field", F.regexp_replace("field", "^acc_", ""))


COMPARE_METRICS = ("schema_validity", "exact_match", "mean_latency_ms", "cost_per_1k_usd")


def compare(report: DataFrame, base: str, tuned: str, by: str = "model") -> DataFrame:
    """(metric, base, tuned, delta) for the four headline metrics, plus a
    ``cost_reduction_pct`` row when the base cost is positive.

    One pass over the report: the two models' rows are pivoted into a single
    row and the metric rows are generated from it (a union of two branches
    would evaluate the predictions twice)."""
    metrics = {
        "schema_validity": F.col("schema_validity"),
        "exact_match": F.col("exact_match"),
        "mean_latency_ms": F.col("mean_latency_s") * 1000.0,
        "cost_per_1k_usd": F.col("cost_per_1k_usd"),
    }
    r = report.filter(F.col(by).isin(base, tuned))
    wide = r.groupBy().pivot(by, [base, tuned]).agg(*[F.first(e).alias(m) for m, e in metrics.items()])

    def col(model, m):
        return F.col(f"`{model}_{m}`")

    rows = [
        F.struct(F.lit(m).alias("metric"), col(base, m).alias("base"), col(tuned, m).alias("tuned"),
                 (col(tuned, m) - col(base, m)).alias("delta"))
        for m in metrics
    ]
    bc, tc = col(base, "cost_per_1k_usd"), col(tuned, "cost_per_1k_usd")
    rows.append(F.struct(F.lit("cost_reduction_pct").alias("metric"), bc.alias("base"), tc.alias("tuned"),
                         (F.lit(100.0) * (F.lit(1.0) - F.try_divide(tc, bc))).alias("delta")))
    out = wide.select(F.inline(F.array(*rows)))
    keep = F.col("base").isNotNull() | F.col("tuned").isNotNull()
    return out.filter(keep & ((F.col("metric") != "cost_reduction_pct") | (F.col("base") > 0)))


# Fixed value: the layout of a report's one-line summary (kept equal to the
# reference's so summaries can be compared as text).
REPORT_LINE = "n=%d  schema_validity=%.3f  exact_match=%.3f  [{acc}]  lat=%.0fms  out_tok=%.0f  $%.3f/1k"


def report_lines(report: DataFrame, contract: Contract = TICKET) -> DataFrame:
    """One formatted summary line per model (Java %f rounds half-up)."""
    acc = ", ".join(f"{f}=%.2f" for f in contract.scored_fields)
    fmt = REPORT_LINE.replace("{acc}", acc)
    args = [F.col("n"), F.col("schema_validity"), F.col("exact_match")]
    args += [F.col(f"acc_{f}") for f in contract.scored_fields]
    args += [F.col("mean_latency_s") * 1000.0, F.col("mean_completion_tokens"), F.col("cost_per_1k_usd")]
    return report.select("model", F.format_string(fmt, *[a.cast("double") if i else a for i, a in enumerate(args)]).alias("line"))


def gold_lookup(queries: DataFrame, gold: DataFrame, message: str = "message", ticket: str = "ticket",
                key: str = "example_id") -> DataFrame:
    """(key, gold_json): the gold ticket of each query message as compact JSON,
    ``{}`` when the message is not in gold; for a message that appears more
    than once in gold the row with the largest key wins (last one in order)."""
    from quarry.operators.corrupt import compact_json

    book = gold.groupBy(F.col(message).alias("_m")).agg(F.max_by(compact_json(F.col(ticket)), F.col(key)).alias("_g"))
    # The book is an aggregate: AQE broadcasts it from its measured size.
    j = queries.select(key, message).join(book, F.col(message).eqNullSafe(F.col("_m")), "left")
    return j.select(key, F.coalesce(F.col("_g"), F.lit("{}")).alias("gold_json"))

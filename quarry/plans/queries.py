"""The registered queries: each takes ``(spark, sf_dir)`` and returns a
DataFrame over the driver's tables (or data Spark derives from them), so
its work grows with the scale factor. Column names match ``oracle.py``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.contract import SYSTEM_PROMPT
from quarry.operators.chat import (
    assistant_spans,
    inference_prompt,
    messages_long,
    preference_pairs,
    render_chat,
    split_reasoning,
    to_chat,
)
from quarry.operators.corrupt import DEFAULT_MODES, compact_json, simulate_columns, simulate_models
from quarry.operators.evaluate import (
    alignment_check,
    alignment_faults,
    compare,
    evaluate,
    field_accuracy_long,
    gold_lookup,
    report_lines,
)
from quarry.operators.experiments import curve_plateau, pareto_front, promotion_gate, sweep
from quarry.operators.generate import generate_examples, generate_ood
from quarry.operators.infer import KeywordPredictor, extract_batch, route
from quarry.operators.ledger import CallLedger, prompt_hash
from quarry.operators.prepare import (
    decontaminate_embeddings,
    decontaminate_ngrams,
    decontaminate_exact,
    decontamination_counts,
    duplicate_report,
    head,
    ngram_overlap,
    prefix_slices,
    split_fraction,
    split_fraction_parts,
)
from quarry.operators.ranks import written
from quarry.operators.route import escalation_reasons, route_columns, route_prescored, routing_report, served_by
from quarry.operators.validate import (
    failure_histogram,
    failures,
    gate,
    gold_check,
    guard_report,
    order_id_guard,
    validate_outputs,
)
from quarry.plans.build import build_dataset
from quarry.plans.sizing import spread
from quarry.session import ensure_conf, scratch_path
from quarry.sources.jsonl import read_examples, write_examples
from quarry.streaming.validate import (
    account_windows,
    escalation_rate_stream,
    read_table_stream,
    run_available,
    stream_gate,
    utc_text,
)

# Fixed parameters of the registered queries (the reference's notebook run:
# 800 examples split 100 test / 100 val, i.e. one eighth each).
GEN_SEED = 7
MODELS = [("base", 0.45, 1), ("tuned", 0.05, 2)]
PRICES = {"base": (2.5e-6, 10e-6), "tuned": (0.05e-6, 0.20e-6)}
SPLIT_FRAC = 0.125
PREFIX_KS = [0.1, 0.25, 0.5, 1.0]
HEAD_K = 50
EVAL_FRAC = 0.1
NGRAM_N = 8
COSINE_THRESHOLD = 0.4
TICKET_FIELDS = ["order_id", "issue", "sentiment", "priority", "summary"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def tickets(spark, sf_dir, **kw) -> DataFrame:
    """Gold examples, one per order (key ``o_orderkey``)."""
    keys = spread(table(spark, sf_dir, "orders").select("o_orderkey"))
    return generate_examples(keys, key="o_orderkey", seed=GEN_SEED, **kw)


def flat_tickets(df: DataFrame) -> DataFrame:
    return df.select("example_id", "message", *[F.col(f"ticket.{f}").alias(f) for f in TICKET_FIELDS])


def preds(spark, sf_dir, configs=MODELS, **kw) -> DataFrame:
    """Stub predictions for every configured model, gold passed through."""
    ensure_conf(spark)
    return simulate_models(tickets(spark, sf_dir), configs, **kw)


def validated(spark, sf_dir, configs=MODELS, **kw) -> DataFrame:
    p = preds(spark, sf_dir, configs, **kw).withColumnRenamed("ticket", "gold")
    return validate_outputs(p, "raw", into="pred")


def report(spark, sf_dir) -> DataFrame:
    return evaluate(validated(spark, sf_dir), prices=PRICES, with_map=False)


# --- queries ---------------------------------------------------------------


def q_tickets_generate(spark, sf_dir):
    return flat_tickets(tickets(spark, sf_dir))


def q_tickets_diverse(spark, sf_dir):
    return flat_tickets(tickets(spark, sf_dir, diverse=True, detailed_summary=True))


def q_tickets_ood(spark, sf_dir):
    return flat_tickets(ood_tickets(spark, sf_dir))


def q_corrupt_outputs(spark, sf_dir):
    return preds(spark, sf_dir).select(
        "model", "example_id", "raw", "latency_s", "prompt_tokens", "completion_tokens"
    )


def q_validate_outputs(spark, sf_dir):
    v = validated(spark, sf_dir)
    return v.select(
        "model", "example_id", "is_valid", "reason_code", "reason_detail",
        *[F.col(f"pred.{f}").alias(f"p_{f}") for f in TICKET_FIELDS],
    )


def q_failures(spark, sf_dir):
    return failures(validated(spark, sf_dir)).select("model", "example_id", "message", "reason_code", "raw_excerpt")


def q_failure_histogram(spark, sf_dir):
    return failure_histogram(validated(spark, sf_dir))


def q_evaluate_models(spark, sf_dir):
    return report(spark, sf_dir)


def q_field_accuracy(spark, sf_dir):
    return field_accuracy_long(report(spark, sf_dir))


def q_compare_models(spark, sf_dir):
    return compare(report(spark, sf_dir), "base", "tuned")


def q_report_lines(spark, sf_dir):
    return report_lines(report(spark, sf_dir))


def q_split_tail(spark, sf_dir):
    return split_fraction(tickets(spark, sf_dir), SPLIT_FRAC, SPLIT_FRAC).select("example_id", "split")


def q_split_by_source(spark, sf_dir):
    """A string key with heavy ties: the split runs through the rows of one source."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return split_fraction(docs, SPLIT_FRAC, SPLIT_FRAC, key="source", ties=("doc_id",)).select("doc_id", "source", "split")


def q_prefix_slices(spark, sf_dir):
    return prefix_slices(tickets(spark, sf_dir).select("example_id"), PREFIX_KS)


def q_head_limit(spark, sf_dir):
    return head(tickets(spark, sf_dir), HEAD_K).select("example_id", "message")


def documents_split(spark, sf_dir) -> dict[str, DataFrame]:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return split_fraction_parts(docs, EVAL_FRAC, 0.0, key="doc_id")


def q_decontaminate_exact(spark, sf_dir):
    d = documents_split(spark, sf_dir)
    return decontaminate_exact(d["train"], d["test"], col="text", key="doc_id").select("doc_id")


def q_decontamination_counts(spark, sf_dir):
    d = documents_split(spark, sf_dir)
    return decontamination_counts(d["train"], d["test"], col="text", key="doc_id")


def q_duplicate_report(spark, sf_dir):
    return duplicate_report(table(spark, sf_dir, "documents"), col="text")


def q_decontaminate_ngrams(spark, sf_dir):
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text"))
    bench = table(spark, sf_dir, "benchmark").select("text")
    return ngram_overlap(docs, bench, n=NGRAM_N)


def q_ngrams_kept(spark, sf_dir):
    """The documents that share no n-gram with the benchmark."""
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    bench = table(spark, sf_dir, "benchmark").select("text")
    return decontaminate_ngrams(docs, bench, n=NGRAM_N).select("doc_id", "source", F.md5("text").alias("text_md5"))


def q_decontaminate_embeddings(spark, sf_dir):
    e = split_fraction_parts(spread(table(spark, sf_dir, "embeddings")), EVAL_FRAC, 0.0, key="vec_id")
    return decontaminate_embeddings(e["train"], e["test"], COSINE_THRESHOLD).select("vec_id", "label")


def conversations(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")


def q_chat_sft(spark, sf_dir):
    return messages_long(to_chat(tickets(spark, sf_dir)))


def q_preference_pairs(spark, sf_dir):
    p = preference_pairs(tickets(spark, sf_dir))
    return p.select(
        "example_id",
        F.col("prompt")[0]["content"].alias("prompt_system"),
        F.col("prompt")[1]["content"].alias("prompt_user"),
        "chosen",
        "rejected",
    )


def q_chat_render(spark, sf_dir):
    return render_chat(conversations(spark, sf_dir))


def q_chat_generation_prompt(spark, sf_dir):
    return render_chat(conversations(spark, sf_dir), add_generation_prompt=True, enable_thinking=False).select(
        "conv_id", F.col("text").alias("prompt")
    )


def with_injected_reasoning(df: DataFrame) -> DataFrame:
    """Assistant turns get a think block in front of their text (the data has
    none): reasoning names the turn; the answer is the original text."""
    inj = F.concat(F.lit("<think>\nreasoning for turn "), F.col("turn").cast("string"), F.lit("\n</think>\n\n"), F.col("text"))
    return df.withColumn("text", F.when(F.col("role") == "assistant", inj).otherwise(F.col("text")))


def q_reasoning_split(spark, sf_dir):
    d = with_injected_reasoning(conversations(spark, sf_dir))
    answer, reasoning = split_reasoning(F.col("text"))
    return d.select("conv_id", "turn", reasoning.alias("reasoning"), answer.alias("content"))


def q_chat_render_reasoning(spark, sf_dir):
    return render_chat(with_injected_reasoning(conversations(spark, sf_dir)))


def q_assistant_spans(spark, sf_dir):
    return assistant_spans(conversations(spark, sf_dir))


QUERIES = {
    "tickets_generate": q_tickets_generate,
    "tickets_diverse": q_tickets_diverse,
    "tickets_ood": q_tickets_ood,
    "corrupt_outputs": q_corrupt_outputs,
    "validate_outputs": q_validate_outputs,
    "failures": q_failures,
    "failure_histogram": q_failure_histogram,
    "evaluate_models": q_evaluate_models,
    "field_accuracy": q_field_accuracy,
    "compare_models": q_compare_models,
    "report_lines": q_report_lines,
    "split_tail": q_split_tail,
    "split_by_source": q_split_by_source,
    "prefix_slices": q_prefix_slices,
    "head_limit": q_head_limit,
    "decontaminate_exact": q_decontaminate_exact,
    "decontamination_counts": q_decontamination_counts,
    "duplicate_report": q_duplicate_report,
    "decontaminate_ngrams": q_decontaminate_ngrams,
    "ngrams_kept": q_ngrams_kept,
    "decontaminate_embeddings": q_decontaminate_embeddings,
    "chat_sft": q_chat_sft,
    "preference_pairs": q_preference_pairs,
    "chat_render": q_chat_render,
    "chat_generation_prompt": q_chat_generation_prompt,
    "reasoning_split": q_reasoning_split,
    "chat_render_reasoning": q_chat_render_reasoning,
    "assistant_spans": q_assistant_spans,
}


# --- guard, gate, routing ----------------------------------------------------

GUARD_MODES = DEFAULT_MODES + ("digit_blend",)
CHEAP = ("tuned", 0.05, 2)
STRONG = ("strong", 0.01, 3)
COST_RATIO = 20.0
SWEEP_RATES = [0.05, 0.15, 0.3, 0.45]
SWEEP = [(f"stub_{i}", r, 10 + i) for i, r in enumerate(SWEEP_RATES)]
# Price per token of each sweep model: the more reliable, the dearer.
SWEEP_PRICES = {m: (0.05e-6 * (4 - i), 0.20e-6 * (4 - i)) for i, (m, _, _) in enumerate(SWEEP)}
PLATEAU_EPS = 0.01


def guarded(spark, sf_dir) -> DataFrame:
    """Validated predictions whose corruption modes include a digit blend of
    the order id (a wrong id that still parses)."""
    p = preds(spark, sf_dir, MODELS, modes=GUARD_MODES).withColumnRenamed("ticket", "gold")
    return validate_outputs(p, "raw", into="pred")


def q_order_id_guard(spark, sf_dir):
    v = guarded(spark, sf_dir).filter("is_valid")
    return v.select("model", "example_id", order_id_guard("pred", "message").alias("guard_ok"))


def q_gate(spark, sf_dir):
    g = gate(guarded(spark, sf_dir), guard=True, ticket_col="pred")
    return g.select("model", "example_id", "ok", "error", "tokens")


def q_guard_report(spark, sf_dir):
    return guard_report(guarded(spark, sf_dir), COST_RATIO, ticket_col="pred")


def routed(spark, sf_dir) -> DataFrame:
    """Both models' answers are produced side by side from one scan, then routed."""
    both = simulate_columns(tickets(spark, sf_dir), [CHEAP, STRONG], modes=[GUARD_MODES, DEFAULT_MODES])
    return route_columns(both, f"raw_{CHEAP[0]}", f"raw_{STRONG[0]}")


def q_route_prescored(spark, sf_dir):
    r = routed(spark, sf_dir)
    return r.select(
        "example_id", "ok", "error", "tokens", "served_by", "escalation_reason",
        *[F.col(f"ticket.{f}").alias(f"t_{f}") for f in TICKET_FIELDS],
    )


def q_served_by(spark, sf_dir):
    return served_by(routed(spark, sf_dir))


def q_routing_economics(spark, sf_dir):
    return routing_report(routed(spark, sf_dir), COST_RATIO, with_map=False)


def q_escalation_reasons(spark, sf_dir):
    return escalation_reasons(routed(spark, sf_dir))


# --- experiments -------------------------------------------------------------


def sweep_report(spark, sf_dir) -> DataFrame:
    p = preds(spark, sf_dir, SWEEP, extra={"break_rate": SWEEP_RATES}).withColumnRenamed("ticket", "gold")
    return sweep(p, by=("break_rate", "model"), prices=SWEEP_PRICES)


def q_experiment_sweep(spark, sf_dir):
    return sweep_report(spark, sf_dir)


def q_pareto_front(spark, sf_dir):
    return pareto_front(sweep_report(spark, sf_dir)).select("model", "break_rate", "schema_validity", "cost_per_1k_usd")


def q_pareto_documents(spark, sf_dir):
    """A front of many rows, nearly all dominated: documents longer than every one of a smaller id."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "n_chars", "source")
    return pareto_front(docs, "n_chars", "doc_id")


def q_curve_plateau(spark, sf_dir):
    sl = prefix_slices(tickets(spark, sf_dir), PREFIX_KS)
    p = simulate_models(sl, [CHEAP]).withColumnRenamed("ticket", "gold")
    rep = evaluate(p, by=("k", "model"), with_map=False)
    return curve_plateau(rep, "k", "schema_validity", PLATEAU_EPS)


def q_promotion_gate(spark, sf_dir):
    return promotion_gate(compare(report(spark, sf_dir), "base", "tuned"))


# --- gold checks -------------------------------------------------------------


def q_gold_check(spark, sf_dir):
    return gold_check(tickets(spark, sf_dir))


def q_gold_lookup(spark, sf_dir):
    t = tickets(spark, sf_dir)
    test = split_fraction_parts(t, SPLIT_FRAC, 0.0)["test"]
    return gold_lookup(t, test)


def q_alignment_faults(spark, sf_dir):
    """Gold and predictions of the test part with faults of every kind put
    in by key: all are found and counted by model."""
    t = tickets(spark, sf_dir)
    test = split_fraction_parts(t, SPLIT_FRAC, 0.0)["test"].select("example_id", "message", "ticket")
    nth = F.col("example_id") % 11
    gold = test.where(nth != 3).withColumn("ticket", F.when(nth == 4, F.col("ticket").withField("issue", F.lit("unheard_of"))).otherwise(F.col("ticket")))
    gold = gold.unionByName(gold.where(nth == 5))
    preds = simulate_models(test, MODELS).where((nth != 6) | (F.col("model") != MODELS[0][0]))
    preds = preds.unionByName(preds.where(nth == 7))
    return alignment_faults(preds, gold, [m[0] for m in MODELS])


def q_alignment_check(spark, sf_dir):
    t = tickets(spark, sf_dir)
    test = split_fraction_parts(t, SPLIT_FRAC, 0.0)["test"]
    return alignment_check(simulate_models(test, MODELS), t)


QUERIES.update(
    {
        "order_id_guard": q_order_id_guard,
        "gate": q_gate,
        "guard_report": q_guard_report,
        "route_prescored": q_route_prescored,
        "served_by": q_served_by,
        "routing_economics": q_routing_economics,
        "escalation_reasons": q_escalation_reasons,
        "experiment_sweep": q_experiment_sweep,
        "pareto_front": q_pareto_front,
        "pareto_documents": q_pareto_documents,
        "curve_plateau": q_curve_plateau,
        "promotion_gate": q_promotion_gate,
        "gold_check": q_gold_check,
        "gold_lookup": q_gold_lookup,
        "alignment_check": q_alignment_check,
        "alignment_faults": q_alignment_faults,
    }
)


# --- model calls, files, end-to-end build, streams --------------------------

CHEAP_FAIL_EVERY = 9  # the local cheap model answers in prose for ~1 in 9 messages


def cheap_predictor():
    return KeywordPredictor(fail_every=CHEAP_FAIL_EVERY)


def strong_predictor():
    return KeywordPredictor()


def q_extract_batch(spark, sf_dir):
    p = extract_batch(tickets(spark, sf_dir).select("example_id", "message"), cheap_predictor, "keyword")
    return p.select("example_id", "model", "raw", "prompt_tokens", "completion_tokens")


def q_extract_ledger(spark, sf_dir):
    """Extraction in two runs on one ledger, the first over the test part
    only: every question has one entry, whichever run asked it."""
    t = tickets(spark, sf_dir).select("example_id", "message")
    book = CallLedger(spark, scratch_path(spark, "extract-ledger"))
    book.call(split_fraction_parts(t, SPLIT_FRAC, 0.0)["test"], cheap_predictor, "keyword")
    answered = book.call(t, cheap_predictor, "keyword")
    entries = book.entries().groupBy("id", "prompt_hash").agg(F.count("*").alias("n_calls"))
    rows = answered.select("example_id", prompt_hash(F.col("message"), SYSTEM_PROMPT).alias("prompt_hash"), F.col("raw").isNotNull().alias("answered"))
    same = (F.col("example_id").cast("string") == F.col("id")) & (rows.prompt_hash == entries.prompt_hash)
    return rows.join(entries, same, "left").select("example_id", rows.prompt_hash, "answered", "n_calls")


def q_route_fallback(spark, sf_dir):
    r = route(tickets(spark, sf_dir), cheap_predictor, strong_predictor)
    return r.select("example_id", "ok", "error", "served_by", "escalation_reason")


def q_jsonl_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "tickets-jsonl")
    write_examples(tickets(spark, sf_dir), path)
    return flat_tickets(read_examples(spark, path))


def q_dataset_build(spark, sf_dir):
    keys = spread(table(spark, sf_dir, "orders").select("o_orderkey"))
    n = keys.count()
    k = int(n * SPLIT_FRAC)
    return build_dataset(keys, "o_orderkey", scratch_path(spark, "dataset"), k, k, seed=GEN_SEED, n_keys=n)


EVENTS_SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def event_tickets_stream(spark, sf_dir) -> DataFrame:
    """The events table as a stream of incoming requests: one generated
    ticket per event (event time kept), answered by the cheap stub model."""
    schema = spark.createDataFrame([], EVENTS_SCHEMA).schema
    ev = read_table_stream(spark, sf_dir, "events", schema)
    gold = generate_examples(ev, key="event_id", seed=GEN_SEED, keep=("ts",))
    return simulate_models(gold, [CHEAP], modes=GUARD_MODES)


def q_stream_validate(spark, sf_dir):
    ensure_conf(spark)
    g = stream_gate(event_tickets_stream(spark, sf_dir))
    out = run_available(
        g.select("example_id", "is_valid", "reason_code", "ok", "error"), "stream-validate", "append"
    )
    return spark.read.parquet(out)


def q_stream_escalation_rate(spark, sf_dir):
    ensure_conf(spark)
    rates = escalation_rate_stream(stream_gate(event_tickets_stream(spark, sf_dir)), "ts")
    # the state holds one row per day-window: a few state partitions suffice
    out = run_available(rates, "stream-escalation", "complete", state_partitions=spark.sparkContext.defaultParallelism)
    r = spark.read.parquet(out)
    return r.select(utc_text(r, "window_start").alias("window_start"), "n", "escalated", "escalation_rate")


def q_stream_windows(spark, sf_dir):
    """Append mode: closed windows with their rates, open ones and late rows."""
    ensure_conf(spark)
    gated = stream_gate(event_tickets_stream(spark, sf_dir))
    r = account_windows(gated, "ts", scratch_path(spark, "stream-windows"), state_partitions=spark.sparkContext.defaultParallelism)
    return r.select(utc_text(r, "window_start").alias("window_start"), "state", "n", "escalated")


QUERIES.update(
    {
        "extract_batch": q_extract_batch,
        "extract_ledger": q_extract_ledger,
        "route_fallback": q_route_fallback,
        "jsonl_roundtrip": q_jsonl_roundtrip,
        "dataset_build": q_dataset_build,
        "stream_validate": q_stream_validate,
        "stream_escalation_rate": q_stream_escalation_rate,
        "stream_windows": q_stream_windows,
    }
)


# --- more operator coverage ---------------------------------------------------


def q_failure_detail_histogram(spark, sf_dir):
    return failure_histogram(validated(spark, sf_dir), by="reason_detail")


def q_gate_null_policy(spark, sf_dir):
    """Guard failures keep the row and null the order id instead of escalating."""
    g = gate(guarded(spark, sf_dir), guard=True, ticket_col="pred", on_fail="null")
    return g.select("model", "example_id", "ok", "error", F.col("pred.order_id").alias("order_id"))


def q_inference_prompts(spark, sf_dir):
    """[system, user] prompts, and [user] only for the prompt-free variant
    (both variants generated from one scan)."""
    t = tickets(spark, sf_dir)
    variants = F.array(
        F.struct(F.lit(True).alias("with_system"), inference_prompt(F.col("message")).alias("p")),
        F.struct(F.lit(False).alias("with_system"), inference_prompt(F.col("message"), None).alias("p")),
    )
    both = t.select("example_id", F.inline(variants))
    return both.select("example_id", "with_system", F.posexplode_outer("p").alias("idx", "m")).select(
        "example_id", "with_system", "idx", F.col("m.role").alias("role"), F.col("m.content").alias("content")
    )


def q_preference_consistency(spark, sf_dir):
    """Both sides of every preference pair must decode to the same ticket."""
    p = preference_pairs(tickets(spark, sf_dir))
    c = validate_outputs(p.select("example_id", "rejected", F.col("chosen").alias("raw")), "raw", into="tc")
    r = validate_outputs(c.select("example_id", "tc", F.col("is_valid").alias("c_ok"), F.col("rejected").alias("raw")),
                         "raw", into="tr")
    same = F.col("c_ok") & F.col("is_valid") & F.col("tc").eqNullSafe(F.col("tr"))
    return r.agg(F.count(F.lit(1)).alias("n_pairs"), F.count_if(~same).alias("n_mismatch"))


def q_evaluate_price_table(spark, sf_dir):
    prices = spark.createDataFrame([(m, i, o) for m, (i, o) in PRICES.items()], "model string, in_price double, out_price double")
    return evaluate(validated(spark, sf_dir), prices=prices, with_map=False)


QUERIES.update(
    {
        "failure_detail_histogram": q_failure_detail_histogram,
        "gate_null_policy": q_gate_null_policy,
        "inference_prompts": q_inference_prompts,
        "preference_consistency": q_preference_consistency,
        "evaluate_price_table": q_evaluate_price_table,
    }
)


def ood_tickets(spark, sf_dir) -> DataFrame:
    cust = spread(table(spark, sf_dir, "customer").select("c_custkey"))
    return generate_ood(cust, key="c_custkey", seed=99)


def q_ood_evaluate(spark, sf_dir):
    """Both stub models scored on the out-of-distribution set."""
    p = simulate_models(ood_tickets(spark, sf_dir), MODELS).withColumnRenamed("ticket", "gold")
    return evaluate(validate_outputs(p, "raw", into="pred"), prices=PRICES, with_map=False)


def q_ood_guard_report(spark, sf_dir):
    """The order-id guard on the out-of-distribution set (wrong ids that parse)."""
    p = simulate_models(ood_tickets(spark, sf_dir), MODELS, modes=GUARD_MODES).withColumnRenamed("ticket", "gold")
    return guard_report(validate_outputs(p, "raw", into="pred"), COST_RATIO, ticket_col="pred")


QUERIES.update({"ood_evaluate": q_ood_evaluate, "ood_guard_report": q_ood_guard_report})


def q_stream_route(spark, sf_dir):
    """Cheap-first routing on a stream: requests from the events stream, both
    models' answers side by side, routed per row (stateless, append mode)."""
    ensure_conf(spark)
    ev = read_table_stream(spark, sf_dir, "events", spark.createDataFrame([], EVENTS_SCHEMA).schema)
    gold = generate_examples(ev, key="event_id", seed=GEN_SEED)
    both = simulate_columns(gold, [CHEAP, STRONG], modes=[GUARD_MODES, DEFAULT_MODES])
    r = route_columns(both, f"raw_{CHEAP[0]}", f"raw_{STRONG[0]}")
    flat = r.select(
        "example_id", "ok", "error", "tokens", "served_by", "escalation_reason",
        *[F.col(f"ticket.{f}").alias(f"t_{f}") for f in TICKET_FIELDS],
    )
    return spark.read.parquet(run_available(flat, "stream-route", "append"))


QUERIES.update({"stream_route": q_stream_route})


TOOL_SEED = 11


def with_injected_tools(df: DataFrame) -> DataFrame:
    """Derive tool traffic from the conversations (the table has none): some
    user and assistant turns become tool results (so runs of tool messages
    occur), some other user turns are wrapped in
    tool_response tags; chosen by seeded hash draws per (conversation, turn)."""
    from quarry.functions import draws

    k = F.col("conv_id") * F.lit(1000) + F.col("turn")
    is_user = F.col("role") == "user"
    to_tool = (is_user | (F.col("role") == "assistant")) & draws.below(TOOL_SEED, k, "tool", 0.3)
    wrap = is_user & ~to_tool & draws.below(TOOL_SEED, k, "wrap", 0.2)
    return df.select(
        "conv_id", "turn",
        F.when(to_tool, F.lit("tool")).otherwise(F.col("role")).alias("role"),
        F.when(wrap, F.concat(F.lit("<tool_response>"), F.col("text"), F.lit("</tool_response>"))).otherwise(F.col("text")).alias("text"),
    )


def q_chat_render_tools(spark, sf_dir):
    return render_chat(with_injected_tools(conversations(spark, sf_dir)))


QUERIES.update({"chat_render_tools": q_chat_render_tools})


def hard_outputs(spark, sf_dir) -> DataFrame:
    """Outputs that a parser gets wrong easily, one per order: the ticket's
    JSON as it is, fenced, followed by prose, twice, listed with a comma, with
    single quotes, with raw tabs in its strings, cut off, and with a value
    outside the contract."""
    ensure_conf(spark)
    t = tickets(spark, sf_dir)
    g = compact_json(F.col("ticket"))
    forms = [
        g, F.concat(F.lit("Sure! Here:\n```json\n"), g, F.lit("\n```")), F.concat(g, F.lit(" Hope that helps.")), F.concat(g, F.lit(" "), g), F.concat(g, F.lit(","), g),
        F.replace(g, F.lit('"'), F.lit("'")), F.replace(g, F.lit(" "), F.lit("\t")), F.substring(g, 1, 30), F.replace(g, F.lit('"priority":"'), F.lit('"priority":"very ')),
    ]
    raw = F.lit(None).cast("string")
    for k, form in enumerate(forms):
        raw = F.when(F.pmod("example_id", F.lit(len(forms))) == k, form).otherwise(raw)
    return t.select("example_id", raw.alias("raw"))


def q_parse_hard(spark, sf_dir):
    v = validate_outputs(hard_outputs(spark, sf_dir), "raw", into="pred")
    return v.select("example_id", "is_valid", "reason_code", "reason_detail", *[F.col(f"pred.{f}").alias(f"p_{f}") for f in TICKET_FIELDS])


def q_route_two_tables(spark, sf_dir):
    """Pre-scored routing of two tables: the strong model's answers were stored
    before and are joined to the cheap model's by the key."""
    ensure_conf(spark)
    gold = tickets(spark, sf_dir)
    stored = written(simulate_models(gold, [STRONG], modes=DEFAULT_MODES).select("example_id", "raw"), "strong-answers")
    r = route_prescored(simulate_models(gold, [CHEAP], modes=GUARD_MODES), stored)
    return r.select("example_id", "ok", "error", "tokens", "served_by", "escalation_reason", *[F.col(f"ticket.{f}").alias(f"t_{f}") for f in TICKET_FIELDS])


QUERIES.update({"parse_hard": q_parse_hard, "route_two_tables": q_route_two_tables})

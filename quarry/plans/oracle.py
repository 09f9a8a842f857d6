"""DuckDB oracle SQL for the registered queries (views named after the
driver's tables). Built from the same fixed values as the Spark code, but
the logic is written independently in SQL."""

from __future__ import annotations

from quarry.contract import SYSTEM_PROMPT
from quarry.operators.chat import EMPTY_THINK, REJECTED_PREAMBLE
from quarry.plans import sqlgen as S
from quarry.plans.queries import (
    CHEAP,
    COSINE_THRESHOLD,
    COST_RATIO,
    EVAL_FRAC,
    GEN_SEED,
    GUARD_MODES,
    HEAD_K,
    MODELS,
    NGRAM_N,
    PLATEAU_EPS,
    PREFIX_KS,
    PRICES,
    SPLIT_FRAC,
    STRONG,
    SWEEP,
    SWEEP_PRICES,
    SWEEP_RATES,
)

TICKETS = S.tickets_sql("orders", "o_orderkey", GEN_SEED)
TICKET_COLS = "example_id, message, order_id, issue, sentiment, priority, summary"
PREDS = S.preds_sql(TICKETS, MODELS)
VALIDATED = S.validated_sql(PREDS)
REPORT = S.report_sql(VALIDATED, PRICES)
P_COLS = "p_order_id, p_issue, p_sentiment, p_priority, p_summary"


def _report_line_sql() -> str:
    fmt = ("n=%d  schema_validity=%.3f  exact_match=%.3f  [order_id=%.2f, issue=%.2f, sentiment=%.2f, "
           "priority=%.2f]  lat=%.0fms  out_tok=%.0f  $%.3f/1k")
    return (f"SELECT model, printf('{fmt}', n, schema_validity, exact_match, acc_order_id, acc_issue, acc_sentiment, "
            f"acc_priority, mean_latency_s * 1000.0, mean_completion_tokens, cost_per_1k_usd) AS line FROM {REPORT} r")


def _ranked(src: str, key: str, order: str = "DESC") -> str:
    return (f"(SELECT s.*, row_number() OVER (ORDER BY {key} {order}) AS rn, count(*) OVER () AS n_all "
            f"FROM {src} s)")


SPLIT = (f"SELECT example_id, CASE WHEN rn <= floor(n_all * {SPLIT_FRAC}::DOUBLE) THEN 'test' "
         f"WHEN rn <= floor(n_all * {SPLIT_FRAC}::DOUBLE) + floor(n_all * {SPLIT_FRAC}::DOUBLE) THEN 'val' ELSE 'train' END AS split "
         f"FROM {_ranked(TICKETS, 'example_id')} r")
LEDGER = (f"SELECT example_id, sha256(concat(sha256({S.q(SYSTEM_PROMPT)}), ':', message)) AS prompt_hash, true AS answered, "
          f"1::BIGINT AS n_calls FROM {TICKETS} t")
SPLIT_SOURCE = f"""
SELECT doc_id, source, CASE WHEN source IS NULL THEN 'train' WHEN rn <= floor(n_all * {SPLIT_FRAC}::DOUBLE) THEN 'test'
  WHEN rn <= 2 * floor(n_all * {SPLIT_FRAC}::DOUBLE) THEN 'val' ELSE 'train' END AS split
FROM (SELECT doc_id, source, row_number() OVER (ORDER BY source DESC NULLS LAST, doc_id DESC) AS rn, count(source) OVER () AS n_all FROM documents) r
"""
PREFIX = " UNION ALL ".join(
    f"SELECT floor(n_all * {k!r}::DOUBLE)::INTEGER AS k, example_id FROM {_ranked(TICKETS, 'example_id', 'ASC')} r "
    f"WHERE rn <= floor(n_all * {k!r}::DOUBLE)"
    for k in PREFIX_KS
)
DOCS_SPLIT = f"""(SELECT doc_id, text, rn <= floor(n_all * {EVAL_FRAC}::DOUBLE) AS is_test FROM {_ranked('documents', 'doc_id')} r)"""
DECON_EXACT = f"""
WITH d AS {DOCS_SPLIT}, te AS (SELECT text FROM d WHERE is_test), tr AS (SELECT * FROM d WHERE NOT is_test)
SELECT doc_id FROM tr WHERE NOT EXISTS (SELECT 1 FROM te WHERE te.text IS NOT DISTINCT FROM tr.text)"""
DECON_COUNTS = f"""
WITH d AS {DOCS_SPLIT}, te AS (SELECT text FROM d WHERE is_test), tr AS (SELECT * FROM d WHERE NOT is_test),
f AS (SELECT doc_id, EXISTS (SELECT 1 FROM te WHERE te.text IS NOT DISTINCT FROM tr.text) AS removed FROM tr)
SELECT (SELECT count(*) FROM tr) AS n_train, (SELECT count(*) FROM te) AS n_test,
       (SELECT count(*) FROM f WHERE removed) AS n_removed, (SELECT count(*) FROM f WHERE NOT removed) AS n_clean"""
DUP_REPORT = """
WITH g AS (SELECT text, count(*) AS c FROM documents GROUP BY text)
SELECT sum(c)::BIGINT AS n_rows, count(*) AS n_distinct, count(*)::DOUBLE / sum(c)::DOUBLE AS distinct_ratio,
       (sum(c) - count(*))::BIGINT AS duplicate_rows, count(*) FILTER (WHERE c > 1) AS duplicate_groups, max(c)::BIGINT AS max_copies
FROM g"""


WORD_RE = r"[^\p{L}\p{N}]+"


def _grams(src: str, key_sel: str, n: int) -> str:
    return f"""(
SELECT DISTINCT {key_sel} array_to_string(w[i:i + {n - 1}], ' ') AS g
FROM (SELECT *, list_filter(regexp_split_to_array(lower(text), '{WORD_RE}'), lambda x: x <> '') AS w FROM {src} s) ww,
     unnest(range(1, len(w) - {n - 2})) AS t(i)
WHERE len(w) >= {n}
)"""


NGRAMS = f"""
SELECT dg.doc_id, count(*) AS shared_ngrams
FROM {_grams('documents', 'doc_id,', NGRAM_N)} dg JOIN {_grams('benchmark', '', NGRAM_N)} eg ON dg.g = eg.g
GROUP BY dg.doc_id"""
KEPT = f"SELECT doc_id, source, md5(text) AS text_md5 FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM ({NGRAMS}) n)"
EMB = f"""
WITH r AS (SELECT vec_id, label, embedding, rn <= floor(n_all * {EVAL_FRAC}::DOUBLE) AS is_test FROM {_ranked('embeddings', 'vec_id')} x),
ev AS (SELECT embedding FROM r WHERE is_test), tr AS (SELECT * FROM r WHERE NOT is_test),
m AS (SELECT tr.vec_id, max(list_dot_product(tr.embedding, ev.embedding)) AS mx FROM tr, ev GROUP BY tr.vec_id)
SELECT tr.vec_id, tr.label FROM tr LEFT JOIN m USING (vec_id) WHERE m.mx IS NULL OR m.mx < {COSINE_THRESHOLD!r}"""


NL = "chr(10)"


def _pretty(prefix: str = "") -> str:
    lines = " || ',' || chr(10) || ".join(
        f"'  \"{f}\": ' || coalesce(to_json({prefix}{f})::VARCHAR, 'null')"
        for f in ["order_id", "issue", "sentiment", "priority", "summary"]
    )
    return f"('{{' || chr(10) || {lines} || chr(10) || '}}')"


CHAT_SFT = f"""
SELECT example_id, 0 AS idx, 'system' AS role, {S.q(SYSTEM_PROMPT)} AS content FROM {TICKETS} t
UNION ALL SELECT example_id, 1, 'user', message FROM {TICKETS} t
UNION ALL SELECT example_id, 2, 'assistant', {S.clean_json()} FROM {TICKETS} t"""
PREF = f"""
SELECT example_id, {S.q(SYSTEM_PROMPT)} AS prompt_system, message AS prompt_user, {S.clean_json()} AS chosen,
       {S.q(REJECTED_PREAMBLE + "```json")} || chr(10) || {_pretty()} || chr(10) || '```' AS rejected
FROM {TICKETS} t"""


def _inject(src: str) -> str:
    return (f"(SELECT conv_id, turn, role, CASE WHEN role = 'assistant' THEN '<think>' || chr(10) || 'reasoning for turn ' || "
            f"CAST(turn AS VARCHAR) || chr(10) || '</think>' || chr(10) || chr(10) || text ELSE text END AS text FROM {src} s)")


def _split_sql(c: str) -> tuple[str, str]:
    answer = f"CASE WHEN contains({c}, '</think>') THEN ltrim(string_split({c}, '</think>')[-1], chr(10)) ELSE {c} END"
    reasoning = (f"CASE WHEN contains({c}, '</think>') THEN ltrim(string_split(rtrim(string_split({c}, '</think>')[1], chr(10)), "
                 f"'<think>')[-1], chr(10)) ELSE '' END")
    return answer, reasoning


def _pieces(src: str) -> str:
    ans, rea = _split_sql("c")
    return f"""(
WITH t AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS c,
         lag(role) OVER w AS prev_role, lead(role) OVER w AS next_role,
         min(turn) OVER p AS first_turn, max(turn) OVER p AS last_turn,
         max(CASE WHEN role = 'user' AND NOT (starts_with(coalesce(text, ''), '<tool_response>')
                  AND ends_with(coalesce(text, ''), '</tool_response>')) THEN turn END) OVER p AS lq
  FROM {src} src WINDOW w AS (PARTITION BY conv_id ORDER BY turn), p AS (PARTITION BY conv_id)
), s AS (SELECT *, {ans} AS answer, {rea} AS reasoning FROM t)
SELECT conv_id, turn, role,
  CASE
    WHEN role IN ('user', 'system') THEN '<|im_start|>' || role || chr(10) || c || '<|im_end|>' || chr(10)
    WHEN role = 'assistant' THEN '<|im_start|>' || role || chr(10) ||
      (CASE WHEN turn > coalesce(lq, last_turn) AND (turn = last_turn OR reasoning <> '')
            THEN '<think>' || chr(10) || trim(reasoning, chr(10)) || chr(10) || '</think>' || chr(10) || chr(10) || ltrim(answer, chr(10))
            ELSE answer END) || '<|im_end|>' || chr(10)
    WHEN role = 'tool' THEN
      (CASE WHEN turn = first_turn OR coalesce(prev_role, '') <> 'tool' THEN '<|im_start|>user' ELSE '' END) ||
      chr(10) || '<tool_response>' || chr(10) || c || chr(10) || '</tool_response>' ||
      (CASE WHEN turn = last_turn OR coalesce(next_role, '') <> 'tool' THEN '<|im_end|>' || chr(10) ELSE '' END)
    ELSE '' END AS piece
FROM s
)"""


def _render(src: str) -> str:
    return f"SELECT conv_id, string_agg(piece, '' ORDER BY turn) AS text FROM {_pieces(src)} p GROUP BY conv_id"


REASONING = (f"SELECT conv_id, turn, {_split_sql('text')[1]} AS reasoning, {_split_sql('text')[0]} AS content "
             f"FROM {_inject('conversations')} x")
GEN_PROMPT = (f"SELECT conv_id, string_agg(piece, '' ORDER BY turn) || '<|im_start|>assistant' || chr(10) || "
              f"{S.q(EMPTY_THINK)} AS prompt FROM {_pieces('conversations')} p GROUP BY conv_id")
SPANS = f"""
SELECT conv_id, turn, span_start, span_end FROM (
  SELECT conv_id, turn, role,
         CAST(coalesce(sum(length(piece)) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
              + length('<|im_start|>assistant') + 1 AS BIGINT) AS span_start,
         CAST(coalesce(sum(length(piece)) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
              + length(piece) - 1 AS BIGINT) AS span_end
  FROM {_pieces('conversations')} p
) x WHERE role = 'assistant'"""


ORACLE = {
    "tickets_generate": f"SELECT * FROM {TICKETS} t",
    "tickets_diverse": f"SELECT * FROM {S.tickets_sql('orders', 'o_orderkey', GEN_SEED, diverse=True, detailed=True)} t",
    "tickets_ood": f"SELECT * FROM {S.ood_sql('customer', 'c_custkey', 99)} t",
    "corrupt_outputs": f"SELECT model, example_id, raw, latency_s, prompt_tokens, completion_tokens FROM {PREDS} p",
    "validate_outputs": f"SELECT model, example_id, is_valid, reason_code, reason_detail, {P_COLS} FROM {VALIDATED} v",
    "failures": f"SELECT model, example_id, message, reason_code, substr(coalesce(raw, ''), 1, 200) AS raw_excerpt FROM {VALIDATED} v WHERE NOT is_valid",
    "failure_histogram": f"SELECT model, reason_code, count(*) AS n_failures FROM {VALIDATED} v WHERE NOT is_valid GROUP BY model, reason_code",
    "evaluate_models": f"SELECT * FROM {REPORT} r",
    "field_accuracy": (
        f"SELECT model, field, accuracy FROM (UNPIVOT (SELECT model, acc_order_id AS order_id, acc_issue AS issue, "
        f"acc_sentiment AS sentiment, acc_priority AS priority FROM {REPORT} r) ON order_id, issue, sentiment, priority "
        f"INTO NAME field VALUE accuracy) u"
    ),
    "compare_models": f"SELECT * FROM {S.compare_sql(REPORT)} c",
    "report_lines": _report_line_sql(),
    "split_tail": SPLIT,
    "extract_ledger": LEDGER,
    "split_by_source": SPLIT_SOURCE,
    "prefix_slices": PREFIX,
    "head_limit": f"SELECT example_id, message FROM {TICKETS} t ORDER BY example_id LIMIT {HEAD_K}",
    "decontaminate_exact": DECON_EXACT,
    "decontamination_counts": DECON_COUNTS,
    "duplicate_report": DUP_REPORT,
    "decontaminate_ngrams": NGRAMS,
    "ngrams_kept": KEPT,
    "decontaminate_embeddings": EMB,
    "chat_sft": CHAT_SFT,
    "preference_pairs": PREF,
    "chat_render": _render("conversations"),
    "chat_generation_prompt": GEN_PROMPT,
    "reasoning_split": REASONING,
    "chat_render_reasoning": _render(_inject("conversations")),
    "assistant_spans": SPANS,
}


# --- guard, gate, routing ----------------------------------------------------

GUARDED = S.validated_sql(S.preds_sql(TICKETS, MODELS, modes=GUARD_MODES))
GUARD_OK = "(p_order_id IS NULL OR contains(message, p_order_id))"
GATED = (f"(SELECT *, is_valid AND {GUARD_OK} AS ok, CASE WHEN NOT is_valid THEN reason_code "
         f"WHEN NOT {GUARD_OK} THEN 'order_id_not_in_message' END AS error, completion_tokens AS tokens FROM {GUARDED} g)")
GUARD_REPORT = f"""
SELECT model, count(*) AS n, count_if(is_valid AND NOT {GUARD_OK}) AS caught,
       count_if(is_valid AND NOT {GUARD_OK})::DOUBLE / count(*) AS caught_rate,
       round_even((count(*) + count_if(is_valid AND NOT {GUARD_OK}) * {COST_RATIO}::DOUBLE) / (count(*) * {COST_RATIO}::DOUBLE), 2) AS cost_vs_all_strong
FROM {GUARDED} g GROUP BY model"""

CHEAP_GATED = (f"(SELECT *, is_valid AND {GUARD_OK} AS ok, CASE WHEN NOT is_valid THEN reason_code "
               f"WHEN NOT {GUARD_OK} THEN 'order_id_not_in_message' END AS error FROM "
               f"{S.validated_sql(S.preds_sql(TICKETS, [CHEAP], modes=GUARD_MODES))} g)")
STRONG_V = S.validated_sql(S.preds_sql(TICKETS, [STRONG]))
_T = ", ".join(f"c.p_{f} AS t_{f}" for f in ["order_id", "issue", "sentiment", "priority", "summary"])
_TS = ", ".join(f"s.p_{f} AS t_{f}" for f in ["order_id", "issue", "sentiment", "priority", "summary"])
ROUTED = f"""(
SELECT c.example_id, TRUE AS ok, NULL::VARCHAR AS error, c.completion_tokens AS tokens, 'tuned_small' AS served_by,
       NULL::VARCHAR AS escalation_reason, {_T}
FROM {CHEAP_GATED} c WHERE c.ok
UNION ALL
SELECT c.example_id, coalesce(s.is_valid, FALSE) AS ok,
       CASE WHEN s.is_valid THEN NULL ELSE coalesce(s.reason_code, 'no_json_object') END AS error,
       NULL::INTEGER AS tokens, 'strong_fallback' AS served_by, c.error AS escalation_reason, {_TS}
FROM {CHEAP_GATED} c LEFT JOIN {STRONG_V} s ON s.example_id = c.example_id WHERE NOT c.ok
)"""
ECON = f"""
SELECT count(*) AS n, count_if(served_by = 'tuned_small') AS served_cheap, count_if(served_by = 'strong_fallback') AS escalated,
       coalesce(count_if(served_by = 'strong_fallback')::DOUBLE / nullif(count(*), 0), 0.0) AS escalation_rate,
       coalesce((count(*) + count_if(served_by = 'strong_fallback') * {COST_RATIO}::DOUBLE) / nullif(count(*) * {COST_RATIO}::DOUBLE, 0), 1.0) AS cost_vs_all_strong,
       coalesce(1.0 - (count(*) + count_if(served_by = 'strong_fallback') * {COST_RATIO}::DOUBLE) / nullif(count(*) * {COST_RATIO}::DOUBLE, 0), 0.0) AS saving_vs_all_strong
FROM {ROUTED} r"""

# --- experiments -------------------------------------------------------------
SWEEP_PREDS = S.preds_sql(TICKETS, SWEEP, extra={"break_rate": SWEEP_RATES})
SWEEP_REPORT = S.report_sql(S.validated_sql(SWEEP_PREDS), SWEEP_PRICES, by=("break_rate", "model"))
PARETO = f"""
WITH r AS (SELECT * FROM {SWEEP_REPORT} x)
SELECT model, break_rate, schema_validity, cost_per_1k_usd FROM r a
WHERE NOT EXISTS (SELECT 1 FROM r b WHERE b.cost_per_1k_usd <= a.cost_per_1k_usd AND b.schema_validity >= a.schema_validity
                  AND (b.cost_per_1k_usd < a.cost_per_1k_usd OR b.schema_validity > a.schema_validity))"""
SLICES = f"(SELECT p.k, t.* FROM ({PREFIX}) p JOIN {TICKETS} t USING (example_id))"
CURVE_REPORT = S.report_sql(S.validated_sql(S.preds_sql(SLICES, [CHEAP])), None, by=("k", "model"))
CURVE = f"""
WITH r AS (SELECT model, k, schema_validity AS value FROM {CURVE_REPORT} x),
g AS (SELECT *, value - lag(value) OVER (PARTITION BY model ORDER BY k) AS gain FROM r)
SELECT model, k, value, gain,
       coalesce(k = min(CASE WHEN gain IS NOT NULL AND gain < {PLATEAU_EPS!r} THEN k END) OVER (PARTITION BY model), FALSE) AS plateau
FROM g"""
PROMOTION = f"""
SELECT metric, base, tuned, tuned - base AS abs_gain, (tuned - base) / nullif(base, 0) AS rel_gain,
       (tuned - base) / nullif(1.0::DOUBLE - base, 0) AS gap_closed, (tuned - base) >= 0.1::DOUBLE AS promote
FROM {S.compare_sql(REPORT)} c WHERE metric IN ('schema_validity', 'exact_match')"""

# --- gold checks -------------------------------------------------------------
GOLD_CHECK = (f"SELECT count(*) AS n_gold, count_if(NOT is_valid) AS n_invalid_gold FROM "
              f"{S.validated_sql(f'(SELECT {S.clean_json()} AS raw FROM {TICKETS} t)')} v")
TEST_IDS = f"(SELECT example_id FROM ({SPLIT}) s WHERE split = 'test')"
GOLD_LOOKUP = f"""
WITH g AS (SELECT message, arg_max({S.clean_json()}, example_id) AS gj FROM {TICKETS} t WHERE example_id IN {TEST_IDS} GROUP BY message)
SELECT t.example_id, coalesce(g.gj, '{{}}') AS gold_json FROM {TICKETS} t LEFT JOIN g USING (message)"""
FAULTS = f"""
SELECT m.model, f.fault, sum(f.n)::BIGINT AS n
FROM {TEST_IDS} t, (VALUES {", ".join(f"('{m[0]}')" for m in MODELS)}) m(model),
  (VALUES (3, 'no gold', 1), (4, 'invalid gold', 1), (5, 'repeated gold key', 2), (6, 'no prediction', 1), (7, 'repeated prediction', 2)) f(nth, fault, n)
WHERE t.example_id % 11 = f.nth AND (f.nth <> 6 OR m.model = '{MODELS[0][0]}') GROUP BY m.model, f.fault"""
ALIGN = f"""
WITH p AS (SELECT model, example_id FROM {S.preds_sql(f'(SELECT * FROM {TICKETS} t WHERE example_id IN {TEST_IDS})', MODELS)} x),
k AS (SELECT model, example_id, count(*) AS np FROM p GROUP BY model, example_id),
j AS (SELECT k.*, t.example_id IS NOT NULL AS g FROM k LEFT JOIN {TICKETS} t USING (example_id))
SELECT model, (SELECT count(*) FROM {TICKETS} t) - count_if(g) AS gold_without_pred, count_if(NOT g) AS pred_without_gold,
       count_if(np > 1) AS duplicate_keys
FROM j GROUP BY model"""

ORACLE.update(
    {
        "order_id_guard": f"SELECT model, example_id, {GUARD_OK} AS guard_ok FROM {GUARDED} g WHERE is_valid",
        "gate": f"SELECT model, example_id, ok, error, tokens FROM {GATED} g",
        "guard_report": GUARD_REPORT,
        "route_prescored": f"SELECT * FROM {ROUTED} r",
        "served_by": f"SELECT served_by, count(*) AS n FROM {ROUTED} r GROUP BY served_by",
        "routing_economics": ECON,
        "escalation_reasons": f"SELECT escalation_reason, count(*) AS n FROM {ROUTED} r WHERE served_by = 'strong_fallback' GROUP BY escalation_reason",
        "experiment_sweep": f"SELECT * FROM {SWEEP_REPORT} r",
        "pareto_front": PARETO,
        "pareto_documents": ("SELECT doc_id, n_chars, source FROM (SELECT doc_id, n_chars, source, max(n_chars) OVER (ORDER BY doc_id "
                             "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS bar FROM documents) r WHERE bar IS NULL OR n_chars > bar"),
        "curve_plateau": CURVE,
        "promotion_gate": PROMOTION,
        "gold_check": GOLD_CHECK,
        "gold_lookup": GOLD_LOOKUP,
        "alignment_check": ALIGN,
        "alignment_faults": FAULTS,
    }
)


# --- files, build, streams ---------------------------------------------------
EV_TICKETS = S.tickets_sql("events", "event_id", GEN_SEED)
EV_GATED = (f"(SELECT *, is_valid AND {GUARD_OK} AS ok, CASE WHEN NOT is_valid THEN reason_code "
            f"WHEN NOT {GUARD_OK} THEN 'order_id_not_in_message' END AS error FROM "
            f"{S.validated_sql(S.preds_sql(EV_TICKETS, [CHEAP], modes=GUARD_MODES))} g)")
STREAM_RATE = f"""
SELECT strftime(date_trunc('day', e.ts), '%Y-%m-%d %H:%M:%S') AS window_start, count(*) AS n,
       count_if(NOT g.ok) AS escalated, count_if(NOT g.ok)::DOUBLE / count(*) AS escalation_rate
FROM {EV_GATED} g JOIN events e ON e.event_id = g.example_id GROUP BY 1"""
STREAM_WINDOWS = f"""
SELECT strftime(date_trunc('day', e.ts), '%Y-%m-%d %H:%M:%S') AS window_start,
       CASE WHEN date_trunc('day', e.ts) + INTERVAL 1 DAY <= (SELECT max(ts) - INTERVAL 1 DAY FROM events) THEN 'closed' ELSE 'open' END AS state,
       count(*) AS n, count_if(NOT g.ok)::BIGINT AS escalated
FROM {EV_GATED} g JOIN events e ON e.event_id = g.example_id WHERE e.ts IS NOT NULL GROUP BY 1, 2"""
BUILD = f"""
WITH s AS (
  SELECT example_id, message,
         CASE WHEN rn <= floor(n_all * {SPLIT_FRAC}::DOUBLE) THEN 'test'
              WHEN rn <= 2 * floor(n_all * {SPLIT_FRAC}::DOUBLE) THEN 'val' ELSE 'train' END AS split, n_all
  FROM {_ranked(TICKETS, 'example_id')} r
), rm AS (
  SELECT count(*) AS removed FROM s tr WHERE tr.split = 'train'
    AND EXISTS (SELECT 1 FROM s te WHERE te.split = 'test' AND te.message IS NOT DISTINCT FROM tr.message)
)
SELECT max(n_all) AS n_examples, count_if(split = 'train') - max(rm.removed) AS n_train, count_if(split = 'val') AS n_val,
       count_if(split = 'test') AS n_test, max(rm.removed) AS n_removed
FROM s, rm"""

ORACLE.update(
    {
        "jsonl_roundtrip": f"SELECT * FROM {TICKETS} t",
        "dataset_build": BUILD,
        "stream_validate": f"SELECT example_id, is_valid, reason_code, ok, error FROM {EV_GATED} g",
        "stream_escalation_rate": STREAM_RATE,
        "stream_windows": STREAM_WINDOWS,
    }
)


# --- more operator coverage ---------------------------------------------------
GATE_NULL = f"""
SELECT model, example_id, is_valid AS ok, CASE WHEN NOT is_valid THEN reason_code END AS error,
       CASE WHEN is_valid AND {GUARD_OK} THEN p_order_id END AS order_id
FROM {GUARDED} g"""
PROMPTS = f"""
SELECT example_id, TRUE AS with_system, 0 AS idx, 'system' AS role, {S.q(SYSTEM_PROMPT)} AS content FROM {TICKETS} t
UNION ALL SELECT example_id, TRUE, 1, 'user', message FROM {TICKETS} t
UNION ALL SELECT example_id, FALSE, 0, 'user', message FROM {TICKETS} t"""
PREF_PAIRS_RAW = f"""(SELECT example_id, {S.clean_json()} AS raw,
       {S.q(REJECTED_PREAMBLE + "```json")} || chr(10) || {_pretty()} || chr(10) || '```' AS rejected FROM {TICKETS} t)"""
PREF_CONSIST = f"""
WITH c AS (SELECT * FROM {S.validated_sql(PREF_PAIRS_RAW, prefix='c_')} x),
r AS (SELECT * FROM {S.validated_sql(f'(SELECT example_id, rejected AS raw FROM {PREF_PAIRS_RAW} y)', prefix='r_')} z)
SELECT count(*) AS n_pairs,
       count_if(NOT (c.is_valid AND r.is_valid AND c.c_order_id IS NOT DISTINCT FROM r.r_order_id AND c.c_issue = r.r_issue
                     AND c.c_sentiment = r.r_sentiment AND c.c_priority = r.r_priority AND c.c_summary = r.r_summary)) AS n_mismatch
FROM c JOIN r USING (example_id)"""

ORACLE.update(
    {
        "failure_detail_histogram": f"SELECT model, reason_detail, count(*) AS n_failures FROM {VALIDATED} v WHERE NOT is_valid GROUP BY model, reason_detail",
        "gate_null_policy": GATE_NULL,
        "inference_prompts": PROMPTS,
        "preference_consistency": PREF_CONSIST,
        "evaluate_price_table": f"SELECT * FROM {REPORT} r",
    }
)


# Floating-point columns are compared at 6 decimals (sums and averages may
# differ in the last bit between engines); both sides round these columns.
ROUND_DIGITS = 6
DOUBLE_COLUMNS = {
    "corrupt_outputs": ["latency_s"],
    "evaluate_models": ["schema_validity", "exact_match", "acc_order_id", "acc_issue", "acc_sentiment", "acc_priority",
                        "mean_latency_s", "mean_prompt_tokens", "mean_completion_tokens", "cost_per_1k_usd"],
    "field_accuracy": ["accuracy"],
    "compare_models": ["base", "tuned", "delta"],
    "duplicate_report": ["distinct_ratio"],
    "guard_report": ["caught_rate", "cost_vs_all_strong"],
    "routing_economics": ["escalation_rate", "cost_vs_all_strong", "saving_vs_all_strong"],
    "experiment_sweep": ["break_rate", "schema_validity", "exact_match", "acc_order_id", "acc_issue", "acc_sentiment",
                         "acc_priority", "mean_latency_s", "mean_prompt_tokens", "mean_completion_tokens", "cost_per_1k_usd"],
    "pareto_front": ["break_rate", "schema_validity", "cost_per_1k_usd"],
    "curve_plateau": ["value", "gain"],
    "promotion_gate": ["base", "tuned", "abs_gain", "rel_gain", "gap_closed"],
    "stream_escalation_rate": ["escalation_rate"],
    "evaluate_price_table": ["schema_validity", "exact_match", "acc_order_id", "acc_issue", "acc_sentiment",
                             "acc_priority", "mean_latency_s", "mean_prompt_tokens", "mean_completion_tokens",
                             "cost_per_1k_usd"],
}


def rounded_sql(name: str, sql: str) -> str:
    cols = DOUBLE_COLUMNS.get(name)
    if not cols:
        return sql
    rep = ", ".join(f"round({c}, {ROUND_DIGITS}) AS {c}" for c in cols)
    return f"SELECT * REPLACE ({rep}) FROM ({sql}) AS _q"


# --- out-of-distribution experiments ----------------------------------------
OOD = S.ood_sql("customer", "c_custkey", 99)
OOD_GUARDED = S.validated_sql(S.preds_sql(OOD, MODELS, modes=GUARD_MODES))
ORACLE.update(
    {
        "ood_evaluate": f"SELECT * FROM {S.report_sql(S.validated_sql(S.preds_sql(OOD, MODELS)), PRICES)} r",
        "ood_guard_report": GUARD_REPORT.replace(GUARDED, OOD_GUARDED),
    }
)
DOUBLE_COLUMNS.update(
    {
        "ood_evaluate": DOUBLE_COLUMNS["evaluate_models"],
        "ood_guard_report": DOUBLE_COLUMNS["guard_report"],
    }
)


# --- routing on a stream ---------------------------------------------------------
EV_CHEAP_GATED = CHEAP_GATED.replace(TICKETS, EV_TICKETS)
EV_STRONG_V = STRONG_V.replace(TICKETS, EV_TICKETS)
ORACLE.update({"stream_route": f"SELECT * FROM {ROUTED.replace(CHEAP_GATED, EV_CHEAP_GATED).replace(STRONG_V, EV_STRONG_V)} r"})


# --- rendering with derived tool traffic ------------------------------------------
def _tools(src: str) -> str:
    from quarry.plans.queries import TOOL_SEED

    k = "(conv_id * 1000 + turn)"
    two32 = 4294967296
    to_tool = f"(role IN ('user', 'assistant') AND {S.sql_u32(TOOL_SEED, k, 'tool')} < 0.3::DOUBLE * {two32})"
    wrap = f"(role = 'user' AND NOT {to_tool} AND {S.sql_u32(TOOL_SEED, k, 'wrap')} < 0.2::DOUBLE * {two32})"
    return (f"(SELECT conv_id, turn, CASE WHEN {to_tool} THEN 'tool' ELSE role END AS role, "
            f"CASE WHEN {wrap} THEN '<tool_response>' || text || '</tool_response>' ELSE text END AS text FROM {src} s)")


ORACLE.update({"chat_render_tools": _render(_tools("conversations"))})


# --- hard outputs and two-table routing --------------------------------------------
_HARD_FORMS = [
    "g", "'Sure! Here:' || chr(10) || '```json' || chr(10) || g || chr(10) || '```'", "g || ' Hope that helps.'", "g || ' ' || g", "g || ',' || g",
    "replace(g, '\"', '''')", "replace(g, ' ', chr(9))", "substr(g, 1, 30)", "replace(g, '\"priority\":\"', '\"priority\":\"very ')",
]
HARD = (f"(SELECT example_id, CASE example_id % {len(_HARD_FORMS)} " + " ".join(f"WHEN {k} THEN {form}" for k, form in enumerate(_HARD_FORMS))
        + f" END AS raw FROM (SELECT example_id, {S.clean_json()} AS g FROM {TICKETS} t) t)")
ORACLE.update({
    "parse_hard": f"SELECT example_id, is_valid, reason_code, reason_detail, {P_COLS} FROM {S.validated_sql(HARD)} v",
    "route_two_tables": f"SELECT * FROM {ROUTED} r",
})

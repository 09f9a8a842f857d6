"""Small helpers to write the DuckDB oracle SQL from the same fixed values
the Spark operators use (so the oracle checks logic, not copied constants)."""

from __future__ import annotations

from quarry.contract import ISSUES, TICKET
from quarry.functions.draws import sql_u32
from quarry.operators.corrupt import (
    BAD_PRIORITY,
    DEFAULT_MODES,
    FENCE_CLOSE,
    FENCE_PREAMBLE,
    PROSE_REPLY,
    STUB_COMPLETION_TOKENS,
    STUB_LATENCY_S,
    STUB_PROMPT_TOKENS,
)
from quarry.functions.templates import (
    CLOSINGS,
    DETAILED_SUMMARIES,
    GREETINGS,
    NO_ID_PATTERNS,
    NO_ID_TEXT,
    SUMMARIES,
    pool_rows,
)


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def lit_sql(v) -> str:
    """A literal typed the way ``F.lit`` types it in Spark."""
    if isinstance(v, bool):
        return "TRUE" if v else "FALSE"
    if isinstance(v, int):
        return f"{v}::INTEGER"
    if isinstance(v, float):
        return f"{v!r}::DOUBLE"
    return q(str(v))


def lst(values) -> str:
    return "[" + ", ".join(q(v) if isinstance(v, str) else str(v) for v in values) + "]"


def pick(seed, key_sql: str, axis: str, k_sql) -> str:
    return f"({sql_u32(seed, key_sql, axis)} % ({k_sql}))"


def fill(template_sql: str, oid_sql: str) -> str:
    no_id = template_sql
    for p in NO_ID_PATTERNS:
        no_id = f"replace({no_id}, {q(p)}, {q(NO_ID_TEXT)})"
    return f"(CASE WHEN {oid_sql} IS NOT NULL AND {oid_sql} <> '' THEN replace({template_sql}, '{{oid}}', {oid_sql}) ELSE {no_id} END)"


def vary(g: str, core: str, c: str) -> str:
    return f"((CASE WHEN {g} = '' THEN {core} ELSE {g} || lower(substr({core}, 1, 1)) || substr({core}, 2) END) || {c})"


def summary(issue_sql: str, oid_sql: str, detailed: bool) -> str:
    table = DETAILED_SUMMARIES if detailed else SUMMARIES
    s = f"list_extract({lst([table[i] for i in ISSUES])}, list_position({lst(ISSUES)}, {issue_sql}))"
    return fill(s, oid_sql) if detailed else s


def tickets_sql(source: str, key: str, seed: int = 7, diverse: bool = False, detailed: bool = False) -> str:
    """SELECT example_id, message, order_id, issue, sentiment, priority, summary."""
    rows = pool_rows(("base", "diverse") if diverse else ("base",))
    counts = [sum(1 for r in rows if r[1] == i) for i in ISSUES]
    offsets = [sum(counts[:j]) for j in range(len(ISSUES))]
    two32 = 4294967296
    return f"""(
WITH d0 AS (
  SELECT CAST({key} AS BIGINT) AS example_id,
         {pick(seed, key, 'issue', len(ISSUES))} AS issue_idx
  FROM {source}
), d1 AS (
  SELECT example_id, issue_idx,
         list_extract({lst(offsets)}, issue_idx + 1) + {pick(seed, 'example_id', 'template', f'list_extract({lst(counts)}, issue_idx + 1)')} AS flat
  FROM d0
), d2 AS (
  SELECT example_id,
         list_extract({lst(ISSUES)}, issue_idx + 1) AS issue,
         list_extract({lst([r[3] for r in rows])}, flat + 1) AS template,
         list_extract({lst([r[4] for r in rows])}, flat + 1) AS sentiment,
         list_extract({lst([r[5] for r in rows])}, flat + 1) AS priority,
         {sql_u32(seed, 'example_id', 'has_oid')} < 0.15::DOUBLE * {two32} AS no_id,
         CAST(10000 + {pick(seed, 'example_id', 'oid', 90000)} AS VARCHAR) AS oid_all,
         list_extract({lst(GREETINGS)}, {pick(seed, 'example_id', 'greeting', len(GREETINGS))} + 1) AS g,
         list_extract({lst(CLOSINGS)}, {pick(seed, 'example_id', 'closing', len(CLOSINGS))} + 1) AS c
  FROM d1
), d3 AS (
  SELECT *, CASE WHEN contains(template, '{{oid}}') AND NOT no_id THEN oid_all END AS order_id FROM d2
)
SELECT example_id,
       {vary('g', fill('template', 'order_id'), 'c')} AS message,
       order_id, issue, sentiment, priority,
       {summary('issue', 'order_id', detailed)} AS summary
FROM d3
)"""


# --- stub predictions, validation and scoring -------------------------------

PY_SPACE_RE2 = r"[\x{9}-\x{d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def py_strip(expr: str) -> str:
    return f"regexp_replace({expr}, '^{PY_SPACE_RE2}+|{PY_SPACE_RE2}+$', '', 'g')"


def clean_json(prefix: str = "") -> str:
    p = prefix
    return (
        f"to_json(struct_pack(order_id := {p}order_id, issue := {p}issue, sentiment := {p}sentiment, "
        f"priority := {p}priority, summary := {p}summary))::VARCHAR"
    )


def corrupt_case(clean: str, mode: str, oid: str) -> str:
    bad = f"replace(replace({clean}, '\"priority\":\"high\"', '\"priority\":\"{BAD_PRIORITY}\"'), '\"priority\":\"medium\"', '\"priority\":\"{BAD_PRIORITY}\"')"
    rot = f"(substr({oid}, length({oid}), 1) || substr({oid}, 1, length({oid}) - 1))"
    blend = (f"(CASE WHEN {oid} IS NOT NULL AND length({oid}) > 1 THEN replace({clean}, '\"order_id\":\"' || {oid} || '\"', "
             f"'\"order_id\":\"' || {rot} || '\"') ELSE {clean} END)")
    return (
        f"(CASE {mode} WHEN 'prose' THEN {q(PROSE_REPLY)} "
        f"WHEN 'truncated' THEN substr({clean}, 1, greatest(8, length({clean}) // 2)) "
        f"WHEN 'bad_enum' THEN {bad} "
        f"WHEN 'fenced' THEN {q(FENCE_PREAMBLE)} || {clean} || {q(FENCE_CLOSE)} "
        f"WHEN 'digit_blend' THEN {blend} ELSE {clean} END)"
    )


def preds_sql(gold_sql: str, configs, modes=DEFAULT_MODES, extra: dict | None = None) -> str:
    """Gold columns + model, raw, latency_s, prompt_tokens, completion_tokens."""
    extra = extra or {}
    parts = []
    for i, (m, rate, seed) in enumerate(configs):
        ex = "".join(f", {lit_sql(v[i])} AS {name}" for name, v in extra.items())
        two32 = 4294967296
        u_break = sql_u32(seed, "g.example_id", "break")
        mode = f"list_extract({lst(modes)}, {pick(seed, 'g.example_id', 'mode', len(modes))} + 1)"
        parts.append(
            f"SELECT g.*{ex}, {q(m)} AS model, "
            f"CASE WHEN {u_break} < {float(rate)}::DOUBLE * {two32} THEN {corrupt_case('g.clean', mode, 'g.order_id')} ELSE g.clean END AS raw, "
            f"{STUB_LATENCY_S}::DOUBLE AS latency_s, {STUB_PROMPT_TOKENS}::INTEGER AS prompt_tokens, "
            f"{STUB_COMPLETION_TOKENS}::INTEGER AS completion_tokens "
            f"FROM (SELECT *, {clean_json()} AS clean FROM {gold_sql} gg) g"
        )
    return "(" + " UNION ALL ".join(parts) + ")"


def validated_sql(src: str, contract=TICKET, prefix: str = "p_") -> str:
    """src columns + is_valid, reason_code, reason_detail, p_<field>."""
    errs = []
    vals = []
    for f in contract.fields:
        t = f"json_type(j, '$.{f.name}')"
        s = f"json_extract_string(j, '$.{f.name}')"
        if f.kind == "optional_string":
            errs.append(f"CASE WHEN {t} IS NOT NULL AND {t} NOT IN ('VARCHAR', 'NULL') THEN {q(f.name + ': input should be a string or null')} END")
            vals.append(f"CASE WHEN {t} = 'VARCHAR' THEN {s} END AS {prefix}{f.name}")
        elif f.kind == "enum":
            allowed = ", ".join(f"'{a}'" for a in f.allowed)
            errs.append(
                f"CASE WHEN {t} IS NULL THEN {q(f.name + ': field required')} "
                f"WHEN {t} <> 'VARCHAR' OR {s} NOT IN ({allowed}) THEN {q(f.name + ': input should be one of ' + allowed)} END"
            )
            vals.append(f"{s} AS {prefix}{f.name}")
        else:
            errs.append(
                f"CASE WHEN {t} IS NULL THEN {q(f.name + ': field required')} "
                f"WHEN {t} <> 'VARCHAR' THEN {q(f.name + ': input should be a string')} "
                f"WHEN {py_strip(s)} = '' THEN {q(f.name + ': must be non-empty')} END"
            )
            vals.append(f"{py_strip(s)} AS {prefix}{f.name}")
    schema_err = "coalesce(" + ", ".join(errs) + ")"
    code = (
        "CASE WHEN NOT has_obj THEN 'no_json_object' WHEN NOT decoded THEN 'invalid_json' "
        f"WHEN {schema_err} IS NOT NULL THEN 'schema_violation' END"
    )
    detail = (
        "CASE WHEN NOT has_obj THEN 'no braces around a JSON object' WHEN NOT decoded THEN 'not exactly one JSON value' "
        f"ELSE {schema_err} END"
    )
    sel_vals = ", ".join(
        f"CASE WHEN {schema_err} IS NULL AND has_obj AND decoded THEN {v.rsplit(' AS ', 1)[0]} END AS {v.rsplit(' AS ', 1)[1]}"
        for v in vals
    )
    return f"""(
WITH v0 AS (SELECT *, {py_strip('coalesce(raw, \'\')')} AS _s FROM {src} src),
v1 AS (SELECT *, strpos(_s, '{{') AS _l,
        CASE WHEN strpos(reverse(_s), '}}') > 0 THEN length(_s) - strpos(reverse(_s), '}}') + 1 ELSE 0 END AS _r,
        starts_with(_s, '```') AS _fenced FROM v0),
v2 AS (SELECT *, _l > 0 AND _r > 0 AND NOT (_fenced AND _r < _l) AS has_obj,
        CASE WHEN _r >= _l THEN substr(_s, _l, _r - _l + 1) ELSE '' END AS _cand FROM v1),
v3 AS (SELECT *, has_obj AND coalesce(json_valid(_cand), false) AND json_type(CASE WHEN json_valid(_cand) THEN _cand ELSE '1' END) = 'OBJECT' AS decoded FROM v2),
v4 AS (SELECT *, CASE WHEN decoded THEN _cand ELSE '{{}}' END AS j FROM v3),
v5 AS (SELECT * EXCLUDE (_s, _l, _r, _fenced, _cand), {code} AS reason_code, {detail} AS reason_detail, {sel_vals} FROM v4)
SELECT * EXCLUDE (j, has_obj, decoded), reason_code IS NULL AS is_valid FROM v5
)"""


def ood_sql(source: str, key: str, seed: int = 99) -> str:
    from quarry.operators.generate import ood_rows

    rows = ood_rows()
    n = len(rows)
    vals = ", ".join(f"({i}, {q(r[1])}, {q(r[2])}, {q(r[3])}, {q(r[4])})" for i, r in enumerate(rows))
    return f"""(
WITH t(pos, issue, template, sentiment, priority) AS (VALUES {vals}),
x AS (SELECT CAST(s.{key} AS BIGINT) * {n} + t.pos AS example_id, t.* FROM {source} s, t),
y AS (SELECT *, CASE WHEN contains(template, '{{oid}}') THEN CAST(10000 + {pick(seed, 'example_id', 'oid', 90000)} AS VARCHAR) END AS order_id FROM x)
SELECT example_id, {fill('template', 'order_id')} AS message, order_id, issue, sentiment, priority,
       {summary('issue', 'order_id', False)} AS summary
FROM y
)"""


def report_sql(validated: str, prices: dict | None, by=("model",), contract=TICKET) -> str:
    """Per-group report with the same columns as ``evaluate(with_map=False)``."""
    g = ", ".join(by)
    exact = " AND ".join(
        [
            f"p_{f.name} IS NOT DISTINCT FROM {py_strip(f.name) if f.kind == 'text' else f.name}"
            for f in contract.fields
        ]
    )
    accs = ", ".join(
        f"coalesce(count_if(is_valid AND p_{f} IS NOT DISTINCT FROM {f})::DOUBLE / nullif(count_if(is_valid), 0), 0.0) AS acc_{f}"
        for f in contract.scored_fields
    )
    if prices:
        pin = "CASE model " + " ".join(f"WHEN {q(m)} THEN {float(i)!r}::DOUBLE" for m, (i, _) in prices.items()) + " ELSE 0.0 END"
        pout = "CASE model " + " ".join(f"WHEN {q(m)} THEN {float(o)!r}::DOUBLE" for m, (_, o) in prices.items()) + " ELSE 0.0 END"
    else:
        pin = pout = "0.0::DOUBLE"
    return f"""(
SELECT {g}, count(*) AS n,
       count_if(is_valid)::DOUBLE / count(*) AS schema_validity,
       count_if(is_valid AND {exact})::DOUBLE / count(*) AS exact_match,
       {accs},
       avg(latency_s) AS mean_latency_s,
       avg(prompt_tokens) AS mean_prompt_tokens,
       avg(completion_tokens) AS mean_completion_tokens,
       1000.0::DOUBLE * (avg(prompt_tokens) * {pin} + avg(completion_tokens) * {pout}) AS cost_per_1k_usd
FROM {validated} vv GROUP BY {g}
)"""


def compare_sql(report: str, base: str = "base", tuned: str = "tuned") -> str:
    return f"""(
WITH r AS (SELECT * FROM {report} rr),
l AS (
  SELECT model, 'schema_validity' AS metric, schema_validity AS v FROM r
  UNION ALL SELECT model, 'exact_match', exact_match FROM r
  UNION ALL SELECT model, 'mean_latency_ms', mean_latency_s * 1000.0 FROM r
  UNION ALL SELECT model, 'cost_per_1k_usd', cost_per_1k_usd FROM r
),
w AS (SELECT metric, max(v) FILTER (WHERE model = {q(base)}) AS base, max(v) FILTER (WHERE model = {q(tuned)}) AS tuned FROM l GROUP BY metric)
SELECT metric, base, tuned, tuned - base AS delta FROM w
UNION ALL
SELECT 'cost_reduction_pct', base, tuned, 100.0 * (1.0 - tuned / base) FROM w WHERE metric = 'cost_per_1k_usd' AND base > 0
)"""

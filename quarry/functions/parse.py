"""Strict parse of raw model output into a contract-checked struct.

All built-in expressions (no UDF). Rules, in the order they are applied:

1. ``s`` = Unicode-stripped raw (null counts as empty).
2. No ``{`` or no ``}`` -> ``no_json_object``. A fenced reply (starts with
   three backticks) whose last ``}`` comes before its first ``{`` is also
   ``no_json_object``; unfenced, that shape is an empty candidate and so
   ``invalid_json``. Otherwise the candidate is ``s[first { .. last }]``.
3. The candidate must be exactly one JSON value. ``try_parse_json`` alone
   accepts trailing data, so the candidate is wrapped as
   ``[cand, "<sentinel>"]``: it decodes to a two-element array ending in the
   sentinel only when the candidate is a single complete value.
4. Field checks use the variant's own type (``schema_of_variant``), because
   ``from_json`` would coerce numbers and booleans into strings.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column
from pyspark.sql import functions as F

from quarry.contract import TICKET, Contract
from quarry.functions.text import py_strip

# The parser ignores trailing data, so a candidate that itself contained the
# sentinel could close the wrapper array early. The sentinels are random per
# process, a candidate containing the one in use is rejected as undecodable,
# and a second sentinel is used when it contains the first (say, in a string).
SENTINEL = "~qv-" + uuid.uuid4().hex + "~"
SENTINEL_2 = "~qv-" + uuid.uuid4().hex + "~"

NO_JSON = "no_json_object"
INVALID_JSON = "invalid_json"
SCHEMA_VIOLATION = "schema_violation"


def candidate_columns(raw: Column) -> dict[str, Column]:
    """Stage 1: stripped text, brace positions and the JSON candidate."""
    s = py_strip(F.coalesce(raw, F.lit("")))
    return {"_s": s}


def candidate_span_columns() -> dict[str, Column]:
    """Stage 2 (reads ``_s``): has-object flag and the candidate text."""
    s = F.col("_s")
    left = F.instr(s, "{")
    right = F.length(s) - F.length(F.substring_index(s, "}", -1))  # 0 without a brace
    fenced = s.startswith("```")
    has_obj = (left > 0) & (right > 0) & ~(fenced & (right < left))
    cand = F.when(right >= left, F.substring(s, left, right - left + 1)).otherwise(F.lit(""))
    return {"_has_obj": has_obj, "_cand": cand}


def decode_columns() -> dict[str, Column]:
    """Stage 3 (reads ``_cand``): the sentinel in use, whether the candidate
    is free of it, and the decoded variant of the wrapped candidate."""
    cand = F.col("_cand")
    has1 = F.contains(cand, F.lit(SENTINEL))
    sent = F.when(has1, F.lit(SENTINEL_2)).otherwise(F.lit(SENTINEL))
    sent_ok = ~has1 | ~F.contains(cand, F.lit(SENTINEL_2))
    wrapped = F.concat(F.lit("["), cand, F.lit(',"'), sent, F.lit('"]'))
    return {
        "_sent_ok": sent_ok,
        "_sent": sent,
        "_v": F.when(F.col("_has_obj"), F.try_parse_json(wrapped)),
    }


def object_columns(contract: Contract = TICKET) -> dict[str, Column]:
    """Stage 3 (reads ``_v``): the candidate's contract fields as variants,
    taken in one walk over the object."""
    kind = ", ".join(f"`{f.name}` variant" for f in contract.fields)
    return {"_f": F.try_variant_get(F.col("_v"), "$[0]", f"struct<{kind}>")}


def field_columns(contract: Contract = TICKET) -> dict[str, Column]:
    """Stage 3 (reads ``_v`` and ``_f``): decode flag, per-field variant type
    and text."""
    v = F.col("_v")
    # Decoded iff the array is [candidate, sentinel] and the sentinel can only
    # be ours. The candidate starts with "{", so the single value is an object.
    ok = F.coalesce(
        F.col("_sent_ok")
        & (F.try_variant_get(v, "$[1]", "string") == F.col("_sent"))
        & F.try_variant_get(v, "$[2]", "variant").isNull(),
        F.lit(False),
    )
    out = {"_decoded": ok}
    for f in contract.fields:
        x = F.col("_f")[f.name]
        out[f"_t_{f.name}"] = F.schema_of_variant(x)
        out[f"_s_{f.name}"] = F.try_variant_get(x, "$", "string")
    return out


def _field_error(f) -> Column:
    t = F.col(f"_t_{f.name}")
    s = F.col(f"_s_{f.name}")
    if f.kind == "optional_string":
        return F.when(t.isNotNull() & ~t.isin("VOID", "STRING"), F.lit(f"{f.name}: input should be a string or null"))
    if f.kind == "enum":
        allowed = ", ".join(f"'{a}'" for a in f.allowed)
        return F.when(t.isNull(), F.lit(f"{f.name}: field required")).when(
            (t != "STRING") | ~s.isin(*f.allowed), F.lit(f"{f.name}: input should be one of {allowed}")
        )
    return (
        F.when(t.isNull(), F.lit(f"{f.name}: field required"))
        .when(t != "STRING", F.lit(f"{f.name}: input should be a string"))
        .when(py_strip(s) == "", F.lit(f"{f.name}: must be non-empty"))
    )


def _field_value(f) -> Column:
    t = F.col(f"_t_{f.name}")
    s = F.col(f"_s_{f.name}")
    if f.kind == "optional_string":
        return F.when(t == "STRING", s)
    if f.kind == "text":
        return py_strip(s)
    return s


def schema_error_column(contract: Contract = TICKET) -> dict[str, Column]:
    """Stage 4: the first field error in contract order (null if none)."""
    return {"_schema_err": F.coalesce(*[_field_error(f) for f in contract.fields])}


def code_column() -> dict[str, Column]:
    """Stage 5: the reason code."""
    code = (
        F.when(~F.col("_has_obj"), F.lit(NO_JSON))
        .when(~F.col("_decoded"), F.lit(INVALID_JSON))
        .when(F.col("_schema_err").isNotNull(), F.lit(SCHEMA_VIOLATION))
    )
    return {"reason_code": code}


def result_columns(contract: Contract = TICKET, code: Column | None = None) -> dict[str, Column]:
    """Detail and the typed struct (null unless ``code`` is null)."""
    code = F.col("reason_code") if code is None else code
    detail = (
        F.when(~F.col("_has_obj"), F.lit("no braces around a JSON object"))
        .when(~F.col("_decoded"), F.lit("not exactly one JSON value"))
        .otherwise(F.col("_schema_err"))
    )
    ticket = F.when(
        code.isNull(), F.struct(*[_field_value(f).alias(f.name) for f in contract.fields])
    )
    return {"reason_detail": detail, "ticket": ticket}


def temp_columns(contract: Contract = TICKET) -> list[str]:
    cols = ["_s", "_has_obj", "_cand", "_sent_ok", "_sent", "_v", "_f", "_decoded", "_schema_err"]
    for f in contract.fields:
        cols += [f"_t_{f.name}", f"_s_{f.name}"]
    return cols

"""Model calls over a table, and routing that only calls the strong model on
the rows the cheap one could not serve.

A predictor factory is a picklable zero-argument callable returning an object
with ``predict(messages: pandas.Series) -> pandas.DataFrame`` (columns raw,
latency_s, prompt_tokens, completion_tokens). One predictor is built per task
and reused for all its Arrow batches. Routing keeps the answers of paid calls
in a call ledger (see ``ledger``), so a lost executor, a second action or a
second run never calls the model again for rows whose task had ended.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.contract import SYSTEM_PROMPT, TICKET
from quarry.operators.route import served_cheap_rows, strong_rows
from quarry.operators.validate import gate, validate_outputs

PRED_FIELDS = [
    T.StructField("model", T.StringType(), False),
    T.StructField("raw", T.StringType(), True),
    T.StructField("latency_s", T.DoubleType(), True),
    T.StructField("prompt_tokens", T.IntegerType(), True),
    T.StructField("completion_tokens", T.IntegerType(), True),
]


def extract_batch(df: DataFrame, predictor_factory, model: str, message: str = "message",
                  system_prompt: str = SYSTEM_PROMPT) -> DataFrame:
    """Input columns + model, raw, latency_s, prompt_tokens, completion_tokens.

    Null content becomes "" and missing usage 0, as the reference's client
    wrapper does. Concurrency is the number of tasks."""
    from quarry.session import ship_package

    ship_package(df.sparkSession)
    schema = T.StructType(list(df.schema.fields) + PRED_FIELDS)
    out_cols = [f.name for f in df.schema.fields] + [f.name for f in PRED_FIELDS]

    def run(batches):
        import pandas as pd

        predictor = predictor_factory()
        for pdf in batches:
            if len(pdf) == 0:
                continue
            res = predictor.predict(pdf[message].fillna(""), system_prompt=system_prompt)
            res = pd.DataFrame(res).reset_index(drop=True)
            out = pdf.reset_index(drop=True).copy()
            out["model"] = model
            out["raw"] = res.get("raw", pd.Series([""] * len(pdf))).fillna("").astype(str)
            out["latency_s"] = res.get("latency_s", pd.Series([0.0] * len(pdf))).astype("float64")
            out["prompt_tokens"] = res.get("prompt_tokens", pd.Series([0] * len(pdf))).fillna(0).astype("int32")
            out["completion_tokens"] = res.get("completion_tokens", pd.Series([0] * len(pdf))).fillna(0).astype("int32")
            yield out[out_cols]

    return df.mapInPandas(run, schema)


def route(df: DataFrame, cheap_factory, strong_factory, key: str = "example_id", message: str = "message",
          guard: bool = True, cheap_model: str = "cheap", strong_model: str = "strong", ledger: str | None = None) -> DataFrame:
    """Cheap-first routing with real calls: every row goes to the cheap model,
    and only failing rows are sent to the strong model (a filter before the
    call, never a conditional inside it). All answers go through a call ledger
    at ``ledger`` (a fresh folder when not given): a run that failed and is
    started again with the same ledger asks neither model anything twice."""
    from quarry.operators.ledger import CallLedger
    from quarry.operators.ranks import written
    from quarry.session import scratch_path

    if cheap_model == strong_model:
        raise ValueError("the ledger tells models by name: the two names must differ")
    book = CallLedger(df.sparkSession, ledger or scratch_path(df.sparkSession, "call-ledger"))
    base = written(df.select(key, message), "route-rows")
    # Written once gated: the answers are parsed once, not again for each of the three readers below.
    cheap = validate_outputs(book.call(base, cheap_factory, cheap_model, key, message), "raw", TICKET, into="ticket")
    gated = written(gate(cheap, guard=guard, message_col=message).select(key, message, "ok", "ticket", "error", "tokens"), "route-gated")
    esc = gated.filter(~F.col("ok")).select(key, message, F.col("error").alias("escalation_reason"))
    strong = written(book.call(esc, strong_factory, strong_model, key, message), "route-strong")
    sv = validate_outputs(strong, "raw", TICKET, into="ticket")
    return served_cheap_rows(gated, key).unionByName(strong_rows(sv, key))


# --- local predictors (no network): stand-ins for a served model --------------


class KeywordPredictor:
    """A deterministic rule-based extractor over pandas batches: the first
    five-digit number is the order id, keywords pick issue and sentiment, and
    the issue's usual priority is used. Good enough to exercise the pipeline."""

    ISSUE_WORDS = [
        ("delivery_delay", ("late", "track", "where", "behind", "arriv", "deliver", "promised", "moving")),
        ("damaged_item", ("damag", "pieces", "scuff", "crack", "broken", "bent", "wreck", "chip")),
        ("wrong_item", ("wrong", "instead", "exchange", "different", "colour", "color")),
        ("billing_error", ("charge", "billed", "receipt", "invoice", "payment")),
        ("refund_request", ("refund", "money back", "cancel")),
        ("account_access", ("log in", "login", "password", "sign in", "account", "reset")),
    ]
    NEGATIVE = ("not happy", "now", "annoy", "unaccept", "fum", "furious", "unreal", "over it", "wreck")
    POSITIVE = ("thank", "great", "praise", "helped")
    PRIORITY = {"delivery_delay": "high", "damaged_item": "high", "wrong_item": "medium", "billing_error": "high",
                "refund_request": "medium", "account_access": "high", "other": "low"}

    def __init__(self, fail_every: int = 0):
        # With fail_every = k, messages whose CRC32 is divisible by k get a
        # prose answer (a deterministic failure, whatever the partitioning).
        self.fail_every = fail_every

    def predict(self, messages, system_prompt: str = SYSTEM_PROMPT):
        import json

        import pandas as pd

        t0 = time.perf_counter()
        low = messages.str.lower()
        oid = messages.str.extract(r"(?<!\d)(\d{5})(?!\d)", expand=False)
        holds = lambda text, words: any(w in text for w in words)
        issue = [next((name for name, words in self.ISSUE_WORDS if holds(m, words)), "other") for m in low]
        sentiment = ["negative" if holds(m, self.NEGATIVE) else "positive" if holds(m, self.POSITIVE) else "neutral" for m in low]
        raws = []
        import zlib

        for m, o, iss, s in zip(messages, oid, issue, sentiment):
            if self.fail_every and zlib.crc32(m.encode("utf-8")) % self.fail_every == 0:
                raws.append("I could not work that out, sorry.")
                continue
            t = {"order_id": None if pd.isna(o) else str(o), "issue": iss, "sentiment": s,
                 "priority": self.PRIORITY[iss], "summary": f"Ticket about {iss.replace('_', ' ')}."}
            raws.append(json.dumps(t, separators=(",", ":")))
        dt = (time.perf_counter() - t0) / max(1, len(messages))
        n_system = len(system_prompt.split())
        n_prompt = [n_system + len(m.split()) for m in messages]
        return pd.DataFrame({
            "raw": raws,
            "latency_s": [dt] * len(messages),
            "prompt_tokens": n_prompt,
            "completion_tokens": [len(r.split()) for r in raws],
        })


class CountingFactory:
    """Wraps a predictor factory and counts predicted rows in an accumulator
    (used to check that routing calls the strong model only when needed)."""

    def __init__(self, factory, accumulator):
        self.factory = factory
        self.acc = accumulator

    def __call__(self):
        inner = self.factory()
        acc = self.acc

        class _Counted:
            def predict(self, messages, system_prompt=SYSTEM_PROMPT):
                acc.add(len(messages))
                return inner.predict(messages, system_prompt=system_prompt)

        return _Counted()

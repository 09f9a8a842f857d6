"""The call ledger: a failed and resumed run asks no answered row again."""

import pandas as pd
import pytest

from quarry.operators.infer import KeywordPredictor, route
from quarry.operators.ledger import CallLedger


def logged(log, mended=True):
    """A predictor factory: answers with the message's length, notes in a
    folder what it was asked, fails on a message that says so unless ``mended``."""
    log = str(log)

    class Logged:  # defined here, so that it travels to the workers by value
        def predict(self, messages, system_prompt=""):
            import uuid

            if not mended and (messages == "fail").any():
                raise RuntimeError("the service is gone")
            with open(f"{log}/{uuid.uuid4().hex}", "w") as f:
                f.writelines(m + "\n" for m in messages)
            return pd.DataFrame({"raw": [f"{system_prompt[:3]}{len(m)}" for m in messages], "latency_s": 0.5, "prompt_tokens": 1, "completion_tokens": 2})

    return Logged


def asked(log):
    return sorted(line for f in log.iterdir() for line in f.read_text().split("\n") if line)


@pytest.fixture
def log(tmp_path):
    (tmp_path / "log").mkdir()
    return tmp_path / "log"


def test_failed_run_resumes_behind_its_answers(spark, tmp_path, log):
    rows = [(i, f"message {i:04d}") for i in range(400)] + [(400, "fail")]
    df = spark.createDataFrame(rows, "example_id long, message string")
    book = CallLedger(spark, str(tmp_path / "ledger"), rows_per_commit=20)
    with pytest.raises(Exception, match="service is gone"):
        book.call(df, logged(log, mended=False), "m")
    kept = {r.id for r in book.entries().collect()}
    first = asked(log)
    assert 0 < len(kept) < 401
    left = {int(r.id) for r in book.pending(df, "m", "example_id", "message").collect()}
    assert left == {i for i, _ in rows} - {int(i) for i in kept}
    got = book.call(df, logged(log), "m").collect()
    assert sorted((r.example_id, r.raw) for r in got) == sorted((i, f"You{len(m)}") for i, m in rows)
    second = asked(log)
    # What the first run committed was asked once; only what it had asked without committing came again.
    for i in kept:
        assert second.count(f"message {int(i):04d}") == 1
    assert len(second) - len(first) == len(left)
    assert book.entries().groupBy("id", "prompt_hash").count().where("count > 1").count() == 0
    book.call(df, logged(log), "m").collect()
    assert asked(log) == second


def test_models_prompts_nulls_and_repeats(spark, tmp_path, log):
    rows = [(1, "a", "x"), (1, "a", "y"), (1, "b", "z"), (None, "a", "n"), (None, None, "o"), (2, None, "p"), (2, "", "q")]
    df = spark.createDataFrame([(*r, "old") for r in rows], "example_id long, message string, extra string, raw string")
    book = CallLedger(spark, str(tmp_path / "ledger"))
    got = book.call(df, logged(log), "one").collect()
    assert sorted(r.extra for r in got) == sorted(r[2] for r in rows)
    assert all(r.raw == f"You{len(r.message or '')}" and r.model == "one" for r in got)
    assert book.entries().count() == 5  # repeated rows, and null and empty messages of one id, share a question
    book.call(df, logged(log), "two")
    book.call(df, logged(log), "one", system_prompt="other")
    assert book.entries().count() == 15
    assert sorted(book.call(df, logged(log), "one", system_prompt="other").select("raw").distinct().toPandas()["raw"]) == ["oth0", "oth1"]
    assert book.entries().count() == 15


def test_empty_input(spark, tmp_path, log):
    none = spark.createDataFrame([], "example_id long, message string")
    book = CallLedger(spark, str(tmp_path / "ledger"))
    assert book.call(none, logged(log), "m").count() == 0 and asked(log) == []


def test_routing_resumes(spark, sf_small, tmp_path):
    """A second routing run on the same ledger makes no call at all."""
    from quarry.operators.infer import CountingFactory
    from quarry.plans.queries import cheap_predictor, strong_predictor, tickets

    acc = [spark.sparkContext.accumulator(0) for _ in range(2)]
    run = lambda: route(tickets(spark, sf_small), CountingFactory(cheap_predictor, acc[0]), CountingFactory(strong_predictor, acc[1]), ledger=str(tmp_path / "ledger"))
    cols = ["example_id", "ok", "served_by", "escalation_reason"]
    one = sorted(map(tuple, run().select(cols).collect()), key=str)
    calls = [a.value for a in acc]
    assert calls[0] == len(one) and calls[1] == sum(r[2] == "strong_fallback" for r in one) > 0
    assert sorted(map(tuple, run().select(cols).collect()), key=str) == one
    assert [a.value for a in acc] == calls
    with pytest.raises(ValueError):
        route(tickets(spark, sf_small), KeywordPredictor, KeywordPredictor, cheap_model="m", strong_model="m")

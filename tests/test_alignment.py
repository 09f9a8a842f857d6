"""Alignment that fails loudly, in the pass that uses its rows."""

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from quarry.operators.evaluate import align_complete, alignment_faults, evaluate
from quarry.operators.validate import validate_outputs
from quarry.plans.score import score_and_compare

MODELS = ["base", "tuned"]
TICKET = "struct<order_id:string,issue:string,sentiment:string,priority:string,summary:string>"
GOOD = ("12345", "other", "neutral", "low", "s")
RAW = '{"order_id":"12345","issue":"other","sentiment":"neutral","priority":"low","summary":"s"}'


def gold_of(spark, rows):
    return spark.createDataFrame([(k, f"order 12345 {k}", t) for k, t in rows], f"example_id long, message string, ticket {TICKET}")


def preds_of(spark, rows):
    return spark.createDataFrame([(k, m, RAW, 0.1, 5, 6) for k, m in rows], "example_id long, model string, raw string, latency_s double, prompt_tokens int, completion_tokens int")


IDS = list(range(30)) + [None]
GOLD = [(k, GOOD) for k in IDS]
PREDS = [(k, m) for k in IDS for m in MODELS]
CASES = {
    "no prediction": (GOLD, [p for p in PREDS if p != (7, "tuned")]),
    "missing model": (GOLD, [p for p in PREDS if p[1] == "base"]),
    "none at all": (GOLD, []),
    "no gold": (GOLD[1:], PREDS),
    "no gold rows": ([], PREDS),
    "other model": (GOLD, [*PREDS, (3, "third")]),
    "null model": (GOLD, [*PREDS, (3, None)]),
    "repeated gold key": ([*GOLD, GOLD[4]], PREDS),
    "repeated null key": ([*GOLD, GOLD[-1]], PREDS),
    "repeated prediction": (GOLD, [*PREDS, PREDS[9]]),
    "invalid gold": ([*GOLD[:5], (5, ("12345", "unheard_of", "neutral", "low", "s")), *GOLD[6:]], PREDS),
    "null gold": ([*GOLD[:5], (5, None), *GOLD[6:]], PREDS),
}


def test_complete_rows_pass(spark):
    rows = align_complete(preds_of(spark, PREDS), gold_of(spark, GOLD), MODELS).collect()
    assert sorted(((r.example_id, r.model) for r in rows), key=str) == sorted(PREDS, key=str)
    assert all(r.gold.order_id == "12345" and r.message == f"order 12345 {r.example_id}" for r in rows)
    assert align_complete(preds_of(spark, []), gold_of(spark, []), MODELS).count() == 0


@pytest.mark.parametrize("case", CASES)
def test_every_fault_ends_the_job(spark, case):
    gold, preds = CASES[case]
    rows = align_complete(preds_of(spark, preds), gold_of(spark, gold), MODELS)
    with pytest.raises(Exception, match="not aligned"):
        # The aggregate itself fails; a later filter that drops the faulty row doesn't hide it.
        evaluate(validate_outputs(rows.where(F.col("raw").isNotNull() & F.col("gold").isNotNull()), "raw", into="pred")).collect()


def test_scoring_checks_its_alignment(spark):
    good = score_and_compare(preds_of(spark, PREDS), "base", "tuned", gold=gold_of(spark, GOLD))
    assert {r.model: r.exact_match for r in good.report.collect()} == {"base": 1.0, "tuned": 1.0}
    bad = score_and_compare(preds_of(spark, PREDS[:-1]), "base", "tuned", gold=gold_of(spark, GOLD))
    with pytest.raises(Exception, match="no prediction for key null model tuned"):
        bad.report.collect()


def test_faults_are_counted_without_another_scan(spark):
    gold, preds = [*GOLD, GOLD[4], (90, GOOD)], [*PREDS, PREDS[21], (80, "base")]
    seen = Observation()
    rows = align_complete(preds_of(spark, preds), gold_of(spark, gold), MODELS, observation=seen)
    assert rows.count() == 62 - 2 - 1
    assert seen.get == {"rows": 68, "repeated gold key": 4, "invalid gold": 0, "no prediction": 2, "no gold": 1, "repeated prediction": 2}
    faults = {(r.model, r.fault): r.n for r in alignment_faults(preds_of(spark, preds), gold_of(spark, gold), MODELS).collect()}
    assert faults == {("base", "repeated gold key"): 2, ("tuned", "repeated gold key"): 2, ("base", "no prediction"): 1, ("tuned", "no prediction"): 1,
                      ("base", "no gold"): 1, (PREDS[21][1], "repeated prediction"): 2}

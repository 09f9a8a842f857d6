"""Guard, gate, routing economics (FIXTURES §4: O24, O25, O44, O45, O49)."""

import pytest
from pyspark.sql import functions as F

from quarry.operators.infer import KeywordPredictor, route
from quarry.operators.route import SERVED_CHEAP, SERVED_STRONG, routing_report
from quarry.operators.validate import gate, guard_report, validate_outputs


def _routed(spark, n, esc):
    rows = [(SERVED_STRONG if i < esc else SERVED_CHEAP, "invalid_json" if i < esc else None) for i in range(n)]
    return spark.createDataFrame(rows, "served_by string, escalation_reason string")


@pytest.mark.parametrize(
    "n,esc,rate,cost,saving",
    [(50, 3, 0.06, 0.11, 0.89), (10, 10, 1.0, 1.05, -0.05), (0, 0, 0.0, 1.0, 0.0)],
)
def test_economics(spark, n, esc, rate, cost, saving):
    r = routing_report(_routed(spark, n, esc), 20.0).first()
    assert r.n == n and r.escalated == esc
    assert r.escalation_rate == pytest.approx(rate)
    assert r.cost_vs_all_strong == pytest.approx(cost)
    assert r.saving_vs_all_strong == pytest.approx(saving)


def test_guard_catches_blended_digits(spark):
    msg = "wrong thing on #88321, it has been 2 weeks"
    raw = '{"order_id":"28321","issue":"wrong_item","sentiment":"negative","priority":"medium","summary":"x"}'
    ok = '{"order_id":null,"issue":"wrong_item","sentiment":"negative","priority":"medium","summary":"x"}'
    empty = '{"order_id":"","issue":"wrong_item","sentiment":"negative","priority":"medium","summary":"x"}'
    df = spark.createDataFrame([(1, msg, raw, 5), (2, msg, ok, 5), (3, msg, empty, 5), (4, msg, "oops", 5)],
                               "example_id long, message string, raw string, completion_tokens int")
    g = {r.example_id: r for r in gate(validate_outputs(df)).collect()}
    assert not g[1].ok and g[1].error == "order_id_not_in_message"
    assert g[2].ok and g[3].ok
    assert g[4].error == "no_json_object"  # parse reason first


def test_guard_report_cost(spark):
    msg = "order 11111"
    good = '{"order_id":"11111","issue":"other","sentiment":"neutral","priority":"low","summary":"x"}'
    bad = '{"order_id":"99999","issue":"other","sentiment":"neutral","priority":"low","summary":"x"}'
    rows = [(i, msg, bad if i < 2 else good) for i in range(8)]
    df = validate_outputs(spark.createDataFrame(rows, "example_id long, message string, raw string"))
    r = guard_report(df, 20.0, group=()).first()
    assert r.caught == 2 and r.cost_vs_all_strong == pytest.approx(0.3)


def test_strong_model_called_only_for_escalations(spark, sf_small):
    from quarry.operators.infer import CountingFactory, route
    from quarry.plans.queries import cheap_predictor, strong_predictor, tickets

    acc = spark.sparkContext.accumulator(0)
    r = route(tickets(spark, sf_small), cheap_predictor, CountingFactory(strong_predictor, acc))
    esc = r.filter(F.col("served_by") == SERVED_STRONG).count()
    total = r.count()
    assert esc > 0 and total == spark.read.parquet(f"{sf_small}/orders.parquet").count()
    assert acc.value == esc


def test_prescored_join_equals_side_by_side(spark, sf_small):
    from quarry.operators.corrupt import DEFAULT_MODES, simulate_columns, simulate_models
    from quarry.operators.route import route_columns, route_prescored
    from quarry.plans.queries import CHEAP, GUARD_MODES, STRONG, tickets

    t = tickets(spark, sf_small)
    a = route_prescored(simulate_models(t, [CHEAP], modes=GUARD_MODES), simulate_models(t, [STRONG]))
    both = simulate_columns(t, [CHEAP, STRONG], modes=[GUARD_MODES, DEFAULT_MODES])
    b = route_columns(both, f"raw_{CHEAP[0]}", f"raw_{STRONG[0]}")
    cols = ["example_id", "ok", "error", "tokens", "served_by", "escalation_reason", "ticket"]
    assert a.select(*cols).exceptAll(b.select(*cols)).count() == 0
    assert b.select(*cols).exceptAll(a.select(*cols)).count() == 0
    assert b.filter("served_by = 'strong_fallback'").count() > 0


def test_economics_zero_ratio(spark):
    r = routing_report(_routed(spark, 10, 3), 0.0).first()
    assert r.cost_vs_all_strong == 1.0 and r.saving_vs_all_strong == 0.0


def test_gate_without_guard(spark):
    msg = "order 11111"
    bad_id = '{"order_id":"99999","issue":"other","sentiment":"neutral","priority":"low","summary":"x"}'
    df = validate_outputs(spark.createDataFrame([(1, msg, bad_id, 3)],
                                                "example_id long, message string, raw string, completion_tokens int"))
    on = gate(df, guard=True).first()
    off = gate(df, guard=False).first()
    assert (on.ok, on.error) == (False, "order_id_not_in_message")
    assert (off.ok, off.error, off.tokens) == (True, None, 3) and off.ticket.order_id == "99999"


def test_failures_keep_a_200_character_excerpt(spark):
    from quarry.operators.validate import failures

    raw = "é" * 150 + "x" * 150  # 300 characters, multi-byte ones first
    df = validate_outputs(spark.createDataFrame([(1, "m", raw)], "example_id long, message string, raw string"))
    r = failures(df).first()
    assert r.reason_code == "no_json_object" and r.raw_excerpt == raw[:200]


def test_escalation_reasons_map(spark):
    rows = [(SERVED_STRONG, "invalid_json")] * 2 + [(SERVED_STRONG, "order_id_not_in_message")] + [(SERVED_CHEAP, None)] * 4
    r = routing_report(spark.createDataFrame(rows, "served_by string, escalation_reason string"), 20.0).first()
    assert r.escalation_reasons == {"invalid_json": 2, "order_id_not_in_message": 1}
    assert (r.n, r.served_cheap, r.escalated) == (7, 4, 3)


def test_answers_are_parsed_once(spark):
    """What ``route`` returns parses the strong answers; the cheap ones were parsed and gated once before."""
    rows = spark.createDataFrame([(i, f"Order {10000 + i} is late") for i in range(40)], "id long, text string")
    routed = route(rows, lambda: KeywordPredictor(fail_every=3), KeywordPredictor, key="id", message="text")
    assert str(routed._jdf.queryExecution().optimizedPlan()).count("parseJson") == 1
    assert routed.count() == 40 and routed.where("ok").count() == 40

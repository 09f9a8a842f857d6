"""Parse cases of the output contract (FIXTURES §3)."""

import json

import pytest

from quarry.operators.validate import validate_outputs

G = '{"order_id":"12345","issue":"delivery_delay","sentiment":"negative","priority":"high","summary":"late"}'
FENCE = "```"


def mod(**kw):
    d = json.loads(G)
    for k, v in kw.items():
        if v == "__DEL__":
            d.pop(k)
        else:
            d[k] = v
    return json.dumps(d)


CASES = [
    (G, None, "late"),
    (FENCE + "json\n" + G + "\n" + FENCE, None, None),
    ("Sure! Here:\n" + FENCE + "json\n" + G + "\n" + FENCE, None, None),
    (G + " Hope that helps.", None, None),
    (" \n" + G, None, None),
    ("", "no_json_object", None),
    (None, "no_json_object", None),
    ("prose only", "no_json_object", None),
    (G[:30], "no_json_object", None),
    ("} {", "invalid_json", None),
    (FENCE + "} {" + FENCE, "no_json_object", None),
    (G + " " + G, "invalid_json", None),
    (G + "," + G, "invalid_json", None),
    (G + "],[" + G, "invalid_json", None),
    ("{'a':1}", "invalid_json", None),
    ('{"a":1,}', "invalid_json", None),
    (G.replace('"late"', '"la\tte"'), "invalid_json", None),
    ("{}", "schema_violation", "issue"),
    (mod(order_id=12345), "schema_violation", "order_id"),
    (mod(order_id=True), "schema_violation", "order_id"),
    (mod(order_id={"x": 1}), "schema_violation", "order_id"),
    (mod(order_id=None), None, None),
    (mod(order_id="__DEL__"), None, None),
    (mod(order_id=""), None, None),
    (mod(priority="urgent"), "schema_violation", "priority"),
    (mod(priority="High"), "schema_violation", "priority"),
    (mod(priority=None), "schema_violation", "priority"),
    (mod(summary="   "), "schema_violation", "summary"),
    (mod(summary="\u001c"), "schema_violation", "summary"),
    (mod(summary=" late \n"), None, "late"),
    (mod(summary=None), "schema_violation", "summary"),
    (mod(summary="__DEL__"), "schema_violation", "summary"),
    (mod(extra=1), None, None),
    ('{"order_id":"12345","issue":"delivery_delay","sentiment":"negative","priority":"urgent","priority":"high","summary":"late"}', None, None),
    ("<think>{x}</think>" + G, "invalid_json", None),
    (mod(summary="café \U0001f389 } {"), None, None),
    (G.replace('"issue"', '"ISSUE"'), "schema_violation", "issue"),
]


@pytest.fixture(scope="module")
def parsed(spark):
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(CASES)], "i int, raw string")
    return {r.i: r for r in validate_outputs(df).collect()}


@pytest.mark.parametrize("i", range(len(CASES)))
def test_case(parsed, i):
    raw, code, extra = CASES[i]
    r = parsed[i]
    assert r.reason_code == code
    assert r.is_valid == (code is None)
    if code == "schema_violation" and extra:
        assert r.reason_detail.startswith(extra + ":")
    if code is None:
        assert r.ticket is not None
        if extra:
            assert r.ticket.summary == extra


def test_order_id_null_and_missing_are_null(parsed):
    assert parsed[21].ticket.order_id is None
    assert parsed[22].ticket.order_id is None
    assert parsed[23].ticket.order_id == ""


def test_duplicate_key_last_wins(parsed):
    assert parsed[33].ticket.priority == "high"


def test_filter_on_validity_keeps_one_parse(spark):
    """A filter on is_valid must not be pushed below the parse (which would
    re-inline the JSON parse once per reference)."""
    df = spark.createDataFrame([(G,)], "raw string")
    plan = validate_outputs(df).filter("is_valid")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parse_json") + plan.count("parseJson") <= 1


def test_sentinel_inside_output_cannot_fool_the_decoder(spark):
    from quarry.functions.parse import SENTINEL, SENTINEL_2

    def ok(summary):
        return '{"order_id":null,"issue":"other","sentiment":"neutral","priority":"low","summary":"' + summary + '"}'

    tricks = [
        ok(SENTINEL),
        '{"a":1},"' + SENTINEL + '",{"b":2}',
        '{"a":1},"' + SENTINEL + '"]] {"b":2}',
        '{"a":1}],"' + SENTINEL + '",[{}',
        ok(SENTINEL + " " + SENTINEL_2),
        '{"a":1},"' + SENTINEL_2 + '"]] {"b":2}',
        ok("fine") + ' "' + SENTINEL + '"]] {}',
    ]
    df = spark.createDataFrame(list(enumerate(tricks)), "i int, raw string")
    got = {r.i: r.reason_code for r in validate_outputs(df).collect()}
    # 4 holds both sentinels: it cannot be decoded safely and is rejected
    # (with random sentinels this needs an output that contains both tokens).
    assert got == {0: None, 1: "invalid_json", 2: "invalid_json", 3: "invalid_json", 4: "invalid_json",
                   5: "invalid_json", 6: "invalid_json"}

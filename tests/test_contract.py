"""The contract is a parameter: a different schema drives validation,
scoring and the prompt hint without code changes."""

from quarry.contract import Contract, FieldSpec
from quarry.operators.evaluate import evaluate
from quarry.operators.validate import validate_outputs

INVOICE = Contract(
    fields=(
        FieldSpec("vendor", "optional_string", scored=True),
        FieldSpec("currency", "enum", ("EUR", "USD"), scored=True),
        FieldSpec("note", "text"),
    ),
    name="invoice",
)


def test_custom_contract_validation(spark):
    rows = [
        (1, '{"vendor": "ACME", "currency": "EUR", "note": " paid "}'),
        (2, '{"vendor": 7, "currency": "EUR", "note": "x"}'),
        (3, '{"currency": "GBP", "note": "x"}'),
        (4, '{"currency": "USD", "note": "   "}'),
        (5, '{"currency": "USD", "note": "ok", "issue": "ignored"}'),
    ]
    df = spark.createDataFrame(rows, "i int, raw string")
    got = {r.i: r for r in validate_outputs(df, contract=INVOICE, into="inv").collect()}
    assert got[1].is_valid and got[1].inv.note == "paid" and got[1].inv.vendor == "ACME"
    assert got[2].reason_detail.startswith("vendor:")
    assert got[3].reason_detail.startswith("currency:")
    assert got[4].reason_detail.startswith("note:")
    assert got[5].is_valid and got[5].inv.vendor is None
    assert "currency: EUR | USD" in INVOICE.hint()


def test_custom_contract_scoring(spark):
    schema = ("model string, raw string, latency_s double, prompt_tokens int, completion_tokens int, "
              "gold struct<vendor: string, currency: string, note: string>")
    rows = [
        ("m", '{"vendor": "ACME", "currency": "EUR", "note": "paid"}', 0.1, 10, 5, ("ACME", "EUR", "paid")),
        ("m", '{"vendor": "ACME", "currency": "USD", "note": "paid"}', 0.1, 10, 5, ("ACME", "EUR", "paid")),
    ]
    r = evaluate(spark.createDataFrame(rows, schema), contract=INVOICE).first()
    assert r.schema_validity == 1.0 and r.exact_match == 0.5
    assert r.acc_vendor == 1.0 and r.acc_currency == 0.5

"""Differential test: the Spark parser against a plain-Python statement of
the same contract (``json.loads`` + field rules) on generated outputs."""

import json
import random

from quarry.contract import ISSUES, PRIORITIES, SENTIMENTS
from quarry.operators.validate import validate_outputs

MISSING = object()
ENUMS = {"issue": ISSUES, "sentiment": SENTIMENTS, "priority": PRIORITIES}


def python_parse(raw):
    """Reason code and ticket by the contract's rules (the case table):
    s = stripped text; no "{" or no "}" -> no_json_object; last "}" before
    first "{" -> no_json_object when fenced, else an empty candidate (so
    invalid_json); otherwise the candidate s[first "{" .. last "}"] must be
    one JSON value, then the field rules apply in field order."""
    s = (raw or "").strip()
    first, last = s.find("{"), s.rfind("}")
    if first < 0 or last < 0:
        return "no_json_object", None
    if last < first:
        return ("no_json_object" if s.startswith("```") else "invalid_json"), None
    try:
        obj = json.loads(s[first : last + 1])
    except json.JSONDecodeError:
        return "invalid_json", None
    oid = obj.get("order_id")
    if oid is not None and not isinstance(oid, str):
        return "schema_violation", None
    for f, allowed in ENUMS.items():
        v = obj.get(f, MISSING)
        if not (isinstance(v, str) and v in allowed):
            return "schema_violation", None
    summary = obj.get("summary", MISSING)
    if not isinstance(summary, str) or not summary.strip():
        return "schema_violation", None
    return None, (oid, obj["issue"], obj["sentiment"], obj["priority"], summary.strip())


SPACES = [" ", "\n", "\t", " ", " ", "　", "\u001c", ""]


def _value(rng, field):
    r = rng.random()
    if field in ENUMS and r < 0.6:
        v = rng.choice(ENUMS[field])
        return v.upper() if rng.random() < 0.1 else v
    if field == "summary" and r < 0.6:
        return rng.choice(SPACES) + rng.choice(["late", "Ça marche 🎉", "a } b { c", "", "   "]) + rng.choice(SPACES)
    if field == "order_id" and r < 0.5:
        return rng.choice([str(rng.randint(10000, 99999)), "", None])
    return rng.choice([None, 123, 4.5, True, False, "x", [], {"k": "v"}, [1, "2"]])


def _object(rng):
    fields = ["order_id", "issue", "sentiment", "priority", "summary"]
    obj = {}
    for f in fields:
        if rng.random() < 0.9:
            obj[f] = _value(rng, f)
    if rng.random() < 0.2:
        obj["extra"] = rng.choice([1, "y", None, {"a": [1, 2]}])
    text = json.dumps(obj, ensure_ascii=rng.random() < 0.5,
                      indent=rng.choice([None, None, 2]), separators=rng.choice([None, (",", ":")]))
    if rng.random() < 0.1 and "priority" in obj:  # duplicate key, last wins
        text = text[:-1] + ', "priority": "' + rng.choice(PRIORITIES) + '"}'
    return text


def _mutate(rng, text):
    r = rng.random()
    if r < 0.15:
        text = "```json\n" + text + "\n```"
    elif r < 0.25:
        text = "Sure, here it is:\n```\n" + text + "\n```"
    elif r < 0.35:
        text = text + rng.choice([" Hope that helps.", " } trailing", " " + text, "," + text, "]"])
    elif r < 0.45:
        text = text[: rng.randint(0, len(text))]
    elif r < 0.5:
        text = rng.choice(["", "no json", "} {", "```} {```", "{'a': 1}", '{"a":1,}', "<think>{x}</think>" + text])
    return rng.choice(SPACES) + text + rng.choice(SPACES)


def test_parser_matches_python_rules(spark):
    rng = random.Random(1234)
    raws = [_mutate(rng, _object(rng)) for _ in range(4000)]
    df = spark.createDataFrame(list(enumerate(raws)), "i int, raw string")
    got = {r.i: r for r in validate_outputs(df).collect()}
    bad = []
    for i, raw in enumerate(raws):
        code, ticket = python_parse(raw)
        r = got[i]
        t = tuple(r.ticket) if r.ticket is not None else None
        if r.reason_code != code or t != ticket:
            bad.append((raw, code, r.reason_code, ticket, t))
    codes = {python_parse(x)[0] for x in raws}
    assert codes == {None, "no_json_object", "invalid_json", "schema_violation"}
    assert not bad, bad[:5]

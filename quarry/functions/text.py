"""String expressions shared by several operators (all JVM built-ins)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quarry.functions.templates import NO_ID_PATTERNS, NO_ID_TEXT

# The characters Python's str.strip() removes are those with str.isspace();
# Java's \s covers only [ \t\n\x0B\f\r], so the class is built from that rule.
PY_SPACE_CHARS = "".join(chr(c) for c in range(0x110000) if chr(c).isspace())
PY_SPACE = "[" + "".join(f"\\u{ord(ch):04x}" for ch in PY_SPACE_CHARS) + "]"


def py_strip(c: Column) -> Column:
    """Python ``str.strip()`` with no arguments (Unicode whitespace).

    The regex only runs when the first or last character is whitespace (a
    cheap ``instr`` test); most values need no stripping."""
    ws = F.lit(PY_SPACE_CHARS)
    edge = (F.length(c) > 0) & (
        (F.instr(ws, F.substring(c, 1, 1)) > 0) | (F.instr(ws, F.substring(c, -1, 1)) > 0)
    )
    return F.when(edge, F.regexp_replace(c, rf"\A{PY_SPACE}+|{PY_SPACE}+\z", "")).otherwise(c)


def strip_newlines(c: Column, left: bool = True, right: bool = True) -> Column:
    """Python ``str.strip('\\n')`` / ``lstrip`` / ``rstrip`` for newlines only."""
    if left and right:
        return F.regexp_replace(c, r"\A\n+|\n+\z", "")
    if left:
        return F.regexp_replace(c, r"\A\n+", "")
    return F.regexp_replace(c, r"\n+\z", "")


def tail_from(c: Column, pos: int | Column) -> Column:
    """``substring(c, pos)`` to the end of the string (1-based)."""
    p = pos if isinstance(pos, Column) else F.lit(pos)
    return F.call_function("substring", c, p)


def fill_order_id(template: Column, oid: Column) -> Column:
    """Put the order id into ``{oid}``; without an id replace the id patterns,
    in order, by the no-id text (literal, case-sensitive replacement)."""
    no_id = template
    for pat in NO_ID_PATTERNS:
        no_id = F.replace(no_id, F.lit(pat), F.lit(NO_ID_TEXT))
    return F.when(oid.isNotNull() & (oid != ""), F.replace(template, F.lit("{oid}"), oid)).otherwise(no_id)


def vary(greeting: Column, core: Column, closing: Column) -> Column:
    """Greeting + core (first character lower-cased after a greeting) + closing."""
    body = F.when(greeting == "", core).otherwise(
        F.concat(greeting, F.lower(F.substring(core, 1, 1)), tail_from(core, 2))
    )
    return F.concat(body, closing)


def json_str(c: Column) -> Column:
    """A JSON string literal for ``c`` (``null`` when null), compact escaping."""
    arr = F.to_json(F.array(c))  # '["..."]' or '[null]'
    return arr.substr(F.lit(2), F.length(arr) - 2)


def excerpt(c: Column, n: int = 200) -> Column:
    """The first ``n`` characters (code points), like ``s[:n]``."""
    return F.substring(F.coalesce(c, F.lit("")), 1, n)


# Control characters Jackson escapes as \u00XX with upper-case hex letters
# (\b \t \n \f \r use short forms); Python writes lower-case hex.
_UPPER_HEX_ESCAPES = [c for c in range(0x20) if c not in (8, 9, 10, 12, 13) and any(ch in "ABCDEF" for ch in f"{c:02X}")]


def python_json_text(j: Column) -> Column:
    """Spark ``to_json`` text -> byte-identical ``json.dumps`` output (with
    ``ensure_ascii=True``): lower-case hex escapes, and every character
    outside printable ASCII escaped as ``\\uXXXX`` (surrogate pairs above
    U+FFFF). Escaped backslashes are parked on a raw U+0001 first, a code
    that never occurs unescaped in JSON text. The per-character pass only
    runs on text that holds a non-ASCII or DEL character."""
    t = F.replace(j, F.lit("\\\\"), F.lit("\x01"))
    for c in _UPPER_HEX_ESCAPES:
        t = F.replace(t, F.lit(f"\\u{c:04X}"), F.lit(f"\\u{c:04x}"))
    t = F.replace(t, F.lit("\x01"), F.lit("\\\\"))
    chars = F.regexp_extract_all(t, F.lit("(?s)."), 0)

    def esc(ch):
        cp = F.ascii(ch)
        hi = F.lit(0xD800) + F.shiftright(cp - F.lit(0x10000), 10)
        lo = F.lit(0xDC00) + (cp - F.lit(0x10000)).bitwiseAND(F.lit(0x3FF))
        return (
            F.when(cp < 127, ch)
            .when(cp < 0x10000, F.format_string("\\u%04x", cp))
            .otherwise(F.format_string("\\u%04x\\u%04x", hi, lo))
        )

    return F.when(t.rlike("[^\\x00-\\x7e]"), F.array_join(F.transform(chars, esc), "")).otherwise(t)

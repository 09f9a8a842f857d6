"""The output contract: one spec object drives the Spark schema, the
validation expressions and the prompt hint, so they never drift apart.

A contract is an ordered list of fields. Validation reports the first bad
field in this order, the way the reference's model validator does.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


@dataclass(frozen=True)
class FieldSpec:
    name: str
    # "optional_string": string or JSON null or missing (null).
    # "enum": required string, exact (case-sensitive) member of ``allowed``.
    # "text": required string, non-blank after Unicode strip, stored stripped.
    kind: str
    allowed: tuple[str, ...] = ()
    scored: bool = False  # part of per-field accuracy

    def hint(self) -> str:
        if self.kind == "optional_string":
            return f"{self.name}: text, null if absent"
        if self.kind == "enum":
            return f"{self.name}: {' | '.join(self.allowed)}"
        return f"{self.name}: text"


@dataclass(frozen=True)
class Contract:
    fields: tuple[FieldSpec, ...]
    name: str = "ticket"

    @property
    def names(self) -> list[str]:
        return [f.name for f in self.fields]

    @property
    def scored_fields(self) -> list[str]:
        return [f.name for f in self.fields if f.scored]

    def field(self, name: str) -> FieldSpec:
        for f in self.fields:
            if f.name == name:
                return f
        raise KeyError(name)

    def spark_schema(self) -> T.StructType:
        return T.StructType(
            [T.StructField(f.name, T.StringType(), f.kind == "optional_string") for f in self.fields]
        )

    def hint(self) -> str:
        rows = "".join(f"\n- {f.hint()}" for f in self.fields)
        return f"Answer format, JSON only:{rows}"


# ---------------------------------------------------------------------------
# The ticket contract's domains. They must equal the
# reference's for results to compare (field names, order, enum members).
ISSUES = (
    "delivery_delay",
    "damaged_item",
    "wrong_item",
    "billing_error",
    "refund_request",
    "account_access",
    "other",
)
SENTIMENTS = ("positive", "neutral", "negative")
PRIORITIES = ("low", "medium", "high")

TICKET = Contract(
    fields=(
        FieldSpec("order_id", "optional_string", scored=True),
        FieldSpec("issue", "enum", ISSUES, scored=True),
        FieldSpec("sentiment", "enum", SENTIMENTS, scored=True),
        FieldSpec("priority", "enum", PRIORITIES, scored=True),
        FieldSpec("summary", "text"),
    )
)

SYSTEM_PROMPT = "You file customer messages. Each message becomes one record.\n" + TICKET.hint()

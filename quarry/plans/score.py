"""Score-and-compare and route-and-report: the reference's two evaluation
entry points as one call each, returning DataFrames (nothing is collected)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from quarry.operators.evaluate import align_complete, compare, evaluate, report_lines
from quarry.operators.infer import route
from quarry.operators.route import escalation_reasons, routing_report, served_by
from quarry.operators.validate import failure_histogram, failures, validate_outputs


@dataclass
class Scored:
    report: DataFrame
    compare: DataFrame
    failures: DataFrame
    histogram: DataFrame
    lines: DataFrame


def score_and_compare(preds: DataFrame, base: str, tuned: str, prices=None, gold: DataFrame | None = None,
                      key: str = "example_id", models: list[str] | None = None) -> Scored:
    """Validate every model's raw output once, then derive the report, the
    base-vs-tuned comparison, the failures table and the failure histogram.

    ``preds`` carries ``gold`` (a gold ticket column) or, with ``gold`` given,
    is aligned to it on ``key``: every gold row needs one prediction of each of
    ``models`` (``base`` and ``tuned`` when not given) and a valid label, else
    the job that reads a result fails. Checkpoint ``validated`` first when the
    predictions are expensive to recompute."""
    aligned = align_complete(preds, gold, models or [base, tuned], key) if gold is not None else preds
    validated = validate_outputs(aligned, "raw", into="pred")
    rep = evaluate(validated, prices=prices)
    return Scored(
        report=rep,
        compare=compare(rep, base, tuned),
        failures=failures(validated),
        histogram=failure_histogram(validated),
        lines=report_lines(rep),
    )


@dataclass
class Routed:
    routed: DataFrame
    report: DataFrame
    served_by: DataFrame
    reasons: DataFrame


def route_and_report(df: DataFrame, cheap_factory, strong_factory, cost_ratio: float = 20.0, guard: bool = True,
                     key: str = "example_id", message: str = "message") -> Routed:
    """Cheap-first routing with real model calls and its economics."""
    r = route(df, cheap_factory, strong_factory, key=key, message=message, guard=guard)
    return Routed(routed=r, report=routing_report(r, cost_ratio), served_by=served_by(r), reasons=escalation_reasons(r))

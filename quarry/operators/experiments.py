"""Experiment reports: sweeps, scaling-curve plateau, Pareto front and the
promotion gate. They read report tables (one row per model / experiment),
which are small aggregates whatever the size of the predictions behind them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.operators.evaluate import evaluate
from quarry.operators.ranks import written


def sweep(aligned: DataFrame, by=("experiment", "model"), prices=None) -> DataFrame:
    """All variants scored in one job: ``evaluate`` grouped by the experiment
    columns as well as the model."""
    return evaluate(aligned, prices=prices, by=by, with_map=False)


def curve_plateau(reports: DataFrame, k: str = "k", metric: str = "schema_validity", eps: float = 0.01,
                  series=("model",)) -> DataFrame:
    """(…series, k, value, gain, plateau): gain over the previous k of the same
    series; ``plateau`` marks the first k whose gain is below ``eps``."""
    series = [s for s in series if s in reports.columns]
    w = Window.partitionBy(*series).orderBy(k) if series else Window.orderBy(k)
    d = reports.select(*series, F.col(k), F.col(metric).alias("value"))
    d = d.withColumn("gain", F.col("value") - F.lag("value").over(w))
    flat = F.col("gain").isNotNull() & (F.col("gain") < F.lit(eps))
    first_flat = F.min(F.when(flat, F.col(k))).over(
        (Window.partitionBy(*series) if series else Window.partitionBy()).rowsBetween(
            Window.unboundedPreceding, Window.unboundedFollowing
        )
    )
    return d.withColumn("plateau", F.coalesce(F.col(k) == first_flat, F.lit(False)))


def pareto_front(reports: DataFrame, maximize: str = "schema_validity", minimize: str = "cost_per_1k_usd") -> DataFrame:
    """Rows not dominated by any other (no row is at least as good on both
    metrics and strictly better on one). Rows that agree on both stay
    together; a row without one of the metrics is not on the front and
    dominates none.

    A skyline scan over ranges, for any number of rows: the best value of each
    cost is range-partitioned by cost, each range starts from the best value
    of all cheaper ranges (one number a range), and a running maximum inside
    the range tells which costs bring a better value. ``reports`` is worked
    out once and written, as the front's points are looked up in it."""
    c, v = F.col(minimize), F.col(maximize)
    rows = written(reports.where(c.isNotNull() & v.isNotNull()), "pareto-rows")
    best = rows.groupBy(c.alias("_c")).agg(F.max(v).alias("_v"))
    ranges = written(best.repartitionByRange("_c").withColumn("_part", F.spark_partition_id()), "pareto-ranges")
    tops = ranges.groupBy("_part").agg(F.max("_v").alias("top")).collect()  # one row a partition
    known, before = None, {}
    for r in sorted(tops):
        before[r["_part"]] = known
        known = r["top"] if known is None else max(known, r["top"])
    kind = ranges.schema["_v"].dataType
    start = F.create_map(*(x for part, top in before.items() for x in (F.lit(part), F.lit(top).cast(kind)))) if before else F.create_map()
    cheaper = Window.partitionBy("_part").orderBy("_c").rowsBetween(Window.unboundedPreceding, -1)
    bar = F.greatest(F.max("_v").over(cheaper), F.try_element_at(start, F.col("_part"))) if before else F.lit(None).cast(kind)
    front = ranges.withColumn("_bar", bar).where(F.col("_bar").isNull() | (F.col("_v") > F.col("_bar"))).select("_c", "_v")
    return rows.join(front, (c == F.col("_c")) & (v == F.col("_v")), "left_semi")


def promotion_gate(compare_df: DataFrame, metrics=("schema_validity", "exact_match"), min_gain: float = 0.10,
                   ceiling: float = 1.0) -> DataFrame:
    """(metric, base, tuned, abs_gain, rel_gain, gap_closed, promote):
    promote when the tuned model gains at least ``min_gain`` (absolute) over
    base; ``gap_closed`` is the share of the base-to-``ceiling`` gap closed."""
    d = compare_df.filter(F.col("metric").isin(*metrics))
    return d.select(
        "metric",
        "base",
        "tuned",
        (F.col("tuned") - F.col("base")).alias("abs_gain"),
        F.try_divide(F.col("tuned") - F.col("base"), F.col("base")).alias("rel_gain"),
        gap_closed(F.col("base"), F.col("tuned"), F.lit(float(ceiling))).alias("gap_closed"),
        ((F.col("tuned") - F.col("base")) >= F.lit(min_gain)).alias("promote"),
    )


def gap_closed(base, tuned, ceiling):
    """Share of the base-to-ceiling gap a candidate closes (columns in, column out)."""
    return F.try_divide(tuned - base, ceiling - base)

"""Spreading inputs over the cluster's cores, in tasks of bounded size."""

from __future__ import annotations

from pyspark.sql import DataFrame

ROWS_PER_TASK = 100_000


def spread(df: DataFrame, min_partitions: int | None = None, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Round-robin rows over at least as many partitions as there are cores,
    of about ``rows_per_task`` rows each, when a scan yields fewer (small
    files, files with one row group, or a narrow column of many rows, which
    a scan cuts by bytes).

    Meant for the narrow input of CPU-heavy per-row work (hashing, JSON
    parsing, n-grams): shuffling a key column costs little next to the work,
    and a task has the same work however many rows there are. Inputs with
    enough splits are returned unchanged (no shuffle). Rows are counted from
    the Parquet footers when ``df`` is a scan."""
    target = max(min_partitions or df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // rows_per_task))
    if df.rdd.getNumPartitions() < target:
        return df.repartition(target)
    return df

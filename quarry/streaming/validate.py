"""Structured Streaming: validation and routing metrics over a live stream.

Validation, the guard and the gate are stateless column expressions, so the
batch operators run unchanged on a streaming DataFrame. The escalation rate
is the one stateful part: a watermarked event-time window aggregation, whose
state lives in the checkpoint location. In append mode (``account_windows``) a
window's state is dropped once the watermark passes it; in complete mode
every window is kept and the watermark frees nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.contract import TICKET, Contract
from quarry.operators.validate import gate, validate_outputs
from quarry.session import ensure_conf, scratch_path


def read_table_stream(spark: SparkSession, directory: str, name: str, schema: T.StructType,
                      files_per_trigger: int = 1) -> DataFrame:
    """Stream the table ``<name>.parquet`` of a folder: one file, or a folder
    of part files that are taken as they arrive."""
    # Written as a pattern, the path may be a file or a folder.
    return (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", files_per_trigger)
        .parquet(f"{directory}/{name}.parque[t]")
    )


def validate_stream(sdf: DataFrame, raw_col: str = "raw", contract: Contract = TICKET, into: str = "ticket") -> DataFrame:
    """The batch validator applied to a stream (stateless, append-safe)."""
    ensure_conf(sdf.sparkSession)
    return validate_outputs(sdf, raw_col, contract, into)


def _session_tz(df: DataFrame) -> str:
    return df.sparkSession.conf.get("spark.sql.session.timeZone")


def utc_instant(df: DataFrame, c: str):
    """A TIMESTAMP_NTZ wall clock read as UTC, whatever the session zone
    (a plain cast would read it in the session's zone)."""
    if df.schema[c].dataType.typeName() == "timestamp_ntz":
        return F.convert_timezone(F.lit("UTC"), F.lit(_session_tz(df)), F.col(c)).cast("timestamp")
    return F.col(c)


def utc_text(df: DataFrame, c: str, fmt: str = "yyyy-MM-dd HH:mm:ss"):
    """An instant rendered as its UTC wall clock, whatever the session zone."""
    local = F.col(c).cast("timestamp_ntz")
    return F.date_format(F.convert_timezone(F.lit(_session_tz(df)), F.lit("UTC"), local), fmt)


def escalation_rate_stream(gated: DataFrame, ts: str, window: str = "1 day", watermark: str = "1 day") -> DataFrame:
    """(window_start, window_end, n, escalated, escalation_rate) per event-time
    window of gated rows (``ok`` false = escalated). Rows later than the
    watermark are dropped, as streams must bound their state. Naive
    (TIMESTAMP_NTZ) event times are read as UTC, so windows are UTC-aligned
    whatever the session time zone."""
    t = gated.withColumn("_ts", utc_instant(gated, ts)).withWatermark("_ts", watermark)
    agg = t.groupBy(F.window("_ts", window).alias("w")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(~F.col("ok")).alias("escalated")
    )
    return agg.select(
        F.col("w.start").alias("window_start"),
        F.col("w.end").alias("window_end"),
        "n",
        "escalated",
        (F.col("escalated") / F.col("n")).alias("escalation_rate"),
    )


def run_available(sdf: DataFrame, name: str, output_mode: str = "append", state_partitions: int | None = None) -> str:
    """Run a stream over everything available now and store its result as
    parquet under the shared checkpoint folder; returns the path.

    ``append`` streams go to the file sink. Aggregations in ``complete`` mode
    go through ``foreachBatch``, each micro-batch overwriting the table with
    the full current result (the file sink has no complete mode).
    ``state_partitions`` fixes the number of state-store partitions of a
    stateful query (taken from ``spark.sql.shuffle.partitions`` when the query
    first starts, then kept in its checkpoint): size it to the number of
    groups the state holds, not to the data volume."""
    spark = sdf.sparkSession
    out = scratch_path(spark, f"{name}-out")
    ckpt = scratch_path(spark, f"{name}-ckpt")
    w = sdf.writeStream.option("checkpointLocation", ckpt).trigger(availableNow=True)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    if state_partitions:
        spark.conf.set("spark.sql.shuffle.partitions", str(state_partitions))
    try:
        if output_mode == "append":
            q = w.format("parquet").outputMode("append").option("path", out).start()
        else:
            def write(batch: DataFrame, _bid: int) -> None:
                batch.write.mode("overwrite").parquet(out)

            q = w.outputMode(output_mode).foreachBatch(write).start()
        q.awaitTermination()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return out


def _partial(df: DataFrame, ts: str, window: str) -> DataFrame:
    w = F.window(utc_instant(df, ts), window)
    n = df.groupBy(w.alias("w")).agg(F.count(F.lit(1)).alias("n"), F.count_if(~F.col("ok")).alias("escalated"))
    return n.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "n", "escalated")


def account_windows(gated: DataFrame, ts: str, folder: str, window: str = "1 day", watermark: str = "1 day",
                    state_partitions: int | None = None) -> DataFrame:
    """Run the stream over what is available and account for every row of it:
    (window_start, window_end, state, n, escalated) with state ``closed``
    (counted, the window is final and its state freed), ``late`` (came after
    its window was closed, in no rate) or ``open`` (the watermark hasn't passed
    the window). The three add up to all rows that arrived.

    ``folder`` (shared storage) holds the results and checkpoints; a further
    run on it goes on where the last one ended. Closed windows leave an
    append-mode aggregation once, for good. What arrived is counted by a
    second, stateless stream: each micro-batch writes its own counts under its
    batch number, so a repeated batch replaces itself. Rows without an event
    time belong to no window."""
    spark = gated.sparkSession
    before = spark.conf.get("spark.sql.shuffle.partitions")
    rates = escalation_rate_stream(gated, ts, window, watermark).drop("escalation_rate")

    def count(batch: DataFrame, number: int) -> None:
        _partial(batch, ts, window).write.mode("overwrite").parquet(f"{folder}/arrived/batch={number}")

    def started(sdf: DataFrame, name: str):
        return sdf.writeStream.option("checkpointLocation", f"{folder}/checkpoint-{name}").trigger(availableNow=True)

    def finished(query) -> list:
        query.awaitTermination()
        if query.exception() is not None:
            raise RuntimeError(str(query.exception()))
        return query.recentProgress

    try:
        if state_partitions:
            spark.conf.set("spark.sql.shuffle.partitions", str(state_partitions))
        progress = finished(started(rates, "closed").format("parquet").outputMode("append").option("path", f"{folder}/closed").start())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    timed = gated.where(F.col(ts).isNotNull()).select("ok", ts)
    finished(started(timed, "arrived").foreachBatch(count).start())

    columns = "window_start timestamp, window_end timestamp, n long, escalated long"
    closed = spark.read.schema(columns).parquet(f"{folder}/closed")
    # The last batch closed all windows up to the watermark it reports (ISO time, UTC).
    marks = [p["eventTime"]["watermark"] for p in progress if "watermark" in (p["eventTime"] or {})]
    if marks:
        spark.createDataFrame([(marks[-1],)], "at string").coalesce(1).write.mode("append").parquet(f"{folder}/watermarks")
    last = spark.read.schema("at string").parquet(f"{folder}/watermarks").agg(F.max("at")).first()[0]
    arrived = spark.read.schema(columns).option("basePath", f"{folder}/arrived").parquet(f"{folder}/arrived")
    total = arrived.groupBy("window_start", "window_end").agg(F.sum("n").alias("n"), F.sum("escalated").alias("escalated"))
    both = total.join(closed.withColumnsRenamed({"n": "c_n", "escalated": "c_escalated"}), ["window_start", "window_end"], "left")
    done = F.col("window_end") <= F.to_timestamp(F.lit(last))
    part = lambda state, n, esc: F.struct(F.lit(state).alias("state"), n.cast("long").alias("n"), esc.cast("long").alias("escalated"))
    c_n, c_esc = F.coalesce("c_n", F.lit(0)), F.coalesce("c_escalated", F.lit(0))
    states = F.array(part("closed", c_n, c_esc), part("late", F.col("n") - c_n, F.col("escalated") - c_esc))
    states = F.when(done, states).otherwise(F.array(part("open", F.col("n"), F.col("escalated"))))
    return both.select("window_start", "window_end", F.explode(states).alias("s")).select("window_start", "window_end", "s.*").where("n > 0")


def stream_gate(sdf: DataFrame, guard: bool = True, gold_col: str = "ticket") -> DataFrame:
    """Validate and gate a stream of predictions; a gold ticket column passed
    through from the request is renamed ``gold``."""
    if gold_col in sdf.columns:
        sdf = sdf.withColumnRenamed(gold_col, "gold")
    return gate(validate_stream(sdf, into="pred"), guard=guard, ticket_col="pred")

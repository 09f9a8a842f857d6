"""JSONL round trip and streaming = batch."""

import pytest
from pyspark.sql import functions as F

from quarry.session import scratch_path
from quarry.sources.jsonl import read_examples, write_examples


def test_jsonl_keeps_nulls(spark):
    df = spark.createDataFrame(
        [(1, "m", (None, "other", "neutral", "low", "s"))],
        "example_id long, message string, ticket struct<order_id: string, issue: string, sentiment: string, priority: string, summary: string>",
    )
    p = scratch_path(spark, "t-jsonl")
    write_examples(df, p, single_file=True)
    text = spark.read.text(p).first().value
    assert '"order_id":null' in text
    back = read_examples(spark, p).first()
    assert back.ticket.order_id is None and back.ticket.issue == "other"


def test_jsonl_failfast(spark):
    p = scratch_path(spark, "t-bad")
    spark.createDataFrame([('{"example_id": 1}',), ("not json",)], "value string").coalesce(1).write.text(p)
    with pytest.raises(Exception):
        read_examples(spark, p).collect()


def test_stream_equals_batch(spark, sf_small):
    from quarry.plans.queries import q_stream_escalation_rate, q_stream_validate

    s = {r.window_start: (r.n, r.escalated) for r in q_stream_escalation_rate(spark, sf_small).collect()}
    v = q_stream_validate(spark, sf_small)
    ev = spark.read.parquet(f"{sf_small}/events.parquet").select(F.col("event_id").alias("example_id"), "ts")
    b = (
        v.join(ev, "example_id")
        .groupBy(F.date_format(F.date_trunc("day", "ts"), "yyyy-MM-dd HH:mm:ss").alias("d"))
        .agg(F.count("*").alias("n"), F.count_if(~F.col("ok")).alias("e"))
    )
    assert s == {r.d: (r.n, r.e) for r in b.collect()}


def test_chat_and_preference_jsonl_roundtrip(spark, sf_small):
    from quarry.operators.chat import preference_pairs, to_chat
    from quarry.plans.queries import tickets
    from quarry.sources.jsonl import CHAT_SCHEMA, PREF_SCHEMA, write_dataset
    from quarry.operators.prepare import split_tail

    t = tickets(spark, sf_small)
    p = scratch_path(spark, "t-pref")
    pairs = preference_pairs(t)
    write_examples(pairs, p)
    back = read_examples(spark, p, PREF_SCHEMA)
    assert back.exceptAll(pairs).count() == 0 and pairs.exceptAll(back).count() == 0

    out = scratch_path(spark, "t-ds")
    paths = write_dataset(split_tail(t, 20, 20), out, to_chat)
    tr = read_examples(spark, paths["train"], CHAT_SCHEMA)
    te = read_examples(spark, paths["test"])
    assert te.count() == 20 and tr.count() == t.count() - 40
    assert all(len(r.messages) == 3 for r in tr.limit(5).collect())


def test_late_rows_dropped_by_watermark(spark):
    """Two runs of one stream (same checkpoint): the second brings rows far
    behind the watermark set by the first; append mode must not count them."""
    import datetime as dt

    from quarry.streaming.validate import escalation_rate_stream

    src, out, ckpt = (scratch_path(spark, x) for x in ("t-late-src", "t-late-out", "t-late-ckpt"))
    schema = "ok boolean, ts timestamp_ntz"
    day = dt.datetime(2024, 1, 1)
    on_time = [(i % 3 != 0, day + dt.timedelta(days=i, hours=1)) for i in range(10)]
    late = [(False, day + dt.timedelta(days=1, hours=2)) for _ in range(5)]

    def run():
        stream = spark.readStream.schema(schema).parquet(src)
        q = (escalation_rate_stream(stream, "ts", "1 day", "1 day").writeStream.format("parquet")
             .outputMode("append").option("path", out).option("checkpointLocation", ckpt)
             .trigger(availableNow=True).start())
        q.awaitTermination()

    spark.createDataFrame(on_time, schema).coalesce(1).write.mode("append").parquet(src)
    run()
    spark.createDataFrame(late, schema).coalesce(1).write.mode("append").parquet(src)
    run()
    rows = {r.window_start.day: (r.n, r.escalated) for r in spark.read.parquet(out).collect()}
    assert rows, "some windows must close"
    assert rows[2] == (1, 0)  # the five late rows for 2 January were dropped
    assert sum(n for n, _ in rows.values()) <= 10


def test_model_calls_on_a_stream(spark, sf_small):
    """extract_batch (mapInPandas) runs unchanged on a streaming source."""
    from quarry.operators.generate import generate_examples
    from quarry.operators.infer import KeywordPredictor, extract_batch
    from quarry.plans.queries import EVENTS_SCHEMA
    from quarry.streaming.validate import read_table_stream, run_available

    ev = read_table_stream(spark, sf_small, "events", spark.createDataFrame([], EVENTS_SCHEMA).schema)
    msgs = generate_examples(ev, key="event_id", seed=7).select("example_id", "message")
    out = run_available(extract_batch(msgs, KeywordPredictor, "keyword").drop("latency_s"), "t-extract", "append")
    got = spark.read.parquet(out)
    assert got.count() == spark.read.parquet(f"{sf_small}/events.parquet").count()
    assert got.filter(F.col("raw").startswith("{")).count() == got.count()


def test_jsonl_skips_blank_lines(spark):
    p = scratch_path(spark, "t-blank")
    lines = ['{"example_id": 1, "message": "a", "ticket": null}', "", "   ",
             '{"example_id": 2, "message": "b", "ticket": {"order_id": null, "issue": "other",'
             ' "sentiment": "neutral", "priority": "low", "summary": "s"}}']
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(p)
    got = sorted(r.example_id for r in read_examples(spark, p).collect())
    assert got == [1, 2]

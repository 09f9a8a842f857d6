"""A durable ledger of model calls: what was answered is never asked again.

The ledger is a folder of Parquet files on shared storage, one row for each
answered (model, id, prompt). Rows still to be asked are found by an anti-join
with it, cut into partitions of at most about ``rows_per_commit`` and asked by
the tasks; a task's answers enter the ledger when that task ends, not when the
job does. So a job that is killed or fails half way has lost only the
partitions that were being asked, and the next run resumes behind them.

A prompt is the system prompt and the message (null counts as empty); a
changed prompt is a new question. Rows that repeat id and prompt are asked
once and share the answer. Null ids are an id of their own. Two runs on one
ledger at the same time may ask twice; readers then take the smaller answer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.contract import SYSTEM_PROMPT
from quarry.operators.infer import PRED_FIELDS, extract_batch
from quarry.operators.ranks import written

_ANSWER = [f.name for f in PRED_FIELDS if f.name != "model"]
_SCHEMA = "model string, id string, prompt_hash string, raw string, latency_s double, prompt_tokens int, completion_tokens int"


def prompt_hash(message: Column, system_prompt: str) -> Column:
    return F.sha2(F.concat(F.sha2(F.lit(system_prompt), 256), F.lit(":"), F.coalesce(message, F.lit(""))), 256)


class CallLedger:
    """Answers kept under ``path`` (any file system Spark can write)."""

    def __init__(self, spark: SparkSession, path: str, rows_per_commit: int = 10_000):
        self.spark, self.path, self.rows_per_commit = spark, path, rows_per_commit

    def _exists(self) -> bool:
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(self.path)
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(p)

    def entries(self) -> DataFrame:
        """All rows as they were committed."""
        return self.spark.read.schema(_SCHEMA).parquet(self.path) if self._exists() else self.spark.createDataFrame([], _SCHEMA)

    def answers(self, model: str) -> DataFrame:
        """id, prompt_hash and the answer, once for each question of ``model``."""
        least = F.min(F.struct(*_ANSWER)).alias("a")
        mine = self.entries().where(F.col("model") == model).groupBy("id", "prompt_hash").agg(least)
        return mine.select("id", "prompt_hash", *(F.col(f"a.{c}").alias(c) for c in _ANSWER))

    def pending(self, df: DataFrame, model: str, key: str, message: str, system_prompt: str = SYSTEM_PROMPT) -> DataFrame:
        """id, prompt_hash, prompt of the questions of ``df`` without an answer."""
        asked = df.select(F.col(key).cast("string").alias("id"), prompt_hash(F.col(message), system_prompt).alias("prompt_hash"), F.coalesce(message, F.lit("")).alias("prompt"))
        known = self.answers(model).select(F.col("id").alias("_id"), F.col("prompt_hash").alias("_hash"))
        return asked.dropDuplicates(["id", "prompt_hash"]).join(known, F.col("id").eqNullSafe(F.col("_id")) & (F.col("prompt_hash") == F.col("_hash")), "left_anti")

    def call(self, df: DataFrame, predictor_factory, model: str, key: str = "example_id", message: str = "message", system_prompt: str = SYSTEM_PROMPT) -> DataFrame:
        """``df`` with model, raw, latency_s, prompt_tokens, completion_tokens
        (columns of these names are replaced); asks only what has no answer."""
        # Written once: counted, then asked, without working ``df`` out again.
        pending = written(self.pending(df, model, key, message, system_prompt), "pending-calls")
        n = pending.count()
        if n:
            # Hash partitions of many questions are about even; the count is of questions, not rows.
            spread = pending.repartition(-(-n // self.rows_per_commit), "id", "prompt_hash")
            got = extract_batch(spread, predictor_factory, model, "prompt", system_prompt).select("model", "id", "prompt_hash", *_ANSWER)
            # Version 2 moves a task's files into place when the task commits.
            got.write.mode("append").option("mapreduce.fileoutputcommitter.algorithm.version", "2").parquet(self.path)
        rows = df.drop("model", *_ANSWER)
        known = self.answers(model).withColumnsRenamed({"id": "_id", "prompt_hash": "_hash"})
        same = F.col(key).cast("string").eqNullSafe(F.col("_id")) & (prompt_hash(F.col(message), system_prompt) == F.col("_hash"))
        return rows.join(known, same, "left").select(*rows.columns, F.lit(model).alias("model"), *_ANSWER)

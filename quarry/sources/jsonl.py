"""JSON Lines sources and sinks with explicit schemas.

Reads never infer a schema and fail fast on a malformed line (the default
PERMISSIVE mode would turn it into a silent null row). Writes keep null
fields (``"order_id": null`` must survive) and produce a directory of part
files; a single file only on request.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.contract import TICKET

MESSAGE_T = T.StructType([T.StructField("role", T.StringType()), T.StructField("content", T.StringType())])

EXAMPLE_SCHEMA = T.StructType(
    [
        T.StructField("example_id", T.LongType()),
        T.StructField("message", T.StringType()),
        T.StructField("ticket", TICKET.spark_schema()),
    ]
)
CHAT_SCHEMA = T.StructType(
    [T.StructField("example_id", T.LongType()), T.StructField("messages", T.ArrayType(MESSAGE_T))]
)
PREF_SCHEMA = T.StructType(
    [
        T.StructField("example_id", T.LongType()),
        T.StructField("prompt", T.ArrayType(MESSAGE_T)),
        T.StructField("chosen", T.StringType()),
        T.StructField("rejected", T.StringType()),
    ]
)


def read_examples(spark: SparkSession, path: str, schema: T.StructType = EXAMPLE_SCHEMA) -> DataFrame:
    """One JSON object per non-blank line; blank lines are skipped."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def write_examples(df: DataFrame, path: str, single_file: bool = False) -> None:
    """Overwrite ``path`` (a directory) with one JSON object per line."""
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def write_dataset(parts: DataFrame, out: str, format_chat, split_col: str = "split") -> dict[str, str]:
    """train and val as chat records, test as labelled examples (three writes
    from one DataFrame, which callers should checkpoint first)."""
    paths = {s: f"{out.rstrip('/')}/{s}" for s in ("train", "val", "test")}
    for s in ("train", "val"):
        write_examples(format_chat(parts.filter(F.col(split_col) == s)), paths[s])
    write_examples(parts.filter(F.col(split_col) == "test").drop(split_col), paths["test"])
    return paths

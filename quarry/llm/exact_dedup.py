"""Exact dedup by an extendible-hash index on shared files.

1. Every row's 64-bit hash, SHA-256 and length of its normalised text are
   written to the shared folder (the entries; no texts).
2. The directory: the bytes of the distinct keys are counted by hash prefix,
   and a bucket over its capacity splits in two, which doubles the directory
   where needed, until none is overfull or the hash has no more bits. Rounds
   of counting go deeper only below overfull buckets. The capacity grows with
   the corpus so that there are at most ~2^21 buckets (16 MB of directory).
3. Copies meet first within a task, so one group's copies reach an owner once
   for each batch of rows; then each bucket goes to one owner task, which chains the
   different texts of a hash, compares their bytes and writes the index.
4. Each entry looks its group up by hash and SHA-256.

Texts are equal when identical after each run of ASCII white space became one
space; a null text counts as empty. The smallest doc_id of a group stays;
null ids sort last, and a group with only null ids keeps the null. Rows that
repeat both id and text share that id's fate (``deduplicated`` then keeps one).
Empty tables give no rows; further columns are ignored by the index.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.common import SPACE, free_names, lean, prepare, row_key, slices, table, written

CAPACITY = 8 << 20  # bytes of distinct texts in a bucket, at least
MAX_BUCKETS = 1 << 20
FIRST_BITS, MORE_BITS = 10, 4


def normalised(text: str = "text") -> Column:
    return F.regexp_replace(F.coalesce(F.col(text), F.lit("")), SPACE, " ")


def _hash(col: str, bits: int) -> Column:
    h = F.xxhash64(col)
    return h if bits == 64 else F.shiftleft(F.shiftrightunsigned(h, 64 - bits), 64 - bits)


def directory(entries: DataFrame, capacity: int | None = None) -> np.ndarray:
    """Where each bucket's key range begins (unsigned, sorted)."""
    keys = entries.groupBy("h").agg(F.max("n_bytes").alias("b"))
    starts: list[int] = []
    over: list[int] | None = None
    depth = 0
    while over is None or over:
        deeper = min(64, depth + (MORE_BITS if depth else FIRST_BITS))
        at = lambda d: F.shiftrightunsigned("h", 64 - d) if d < 64 else F.col("h")
        some = keys if over is None else keys.join(F.broadcast(keys.sparkSession.createDataFrame([(p if p < 1 << 63 else p - (1 << 64),) for p in over], "p long")), at(depth) == F.col("p"), "left_semi")
        counts = {r.p % (1 << 64): r.b for r in some.groupBy(at(deeper).alias("p")).agg(F.sum("b").alias("b")).collect()}
        if capacity is None:
            capacity = max(CAPACITY, sum(counts.values()) // MAX_BUCKETS)
        tops, nxt = ([0] if over is None else over), []
        level = {deeper: counts}
        for d in range(deeper - 1, depth - 1, -1):
            level[d] = {}
            for p, b in level[d + 1].items():
                level[d][p >> 1] = level[d].get(p >> 1, 0) + b
        todo = [(p, depth) for p in tops]
        while todo:
            p, d = todo.pop()
            if level[d].get(p, 0) <= capacity or d == 64:
                starts.append(p << (64 - d))
            elif d == deeper:
                nxt.append(p)
            else:
                todo += [(2 * p, d + 1), (2 * p + 1, d + 1)]
        over, depth = nxt, deeper
    return np.array(sorted(starts), dtype=np.uint64)


def index_documents(docs: DataFrame, hash_bits: int = 64, capacity: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(entries, index). ``hash_bits`` shortens the hash, which only tests do."""
    spark = docs.sparkSession
    prepare(spark)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), normalised().alias("t")).withColumn("h", _hash("t", hash_bits))
    entries = written(texts.select("doc_id", "h", F.sha2("t", 256).alias("sha"), F.octet_length("t").alias("n_bytes")), "dedup-entries")
    starts = spark.sparkContext.broadcast(directory(entries, capacity))

    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            seen: dict[str, list] = {}
            for d, t, h in zip(*(b.column(c).to_pylist() for c in ("doc_id", "t", "h")), strict=True):
                g = seen.setdefault(t, [h, d, 0])
                g[1] = d if g[1] is None else g[1] if d is None else min(d, g[1])
                g[2] += 1
            h = np.array([g[0] for g in seen.values()], dtype=np.int64)
            bucket = np.searchsorted(starts.value, h.view(np.uint64), side="right") - 1
            for out in slices([pa.RecordBatch.from_arrays([pa.array(bucket, pa.int64()), pa.array(h), pa.array(seen, pa.string()), pa.array([g[1] for g in seen.values()], pa.int64()), pa.array([g[2] for g in seen.values()], pa.int64())], names=["bucket", "h", "t", "doc_id", "n"])], 2048):
                yield out

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, chains = None, {}

        def out() -> pa.RecordBatch:
            rows = [(now, h, k, hashlib.sha256(t).hexdigest(), g[0], g[1]) for h, chain in chains.items() for k, (t, g) in enumerate(chain)]
            return pa.RecordBatch.from_pylist([dict(zip(schema.names, r, strict=True)) for r in rows], schema)

        schema = pa.schema([("bucket", pa.int64()), ("h", pa.int64()), ("chain", pa.int32()), ("sha", pa.string()), ("keep_id", pa.int64()), ("group_size", pa.int64())])
        for b in slices(batches):
            for bucket, h, t, d, n in zip(*(b.column(c).to_pylist() for c in ("bucket", "h", "t", "doc_id", "n")), strict=True):
                if bucket != now:
                    if chains:
                        yield out()
                    now, chains = bucket, {}
                chain, t = chains.setdefault(h, []), t.encode()
                for have, g in chain:
                    if have == t:  # the bytes, not the hash, decide
                        g[0] = d if g[0] is None else g[0] if d is None else min(d, g[0])
                        g[1] += n
                        break
                else:
                    chain.append((t, [d, n]))
        if chains:
            yield out()

    owned = texts.mapInArrow(lean(combine), "bucket long, h long, t string, doc_id long, n long").repartition("bucket").sortWithinPartitions("bucket")
    return entries, written(owned.mapInArrow(lean(own), "bucket long, h long, chain int, sha string, keep_id long, group_size long"), "dedup-index")


def exact_groups(docs: DataFrame, **how) -> DataFrame:
    """Per row: doc_id, keep_id, group_size, kept, text_sha256, bucket, chain."""
    entries, index = index_documents(docs, **how)
    return entries.join(index, ["h", "sha"]).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), F.col("sha").alias("text_sha256"), "bucket", "chain"
    )


def keep_rows(docs: DataFrame, kept: DataFrame, text: Column) -> DataFrame:
    """The rows of ``docs`` that ``kept`` names, one for each doc_id (null is
    one too) and ``text``: by doc_id, and by text_sha256 of ``text`` where it
    has that column, so that different texts of one id stand or fall apart.
    Of rows that agree in both, the one with the smallest hash of all its
    columns (but maps) stays, so a stage that runs again keeps the same rows.
    Input columns keep their names and values whatever they are called."""
    key, sha, row = free_names(docs, "_key", "_sha", "_row")
    columns = [F.col(f"`{f.name}`") for f in docs.schema.fields]
    plain = [F.col(f"`{f.name}`") for f in docs.schema.fields if not re.search("map<|variant", f.dataType.simpleString())]
    keyed = docs.select(row_key().alias(key), F.sha2(text, 256).alias(sha), F.struct(*columns).alias(row), F.xxhash64(*plain).alias(f"{row}_hash"))
    names = {key: row_key()} | ({sha: F.col("text_sha256")} if "text_sha256" in kept.columns else {})
    rows = keyed.join(kept.select(*[c.alias(k) for k, c in names.items()]), list(names), "left_semi")
    return rows.groupBy(key, sha).agg(F.min_by(row, f"{row}_hash").alias(row)).select(f"{row}.*")


def deduplicated(docs: DataFrame) -> DataFrame:
    return keep_rows(docs, exact_groups(docs).where("kept").select("doc_id", "text_sha256"), normalised())


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents")).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


OP7_SQL = r"""
WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents),
g AS (SELECT t, min(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY t)
SELECT t.doc_id, keep_id, group_size, t.doc_id IS NOT DISTINCT FROM keep_id AS kept, sha256(t) AS text_sha256
FROM t JOIN g USING (t)
"""

"""Token-ID output: flat unsigned integer files plus 64-bit document offsets.

A job range-partitions the documents by id, encodes each partition and writes
three files for it to a shared folder: ``.bin`` (ids, uint16 where the
vocabulary allows, else uint32), ``.off`` (n + 1 int64 offsets into it) and
``.doc`` (int64 document ids, then one byte each: 1 for a null id). One
manifest row for each partition comes back; prefix sums over the manifest give
each partition's base, so that base + offset is a document's place in the
corpus. Files are written under a name of their own attempt and only the
manifest of the attempts that Spark committed is ever read.

Order: ascending doc_id, nulls first, rows of one id by their text's hash.
Null texts count as empty (only the end id). An empty table has no files and
no rows. Other columns of the input are ignored.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.common import crc32_u32, encoder, lean, prepare, table, text_slices, tokenizer_spec, written
from quarry.session import scratch_path

MANIFEST = "part int, path string, n_docs long, n_tokens long, width int"
PARTITION_TEXT_BYTES = 32 << 20


def _open(path: str):
    """(file system, path in it) of a URI or plain path of the shared folder."""
    return pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)


def _read(path: str, dtype) -> np.ndarray:
    """Memory-mapped where the folder is mounted, read through Arrow elsewhere."""
    fs, p = _open(path)
    if isinstance(fs, pafs.LocalFileSystem):
        return np.memmap(p, dtype=dtype, mode="r") if os.path.getsize(p) else np.zeros(0, dtype=dtype)
    with fs.open_input_file(path if p is None else p) as f:
        return np.frombuffer(f.read(), dtype=dtype)


def write_token_files(docs: DataFrame, tokenizer_path: str, end_id: int, folder: str, lead: str = " ") -> DataFrame:
    """Write the files and return the manifest, one row for each partition."""
    spark = docs.sparkSession
    prepare(spark)
    spec = tokenizer_spec(spark, tokenizer_path)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(spec.value, lead)
        width = 2 if max(enc.tok.get_vocab_size() - 1, end_id) < 1 << 16 else 4
        part, total, sizes, ids, nulls = TaskContext.get().partitionId(), 0, [0], [], []
        path = f"{folder}/{part:06d}-{uuid.uuid4().hex[:12]}"
        fs, p = _open(path)
        out = None
        for b in text_slices(batches):
            if out is None:
                fs.create_dir(os.path.dirname(p), recursive=True)
                out = fs.open_output_stream(f"{p}.bin")
            for got in enc.encode(b.column("text")):
                out.write(np.append(got, np.uint32(end_id)).astype(f"<u{width}").tobytes())
                total += len(got) + 1
                sizes.append(total)
            for d in b.column("doc_id").to_pylist():
                ids.append(d or 0)
                nulls.append(d is None)
        if out is None:
            return
        out.close()
        with fs.open_output_stream(f"{p}.off") as f:
            f.write(np.asarray(sizes, dtype="<i8").tobytes())
        with fs.open_output_stream(f"{p}.doc") as f:
            f.write(np.asarray(ids, dtype="<i8").tobytes() + np.asarray(nulls, dtype=np.uint8).tobytes())
        yield pa.RecordBatch.from_pydict(
            {"part": pa.array([part], pa.int32()), "path": [path], "n_docs": pa.array([len(ids)], pa.int64()), "n_tokens": pa.array([total], pa.int64()), "width": pa.array([width], pa.int32())}
        )

    size = docs.agg(F.sum(F.octet_length("text")).alias("b")).first().b or 0
    parts = max(spark.sparkContext.defaultParallelism, -(-size // PARTITION_TEXT_BYTES))
    order = ["doc_id", "_h", "_i"]
    ranged = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("_h"), F.monotonically_increasing_id().alias("_i"))
        .repartitionByRange(parts, *order)
        .sortWithinPartitions(*order)
        .select("doc_id", "text")
    )
    return written(ranged.mapInArrow(lean(write), MANIFEST), "token-manifest")


def read_token_files(manifest: DataFrame) -> DataFrame:
    """Per document, from the files: doc_id, start, n_tokens, ids_crc32."""
    spark = manifest.sparkSession
    prepare(spark)
    # One row per partition of the writing job: bases by a prefix sum.
    rows = sorted(manifest.select("part", "path", "n_tokens", "width").collect())
    bases = [0, *accumulate(r.n_tokens for r in rows)]
    files = spark.createDataFrame([(r.path, b, r.width) for r, b in zip(rows, bases, strict=False)], "path string, base long, width int")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for f in b.to_pylist():
                ids, off = _read(f"{f['path']}.bin", f"<u{f['width']}"), _read(f"{f['path']}.off", "<i8")
                n = len(off) - 1
                doc = _read(f"{f['path']}.doc", np.uint8)
                doc, null = doc[: 8 * n].view("<i8"), doc[8 * n :].astype(bool)
                for i in range(0, n, 4096):
                    j = min(n, i + 4096)
                    yield pa.RecordBatch.from_pydict(
                        {
                            "doc_id": pa.array(np.asarray(doc[i:j]), pa.int64(), mask=null[i:j]),
                            "start": pa.array(off[i:j] + f["base"], pa.int64()),
                            "n_tokens": pa.array(np.diff(off[i : j + 1]), pa.int64()),
                            "ids_crc32": pa.array([crc32_u32(ids[off[k] : off[k + 1]]) for k in range(i, j)], pa.int64()),
                        }
                    )

    return files.repartition(max(1, len(rows)), "path").mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    manifest = write_token_files(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), 2, scratch_path(spark, "tokens"))
    return read_token_files(manifest)

"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams.

Features are the presence of words, bigrams and skip-grams (one or two words
between), hashed into 2^18 places. FTRL-proximal keeps a rate for each
coordinate and its L1 term leaves most weights at zero, so the model is a
short list of (place, weight) that is broadcast (2^18 at most) for scoring.

The learner sees at most about ``ROWS`` labelled documents, drawn by a hash of
the id (a documented bound on the sample; a single task runs over it in
order, for ``EPOCHS`` passes); every document is scored on its whole text.
Labels of one id that differ count as toxic; null labels aren't learned from.
Null and empty texts score the intercept alone; without labels all score 0.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.common import WordHashes, fold, mix64, prepare, slices, table

ROWS = 24_000
EPOCHS = 3
PLACES = 1 << 18
ALPHA, BETA, L1, L2 = 0.15, 1.0, 1.5, 0.5
THRESHOLD = 0.3

_WORDS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or 48 <= c <= 57 or c >= 128 else 32 for c in range(256))
_HASHES = WordHashes()


def places(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(document, place) of every feature occurrence of a few texts. Place 0 is the intercept's."""
    words = [(t or "").encode().translate(_WORDS).split() for t in texts]
    doc = np.repeat(np.arange(len(texts)), [len(w) for w in words])
    h = np.concatenate([_HASHES.of(w) for w in words]) if words else np.zeros(0, np.uint64)
    docs, keys = [doc], [mix64(h)]
    for gap in (1, 2, 3):
        same = doc[gap:] == doc[:-gap]
        docs.append(doc[gap:][same])
        keys.append(mix64(h[:-gap] * np.uint64(2 * gap + 1) + h[gap:] * np.uint64(0x9E3779B97F4A7C15) + np.uint64(gap > 1))[same])
    return np.concatenate(docs), (np.concatenate(keys) % np.uint64(PLACES - 1) + np.uint64(1)).astype(np.int64)


class Ftrl:
    """Per-coordinate FTRL-proximal over sets of places."""

    def __init__(self) -> None:
        self.z, self.n = np.zeros(PLACES), np.zeros(PLACES)

    def weights(self, at) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        return np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2))

    def learn(self, at: np.ndarray, y: int) -> None:
        w = self.weights(at)
        g = 1 / (1 + np.exp(-np.clip(w.sum(), -30, 30))) - y
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / ALPHA * w
        self.n[at] = n + g * g


def train(docs: DataFrame, labels: DataFrame, learn: Column) -> dict[int, float]:
    """Non-zero weights by place."""
    spark = docs.sparkSession
    prepare(spark)
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & learn).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    n = known.count()
    if not n:
        return {}
    draw = F.pmod(F.xxhash64("doc_id", F.lit(8)), F.lit(1 << 20)) / (1 << 20)
    # At most about ROWS (id, label) pairs, whatever the table's size.
    some = F.broadcast(known.where(draw < min(1.0, ROWS / n)))

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, rows = Ftrl(), []
        for b in slices(batches):
            doc, place = places(b.column("text").to_pylist())
            both = np.unique(doc * PLACES + place)
            cuts = np.searchsorted(both, np.arange(b.num_rows + 1) * PLACES)
            rows += [(np.append(0, both[cuts[i] : cuts[i + 1]] % PLACES).astype(np.int32), y) for i, y in enumerate(b.column("toxic").to_pylist())]
        for e in range(EPOCHS):
            for i in np.random.default_rng(e).permutation(len(rows)):
                model.learn(*rows[i])
        w = model.weights(slice(None))
        at = np.flatnonzero(w)
        yield pa.RecordBatch.from_pydict({"place": pa.array(at, pa.int64()), "weight": pa.array(w[at], pa.float64())})

    rows = docs.select("doc_id", "text").join(some, "doc_id").select("doc_id", "text", F.col("toxic").cast("int").alias("toxic"))
    one = rows.repartition(1).sortWithinPartitions("doc_id", F.xxhash64("text"))
    return {r.place: r.weight for r in one.mapInArrow(fit, "place long, weight double").collect()}


def score(docs: DataFrame, model: dict[int, float]) -> DataFrame:
    """``docs`` with ``score``."""
    spark = docs.sparkSession
    prepare(spark)
    at = np.array(sorted(model), dtype=np.int64)
    shared = spark.sparkContext.broadcast((at, np.array([model[k] for k in at])))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, values = shared.value
        w = np.zeros(PLACES)
        w[at] = values
        used = w != 0
        for b in slices(batches):
            doc, place = places(b.column(b.schema.get_field_index("text")).to_pylist())
            hit = used[place]
            both = np.unique(doc[hit] * PLACES + place[hit])
            total = w[0] + np.bincount(both // PLACES, w[both % PLACES], minlength=b.num_rows)
            p = 1 / (1 + np.exp(-np.clip(total, -30, 30))) if len(at) else np.zeros(b.num_rows)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(p, pa.float64())], names=[*b.schema.names, "score"])

    return docs.mapInArrow(run, docs.select("*", F.lit(0.0).alias("score")).schema)


def held_out() -> Column:
    return fold("doc_id", 4) == 2


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = train(docs, table(spark, sf_dir, "labels"), ~held_out())
    scored = score(docs.select("doc_id", "text"), model).withColumn("score", F.round("score", 6))  # the verdict is of the score shown
    return scored.select("doc_id", held_out().alias("held_out"), "score", F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"))

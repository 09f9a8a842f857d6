"""Language identification with error-correcting output codes.

Each language gets a codeword of bits; one binary logistic classifier per bit
is fitted on hashed byte bigrams and trigrams of the letters of whole texts.
A text's language is the one whose codeword has the least logistic loss under
the classifiers' margins (loss-weighted decoding). A decision is ambiguous
where the two best codewords lie within ``AMBIGUOUS`` of loss per bit, or
where the signs of the margins are further from the chosen codeword than half
the code's least distance corrects.

The classifiers learn from at most about ``ROWS_PER_LANG`` labelled rows of
each language, drawn by a hash of the id (a documented bound on the sample;
scoring reads every row). Null languages are never learned from. Texts that
are null or have no letter are ``und`` with score 0, as is every text where
nothing could be learned. With one learned language every text with letters
gets it with score 1. Rows repeat as they do in the input; ties go to the
language first in alphabetical order.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.common import fold, free_names, lean, prepare, slices, table

ROWS_PER_LANG = 1000
BITS = 12  # log2 of the hashed n-gram space
STEPS = 80
AMBIGUOUS = 0.02
UND = "und"

_LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def features(text: str) -> np.ndarray:
    """Square roots of n-gram counts, at unit length."""
    b = np.frombuffer(b" " + b" ".join(text.lower().encode().translate(_LETTERS).split()) + b" ", dtype=np.uint8).astype(np.uint32)
    two = b[:-1] * np.uint32(0x9E3779B1) + b[1:] * np.uint32(0x85EBCA77)
    three = two[:-1] * np.uint32(31) + b[2:] * np.uint32(0xC2B2AE3D)
    x = np.sqrt(np.bincount(np.concatenate([two, three]) >> np.uint32(32 - BITS), minlength=1 << BITS).astype(np.float32))
    return x / (np.linalg.norm(x) or 1)


def codewords(n: int) -> np.ndarray:
    """n rows of +-1: every split of the classes in two while there are few,
    else the best-separated of 40 random codes (fixed seed)."""
    if n <= 6:
        cols = [(1, *c) for c in itertools.product((1, -1), repeat=n - 1) if -1 in c]
        return np.array(cols, dtype=np.float32).T.reshape(n, -1)
    rng, best = np.random.default_rng(7), (-1, None)
    for _ in range(40):
        code = rng.choice(np.array([-1, 1], dtype=np.float32), (n, 10 * int(np.ceil(np.log2(n)))))
        far = ((code.shape[1] - code @ code.T) / 2 + np.eye(n) * code.shape[1]).min()
        best = max(best, (far, code), key=lambda x: x[0])
    return best[1]


def fit(x: np.ndarray, y: np.ndarray, code: np.ndarray) -> np.ndarray:
    """(features + 1, bits) weights, by Adam on the logistic loss; classes weigh alike."""
    t = code[y]
    weight = (1 / np.maximum(np.bincount(y, minlength=len(code)), 1))[y][:, None] / len(code)
    x = np.hstack([x, np.ones((len(x), 1), dtype=np.float32)])
    w = np.zeros((x.shape[1], code.shape[1]), dtype=np.float32)
    m, v = np.zeros_like(w), np.zeros_like(w)
    for k in range(1, STEPS + 1):
        g = x.T @ (-t * weight / (1 + np.exp(t * (x @ w)))).astype(np.float32) + 1e-6 * w
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        w -= 0.3 * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.99**k)) + 1e-8)
    return w


def decode(margins: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(class, score, ambiguous) by the loss of each codeword."""
    loss = np.logaddexp(0, -margins[:, None, :] * code[None]).mean(2)
    best = loss.argmin(1)
    p = np.exp(-code.shape[1] * (loss - loss.min(1, keepdims=True)))
    rest = np.where(np.arange(len(code)) == best[:, None], np.inf, loss).min(1)
    least = ((code.shape[1] - code @ code.T) / 2 + np.eye(len(code)) * code.shape[1]).min()
    wrong = (np.sign(margins) != code[best]).sum(1)
    return best, (p / p.sum(1, keepdims=True)).max(1), (rest - loss.min(1) < AMBIGUOUS) | (2 * wrong > least)


def train(docs: DataFrame, learn: Column) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(languages, codewords, weights) from the labelled rows where ``learn`` holds."""
    prepare(docs.sparkSession)
    rows = docs.where(learn & F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return [], np.zeros((0, 0)), np.zeros((0, 0))
    langs = sorted(counts)
    share = F.create_map(*[F.lit(v) for k in langs for v in (k, min(1.0, ROWS_PER_LANG / counts[k]))])
    draw = F.pmod(F.xxhash64("doc_id", F.octet_length("text"), F.lit(20)), F.lit(1 << 20)) / (1 << 20)

    def feats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            xs = [features(t) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_pydict({"lang": b.column("lang"), "x": pa.array([x.astype(np.float16).tobytes() for x in xs], pa.binary())})

    got = rows.select("doc_id", "text", "lang").where(draw < share[F.col("lang")]).mapInArrow(lean(feats), "lang string, x binary").collect()
    got = sorted((r.lang, bytes(r.x)) for r in got)
    x = np.stack([np.frombuffer(r[1], dtype=np.float16).astype(np.float32) for r in got]) if got else np.zeros((0, 1 << BITS), dtype=np.float32)
    y = np.array([langs.index(r[0]) for r in got], dtype=np.int64)
    code = codewords(len(langs))
    return langs, code, fit(x, y, code) if len(langs) > 1 else np.zeros(((1 << BITS) + 1, 0), dtype=np.float32)


def predict(docs: DataFrame, model: tuple[list[str], np.ndarray, np.ndarray], names: tuple[str, str, str] = ("lang_pred", "score", "ambiguous")) -> DataFrame:
    """``docs`` with the predicted language, its score and the ambiguity flag."""
    spark = docs.sparkSession
    prepare(spark)
    shared = spark.sparkContext.broadcast(model)  # languages x bits and 2^BITS x bits numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs, code, w = shared.value
        for b in slices(batches):
            texts = b.column(b.schema.get_field_index("text")).to_pylist()
            has = [bool(langs) and t is not None and any(map(str.isalpha, t)) for t in texts]
            lang, score, odd = [UND] * len(texts), np.zeros(len(texts)), np.zeros(len(texts), dtype=bool)
            if len(langs) == 1:
                lang, score = [langs[0] if h else UND for h in has], np.array(has, dtype=float)
            elif any(has):
                at = np.flatnonzero(has)
                x = np.stack([features(texts[i]) for i in at])
                best, score[at], odd[at] = decode(x @ w[:-1] + w[-1], code)
                for i, k in zip(at, best, strict=True):
                    lang[i] = langs[k]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(odd, pa.bool_())], names=[*b.schema.names, *names])

    return docs.mapInArrow(lean(run), docs.select("*", F.lit("").alias(names[0]), F.lit(0.0).alias(names[1]), F.lit(True).alias(names[2])).schema)


def held_out() -> Column:
    return fold("doc_id", 3) == 1


def identified(docs: DataFrame) -> DataFrame:
    """The documents kept: those of a language. Rows without a letter (``und``)
    go; an ambiguous text still has a nearest language and stays. Columns keep
    their names and values whatever they are called; an empty table stays empty."""
    names = free_names(docs, "_lang_pred", "_lang_score", "_lang_ambiguous")
    return predict(docs, train(docs, ~held_out()), names).where(F.col(names[0]) != UND).drop(*names)


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = train(docs, ~held_out())
    return predict(docs.select("doc_id", "text"), model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "ambiguous")

"""Spelling variants: one-edit neighbours found in a reduced alphabet.

Words are maximal runs of letters (``A-Za-z`` and U+00C0 to U+00FF) of whole
texts, A-Z lower-cased. A fixed rule first plants typing errors: where 199
divides the crc32 of ``<doc_id>:<word>``, the word loses one letter in that
document. Words of at least ``LETTERS`` code points and ``OCCURRENCES``
occurrences make the vocabulary.

Every letter is hashed to one of ``SYMBOLS`` symbols. For each distinct
reduced word the whole neighbourhood of one edit is generated (the word
itself, each deletion, replacement and insertion over the few symbols) and
joined with the reduced vocabulary; whatever meets there is verified on the
words themselves by edit distance, so the result is exact. Reduced words are
joined by a 64-bit polynomial code from which each neighbour's code follows in
constant space; equal codes only make candidates.

A word's form is its most frequent near word (ties: the smallest) if that one
is at least ``RATIO`` times as frequent; the root is the end of the chain of
forms, found by pointer doubling (a chain's counts grow by RATIO at each
step, so a few rounds do). Null texts have no words; a null id counts as an
empty string in the planting rule; rows that repeat count as often as they
stand. An empty table gives no words. Other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.common import prepare, slices, table, written

LETTERS, OCCURRENCES, RATIO = 6, 5, 5
SYMBOLS = 8
#: Distinct words a task counts before it passes them on, and codes made at once.
HELD, CODES = 300_000, 200_000
_ALPHABET = "abcdefghijklmnopqrstuvwxyz" + "".join(map(chr, range(0xC0, 0x100)))
_RUN = re.compile(f"[A-Za-zÀ-ÿ]{{{LETTERS},}}")
_AZ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
_BASE = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2^64
_INVERSE = pow(_BASE, -1, 1 << 64)


def words_of(doc_id: int | None, text: str | None) -> Counter:
    """The words of one text and how often they stand in it."""
    out: Counter = Counter()
    lead = b"%s:" % (b"" if doc_id is None else str(doc_id).encode())
    # A word never grows, so shorter runs can't become words.
    for run, n in Counter(_RUN.findall(text or "")).items():
        low = run.translate(_AZ)
        h = zlib.crc32(lead + low.encode())
        if h % 199 == 0:
            low = low[: h % len(low)] + low[h % len(low) + 1 :]
        if len(low) >= LETTERS:
            out[low] += n
    return out


def vocabulary(docs: DataFrame) -> DataFrame:
    """word, n of all words with enough occurrences."""
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for b in slices(batches):
            for d, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                held.update(words_of(d, t))
                if len(held) >= HELD:
                    yield passed(held)
                    held = Counter()
        yield passed(held)

    def passed(held: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])

    counted = docs.select("doc_id", "text").mapInArrow(run, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= OCCURRENCES)


def reduced(word: Column) -> Column:
    """The word over the few symbols (digits), letter by letter."""
    return F.translate(word, _ALPHABET, "".join(str(zlib.crc32(c.encode()) % SYMBOLS) for c in _ALPHABET))


def _symbols(reds: list[str]) -> np.ndarray:
    """Reduced words of one length as rows of symbols (from 1)."""
    flat = np.frombuffer("".join(reds).encode(), dtype=np.uint8).astype(np.uint64)
    return flat.reshape(len(reds), -1) - np.uint64(ord("0") - 1)


def _powers(n: int) -> np.ndarray:
    p = np.full(n + 1, _BASE, dtype=np.uint64)
    p[0] = 1
    return np.cumprod(p, dtype=np.uint64)


def codes_of(s: np.ndarray) -> np.ndarray:
    """The code of each row: the sum of symbols times powers of the base, modulo 2^64."""
    return (s * _powers(s.shape[1])[:-1]).sum(axis=1, dtype=np.uint64)


def neighbourhoods(s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, code) of each row's word and of all words one edit from it, each
    code once a row."""
    m, n = s.shape
    power = _powers(n)
    prefix = np.zeros((m, n + 1), dtype=np.uint64)
    np.cumsum(s * power[:-1], axis=1, out=prefix[:, 1:])
    whole = prefix[:, -1:]
    parts = [whole, prefix[:, :-1] + (whole - prefix[:, 1:]) * np.uint64(_INVERSE)]
    for t in np.arange(1, SYMBOLS + 1, dtype=np.uint64):
        parts.append(whole + (t - s) * power[:n])
        parts.append(prefix + t * power + (whole - prefix) * np.uint64(_BASE))
    codes = np.sort(np.concatenate(parts, axis=1), axis=1)
    new = np.ones(codes.shape, dtype=bool)
    new[:, 1:] = codes[:, 1:] != codes[:, :-1]
    return np.nonzero(new)[0], codes[new]


def _by_length(reds: list[str]) -> Iterator[np.ndarray]:
    """Places of words of one length, so many that their neighbourhoods stay small."""
    size = np.array([len(r) for r in reds])
    for n in np.unique(size):
        at = np.flatnonzero(size == n)
        step = max(1, CODES // int((2 * n + 1) * (SYMBOLS + 1)))
        yield from (at[i : i + step] for i in range(0, len(at), step))


def near_pairs(words: DataFrame) -> DataFrame:
    """word, near, near_n: all ordered pairs of words one edit apart.

    ``words``: word (letters of the alphabet only), n; each word once.
    """
    prepare(words.sparkSession)

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            reds = b.column(2).to_pylist()
            made = np.zeros(len(reds), dtype=np.uint64)
            for at in _by_length(reds):
                made[at] = codes_of(_symbols([reds[i] for i in at]))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(made.view(np.int64))], names=["word", "n", "code"])

    def around(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            reds = b.column(0).to_pylist()
            for at in _by_length(reds):
                s = _symbols([reds[i] for i in at])
                row, code = neighbourhoods(s)
                yield pa.RecordBatch.from_arrays([pa.array(codes_of(s)[row].view(np.int64)), pa.array(code.view(np.int64))], names=["centre", "code"])

    v = words.select("word", "n", reduced(F.col("word")).alias("red"))
    made = v.select("red").distinct().mapInArrow(around, "centre long, code long")
    vocabulary = written(v.mapInArrow(coded, "word string, n long, code long"), "reduced")
    # Spark can't know the size of what Python makes: both joins are told to shuffle.
    met = made.hint("merge").join(vocabulary.select("code", F.col("word").alias("near"), F.col("n").alias("near_n")), "code")
    both = met.hint("merge").join(vocabulary.select(F.col("code").alias("centre"), "word"), "centre")
    # Reduced words of equal code could find a pair twice.
    return both.where("levenshtein(word, near, 1) = 1").select("word", "near", "near_n").distinct()


def roots(forms: DataFrame, most: int) -> DataFrame:
    """word, root by doubling: ``forms`` has word, form of the words that have
    one; ``most`` is the greatest count."""
    state = forms.select("word", F.col("form").alias("root"))
    steps, top = 1, OCCURRENCES
    while top * RATIO <= most:
        steps, top = steps + 1, top * RATIO
    for i in range((steps - 1).bit_length()):
        state = written(state, f"roots-{i}")
        on = state.select(F.col("word").alias("root"), F.col("root").alias("further"))
        state = state.join(on, "root", "left").select("word", F.coalesce("further", "root").alias("root"))
    return state


def spelling_variants(docs: DataFrame) -> DataFrame:
    """word, form, root, n, n_near, form_n for every word of ``docs``."""
    words = written(vocabulary(docs), "vocabulary")
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("form"))).alias("best")
    near = near_pairs(words).groupBy("word").agg(F.count("*").alias("n_near"), best)
    form_n = -F.col("best.less")
    taken = form_n >= RATIO * F.col("n")
    rows = written(words.join(near, "word", "left").select("word", F.when(taken, F.col("best.form")).alias("form"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(taken, form_n).alias("form_n")), "forms")
    most = rows.agg(F.max("n")).first()[0] or 0
    ends = roots(rows.where("form is not null"), most)
    return rows.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents"))

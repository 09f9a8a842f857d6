"""Quality rules: base rules, then a hashed n-gram log-likelihood ratio.

Words and word pairs are hashed to ``PLACES`` places. Two multinomials over
the places are estimated: the raw one from all documents, the target one from
trusted documents (ids given by a table; at most about ``TRUSTED`` of them,
drawn by a hash of the id, so that the ids can be broadcast), smoothed with
``PRIOR`` n-grams spread as in the raw one, so that few trusted texts say
little rather than something wrong. A document's ratio is the mean over its n-grams of
log(target / raw), so length doesn't count; the document passes if the ratio
is at least ``LEAST``. The threshold is fixed: it doesn't move with the
corpus, and every document is judged by itself.

Base rules fail documents of fewer than 20 words and those with more than
30 of 100 words in repeated 8-word windows.

Null texts are empty; texts without words have ratio 0 and fail the base
rules. Without trusted documents all ratios are 0 and only the base rules
judge. Repeated rows stay repeated and count as often in the raw multinomial;
null ids are never trusted. An empty table gives no rows; other columns are
ignored. DataFrame functions only; texts of any length are worked on whole,
in time of n log n.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.common import table

PLACES = 1 << 15
TRUSTED = 100_000
PRIOR = 1 << 18
LEAST = -0.12
WINDOW = 8
MIN_WORDS, MAX_REPEATED = 20, 30
_WHITE = " \t\n\x0b\x0c\r"
_SYMBOLS = "#*$%&|<>"


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value worked out once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def words_in(text: Column) -> Column:
    return F.filter(F.split(F.translate(text, _WHITE, " " * len(_WHITE)), " "), lambda w: w != "")


def _pairs(hashes: Column, gap: int) -> Column:
    """Hashes of each element with the one ``gap`` later."""
    n = F.greatest(F.size(hashes) - gap, F.lit(0))
    return F.zip_with(F.slice(hashes, 1, n), F.slice(hashes, gap + 1, n), lambda a, b: F.xxhash64(a, b))


def hashes_of(text: Column) -> Column:
    return F.transform(words_in(text), lambda w: F.xxhash64(w))


def _places(hashes: Column) -> Column:
    """The place of every word and word pair."""
    return F.transform(F.concat(hashes, _pairs(hashes, 1)), lambda h: F.pmod(h, F.lit(PLACES)).cast("int"))


def repeated_words(hashes: Column) -> Column:
    """Words in windows of ``WINDOW`` words found twice or more in the text."""

    def covered(windows: Column) -> Column:
        order = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def starts(s: Column) -> Column:
            twice = F.filter(s, lambda x, k: (x.h == F.get(s, k - 1).h) | (x.h == F.get(s, k + 1).h))
            return F.array_sort(F.transform(twice, lambda x: x.i))

        none = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end"))
        step = lambda acc, i: F.struct((acc.n + (i + WINDOW - F.greatest(acc.end, i))).alias("n"), (i + WINDOW).alias("end"))
        return F.aggregate(_let(order, starts), none, step, lambda acc: acc.n)

    some = lambda w: F.when(F.size(F.array_distinct(w)) == F.size(w), F.lit(0).cast("long")).otherwise(covered(w))
    twos = _pairs(hashes, 1)
    return _let(_pairs(_let(twos, lambda h: _pairs(h, 2)), 4), some)


def without(text: Column, chars: str) -> Column:
    return F.translate(text, chars, "")


def base_columns(text: Column) -> dict[str, Column]:
    """The base counts that need no words."""
    lines = F.filter(F.split(text, "\n"), lambda x: without(x, _WHITE) != "")
    return {
        "word_chars": F.length(without(text, _WHITE)).cast("long"),
        "n_symbols": (F.length(text) - F.length(without(text, _SYMBOLS))).cast("long"),
        "n_dup_lines": _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
    }


def weights(docs: DataFrame, trusted: DataFrame) -> list[float]:
    """log(target / raw) of every place; empty without trusted documents.

    ``trusted``: doc_id of the target's documents.
    """
    ids = trusted.where("doc_id is not null").select("doc_id").distinct()
    n = ids.count()
    if not n:
        return []
    draw = F.pmod(F.xxhash64("doc_id", F.lit(13)), F.lit(1 << 20)) / (1 << 20)
    some = ids.where(draw < min(1.0, TRUSTED / n)).withColumn("target", F.lit(1))
    # At most about TRUSTED ids, whatever the table's size.
    flagged = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(some), "doc_id", "left")
    grams = flagged.select(F.coalesce("target", F.lit(0)).alias("target"), F.explode_outer(_let(hashes_of(F.col("text")), _places)).alias("place"))
    counts = grams.where("place is not null").groupBy("place").agg(F.sum("target").alias("target"), F.count("*").alias("raw"))
    found = {r.place: (r.target, r.raw) for r in counts.collect()}  # PLACES rows at most
    target, raw = (sum(v[i] for v in found.values()) for i in (0, 1))
    if not target:
        return []
    each = [found.get(p, (0, 0)) for p in range(PLACES)]
    # A place without raw counts holds no n-gram of any document.
    return [math.log((t * raw / r + PRIOR) / (target + PRIOR)) if r else 0.0 for t, r in each]


def judge_quality(docs: DataFrame, trusted: DataFrame) -> DataFrame:
    """doc_id, n_words, the base counts, ratio, base_failed, kept for every row."""
    known = weights(docs, trusted)
    # A foldable expression: one array of PLACES numbers in the plan.
    model = F.split(F.lit(",".join(map(repr, known))), ",").cast("array<double>")

    def ratio(hashes: Column) -> Column:
        total = lambda at: F.aggregate(at, F.lit(0.0), lambda acc, p: acc + F.get(model, p)) / F.greatest(F.size(at), F.lit(1))
        return _let(_places(hashes), total) if known else F.lit(0.0)

    text = F.coalesce("text", F.lit(""))
    of_words = _let(hashes_of(text), lambda h: F.struct(F.size(h).cast("long").alias("n_words"), repeated_words(h).alias("n_repeat_words"), ratio(h).alias("ratio")))
    rows = docs.select("doc_id", *(c.alias(k) for k, c in base_columns(text).items()), F.inline_outer(F.array(of_words)))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))
    rows = rows.withColumn("base_failed", failed)
    return rows.withColumn("kept", ~F.col("base_failed") & (F.col("ratio") >= LEAST))


def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    trusted = table(spark, sf_dir, "labels").where("quality = 1")
    return judge_quality(table(spark, sf_dir, "documents"), trusted).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "ratio")

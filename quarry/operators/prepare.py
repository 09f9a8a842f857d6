"""Dataset preparation: deterministic splits, prefix slices, decontamination
(exact, n-gram, embedding) and the duplicate report.

Order-based operators take an explicit key (and columns that order its ties)
instead of relying on row order. Boundaries come from counts per key and
prefix sums over ranges of keys (see ``ranks``), never from a window over the
whole table, so no step runs in a single task.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.operators.metric import MetricIndex, identity
from quarry.operators.ranks import Cuts, RankTable, union


# --- splits and slices -----------------------------------------------------


def _tail_parts(df: DataFrame, n_test: int, n_val: int, key: str, ties: tuple[str, ...],
                table: RankTable | None = None) -> list[tuple[DataFrame, dict[str, Column]]]:
    """Frames that make up ``df``, each with the condition of every split."""
    table = table or RankTable(df, key)
    n_test, n_val = max(n_test, 0), max(n_val, 0)
    cuts = Cuts(df, key, [table.n - n_test - n_val, table.n - n_test], ties, table)
    out = []
    for frame, (past_train, past_val) in cuts.parts:
        preds = {"test": past_val & F.col(key).isNotNull(), "val": past_train & ~past_val & F.col(key).isNotNull(),
                 "train": ~past_train | F.col(key).isNull()}
        out.append((frame, preds))
    return out


def split_parts(df: DataFrame, n_test: int, n_val: int, key: str = "example_id", ties: tuple[str, ...] = (),
                table: RankTable | None = None) -> dict[str, DataFrame]:
    """The tail split as three filtered DataFrames (train, val, test). With
    unique keys the filters are plain comparisons on ``key``, so they reach
    the parquet scan and skip row groups by their min/max statistics."""
    parts = _tail_parts(df, n_test, n_val, key, ties, table)
    return {name: union([f.where(p[name]).select(*df.columns) for f, p in parts]) for name in ("test", "val", "train")}


def split_tail(df: DataFrame, n_test: int, n_val: int, key: str = "example_id", ties: tuple[str, ...] = (),
               table: RankTable | None = None) -> DataFrame:
    """Add ``split``: the last ``n_test`` rows by key are test, the ``n_val``
    before them val, the rest and all rows of a null key train. Rows of equal
    keys are ordered by the ``ties`` columns, then by a hash of the row, so the
    sizes are exact for any key. ``n_test=0`` means an empty test set (the
    reference's slice would return every row); if ``n_test + n_val`` reaches
    the number of keyed rows, train has only null keys."""
    parts = _tail_parts(df, n_test, n_val, key, ties, table)
    named = lambda p: F.when(p["test"], "test").when(p["val"], "val").otherwise("train")
    return union([f.select(*df.columns, named(p).alias("split")) for f, p in parts])


def _fractions(df: DataFrame, test_frac: float, val_frac: float, key: str) -> tuple[int, int, RankTable]:
    table = RankTable(df, key)
    return int(math.floor(table.n * test_frac)), int(math.floor(table.n * val_frac)), table


def split_fraction(df: DataFrame, test_frac: float, val_frac: float = 0.0, key: str = "example_id",
                   ties: tuple[str, ...] = ()) -> DataFrame:
    """Tail split with sizes ``floor(n * frac)`` of the n rows with a key."""
    n_test, n_val, table = _fractions(df, test_frac, val_frac, key)
    return split_tail(df, n_test, n_val, key, ties, table)


def split_fraction_parts(df: DataFrame, test_frac: float, val_frac: float = 0.0, key: str = "example_id",
                         ties: tuple[str, ...] = ()) -> dict[str, DataFrame]:
    """``split_parts`` with sizes ``floor(n * frac)``."""
    n_test, n_val, table = _fractions(df, test_frac, val_frac, key)
    return split_parts(df, n_test, n_val, key, ties, table)


def prefix_slices(df: DataFrame, ks, key: str = "example_id", ties: tuple[str, ...] = ()) -> DataFrame:
    """Nested prefixes: for each k, the first k rows by key (ties as in
    ``split_tail``), tagged with ``k``. A float k <= 1.0 is a fraction of the
    number of rows with a key; rows without one are in no slice. k beyond that
    number gives every row with a key, k = 0 none; equal sizes are one slice.
    All ranks come from one table of counts, and rows are replicated by a
    generator (no join)."""
    table = RankTable(df, key)
    sizes = [int(math.floor(table.n * k)) if isinstance(k, float) and k <= 1.0 else int(k) for k in ks]
    sizes = list(dict.fromkeys(sizes)) or [0]
    out = []
    for frame, beyond in Cuts(df, key, sizes, ties, table).parts:
        inside = [F.when(~b, F.lit(s)) for s, b in zip(sizes, beyond, strict=True)]
        # The outer form: a plain explode makes Catalyst infer a filter on the array, which it works out
        # (the hash of whole rows among it) a second time, below the exchange that spreads the rows.
        tagged = frame.where(F.col(key).isNotNull()).select(F.explode_outer(F.array(*inside)).alias("_slice"), *df.columns)
        out.append(tagged.where(F.col("_slice").isNotNull()).select(F.col("_slice").alias("k"), *df.columns))
    return union(out)


def head(df: DataFrame, k: int, key: str = "example_id") -> DataFrame:
    """The first k rows by key (a top-k: k rows kept per partition, merged)."""
    return df.orderBy(F.col(key).asc()).limit(k)


# --- exact decontamination -------------------------------------------------


def _text_key(c: Column) -> Column:
    """128-bit digest of a text, with a marker for null (null equals null)."""
    return F.when(c.isNull(), F.lit("<null>")).otherwise(F.md5(c))


def _same_text(col: str) -> Column:
    """Train and test texts are the same (nulls match nulls). The hash is the
    equi-join key with the text beside it, so a join that has to shuffle
    compares hashes first and texts where those agree."""
    return (F.xxhash64(col) == F.col("_h")) & F.col(col).eqNullSafe(F.col("_m"))


def _test_texts(test: DataFrame, col: str) -> DataFrame:
    return test.select(F.col(col).alias("_m")).distinct().withColumn("_h", F.xxhash64("_m"))


def contaminated_keys(train: DataFrame, test: DataFrame, col: str = "message", key: str = "example_id") -> DataFrame:
    """Keys of train rows whose ``col`` equals (null-safe) a test row's."""
    return train.select(key, col).join(_test_texts(test, col), _same_text(col), "left_semi").select(key)


def decontaminate_exact(train: DataFrame, test: DataFrame, col: str = "message", key: str = "example_id") -> DataFrame:
    """Drop train rows whose ``col`` equals any test row's (nulls match nulls).
    Duplicates inside train are kept; only train is filtered.

    One anti-join on the text itself at every size: rows are judged by their
    text alone, so null and repeated keys make no difference. AQE broadcasts
    the test texts when their measured size allows and splits hot texts
    otherwise. ``key`` is not needed any more."""
    return train.join(_test_texts(test, col), _same_text(col), "left_anti")


def decontamination_counts(train: DataFrame, test: DataFrame, col: str = "message", key: str = "example_id") -> DataFrame:
    """One row: n_train, n_test, n_removed, n_clean, from one aggregate over
    train rows flagged by a left join to the distinct test texts and the test
    rows."""
    t = _test_texts(test, col).withColumn("_hit", F.lit(True))
    flagged = train.select(col).join(t, _same_text(col), "left")
    sides = flagged.select(F.lit(True).alias("_train"), F.col("_hit").isNotNull().alias("_removed")).unionByName(
        test.select(F.lit(False).alias("_train"), F.lit(False).alias("_removed"))
    )
    return sides.agg(
        F.count_if("_train").alias("n_train"),
        F.count_if(~F.col("_train")).alias("n_test"),
        F.count_if("_removed").alias("n_removed"),
        F.count_if(F.col("_train") & ~F.col("_removed")).alias("n_clean"),
    )


# --- duplicate report --------------------------------------------------------


def duplicate_report(df: DataFrame, col: str = "message") -> DataFrame:
    """One row: n_rows, n_distinct, distinct_ratio, duplicate_rows,
    duplicate_groups, max_copies. Groups on a digest of the text so the
    shuffle carries 32-byte keys; partial aggregation absorbs hot texts."""
    g = df.groupBy(_text_key(F.col(col)).alias("_h")).agg(F.count(F.lit(1)).alias("_c"))
    return g.agg(
        F.sum("_c").cast("bigint").alias("n_rows"),
        F.count(F.lit(1)).alias("n_distinct"),
        F.coalesce(F.try_divide(F.count(F.lit(1)).cast("double"), F.sum("_c").cast("double")), F.lit(0.0)).alias("distinct_ratio"),
        F.coalesce(F.sum("_c") - F.count(F.lit(1)), F.lit(0)).cast("bigint").alias("duplicate_rows"),
        F.count_if(F.col("_c") > 1).alias("duplicate_groups"),
        F.coalesce(F.max("_c"), F.lit(0)).cast("bigint").alias("max_copies"),
    )


# --- n-gram decontamination --------------------------------------------------

WORD_SPLIT = r"[^\p{L}\p{N}]+"


def words(c: Column) -> Column:
    """Lower-cased word tokens (runs of letters and digits)."""
    return F.filter(F.split(F.lower(c), WORD_SPLIT), lambda w: w != "")


def shingles(w: Column, n: int) -> Column:
    """Distinct word n-grams (joined by one space) of a token-array column.
    Pass a column, not an expression: the lambda reads it once per position."""
    idx = F.sequence(F.lit(1), F.size(w) - F.lit(n - 1))
    grams = F.transform(idx, lambda i: F.array_join(F.slice(w, i, n), " "))
    return F.array_distinct(F.when(F.size(w) >= n, grams).otherwise(F.array().cast("array<string>")))


def text_shingles(df: DataFrame, text: str, n: int, keep=()) -> DataFrame:
    """(…keep, g): one row per distinct n-gram of each text. Tokens are
    computed in their own projection so the n-gram lambda reads a column."""
    tok = df.select(*keep, words(F.col(text)).alias("_w"))
    # explode_outer + null filter: the plain explode makes Catalyst infer a
    # size(shingles) > 0 filter below it, computing the n-grams twice.
    return tok.select(*keep, F.explode_outer(shingles(F.col("_w"), n)).alias("g")).filter(F.col("g").isNotNull())


def _combine(a: Column, b: Column) -> Column:
    """Element-wise 64-bit hash of two equally long arrays of hashes."""
    return F.zip_with(a, b, lambda x, y: F.xxhash64(x, y))


def hashed_shingles(df: DataFrame, text: str, n: int, keep=()) -> DataFrame:
    """(…keep, h): distinct 64-bit hashes of a text's word n-grams.

    Words are hashed once; window hashes are built from them with
    ``zip_with`` over shifted slices (no n-gram strings, no per-position
    array): a hash tree in log2(n) passes when n is a power of two, else a
    chain of n - 1 passes. Each pass is its own projection, so the lambdas
    read a column instead of re-evaluating the previous level."""
    d = df.select(*keep, F.transform(words(F.col(text)), lambda w: F.xxhash64(w)).alias("_h"))
    d = d.filter(F.size("_h") >= n)
    if n & (n - 1) == 0:
        span = 1
        while span < n:
            length = F.size("_h") - F.lit(span)
            d = d.select(*keep, _combine(F.slice("_h", 1, length), F.slice("_h", span + 1, length)).alias("_h"))
            span *= 2
    elif n > 1:
        length = F.size("_h") - F.lit(n - 1)
        d = d.select(*keep, "_h", F.slice("_h", 1, length).alias("_acc"))
        for j in range(1, n):
            d = d.select(*keep, "_h", _combine(F.col("_acc"), F.slice("_h", j + 1, length)).alias("_acc"))
        d = d.select(*keep, F.col("_acc").alias("_h"))
    return d.select(*keep, F.explode_outer(F.array_distinct("_h")).alias("h")).filter(F.col("h").isNotNull())


#: Bits of the filter over the eval set's n-grams: 2^18 words of 64 bits, so at
#: most 262,144 rows to broadcast however large the eval set is.
FILTER_BITS = 1 << 24


def _filter_place(h: Column) -> tuple[Column, Column]:
    """Word and bit of a hash in the filter."""
    place = F.pmod(h, F.lit(FILTER_BITS))
    return F.shiftright(place, 6), place.bitwiseAND(F.lit(63)).cast("int")


def _eval_filter(hashes: DataFrame) -> DataFrame:
    """(word, bits): the filter's non-empty words, merged from partial ones."""
    word, bit = _filter_place(F.col("h"))
    return hashes.select(word.alias("word"), F.call_function("shiftleft", F.lit(1).cast("long"), bit).alias("b")).groupBy("word").agg(F.bit_or("b").alias("bits"))


def _shared_ngrams(docs: DataFrame, evals: DataFrame, n: int, text: str, eval_text: str) -> DataFrame:
    """(_a, _b, shared_ngrams) for each different text of ``docs`` (128 bits
    stand for a text) that shares any word n-gram with the eval set.

    Every document's n-grams are hashed from per-word hashes. A filter of
    bounded size, always broadcast, passes those that may be the eval set's
    (all that are, and as many others as its load); only these are matched by
    hash, and only the documents they name are tokenised into n-gram text and
    matched exactly. So neither the filter nor equal hashes make or lose a hit."""
    named = docs.select(*identity(text), F.col(text).alias("_text")).where("_text is not null")
    eh = hashed_shingles(evals, eval_text, n).distinct()
    word, bit = _filter_place(F.col("h"))
    some = hashed_shingles(named, "_text", n, keep=("_a", "_b")).withColumn("word", word)
    passed = some.join(F.broadcast(_eval_filter(eh)), "word").where(F.getbit("bits", bit) == 1)
    cand = passed.join(eh, "h", "left_semi").select("_a", "_b").distinct()
    # Copies of one text are matched once; AQE broadcasts the derived sides when small.
    texts = named.join(cand, ["_a", "_b"], "left_semi").dropDuplicates(["_a", "_b"])
    dg = text_shingles(texts, "_text", n, keep=("_a", "_b"))
    eg = text_shingles(evals, eval_text, n).distinct().withColumnRenamed("g", "eg")
    return dg.join(eg, dg.g == eg.eg, "left_semi").groupBy("_a", "_b").agg(F.count(F.lit(1)).alias("shared_ngrams"))


def ngram_overlap(
    docs: DataFrame, evals: DataFrame, n: int = 8, text: str = "text", key: str = "doc_id", eval_text: str = "text"
) -> DataFrame:
    """(key, shared_ngrams): number of distinct word n-grams a document shares
    with the eval set, for each row of a document sharing at least one (null
    and repeated keys have a row for each of theirs)."""
    hits = _shared_ngrams(docs, evals, n, text, eval_text)
    rows = docs.select(F.col(key).alias("_key"), *identity(text))
    return rows.join(hits, ["_a", "_b"]).select(F.col("_key").alias(key), "shared_ngrams")


def decontaminate_ngrams(
    docs: DataFrame, evals: DataFrame, n: int = 8, min_overlap: int = 1, text: str = "text", key: str = "doc_id"
) -> DataFrame:
    """Drop documents sharing at least ``min_overlap`` distinct n-grams with
    the eval set. Rows are judged by their text, whatever their ``key``."""
    bad = _shared_ngrams(docs, evals, n, text, text).where(F.col("shared_ngrams") >= min_overlap).select("_a", "_b")
    return docs.select("*", *identity(text)).join(bad, ["_a", "_b"], "left_anti").select(*docs.columns)


# --- embedding decontamination ---------------------------------------------


def max_cosine(train: DataFrame, evals: DataFrame, key: str = "vec_id", vec: str = "embedding",
               block_rows: int | None = None) -> DataFrame:
    """(key, max_cosine) of each train vector against every eval vector; null
    for vectors without a direction (see ``metric``) and without eval vectors.

    Exact at any size: a search of the metric index with no bound, so every
    pair is compared, in pieces of about ``block_rows`` eval vectors."""
    best = MetricIndex(evals, vec, block_rows).search(train, vec, -1.0)
    rows = train.select(F.col(key).alias("_key"), *identity(vec))
    # Vectors of one direction at two lengths differ in content and stand apart.
    found = rows.join(best.withColumnRenamed("cosine", "max_cosine"), ["_a", "_b"], "left")
    return found.select(F.col("_key").alias(key), "max_cosine")


def decontaminate_embeddings(train: DataFrame, evals: DataFrame, threshold: float, key: str = "vec_id",
                             vec: str = "embedding") -> DataFrame:
    """Drop train rows whose best cosine against the eval set is >= threshold.

    The search reads only the parts of the eval set that can hold such a
    vector (``metric.MetricIndex``). Rows are judged by their vector: equal
    vectors share their fate, null or repeated keys make no difference, and a
    vector without a direction is never dropped."""
    bad = MetricIndex(evals, vec).search(train, vec, threshold).select("_a", "_b")
    named = train.select("*", *identity(vec))
    return named.join(bad, ["_a", "_b"], "left_anti").select(*train.columns)


def embedding_share(train: DataFrame, evals: DataFrame, threshold: float, vec: str = "embedding") -> float:
    """The share of all (train, eval) pairs that ``decontaminate_embeddings`` compares."""
    return MetricIndex(evals, vec).share(train, vec, threshold)

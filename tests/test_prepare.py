"""Splits, slices, decontamination (FIXTURES §4: O27, O28, O31; X1, X2, X8)."""

from pyspark.sql import functions as F

from quarry.operators import prepare
from quarry.operators.ranks import Cuts


def _split(spark, n, n_test, n_val):
    df = spark.range(n).withColumnRenamed("id", "example_id")
    rows = prepare.split_tail(df, n_test, n_val).collect()
    out = {"train": [], "val": [], "test": []}
    for r in rows:
        out[r.split].append(r.example_id)
    return {k: sorted(v) for k, v in out.items()}


def test_tail_split(spark):
    s = _split(spark, 10, 2, 3)
    assert s == {"test": [8, 9], "val": [5, 6, 7], "train": [0, 1, 2, 3, 4]}


def test_tail_split_edges(spark):
    assert _split(spark, 10, 0, 3) == {"test": [], "val": [7, 8, 9], "train": list(range(7))}
    assert _split(spark, 10, 6, 6)["train"] == []
    assert _split(spark, 10, 0, 0)["train"] == list(range(10))


def test_prefix_slices_nested(spark):
    df = spark.range(100).withColumnRenamed("id", "example_id")
    sl = prepare.prefix_slices(df, [10, 50, 200, 0.3, 0.5])
    got = {r.k: r.n for r in sl.groupBy("k").agg(F.count("*").alias("n")).collect()}
    assert got == {10: 10, 30: 30, 50: 50, 200: 100}
    ids = {r.k: r.m for r in sl.groupBy("k").agg(F.max("example_id").alias("m")).collect()}
    assert ids == {10: 9, 30: 29, 50: 49, 200: 99}


def test_decontaminate_exact_nulls_and_duplicates(spark):
    train = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b"), (4, None)], "example_id long, message string")
    test = spark.createDataFrame([(9, "b"), (10, None)], "example_id long, message string")
    clean = prepare.decontaminate_exact(train, test)
    assert sorted(r.message for r in clean.collect()) == ["a", "a"]
    c = prepare.decontamination_counts(train, test).first()
    assert (c.n_train, c.n_test, c.n_removed, c.n_clean) == (4, 2, 2, 2)


def test_decontaminate_exact_null_and_repeated_keys(spark):
    """Rows are judged by their text: a null key hides no leak and a repeated
    key takes no clean row along, whether the join broadcasts or shuffles."""
    test = spark.createDataFrame([(9, "leak")], "example_id long, message string")
    train = spark.createDataFrame([(None, "leak"), (1, "leak"), (1, "fine"), (2, "ok")], "example_id long, message string")
    for bound in ("10MB", "-1"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", bound)
        try:
            assert sorted(r.message for r in prepare.decontaminate_exact(train, test).collect()) == ["fine", "ok"]
            c = prepare.decontamination_counts(train, test).first()
            assert (c.n_train, c.n_test, c.n_removed, c.n_clean) == (4, 1, 2, 2)
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_no_nested_loop_join(spark):
    train = spark.createDataFrame([(1, "a")], "example_id long, message string")
    plan = prepare.decontaminate_exact(train, train)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_duplicate_report(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,), (None,)], "message string")
    r = prepare.duplicate_report(df).first()
    assert (r.n_rows, r.n_distinct, r.duplicate_rows, r.duplicate_groups, r.max_copies) == (5, 3, 2, 2, 2)


def test_ngram_overlap(spark):
    docs = spark.createDataFrame(
        [(1, "The quick brown fox jumps over the lazy dog today"), (2, "nothing in common here at all")],
        "doc_id long, text string",
    )
    ev = spark.createDataFrame([("a QUICK brown fox jumps!",)], "text string")
    got = {r.doc_id: r.shared_ngrams for r in prepare.ngram_overlap(docs, ev, n=3).collect()}
    assert got == {1: 2}


def test_embeddings(spark):
    train = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, [0.6, 0.8])], "vec_id long, embedding array<float>")
    ev = spark.createDataFrame([(9, [1.0, 0.0])], "vec_id long, embedding array<float>")
    kept = sorted(r.vec_id for r in prepare.decontaminate_embeddings(train, ev, 0.7).collect())
    assert kept == [2, 3]


def test_embeddings_many_blocks_match_brute_force(spark):
    import numpy as np

    rng = np.random.default_rng(0)
    a = rng.normal(size=(300, 16)).astype("float32")
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    train = spark.createDataFrame([(i, a[i].tolist()) for i in range(200)], "vec_id long, embedding array<float>")
    ev = spark.createDataFrame([(i, a[i].tolist()) for i in range(200, 300)], "vec_id long, embedding array<float>")
    got = {r.vec_id: r.max_cosine for r in prepare.max_cosine(train, ev, block_rows=7).collect()}
    want = (a[:200] @ a[200:].T).max(axis=1)
    assert all(abs(got[i] - want[i]) < 1e-5 for i in range(200))


def test_split_properties_on_tickets(spark, sf_small):
    """Splits are disjoint and exhaustive; the clean train shares no message
    with test and |clean| + removed = |train|."""
    from quarry.plans.queries import SPLIT_FRAC, tickets

    t = tickets(spark, sf_small)
    s = prepare.split_fraction(t, SPLIT_FRAC, SPLIT_FRAC)
    counts = {r.split: r.n for r in s.groupBy("split").agg(F.count("*").alias("n")).collect()}
    n = t.count()
    assert sum(counts.values()) == n and counts["test"] == counts["val"] == int(n * SPLIT_FRAC)
    assert s.select("example_id").distinct().count() == n
    train, test = s.filter("split = 'train'"), s.filter("split = 'test'")
    clean = prepare.decontaminate_exact(train, test)
    assert clean.join(test.select("message"), "message", "left_semi").count() == 0
    c = prepare.decontamination_counts(train, test).first()
    assert clean.count() + c.n_removed == train.count() == c.n_train
    assert c.n_removed > 0


def test_ngram_overlap_hash_path(spark, sf_small, monkeypatch):
    """The no-broadcast path gives the same hits as the broadcast path."""
    docs = spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "text")
    bench = spark.read.parquet(f"{sf_small}/benchmark.parquet").select("text")
    want = {(r.doc_id, r.shared_ngrams) for r in prepare.ngram_overlap(docs, bench, 8).collect()}
    monkeypatch.setattr(prepare, "FILTER_BITS", 64)  # one full word: the filter passes nearly all
    got = {(r.doc_id, r.shared_ngrams) for r in prepare.ngram_overlap(docs, bench, 8).collect()}
    assert got == want and len(want) > 0


def test_hashed_shingles_match_text_shingles(spark):
    """Distinct window hashes correspond one to one with distinct n-grams,
    for power-of-two and other n."""
    docs = spark.createDataFrame(
        [(1, "a b c d e f g h i j k a b c d e f g h"), (2, "x y"), (3, "one two three four five")],
        "doc_id long, text string",
    )
    for n in (1, 2, 3, 4, 5, 8):
        h = prepare.hashed_shingles(docs, "text", n, keep=("doc_id",)).groupBy("doc_id").count()
        g = prepare.text_shingles(docs, "text", n, keep=("doc_id",)).groupBy("doc_id").count()
        assert {tuple(r) for r in h.collect()} == {tuple(r) for r in g.collect()}, n


def test_decontaminate_ngrams_min_overlap(spark):
    docs = spark.createDataFrame(
        [(1, "alpha beta gamma delta epsilon"), (2, "alpha beta gamma zzz"), (3, "unrelated words only here")],
        "doc_id long, text string",
    )
    ev = spark.createDataFrame([("Alpha beta gamma delta epsilon",)], "text string")
    kept1 = sorted(r.doc_id for r in prepare.decontaminate_ngrams(docs, ev, n=3, min_overlap=1).collect())
    kept3 = sorted(r.doc_id for r in prepare.decontaminate_ngrams(docs, ev, n=3, min_overlap=3).collect())
    assert kept1 == [3]          # docs 1 and 2 share at least one 3-gram
    assert kept3 == [2, 3]       # only doc 1 shares all three 3-grams


def test_split_with_null_keys(spark):
    df = spark.createDataFrame([(i,) for i in range(10)] + [(None,), (None,)], "example_id long")
    got = {}
    for r in prepare.split_tail(df, 2, 3).collect():
        got.setdefault(r.split, []).append(r.example_id)
    assert sorted(got["test"]) == [8, 9] and sorted(got["val"]) == [5, 6, 7]
    assert sorted(x for x in got["train"] if x is not None) == [0, 1, 2, 3, 4]
    assert sum(1 for x in got["train"] if x is None) == 2
    parts = prepare.split_parts(df, 2, 3)
    assert parts["train"].count() == 7 and parts["test"].count() == 2 and parts["val"].count() == 3


def test_ngrams_of_null_and_repeated_keys(spark):
    """Rows are judged by their text: a null key hides no leak, a repeated key
    takes no clean row along, copies of a text count its n-grams once."""
    leak, clean = "one two three four five six", "nothing of the kind in here at all"
    rows = [(None, leak), (None, clean), (5, leak), (5, clean), (5, leak), (6, None), (7, "")]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, word string").repartition(3)
    ev = spark.createDataFrame([("zero one two three four",), (None,)], "text string")
    got = [(r.doc_id, r.shared_ngrams) for r in prepare.ngram_overlap(docs, ev, n=3).collect()]
    assert sorted(got, key=str) == [(5, 2), (5, 2), (None, 2)]
    kept = sorted(((r.doc_id, r.text) for r in prepare.decontaminate_ngrams(docs, ev, n=3).collect()), key=str)
    assert kept == sorted([(None, clean), (5, clean), (6, None), (7, "")], key=str)
    assert prepare.decontaminate_ngrams(docs, ev.limit(0), n=3).count() == len(rows)
    assert prepare.decontaminate_ngrams(docs.limit(0), ev, n=3).columns == ["doc_id", "text", "word"]


def test_row_hash_is_for_tied_rows_alone(spark):
    """A cut between equal rows hashes those rows; the others' columns aren't worked out for it."""
    keys = spark.createDataFrame([(i,) for i in [*range(1, 9), 5, 5]], "example_id long")
    df = keys.withColumn("heavy", F.when(F.col("example_id") != 5, F.raise_error("worked out").cast("string")).otherwise("x"))
    untied, tied = (frame.select("example_id") for frame, _ in Cuts(df, "example_id", [5]).parts)
    assert sorted(r[0] for r in untied.collect()) == [1, 2, 3, 4, 6, 7, 8] and [r[0] for r in tied.collect()] == [5, 5, 5]

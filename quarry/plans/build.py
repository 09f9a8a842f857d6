"""End-to-end dataset build: generate -> split -> decontaminate -> format ->
write, with the counts of every step returned as a one-row DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.operators.chat import to_chat
from quarry.operators.generate import generate_examples
from quarry.operators.prepare import decontaminate_exact, split_parts
from quarry.sources.jsonl import CHAT_SCHEMA, EXAMPLE_SCHEMA, read_examples, write_examples


def build_dataset(keys: DataFrame, key: str, out: str, n_test: int, n_val: int, seed: int = 7,
                  diverse: bool = False, n_keys: int | None = None) -> DataFrame:
    """Write ``out/train`` and ``out/val`` as chat JSONL (train decontaminated
    against test by exact message) and ``out/test`` as labelled examples.
    Returns (n_examples, n_train, n_val, n_test, n_removed) counted from the
    written files.

    The split boundaries come from the key column alone; each part is
    generated from its own key range (the range predicate reaches the key
    scan), so nothing is materialised in between: generation is a
    deterministic projection and costs less to repeat than to store."""
    n = keys.filter(F.col(key).isNotNull()).count() if n_keys is None else n_keys
    parts = split_parts(keys, n_test, n_val, key)

    def part(name: str) -> DataFrame:
        return generate_examples(parts[name], key=key, seed=seed, diverse=diverse)

    train, val, test = part("train"), part("val"), part("test")
    clean_train = decontaminate_exact(train, test, "message")
    write_examples(to_chat(clean_train), f"{out}/train")
    write_examples(to_chat(val), f"{out}/val")
    write_examples(test, f"{out}/test")
    spark = keys.sparkSession
    tr = read_examples(spark, f"{out}/train", CHAT_SCHEMA).select(F.lit("train").alias("s"))
    va = read_examples(spark, f"{out}/val", CHAT_SCHEMA).select(F.lit("val").alias("s"))
    te = read_examples(spark, f"{out}/test", EXAMPLE_SCHEMA).select(F.lit("test").alias("s"))
    n_split_train = parts["train"].count()
    return tr.unionByName(va).unionByName(te).agg(
        F.lit(n).cast("bigint").alias("n_examples"),
        F.count_if(F.col("s") == "train").alias("n_train"),
        F.count_if(F.col("s") == "val").alias("n_val"),
        F.count_if(F.col("s") == "test").alias("n_test"),
        (F.lit(n_split_train) - F.count_if(F.col("s") == "train")).cast("bigint").alias("n_removed"),
    )


def main(argv=None) -> None:
    """``python -m quarry.plans.build --out DIR``: generate, split,
    decontaminate and write the dataset, then print the counts."""
    import argparse

    from quarry.session import get_session

    ap = argparse.ArgumentParser(description=main.__doc__)
    ap.add_argument("--n", type=int, default=800)
    ap.add_argument("--n-test", type=int, default=100)
    ap.add_argument("--n-val", type=int, default=100)
    ap.add_argument("--seed", type=int, default=7)
    ap.add_argument("--diverse", action="store_true")
    ap.add_argument("--out", required=True)
    ap.add_argument("--master", default=None)
    a = ap.parse_args(argv)
    spark = get_session(a.master)
    keys = spark.range(a.n).withColumnRenamed("id", "example_id")
    stats = build_dataset(keys, "example_id", a.out, a.n_test, a.n_val, seed=a.seed, diverse=a.diverse).first()
    print(" ".join(f"{k}={v}" for k, v in stats.asDict().items()))


if __name__ == "__main__":
    main()

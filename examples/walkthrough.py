"""From labelled examples to a routed, scored model comparison.

    PYTHONPATH=. python examples/walkthrough.py /root/testdata/sf0.001
"""

import sys

from pyspark.sql import functions as F

import quarry as q

sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
spark = q.get_session("local[4]")

# 1. one labelled example per order, seeded hash draws
orders = spark.read.parquet(f"{sf}/orders.parquet").select("o_orderkey")
examples = q.generate_examples(orders, key="o_orderkey", seed=7)

# 2-3. tail split (1/8 test, 1/8 val), then drop train rows whose message is in test
parts = q.split_fraction(examples, 0.125, 0.125)
train, test = parts.filter("split = 'train'"), parts.filter("split = 'test'")
clean = q.decontaminate_exact(train, test, col="message")
q.decontamination_counts(train, test, col="message").show()

# 4. chat records for fine-tuning, preference pairs, rendered training text
sft = q.to_chat(clean)
pairs = q.preference_pairs(clean)
print(sft.first().messages[2].content)

# 5-7. two stand-in models answer the test set; validate, score, compare
preds = q.simulate_models(test.drop("split"), [("base", 0.45, 1), ("tuned", 0.05, 2)])
validated = q.validate_outputs(preds.withColumnRenamed("ticket", "gold"), "raw", into="pred")
report = q.evaluate(validated, prices={"base": (2.5e-6, 10e-6), "tuned": (0.05e-6, 0.20e-6)})
q.compare(report, "base", "tuned").show(truncate=False)
q.failure_histogram(validated).show()

# 8. cheap-first routing with real (local) model calls, and its economics
def cheap():  # a predictor factory: picklable, called once per task
    return q.KeywordPredictor(fail_every=9)


routed = q.route(test, cheap, q.KeywordPredictor)
q.routing_report(routed).show(truncate=False)
q.served_by(routed).orderBy(F.col("served_by")).show()

"""quarry: build, check and score structured-extraction data with Spark.

The operators are plain functions from DataFrames to DataFrames; the most
used ones are re-exported here.
"""

__version__ = "0.1.0"

from quarry.contract import SYSTEM_PROMPT, TICKET, Contract, FieldSpec  # noqa: E402,F401
from quarry.operators.chat import (  # noqa: E402,F401
    assistant_spans,
    inference_prompt,
    preference_pairs,
    render_chat,
    split_reasoning,
    to_chat,
)
from quarry.operators.corrupt import corrupt_outputs, simulate_columns, simulate_models  # noqa: E402,F401
from quarry.operators.evaluate import (  # noqa: E402,F401
    align,
    alignment_check,
    assert_aligned,
    compare,
    evaluate,
    field_accuracy_long,
    gold_lookup,
    report_lines,
)
from quarry.operators.experiments import curve_plateau, gap_closed, pareto_front, promotion_gate, sweep  # noqa: E402,F401
from quarry.operators.generate import generate_examples, generate_ood  # noqa: E402,F401
from quarry.operators.infer import KeywordPredictor, extract_batch, route  # noqa: E402,F401
from quarry.operators.prepare import (  # noqa: E402,F401
    decontaminate_embeddings,
    decontaminate_exact,
    decontaminate_ngrams,
    decontamination_counts,
    duplicate_report,
    head,
    max_cosine,
    ngram_overlap,
    prefix_slices,
    split_fraction,
    split_parts,
    split_tail,
)
from quarry.operators.route import route_columns, route_prescored, routing_report, served_by  # noqa: E402,F401
from quarry.operators.validate import (  # noqa: E402,F401
    failure_histogram,
    failures,
    gate,
    gold_check,
    grounded,
    guard_report,
    order_id_guard,
    validate_outputs,
)
from quarry.session import checkpoint_dir, get_session  # noqa: E402,F401
from quarry.sources.jsonl import read_examples, write_dataset, write_examples  # noqa: E402,F401
from quarry.streaming.validate import escalation_rate_stream, validate_stream  # noqa: E402,F401

"""The registered queries of this package and their DuckDB SQL."""

from quarry.llm.decontaminate import op6_decontaminate
from quarry.llm.exact_dedup import OP7_SQL, op7_exact_dedup
from quarry.llm.hard_negatives import OP11_SQL, op11_hard_negatives
from quarry.llm.langid import op10_language_id
from quarry.llm.near_dup import op5_near_dedup
from quarry.llm.packing import op3_packing
from quarry.llm.pii import op4_pii
from quarry.llm.quality import op13_quality_rules
from quarry.llm.spelling import op12_spelling_variants
from quarry.llm.substring import op9_substring_dedup
from quarry.llm.token_files import op2_token_files
from quarry.llm.toxicity import op8_toxicity
from quarry.llm.url_filter import OP1_SQL, op1_url_filter

QUERIES = {f.__name__: f for f in (op1_url_filter, op2_token_files, op3_packing, op4_pii, op5_near_dedup, op6_decontaminate, op7_exact_dedup, op8_toxicity, op9_substring_dedup, op10_language_id, op11_hard_negatives, op12_spelling_variants, op13_quality_rules)}
ORACLE = {"op1_url_filter": OP1_SQL, "op7_exact_dedup": OP7_SQL, "op11_hard_negatives": OP11_SQL}

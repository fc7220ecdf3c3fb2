"""Queries and DuckDB twins of the operators, as __spark_entry__ registers them."""

from __future__ import annotations

from .op01_mixing import op1_source_mix
from .op02_lpf import op2_suffix_dedup
from .op03_rules import op3_quality_rules
from .op04_classifier import op4_quality_classifier
from .op05_lines import OP5_SQL, op5_line_dedup
from .op06_tokens import op6_token_counts
from .op07_ann import op7_nearest_vectors
from .op08_near import op8_near_duplicates
from .op09_pii import op9_personal_data
from .op10_pieces import op10_sentencepiece
from .op11_packing import op11_best_fit_packing
from .op12_repair import op12_conversation_repair
from .op13_merkle import op13_merkle_manifest

QUERIES = {f.__name__: f for f in (
    op1_source_mix, op2_suffix_dedup, op3_quality_rules, op4_quality_classifier, op5_line_dedup, op6_token_counts,
    op7_nearest_vectors, op8_near_duplicates, op9_personal_data, op10_sentencepiece,
    op11_best_fit_packing, op12_conversation_repair, op13_merkle_manifest)}
ORACLE = {"op5_line_dedup": OP5_SQL}

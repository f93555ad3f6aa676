"""The operators' queries, and the SQL of those that SQL can express."""

from __future__ import annotations

from .common import Query
from .context_tree import op1_context_tree
from .exact_dedup import OP10_SQL, op10_exact_dedup
from .hard_negatives import OP12_SQL, op12_hard_negatives
from .line_dedup import OP8_SQL, op8_line_dedup
from .mixing import OP6_SQL, op6_mixing
from .near_dedup import op3_near_dedup
from .ngram_join import OP11_SQL, op11_ngram_join
from .pieces import op4_sentencepiece
from .quality_classifier import op5_quality_classifier
from .quality_rules import op9_quality_rules
from .secret_scan import op2_secret_scan
from .sharding import op7_sharding
from .spelling import op13_spelling

QUERIES: dict[str, Query] = {
    "op1_context_tree": op1_context_tree,
    "op2_secret_scan": op2_secret_scan,
    "op3_near_dedup": op3_near_dedup,
    "op4_sentencepiece": op4_sentencepiece,
    "op5_quality_classifier": op5_quality_classifier,
    "op6_mixing": op6_mixing,
    "op7_sharding": op7_sharding,
    "op8_line_dedup": op8_line_dedup,
    "op9_quality_rules": op9_quality_rules,
    "op10_exact_dedup": op10_exact_dedup,
    "op11_ngram_join": op11_ngram_join,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_spelling": op13_spelling,
}
ORACLES: dict[str, str] = {
    "op6_mixing": OP6_SQL, "op8_line_dedup": OP8_SQL, "op10_exact_dedup": OP10_SQL, "op11_ngram_join": OP11_SQL, "op12_hard_negatives": OP12_SQL,
}

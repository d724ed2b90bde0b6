"""Queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from .bpe import op10_byte_bpe
from .clusters import OP13_SQL, op13_clusters
from .covertree import OP5_SQL, op5_cover_tree
from .jaccard import op8_jaccard_join
from .langid import op4_langid
from .lm import op2_lm_score
from .mixing import OP9_SQL, op9_mix
from .pii import op1_pii
from .quotes import op6_quotes
from .spelling import op12_spelling
from .suffix import op7_suffix_dedup
from .token_files import op11_token_files
from .webp import op3_webp

QUERIES = {f.__name__: f for f in (op1_pii, op2_lm_score, op3_webp, op4_langid, op5_cover_tree, op6_quotes, op7_suffix_dedup, op8_jaccard_join, op9_mix, op10_byte_bpe, op11_token_files, op12_spelling, op13_clusters)}
ORACLES = {"op5_cover_tree": OP5_SQL, "op9_mix": OP9_SQL, "op13_clusters": OP13_SQL}

"""The queries of this subpackage, by name, and their SQL where SQL can express one."""

from __future__ import annotations

from .collocations import ORACLE as PHRASES
from .collocations import op12_collocations
from .decontaminate import op6_decontaminate
from .hard_negatives import ORACLE as NEGATIVES
from .hard_negatives import op13_hard_negatives
from .language_id import op2_language_id
from .line_dedup import ORACLE as LINES
from .line_dedup import op1_line_dedup
from .near_dedup import op7_near_dedup
from .packing import op5_packing
from .simhash import op11_simhash
from .token_counts import op3_token_counts
from .token_files import op4_token_files
from .topk_search import ORACLE as TOPK
from .topk_search import op9_topk_search
from .toxicity import op8_toxicity
from .url_filter import op10_url_filter

QUERIES = {f.__name__: f for f in (op1_line_dedup, op2_language_id, op3_token_counts, op4_token_files, op5_packing, op6_decontaminate, op7_near_dedup, op8_toxicity, op9_topk_search, op10_url_filter, op11_simhash, op12_collocations, op13_hard_negatives)}
ORACLES: dict[str, str] = {"op1_line_dedup": LINES, "op9_topk_search": TOPK, "op12_collocations": PHRASES, "op13_hard_negatives": NEGATIVES}

"""The queries of this subpackage and, where SQL can express them, their SQL."""

from .alignment import op13_alignment
from .bpe import op1_bpe
from .exact_dedup import OP6_SQL, op6_exact_dedup
from .html_text import op8_html_text
from .language_id import op9_language_id
from .merkle import op10_fingerprints
from .mixing import OP5_SQL, op5_mixing
from .near_dedup import op4_near_dedup
from .pii import op2_pii
from .ranked import OP11_SQL, op11_search
from .sharding import op3_sharding
from .tool_calls import OP7_SQL, op7_tool_calls
from .trie_model import op12_trie_model

QUERIES = {
    "op1_bpe": op1_bpe,
    "op2_pii": op2_pii,
    "op3_sharding": op3_sharding,
    "op4_near_dedup": op4_near_dedup,
    "op5_mixing": op5_mixing,
    "op6_exact_dedup": op6_exact_dedup,
    "op7_tool_calls": op7_tool_calls,
    "op8_html_text": op8_html_text,
    "op9_language_id": op9_language_id,
    "op10_fingerprints": op10_fingerprints,
    "op11_search": op11_search,
    "op12_trie_model": op12_trie_model,
    "op13_alignment": op13_alignment,
}

ORACLE_SQL = {
    "op5_mixing": OP5_SQL,
    "op6_exact_dedup": OP6_SQL,
    "op7_tool_calls": OP7_SQL,
    "op11_search": OP11_SQL,
}

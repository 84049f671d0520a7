"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from gleaner.llm.bytepair import op10_byte_bpe
from gleaner.llm.chat import op3_chat_formatting
from gleaner.llm.chunks import op2_substring_dedup
from gleaner.llm.covertree import op4_embedding_near_dedup
from gleaner.llm.divergence import OP12_SQL, op12_source_divergence
from gleaner.llm.fingerprints import op1_document_fingerprints
from gleaner.llm.language import op8_language_id
from gleaner.llm.lines import OP13_SQL, op13_line_dedup
from gleaner.llm.packing import op6_packing
from gleaner.llm.ppm import op9_lm_scoring
from gleaner.llm.search import OP11_SQL, op11_lexical_search
from gleaner.llm.simhash import op5_simhash_near_dedup
from gleaner.llm.wrappers import op7_html_extraction

QUERIES = {
    f.__name__: f
    for f in (
        op1_document_fingerprints, op2_substring_dedup, op3_chat_formatting, op4_embedding_near_dedup, op5_simhash_near_dedup,
        op6_packing, op7_html_extraction, op8_language_id, op9_lm_scoring, op10_byte_bpe,
        op11_lexical_search, op12_source_divergence, op13_line_dedup,
    )
}
#: The first ten cannot be written in SQL over whole tables in reasonable time; tests/llm
#: holds each against a brute-force version, an exact round trip or held-out accuracy.
ORACLE_SQL: dict[str, str] = {
    "op11_lexical_search": OP11_SQL,
    "op12_source_divergence": OP12_SQL,
    "op13_line_dedup": OP13_SQL,
}

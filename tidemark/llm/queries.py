"""The registered queries of this package and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from tidemark.llm.op10_arrow_tokens import op10_arrow_tokens
from tidemark.llm.op11_spelling_variants import op11_spelling_variants
from tidemark.llm.op12_backtracking_bpe import op12_backtracking_bpe
from tidemark.llm.op13_conversation_repair import op13_conversation_repair
from tidemark.llm.op1_template_decontamination import op1_template_decontamination
from tidemark.llm.op2_bayes_minhash import op2_bayes_minhash
from tidemark.llm.op3_quality_cascade import ORACLE as OP3_SQL
from tidemark.llm.op3_quality_cascade import op3_quality_cascade
from tidemark.llm.op4_warc_derivatives import op4_warc_derivatives
from tidemark.llm.op5_suffixes import op5_suffixes
from tidemark.llm.op6_transducer_bpe import op6_transducer_bpe
from tidemark.llm.op7_fuzzy_lines import op7_fuzzy_lines
from tidemark.llm.op8_feistel_pii import op8_feistel_pii
from tidemark.llm.op9_recompression import op9_recompression

QUERIES = {
    "op1_template_decontamination": op1_template_decontamination,
    "op2_bayes_minhash": op2_bayes_minhash,
    "op3_quality_cascade": op3_quality_cascade,
    "op4_warc_derivatives": op4_warc_derivatives,
    "op5_suffixes": op5_suffixes,
    "op6_transducer_bpe": op6_transducer_bpe,
    "op7_fuzzy_lines": op7_fuzzy_lines,
    "op8_feistel_pii": op8_feistel_pii,
    "op9_recompression": op9_recompression,
    "op10_arrow_tokens": op10_arrow_tokens,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_backtracking_bpe": op12_backtracking_bpe,
    "op13_conversation_repair": op13_conversation_repair,
}

ORACLE_SQL: dict[str, str] = {
    "op3_quality_cascade": OP3_SQL,
}

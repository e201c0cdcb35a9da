"""The registered queries of the training-data operators."""

from __future__ import annotations

from tidemark.llm.bpe import op8_byte_bpe
from tidemark.llm.bpe_tree import op13_bpe_tree
from tidemark.llm.decontam import op10_decontaminate
from tidemark.llm.divergence import OP11_SQL, op11_source_divergence
from tidemark.llm.exact_dedup import OP4_SQL, op4_exact_dedup
from tidemark.llm.language_id import op2_language_id
from tidemark.llm.lm_scoring import op1_lm_scoring
from tidemark.llm.quality import op5_quality
from tidemark.llm.simhash import op6_simhash
from tidemark.llm.spelling import op12_spelling
from tidemark.llm.suffix_dedup import op7_suffix_dedup
from tidemark.llm.toxicity import op9_toxicity
from tidemark.llm.warc import OP3_SQL, op3_warc

QUERIES = {
    "op1_lm_scoring": op1_lm_scoring,
    "op2_language_id": op2_language_id,
    "op3_warc": op3_warc,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_quality": op5_quality,
    "op6_simhash": op6_simhash,
    "op7_suffix_dedup": op7_suffix_dedup,
    "op8_byte_bpe": op8_byte_bpe,
    "op9_toxicity": op9_toxicity,
    "op10_decontaminate": op10_decontaminate,
    "op11_source_divergence": op11_source_divergence,
    "op12_spelling": op12_spelling,
    "op13_bpe_tree": op13_bpe_tree,
}

#: The others have no SQL form (or none that is quick on whole tables); the tests hold them against brute force.
ORACLE_SQL = {
    "op3_warc": OP3_SQL,
    "op4_exact_dedup": OP4_SQL,
    "op11_source_divergence": OP11_SQL,
}

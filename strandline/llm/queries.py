"""Queries of this folder, one per operator, and their DuckDB statements where SQL can express them."""

from __future__ import annotations

from strandline.llm import (
    chat_format,
    collocations,
    decontaminate,
    langid,
    lexical_search,
    line_dedup,
    lm_score,
    ngram_join,
    packing,
    pii_crf,
    quality_rules,
    simhash,
    warc,
)

QUERIES = {
    "op1_line_dedup": line_dedup.op1_line_dedup,
    "op2_quality_rules": quality_rules.op2_quality_rules,
    "op3_warc": warc.op3_warc,
    "op4_decontamination": decontaminate.op4_decontamination,
    "op5_simhash": simhash.op5_simhash,
    "op6_language_id": langid.op6_language_id,
    "op7_lm_score": lm_score.op7_lm_score,
    "op8_pii": pii_crf.op8_pii,
    "op9_packing": packing.op9_packing,
    "op10_chat_format": chat_format.op10_chat_format,
    "op11_ngram_join": ngram_join.op11_ngram_join,
    "op12_lexical_search": lexical_search.op12_lexical_search,
    "op13_collocations": collocations.op13_collocations,
}

#: The other operators learn a model or need a tokenizer; tests/llm holds them
#: against brute force, an exact round trip or held-out accuracy.
ORACLE_SQL = {
    "op1_line_dedup": line_dedup.OP1_SQL,
    "op2_quality_rules": quality_rules.OP2_SQL,
    "op3_warc": warc.OP3_SQL,
    "op10_chat_format": chat_format.OP10_SQL,
    "op11_ngram_join": ngram_join.OP11_SQL,
    "op12_lexical_search": lexical_search.OP12_SQL,
    "op13_collocations": collocations.OP13_SQL,
}

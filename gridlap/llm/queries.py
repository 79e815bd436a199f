"""The registered queries of this subpackage and their SQL twins."""

from __future__ import annotations

from gridlap.llm import (
    byte_bpe,
    chat,
    decontaminate,
    embedding_dups,
    jaccard_join,
    language_id,
    period_runs,
    perplexity,
    quality,
    suffix_dedup,
    token_alignment,
    token_counts,
    warc,
)

QUERIES = {
    "op1_suffix_dedup": suffix_dedup.op1_suffix_dedup,
    "op2_chat_format": chat.op2_chat_format,
    "op3_decontaminate": decontaminate.op3_decontaminate,
    "op4_language_id": language_id.op4_language_id,
    "op5_quality": quality.op5_quality,
    "op6_embedding_dups": embedding_dups.op6_embedding_dups,
    "op7_warc": warc.op7_warc,
    "op8_token_counts": token_counts.op8_token_counts,
    "op9_byte_bpe": byte_bpe.op9_byte_bpe,
    "op10_jaccard_join": jaccard_join.op10_jaccard_join,
    "op11_perplexity_rules": perplexity.op11_perplexity_rules,
    "op12_period_runs": period_runs.op12_period_runs,
    "op13_token_alignment": token_alignment.op13_token_alignment,
}

ORACLE_SQL = {"op2_chat_format": chat.ORACLE_SQL, "op7_warc": warc.ORACLE_SQL}

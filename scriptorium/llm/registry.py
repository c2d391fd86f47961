"""Queries and SQL of this subpackage, by name."""

from scriptorium.llm import chat_format, conversation_repair, embedding_dedup, jaccard_join, language_id, line_dedup, piece_sampling, quality, secret_scan, source_mixing, substring_dedup, syncmers, token_alignment

QUERIES = {
    "op1_embedding_dedup": embedding_dedup.query,
    "op2_quality_classifier": quality.query,
    "op4_ngram_jaccard_join": jaccard_join.query,
    "op3_source_mixing": source_mixing.query,
    "op5_chat_format": chat_format.query,
    "op6_piece_sampling": piece_sampling.query,
    "op7_line_dedup": line_dedup.query,
    "op8_syncmer_fingerprints": syncmers.query,
    "op9_secret_scan": secret_scan.query,
    "op10_language_id": language_id.query,
    "op11_conversation_repair": conversation_repair.query,
    "op12_substring_dedup": substring_dedup.query,
    "op13_token_alignment": token_alignment.query,
}

ORACLES = {
    "op5_chat_format": chat_format.ORACLE,
    "op7_line_dedup": line_dedup.ORACLE,
    "op11_conversation_repair": conversation_repair.ORACLE,
    "op12_substring_dedup": substring_dedup.ORACLE,
}

"""The queries of this subpackage and the SQL for those that SQL can express."""

from __future__ import annotations

from consult.llm import bpe, chat_format, decontaminate, exact_dedup, language_id, license_scan, ngram_join, repair, spelling, substring_dedup, topk_search, toxicity, warc

QUERIES = {
    "op1_substring_dedup": substring_dedup.op1_substring_dedup,
    "op2_decontaminate": decontaminate.op2_decontaminate,
    "op3_byte_bpe": bpe.op3_byte_bpe,
    "op4_chat_format": chat_format.op4_chat_format,
    "op5_warc": warc.op5_warc,
    "op6_language_id": language_id.op6_language_id,
    "op7_toxicity": toxicity.op7_toxicity,
    "op8_license_scan": license_scan.op8_license_scan,
    "op9_exact_dedup": exact_dedup.op9_exact_dedup,
    "op10_ngram_jaccard": ngram_join.op10_ngram_jaccard,
    "op11_topk_search": topk_search.op11_topk_search,
    "op12_spelling_variants": spelling.op12_spelling_variants,
    "op13_conversation_repair": repair.op13_conversation_repair,
}

ORACLE = {
    "op2_decontaminate": decontaminate.ORACLE,
    "op4_chat_format": chat_format.ORACLE,
    "op5_warc": warc.ORACLE,
    "op9_exact_dedup": exact_dedup.ORACLE,
    "op11_topk_search": topk_search.ORACLE,
}

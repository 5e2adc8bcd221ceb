"""The registered queries of the training-data operators and their SQL."""

from __future__ import annotations

from gridframe.llm import chat, decontam, exact, html_text, langid, lexical, lines, merkle, mixing, mtree, ngram_join, packing, suffix_dedup

QUERIES = {
    "op1_ngram_jaccard": ngram_join.op1_ngram_jaccard,
    "op2_best_fit_packing": packing.op2_best_fit_packing,
    "op3_main_text": html_text.op3_main_text,
    "op4_perspective_chat": chat.op4_perspective_chat,
    "op5_language": langid.op5_language,
    "op6_repeated_spans": suffix_dedup.op6_repeated_spans,
    "op7_top_inner_products": mtree.op7_top_inner_products,
    "op8_source_mix": mixing.op8_source_mix,
    "op9_exact_copies": exact.op9_exact_copies,
    "op10_line_dedup": lines.op10_line_dedup,
    "op11_decontamination": decontam.op11_decontamination,
    "op12_lexical_search": lexical.op12_lexical_search,
    "op13_merkle_manifest": merkle.op13_merkle_manifest,
}
SQL = {
    "op4_perspective_chat": chat.OP4_SQL,
    "op7_top_inner_products": mtree.OP7_SQL,
    "op8_source_mix": mixing.OP8_SQL,
    "op9_exact_copies": exact.OP9_SQL,
    "op11_decontamination": decontam.OP11_SQL,
    "op12_lexical_search": lexical.OP12_SQL,
    "op13_merkle_manifest": merkle.OP13_SQL,
}

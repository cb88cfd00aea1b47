"""Queries of the training-data operators, and DuckDB SQL where SQL can express them."""

from __future__ import annotations

from hexaccess.llm import curves, lines, mixing, pieces, privacy, quality, ranked, repair, simhash, token_files, topk, urls, word_bpe

QUERIES = {
    "op1_quality": quality.op1_quality,
    "op2_source_mix": mixing.op2_source_mix,
    "op3_line_dedup": lines.op3_line_dedup,
    "op4_top_k": topk.op4_top_k,
    "op5_token_files": token_files.op5_token_files,
    "op6_simhash": simhash.op6_simhash,
    "op7_personal_data": privacy.op7_personal_data,
    "op8_url_filter": urls.op8_url_filter,
    "op9_sentencepiece": pieces.op9_sentencepiece,
    "op10_neighbours": curves.op10_neighbours,
    "op11_conversation_repair": repair.op11_conversation_repair,
    "op12_word_bpe": word_bpe.op12_word_bpe,
    "op13_ranked_search": ranked.op13_ranked_search,
}

ORACLES = {
    "op2_source_mix": mixing.OP2_SQL,
    "op3_line_dedup": lines.OP3_SQL,
    "op4_top_k": topk.OP4_SQL,
    "op8_url_filter": urls.OP8_SQL,
    "op13_ranked_search": ranked.OP13_SQL,
}

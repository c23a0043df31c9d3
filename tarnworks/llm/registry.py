"""Queries of the training-data operators and their SQL, by name."""

from __future__ import annotations

from tarnworks.llm import balltree, bpe, bursttrie, chat, dedup, langid, license, media, packing, secretscan, topk, urlfilter, warc

QUERIES = {
    "op1_media_avi": media.op1_media_avi,
    "op2_optimal_buckets": packing.op2_optimal_buckets,
    "op3_language_fusion": langid.op3_language_fusion,
    "op4_temporal_url_lists": urlfilter.op4_temporal_url_lists,
    "op5_chat_tree": chat.op5_chat_tree,
    "op6_secret_forest": secretscan.op6_secret_forest,
    "op7_bpe_trie": bpe.op7_bpe_trie,
    "op8_license_rules": license.op8_license_rules,
    "op9_maxscore_topk": topk.op9_maxscore_topk,
    "op10_superminhash": dedup.op10_superminhash,
    "op11_warc_salvage": warc.op11_warc_salvage,
    "op12_ball_tree_search": balltree.op12_ball_tree_search,
    "op13_burst_trie": bursttrie.op13_burst_trie,
}
SQL = {
    "op4_temporal_url_lists": urlfilter.OP4_SQL,
    "op8_license_rules": license.OP8_SQL,
    "op5_chat_tree": chat.OP5_SQL,
    "op9_maxscore_topk": topk.OP9_SQL,
    "op10_superminhash": dedup.OP10_SQL,
    "op11_warc_salvage": warc.OP11_SQL,
    "op12_ball_tree_search": balltree.OP12_SQL,
    "op13_burst_trie": bursttrie.OP13_SQL,
}

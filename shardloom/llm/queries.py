"""The registered queries of this subpackage and their SQL."""
from __future__ import annotations

from shardloom.llm import (byte_bpe, collocations, exact_dedup, fingerprints, language_model, licences, packing, pages,
                           prefix_trie, quality, rules, simhash, suffixes)

QUERIES = {
    "op1_quality_attention": quality.quality_query,
    "op2_licence_scan": licences.licence_query,
    "op3_window_packing": packing.packing_query,
    "op4_page_text": pages.pages_query,
    "op5_exact_dedup": exact_dedup.dedup_query,
    "op6_byte_bpe": byte_bpe.bpe_query,
    "op7_prefix_fingerprints": fingerprints.fingerprint_query,
    "op8_simhash_groups": simhash.simhash_query,
    "op9_repeated_passages": suffixes.repeats_query,
    "op10_log_bilinear": language_model.language_model_query,
    "op11_collocations": collocations.collocation_query,
    "op12_quality_rules": rules.rules_query,
    "op13_prefix_trie": prefix_trie.trie_query,
}
ORACLE = {"op5_exact_dedup": exact_dedup.DEDUP_SQL, "op12_quality_rules": rules.RULES_SQL,
          "op13_prefix_trie": prefix_trie.TRIE_SQL, "op11_collocations": collocations.COLLOCATION_SQL}

"""Registered queries of this package and their SQL twins."""

from __future__ import annotations

import corpus_pipeline
from tillmark.llm import bpe, chat, classifier, hard_negatives, neighbours, packing, quality_rules, secrets, sharding, simhash, substrings, variants, warc

QUERIES = {
    "op1_budgeted_windows": chat.op1_budgeted_windows,
    "op2_inverted_multi_index": neighbours.op2_inverted_multi_index,
    "op3_golay_simhash": simhash.op3_golay_simhash,
    "op4_super_kmers": substrings.op4_super_kmers,
    "op5_factorisation_machine": classifier.op5_factorisation_machine,
    "op6_word_bpe": bpe.op6_word_bpe,
    "op7_vector_packing": packing.op7_vector_packing,
    "op8_quality_rules": quality_rules.op8_quality_rules,
    "op9_jump_sharding": sharding.op9_jump_sharding,
    "op10_secret_ledger": secrets.op10_secret_ledger,
    "op11_gzip_normaliser": warc.op11_gzip_normaliser,
    "op12_inverted_multi_index_negatives": hard_negatives.op12_inverted_multi_index_negatives,
    "op13_sorted_scan": variants.op13_sorted_scan,
    "pipeline": corpus_pipeline.run,
}
ORACLES = {
    "op4_super_kmers": substrings.ORACLE,
    "op9_jump_sharding": sharding.ORACLE,
    "op11_gzip_normaliser": warc.ORACLE,
    "op12_inverted_multi_index_negatives": hard_negatives.ORACLE,
    "op13_sorted_scan": variants.ORACLE,
}

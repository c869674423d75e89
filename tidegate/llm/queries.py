"""The registered query of each operator, over whole tables and with production parameters."""

from __future__ import annotations

import public_tokenizers

from . import (
    hard_negatives, html_blocks, importance, language, neighbours, ngram_trie, odd_sketch, packing, pii, prefix_join, repetition, toxicity, winnowing)
from .tables import read

QUERIES = {
    "op1_ngram_trie": lambda spark, sf_dir: ngram_trie.language_model_scores(read(spark, sf_dir, "documents"), min_count=1),
    "op2_cross_parsing": lambda spark, sf_dir: language.language_id(read(spark, sf_dir, "documents")),
    "op3_vector_packing": lambda spark, sf_dir: packing.packed_digest(
        read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN),
    "op4_pii_anchors": lambda spark, sf_dir: pii.personal_data(read(spark, sf_dir, "documents")),
    "op5_block_rules": lambda spark, sf_dir: html_blocks.extract_text(read(spark, sf_dir, "pages")),
    "op6_noisy_or": lambda spark, sf_dir: toxicity.toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")),
    "op7_winnowing": lambda spark, sf_dir: winnowing.contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")),
    "op8_repetition": lambda spark, sf_dir: repetition.quality_rules(read(spark, sf_dir, "documents")),
    "op9_odd_sketch": lambda spark, sf_dir: odd_sketch.near_duplicates(read(spark, sf_dir, "documents"), words=4),
    "op10_neighbour_vote": lambda spark, sf_dir: neighbours.quality(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")),
    "op11_prefix_join": lambda spark, sf_dir: prefix_join.similar_documents(read(spark, sf_dir, "documents"), words=4, percent=85),
    "op12_importance": lambda spark, sf_dir: importance.resample(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")),
    "op13_cover_tree": lambda spark, sf_dir: hard_negatives.hard_negatives(read(spark, sf_dir, "embeddings")),
}
ORACLES: dict[str, str] = {"op7_winnowing": winnowing.ORACLE, "op9_odd_sketch": odd_sketch.ORACLE, "op11_prefix_join": prefix_join.ORACLE,
                           "op12_importance": importance.ORACLE, "op13_cover_tree": hard_negatives.ORACLE}

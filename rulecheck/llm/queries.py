"""The registered queries of the corpus operators and their DuckDB SQL (where SQL can express the operator)."""

from __future__ import annotations

from rulecheck.llm import bpe, chat, langid, merkle, near_dedup, oracles, packing, periodic, quality, secrets, sharding, token_counts, url_filter, vector_codes


def queries() -> dict:
    return {f.__name__: f for f in (
        near_dedup.op1_order_minhash, bpe.op2_batched_bpe, merkle.op3_merkle_fingerprints, secrets.op4_trigram_secrets,
        langid.op5_subword_langid, token_counts.op6_prefix_token_counts, chat.op7_event_sourced_chat,
        packing.op8_length_buckets, quality.op9_risk_controlled_rules, sharding.op10_histogram_shards, periodic.op12_periodic_runs,
        url_filter.op11_host_reputation, vector_codes.op13_cover_tree_codes)}


def oracle_sql() -> dict[str, str]:
    return oracles.oracle_sql()

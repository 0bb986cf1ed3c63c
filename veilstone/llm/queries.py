"""The registered queries of the numbered operators and their DuckDB SQL."""

from __future__ import annotations

from veilstone.llm import (
    ann, bpe, decontamination, langid, mixing, negatives, pii, quality, sharding, toxicity, trie_join, warc, whitening,
)

QUERIES = {
    "op1_marginal_langid": langid.op1_marginal_langid,
    "op2_pu_toxicity": toxicity.op2_pu_toxicity,
    "op3_warc_captures": warc.op3_warc_captures,
    "op4_hash_tree_shards": sharding.op4_hash_tree_shards,
    "op5_bootstrapped_pii": pii.op5_bootstrapped_pii,
    "op6_attention_quality": quality.op6_attention_quality,
    "op7_minhash_containment": decontamination.op7_minhash_containment,
    "op8_one_bit_neighbours": ann.op8_one_bit_neighbours,
    "op9_trie_components": trie_join.op9_trie_components,
    "op10_flow_mix": mixing.op10_flow_mix,
    "op11_byte_bpe": bpe.op11_byte_bpe,
    "op12_block_whitening": whitening.op12_block_whitening,
    "op13_slot_negatives": negatives.op13_slot_negatives,
}

#: What DuckDB can express; hashes of 64 bits, trained models and floating draws are tested by brute force instead.
ORACLE = {
    "op7_minhash_containment": decontamination.ORACLE,
    "op9_trie_components": trie_join.ORACLE,
    "op13_slot_negatives": negatives.ORACLE,
    "op3_warc_captures": """
        WITH p AS (
            SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
        ), f AS (
            SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS first_id
            FROM p
        )
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN first_id = page_id THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN first_id = page_id THEN NULL ELSE first_id END AS refers_to,
               CASE WHEN first_id = page_id THEN true END AS digest_ok
        FROM f
    """,
}

"""The registered query of each operator, over its whole table, and the SQL of those that SQL can express."""

from __future__ import annotations

from vaultweave.llm.langid import op5_language_id
from vaultweave.llm.mixing import OP6_SQL, op6_mixing_sources
from vaultweave.llm.near_dedup import op4_minhash_near_dedup
from vaultweave.llm.packing import op8_curve_packing
from vaultweave.llm.periodic_runs import op11_periodic_runs
from vaultweave.llm.pii import op9_format_preserving_pii
from vaultweave.llm.prefix_trie import OP12_SQL, op12_conversation_prefix_trie
from vaultweave.llm.sharding import OP13_SQL, op13_proportional_shards
from vaultweave.llm.simhash import op1_document_fingerprints
from vaultweave.llm.suffix_dedup import op2_suffix_dedup
from vaultweave.llm.token_count import op7_token_counts
from vaultweave.llm.topk import OP10_SQL, op10_exact_top_k
from vaultweave.llm.toxicity import op3_toxicity


def queries() -> dict:
    every = (op1_document_fingerprints, op2_suffix_dedup, op3_toxicity, op4_minhash_near_dedup, op5_language_id,
             op6_mixing_sources, op7_token_counts, op8_curve_packing, op9_format_preserving_pii, op10_exact_top_k,
             op11_periodic_runs, op12_conversation_prefix_trie, op13_proportional_shards)
    return {f.__name__: f for f in every}


def oracle_sql() -> dict[str, str]:
    return {"op6_mixing_sources": OP6_SQL, "op10_exact_top_k": OP10_SQL, "op12_conversation_prefix_trie": OP12_SQL,
            "op13_proportional_shards": OP13_SQL}

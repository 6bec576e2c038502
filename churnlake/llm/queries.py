"""The registered queries of this subpackage."""

from __future__ import annotations

from churnlake.llm.clustering import op13_incremental_clusters
from churnlake.llm.decontamination import op5_benchmark_decontamination
from churnlake.llm.exact_dedup import op6_golomb_exact_dedup
from churnlake.llm.licences import op1_license_scan
from churnlake.llm.line_dedup import op9_winnowed_line_dedup
from churnlake.llm.merkle import op12_merkle_manifest
from churnlake.llm.mixing import op3_curriculum_mixing
from churnlake.llm.pii import op7_bootstrapped_pii
from churnlake.llm.quality import op11_latent_quality
from churnlake.llm.sharding import op10_jump_hash_sharding
from churnlake.llm.simhash import op4_simhash_neardup
from churnlake.llm.toxicity import op8_classifier_chain_toxicity
from churnlake.llm.url_filter import op2_redirect_equivalence

QUERIES = {
    "op1_license_scan": op1_license_scan,
    "op2_redirect_equivalence": op2_redirect_equivalence,
    "op3_curriculum_mixing": op3_curriculum_mixing,
    "op4_simhash_neardup": op4_simhash_neardup,
    "op5_benchmark_decontamination": op5_benchmark_decontamination,
    "op6_golomb_exact_dedup": op6_golomb_exact_dedup,
    "op7_bootstrapped_pii": op7_bootstrapped_pii,
    "op8_classifier_chain_toxicity": op8_classifier_chain_toxicity,
    "op9_winnowed_line_dedup": op9_winnowed_line_dedup,
    "op10_jump_hash_sharding": op10_jump_hash_sharding,
    "op11_latent_quality": op11_latent_quality,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_incremental_clusters": op13_incremental_clusters,
}

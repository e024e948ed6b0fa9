"""Queries and SQL of this subpackage, by name."""

from __future__ import annotations

from .alignment import op12_tokenizer_alignment
from .decontaminate import OP1_SQL, op1_decontaminate
from .fingerprint_index import OP8_SQL, op8_fingerprint_index
from .licenses import OP10_SQL, op10_license_scan
from .lines import OP7_SQL, op7_line_dedup
from .merkle import op6_merkle_fingerprints
from .mixing import OP4_SQL, op4_mix_sources
from .pii import op5_personal_data
from .quality import op13_quality_classifier
from .simhash import op3_simhash_near_dedup
from .suffix_doubling import op9_suffix_array_dedup
from .toxicity import op2_toxicity
from .whitening import op11_embedding_whitening

QUERIES = {
    "op1_decontaminate": op1_decontaminate,
    "op2_toxicity": op2_toxicity,
    "op3_simhash_near_dedup": op3_simhash_near_dedup,
    "op4_mix_sources": op4_mix_sources,
    "op5_personal_data": op5_personal_data,
    "op6_merkle_fingerprints": op6_merkle_fingerprints,
    "op7_line_dedup": op7_line_dedup,
    "op8_fingerprint_index": op8_fingerprint_index,
    "op9_suffix_array_dedup": op9_suffix_array_dedup,
    "op10_license_scan": op10_license_scan,
    "op11_embedding_whitening": op11_embedding_whitening,
    "op12_tokenizer_alignment": op12_tokenizer_alignment,
    "op13_quality_classifier": op13_quality_classifier,
}
ORACLES = {"op1_decontaminate": OP1_SQL, "op4_mix_sources": OP4_SQL, "op7_line_dedup": OP7_SQL, "op8_fingerprint_index": OP8_SQL, "op10_license_scan": OP10_SQL}

"""The queries of this package, by name, and their DuckDB twins."""

from stationflow.llm import (
    bpe, collocations, fingerprints, jaccard, mixing, packing, passages, privacy, quality, rules, suffixes, toxicity, whitening,
)

QUERIES = {
    "op1_toxicity": toxicity.op1_toxicity,
    "op2_suffix_dedup": suffixes.op2_suffix_dedup,
    "op3_pii": privacy.op3_pii,
    "op4_ngram_jaccard": jaccard.op4_ngram_jaccard,
    "op5_quality_classifier": quality.op5_quality_classifier,
    "op6_packing": packing.op6_packing,
    "op7_substring_dedup": passages.op7_substring_dedup,
    "op8_quality_rules": rules.op8_quality_rules,
    "op9_bpe": bpe.op9_bpe,
    "op10_fingerprints": fingerprints.op10_fingerprints,
    "op11_embedding_whitening": whitening.op11_embedding_whitening,
    "op12_collocations": collocations.op12_collocations,
    "op13_source_mix": mixing.op13_source_mix,
}
ORACLES = {"op12_collocations": collocations.OP12_SQL, "op13_source_mix": mixing.OP13_SQL}

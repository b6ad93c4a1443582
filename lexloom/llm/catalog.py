"""Queries of this subpackage and their SQL: opN_<name> for each operator N."""

from . import ball_kmeans, bpe, collocations, decontaminate, jaccard, langid, licenses, mixing, phrases, pseudonyms, quality, suffix_dedup, token_store

QUERIES = {
    "op1_line_quality": quality.op1,
    "op2_jaccard_join": jaccard.op2,
    "op2_jaccard_links": jaccard.op2_links,
    "op3_suffix_dedup": suffix_dedup.op3,
    "op4_language_id": langid.op4,
    "op5_phrase_dedup": phrases.op5,
    "op6_spaced_seeds": decontaminate.op6,
    "op7_license_scan": licenses.op7,
    "op8_pseudonyms": pseudonyms.op8,
    "op9_mix_sources": mixing.op9,
    "op10_token_output": token_store.op10,
    "op11_prefix_bpe": bpe.op11,
    "op12_pair_naming": collocations.op12,
    "op13_ball_kmeans": ball_kmeans.op13,
}

ORACLES: dict[str, str] = {
    "op1_line_quality": quality.SQL,
    "op2_jaccard_join": jaccard.SQL,
    "op2_jaccard_links": jaccard.LINKS_SQL,
    "op3_suffix_dedup": suffix_dedup.SQL,
    "op5_phrase_dedup": phrases.SQL,
    "op6_spaced_seeds": decontaminate.SQL,
    "op12_pair_naming": collocations.SQL,
    "op13_ball_kmeans": ball_kmeans.SQL,
}

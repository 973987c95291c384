"""Queries of this subpackage and, where SQL can say the same, their DuckDB text."""

from . import alignment, collocations, exact_dedup, fixity, media, near_dedup, packing, quality, repeats, sentencepieces, sharding, simhash, toxicity

QUERIES = {
    "op1_toxicity": toxicity.op1_toxicity,
    "op2_suffix_dedup": repeats.op2_suffix_dedup,
    "op3_media_columns": media.op3_media_columns,
    "op4_quality": quality.op4_quality,
    "op5_near_dedup": near_dedup.op5_near_dedup,
    "op6_exact_dedup": exact_dedup.op6_exact_dedup,
    "op7_sharding": sharding.op7_sharding,
    "op8_sentencepiece": sentencepieces.op8_sentencepiece,
    "op9_packing": packing.op9_packing,
    "op10_warc_fixity": fixity.op10_warc_fixity,
    "op11_collocations": collocations.op11_collocations,
    "op12_alignment": alignment.op12_alignment,
    "op13_simhash": simhash.op13_simhash,
}

ORACLES = {"op6_exact_dedup": exact_dedup.ORACLE, "op10_warc_fixity": fixity.ORACLE, "op11_collocations": collocations.ORACLE}

"""Queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from tilescope.llm import audit, contamination, fingerprints, links, packing, repeats, scoring, sharding, variants, warc
from tilescope.llm.languages import op6_language_id
from tilescope.llm.mixing import op1_mixing

QUERIES = {
    "op1_mixing": op1_mixing,
    "op2_lm_scoring": scoring.op2_lm_scoring,
    "op3_decontamination": contamination.op3_decontamination,
    "op4_sharding": sharding.op4_sharding,
    "op5_suffix_array": repeats.op5_suffix_array,
    "op6_language_id": op6_language_id,
    "op7_fingerprints": fingerprints.op7_fingerprints,
    "op8_jaccard_join": links.op8_jaccard_join,
    "op9_warc": warc.op9_warc,
    "op10_substring_dedup": repeats.op10_substring_dedup,
    "op11_packing": packing.op11_packing,
    "op12_variants": variants.op12_variants,
    "op13_filter_audit": audit.op13_filter_audit,
}

ORACLE_SQL: dict[str, str] = {
    "op3_decontamination": contamination.ORACLE_SQL,
    "op4_sharding": sharding.ORACLE_SQL,
    "op8_jaccard_join": links.ORACLE_SQL,
    "op9_warc": warc.ORACLE_SQL,
    **repeats.ORACLE_SQL,
    "op12_variants": variants.ORACLE_SQL,
    "op13_filter_audit": audit.ORACLE_SQL,
}

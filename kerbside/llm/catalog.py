"""Queries of the text operators over the driver's tables, with SQL where SQL can state them."""

from __future__ import annotations

import corpus_pipeline
from kerbside.llm import (
    decontam, language, licenses, mixing, negatives, packing, phrases, quality, rlz, setsketch, suffix_bwt, toxicity, warc,
)

QUERIES = {
    "op1_substring_dedup": rlz.op1_substring_dedup,
    "op2_suffix_dedup": suffix_bwt.op2_suffix_dedup,
    "op3_mix_sources": mixing.op3_mix_sources,
    "op4_language": language.op4_language,
    "op5_toxicity": toxicity.op5_toxicity,
    "op6_licenses": licenses.op6_licenses,
    "op7_quality": quality.op7_quality,
    "op8_warc_packages": warc.op8_warc_packages,
    "op9_decontaminate": decontam.op9_decontaminate,
    "op10_near_duplicates": setsketch.op10_near_duplicates,
    "op11_phrases": phrases.op11_phrases,
    "op12_pack_sequences": packing.op12_pack_sequences,
    "op13_hard_negatives": negatives.op13_hard_negatives,
    "pipeline": corpus_pipeline.run,
}
ORACLES = {
    "op1_substring_dedup": rlz.SQL,
    "op6_licenses": licenses.SQL,
    "op7_quality": quality.SQL,
    "op8_warc_packages": warc.SQL,
    "op9_decontaminate": decontam.SQL,
    "op10_near_duplicates": setsketch.SQL,
    "op11_phrases": phrases.SQL,
    "op13_hard_negatives": negatives.SQL,
}

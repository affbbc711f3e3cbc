"""Registered queries of the training-data operators and their DuckDB twins."""

from __future__ import annotations

import corpus_pipeline

from . import (decontam, exact_dedup, hard_negatives, html_extract, langid, licenses, mixing, pii, quality_lm, simhash,
               suffix_dedup, vector_codes, warc)

QUERIES = {
    "op1_source_mix": mixing.query,
    "op2_suffix_dedup": suffix_dedup.query,
    "op3_quality_classifier": quality_lm.query,
    "op4_exact_dedup": exact_dedup.query,
    "op5_html_extraction": html_extract.query,
    "op6_pii_surrogates": pii.query,
    "op7_language_id": langid.query,
    "op8_decontamination": decontam.query,
    "op9_simhash_near_dedup": simhash.query,
    "op10_license_scan": licenses.query,
    "op11_hard_negatives": hard_negatives.query,
    "op12_vector_codes": vector_codes.query,
    "op13_warc_archives": warc.query,
    "pipeline": corpus_pipeline.run,
}

ORACLES = {
    "op1_source_mix": mixing.ORACLE,
    "op4_exact_dedup": exact_dedup.ORACLE,
    "op8_decontamination": decontam.ORACLE,
    "op11_hard_negatives": hard_negatives.ORACLE,
    "op12_vector_codes": vector_codes.ORACLE,
    "op13_warc_archives": warc.ORACLE,
}

"""Registered queries of the text operators and their SQL twins."""

from __future__ import annotations

import corpus_pipeline
from starmart.llm import (collocations, decontamination, hyperminhash, language, lm, packing, pii, quality, rollups, runs,
                          simhash, topk, toxicity)
from starmart.llm.common import shipped

QUERIES = {
    "op1_simhash": simhash.op1_simhash,
    "op2_language": language.op2_language,
    "op3_quality": quality.op3_quality,
    "op4_toxicity": toxicity.op4_toxicity,
    "op5_pii": pii.op5_pii,
    "op6_topk": topk.op6_topk,
    "op7_decontamination": decontamination.op7_decontamination,
    "op8_packing": packing.op8_packing,
    "op10_lm_scores": lm.op10_lm_scores,
    "pipeline": corpus_pipeline.run,
    "op9_token_rollups": rollups.op9_token_rollups,
    "op11_collocations": collocations.op11_collocations,
    "op12_hyperminhash": hyperminhash.op12_hyperminhash,
    "op13_runs": runs.op13_runs,
}
QUERIES = {name: shipped(query) for name, query in QUERIES.items()}

ORACLE: dict[str, str] = {"op6_topk": topk.ORACLE, "op11_collocations": collocations.ORACLE}

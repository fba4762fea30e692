"""Queries of the subpackage, by name, and their SQL."""

from __future__ import annotations

from tidemark.llm import oracles
from tidemark.llm.chat import op12_budgeted_chat
from tidemark.llm.cohorts import op11_cohort_retention
from tidemark.llm.decontamination import op4_winnowing
from tidemark.llm.language import op10_language
from tidemark.llm.packing import op9_packing
from tidemark.llm.pii import op1_contextual_pii
from tidemark.llm.quality import op7_host_quality
from tidemark.llm.scoring import op6_pseudo_likelihood
from tidemark.llm.sharding import op5_sharding
from tidemark.llm.simhash import op2_simhash
from tidemark.llm.spelling import op13_spelling_variants
from tidemark.llm.token_counts import op3_token_counts
from tidemark.llm.toxicity import op8_toxicity

QUERIES = {
    "op1_contextual_pii": op1_contextual_pii,
    "op2_simhash": op2_simhash,
    "op3_token_counts": op3_token_counts,
    "op4_winnowing": op4_winnowing,
    "op5_sharding": op5_sharding,
    "op6_pseudo_likelihood": op6_pseudo_likelihood,
    "op7_host_quality": op7_host_quality,
    "op8_toxicity": op8_toxicity,
    "op9_packing": op9_packing,
    "op10_language": op10_language,
    "op11_cohort_retention": op11_cohort_retention,
    "op12_budgeted_chat": op12_budgeted_chat,
    "op13_spelling_variants": op13_spelling_variants,
}

#: DuckDB SQL where it can express a query over whole tables.
ORACLE_SQL = {
    "op4_winnowing": oracles.WINNOWING,
    "op7_host_quality": oracles.QUALITY,
    "op11_cohort_retention": oracles.COHORTS,

    "op13_spelling_variants": oracles.SPELLING,
}

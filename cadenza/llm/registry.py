"""The queries of the subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cadenza.llm import chat_format, chosen_path, divergence, suffix_dedup
from cadenza.llm.ann import op1_forest_ann
from cadenza.llm.chat_format import op13_chat_formatting
from cadenza.llm.chosen_path import op5_minhash_near_dedup
from cadenza.llm.divergence import op12_source_divergence
from cadenza.llm.language_id import op7_language_id
from cadenza.llm.lm_scoring import op9_lm_scoring
from cadenza.llm.mixing import op3_source_mixing
from cadenza.llm.packing import op8_best_fit_packing
from cadenza.llm.simhash import op4_simhash_fingerprints
from cadenza.llm.suffix_dedup import op2_suffix_dedup
from cadenza.llm.token_counts import op10_token_counts
from cadenza.llm.url_filter import op6_url_language_ratio
from cadenza.llm.whitening import op11_embedding_whitening

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_forest_ann": op1_forest_ann,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_source_mixing": op3_source_mixing,
    "op4_simhash_fingerprints": op4_simhash_fingerprints,
    "op5_minhash_near_dedup": op5_minhash_near_dedup,
    "op6_url_language_ratio": op6_url_language_ratio,
    "op7_language_id": op7_language_id,
    "op8_best_fit_packing": op8_best_fit_packing,
    "op9_lm_scoring": op9_lm_scoring,
    "op10_token_counts": op10_token_counts,
    "op11_embedding_whitening": op11_embedding_whitening,
    "op12_source_divergence": op12_source_divergence,
    "op13_chat_formatting": op13_chat_formatting,
}

ORACLES: dict[str, str] = {
    "op2_suffix_dedup": suffix_dedup.ORACLE,
    "op5_minhash_near_dedup": chosen_path.ORACLE,
    "op12_source_divergence": divergence.ORACLE,
    "op13_chat_formatting": chat_format.ORACLE,
}

"""The queries of this subpackage and the SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .bpe import op13_bpe
from .decontamination import op9_decontamination
from .divergence import op12_source_divergence
from .html_text import op4_html_extraction
from .jaccard_join import op6_jaccard_join
from .katz import op10_lm_scoring
from .oracle import DIVERGENCE, EMBEDDINGS, JACCARD, LEAKS, SUBSTRINGS
from .packing import op7_best_fit_packing
from .periodic import op11_periodic_runs
from .quality import op3_quality_classifier
from .secrets import op8_secret_scan
from .substring_dedup import op2_substring_dedup
from .token_output import op5_token_output
from .vector_graph import op1_embedding_near_dedup

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_embedding_near_dedup": op1_embedding_near_dedup,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_quality_classifier": op3_quality_classifier,
    "op4_html_extraction": op4_html_extraction,
    "op5_token_output": op5_token_output,
    "op6_jaccard_join": op6_jaccard_join,
    "op7_best_fit_packing": op7_best_fit_packing,
    "op8_secret_scan": op8_secret_scan,
    "op9_decontamination": op9_decontamination,
    "op10_lm_scoring": op10_lm_scoring,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_source_divergence": op12_source_divergence,
    "op13_bpe": op13_bpe,
}

#: The others can't be put in SQL: trained or packed results, tokenizers, offsets, floating-point models.
ORACLE_SQL: dict[str, str] = {
    "op1_embedding_near_dedup": EMBEDDINGS,
    "op2_substring_dedup": SUBSTRINGS,
    "op6_jaccard_join": JACCARD,
    "op9_decontamination": LEAKS,
    "op12_source_divergence": DIVERGENCE,
}

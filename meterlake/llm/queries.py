"""The operators as named queries over the whole tables, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from meterlake.llm.chat import op10_chat_formatting
from meterlake.llm.collocations import op11_collocations
from meterlake.llm.jaccard import op5_jaccard
from meterlake.llm.language import op6_language
from meterlake.llm.leaks import op7_decontamination
from meterlake.llm.packing import op4_packing
from meterlake.llm.quality import op9_quality
from meterlake.llm.search import ORACLE as SEARCH_SQL
from meterlake.llm.search import op8_search
from meterlake.llm.secret_scan import op3_secrets
from meterlake.llm.spelling import op13_spelling
from meterlake.llm.suffix import op2_suffix
from meterlake.llm.token_files import op12_token_files
from meterlake.llm.tokens import op1_token_counts

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_counts": op1_token_counts,
    "op2_suffix_dedup": op2_suffix,
    "op3_secret_scans": op3_secrets,
    "op4_best_fit_packing": op4_packing,
    "op5_ngram_jaccard": op5_jaccard,
    "op6_language_id": op6_language,
    "op7_decontamination": op7_decontamination,
    "op8_exact_topk": op8_search,
    "op9_quality_classifier": op9_quality,
    "op10_chat_formatting": op10_chat_formatting,
    "op11_collocations": op11_collocations,
    "op12_token_files": op12_token_files,
    "op13_spelling_variants": op13_spelling,
}
ORACLES: dict[str, str] = {"op8_exact_topk": SEARCH_SQL}

"""The driver's queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from linemend.llm.bpe import op1_bpe_automaton
from linemend.llm.html_text import op5_html_main_text
from linemend.llm.langid import op6_language_bigru
from linemend.llm.mixing import op10_pfair_mixing
from linemend.llm.multi_index import op2_multi_index_search
from linemend.llm.near_vectors import op8_embedding_near_dedup
from linemend.llm.parity_join import op4_parity_jaccard
from linemend.llm.pii import op9_pii_feistel
from linemend.llm.token_count import op7_token_counts
from linemend.llm.toxicity import op3_toxicity_ftrl

QUERIES = (
    op1_bpe_automaton,
    op2_multi_index_search,
    op3_toxicity_ftrl,
    op4_parity_jaccard,
    op5_html_main_text,
    op6_language_bigru,
    op7_token_counts,
    op8_embedding_near_dedup,
    op9_pii_feistel,
    op10_pfair_mixing,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in QUERIES}


def oracle_sql() -> dict[str, str]:
    return {}

"""Registered queries of this package and their DuckDB statements."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from eventstar.llm.convtrie import OP12_SQL, op12_conversation_trie
from eventstar.llm.decontam import OP7_SQL, op7_decontamination
from eventstar.llm.html import op2_html_extraction
from eventstar.llm.jaccard import OP5_SQL, op5_ngram_jaccard
from eventstar.llm.linededup import OP1_SQL, op1_line_dedup
from eventstar.llm.neardup import OP13_SQL, op13_minhash_dedup
from eventstar.llm.packing import op10_best_fit_packing
from eventstar.llm.phrases import OP11_SQL, op11_phrase_mining
from eventstar.llm.quality import OP9_SQL, op9_quality_rules
from eventstar.llm.tokencount import op4_token_counts
from eventstar.llm.toxicity import op6_toxicity
from eventstar.llm.urlfilter import OP3_SQL, op3_url_filters
from eventstar.llm.warc import OP8_SQL, op8_warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_line_dedup": op1_line_dedup,
    "op2_html_extraction": op2_html_extraction,
    "op3_url_filters": op3_url_filters,
    "op4_token_counts": op4_token_counts,
    "op5_ngram_jaccard": op5_ngram_jaccard,
    "op6_toxicity": op6_toxicity,
    "op7_decontamination": op7_decontamination,
    "op8_warc": op8_warc,
    "op9_quality_rules": op9_quality_rules,
    "op10_best_fit_packing": op10_best_fit_packing,
    "op11_phrase_mining": op11_phrase_mining,
    "op12_conversation_trie": op12_conversation_trie,
    "op13_minhash_dedup": op13_minhash_dedup,
}

ORACLE_SQL: dict[str, str] = {
    "op1_line_dedup": OP1_SQL,
    "op3_url_filters": OP3_SQL,
    "op5_ngram_jaccard": OP5_SQL,
    "op7_decontamination": OP7_SQL,
    "op8_warc": OP8_SQL,
    "op9_quality_rules": OP9_SQL,
    "op11_phrase_mining": OP11_SQL,
    "op12_conversation_trie": OP12_SQL,
    "op13_minhash_dedup": OP13_SQL,
}

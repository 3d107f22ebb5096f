"""Registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tarmac.llm.byte_bpe import op12_byte_bpe
from tarmac.llm.decontaminate import op10_decontamination
from tarmac.llm.filter_audit import SQL as OP13_SQL
from tarmac.llm.filter_audit import op13_filter_audit
from tarmac.llm.html_text import op6_html_extraction
from tarmac.llm.language_model import op2_language_model
from tarmac.llm.lexical_search import SQL as OP11_SQL
from tarmac.llm.lexical_search import op11_lexical_search
from tarmac.llm.line_dedup import SQL as OP9_SQL
from tarmac.llm.line_dedup import op9_line_dedup
from tarmac.llm.mixing import SQL as OP8_SQL
from tarmac.llm.mixing import op8_mixing
from tarmac.llm.near_duplicates import op4_near_duplicates
from tarmac.llm.pseudonyms import op7_pseudonyms
from tarmac.llm.quality_classifier import op5_quality_classifier
from tarmac.llm.quality_rules import SQL as OP1_SQL
from tarmac.llm.quality_rules import op1_quality_rules
from tarmac.llm.token_output import op3_token_output

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_rules": op1_quality_rules,
    "op2_language_model": op2_language_model,
    "op3_token_output": op3_token_output,
    "op4_near_duplicates": op4_near_duplicates,
    "op5_quality_classifier": op5_quality_classifier,
    "op6_html_extraction": op6_html_extraction,
    "op7_pseudonyms": op7_pseudonyms,
    "op8_mixing": op8_mixing,
    "op9_line_dedup": op9_line_dedup,
    "op10_decontamination": op10_decontamination,
    "op11_lexical_search": op11_lexical_search,
    "op12_byte_bpe": op12_byte_bpe,
    "op13_filter_audit": op13_filter_audit,
}

#: DuckDB SQL of the queries that SQL can express.
ORACLE_SQL: dict[str, str] = {
    "op1_quality_rules": OP1_SQL,
    "op8_mixing": OP8_SQL,
    "op9_line_dedup": OP9_SQL,
    "op11_lexical_search": OP11_SQL,
    "op13_filter_audit": OP13_SQL,
}

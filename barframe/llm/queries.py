"""Registered queries of the corpus operators, with their SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from barframe.llm.decontaminate import OP7_SQL, op7_decontaminate
from barframe.llm.html_extract import op6_html_extract
from barframe.llm.language_id import op9_language_id
from barframe.llm.license_scan import OP1_SQL, op1_license_scan
from barframe.llm.minhash_dedup import op3_minhash_dedup
from barframe.llm.paragraph_dedup import op4_paragraph_dedup
from barframe.llm.secret_scan import op2_secret_scan
from barframe.llm.simhash_dedup import op11_simhash_dedup
from barframe.llm.source_divergence import OP13_SQL, op13_source_divergence
from barframe.llm.source_mix import OP5_SQL, op5_source_mix
from barframe.llm.suffix_dedup import op10_suffix_dedup
from barframe.llm.topk_search import OP8_SQL, op8_topk_search
from barframe.llm.vector_codes import OP12_SQL, op12_vector_codes

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_license_scan": op1_license_scan,
    "op2_secret_scan": op2_secret_scan,
    "op3_minhash_dedup": op3_minhash_dedup,
    "op4_paragraph_dedup": op4_paragraph_dedup,
    "op5_source_mix": op5_source_mix,
    "op6_html_extract": op6_html_extract,
    "op7_decontaminate": op7_decontaminate,
    "op8_topk_search": op8_topk_search,
    "op9_language_id": op9_language_id,
    "op10_suffix_dedup": op10_suffix_dedup,
    "op11_simhash_dedup": op11_simhash_dedup,
    "op12_vector_codes": op12_vector_codes,
    "op13_source_divergence": op13_source_divergence,
}

SQL: dict[str, str] = {
    "op1_license_scan": OP1_SQL,
    "op5_source_mix": OP5_SQL,
    "op7_decontaminate": OP7_SQL,
    "op8_topk_search": OP8_SQL,
    "op12_vector_codes": OP12_SQL,
    "op13_source_divergence": OP13_SQL,
}

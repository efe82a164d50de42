"""Registered queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from clickloom.llm.chat import op5_chat_format
from clickloom.llm.licenses import op7_licenses
from clickloom.llm.mixing import op10_mixing
from clickloom.llm.near import op8_near_dedup
from clickloom.llm.neighbours import op9_neighbours
from clickloom.llm.packing import op2_packing
from clickloom.llm.phrases import op12_collocations
from clickloom.llm.quality import op4_quality
from clickloom.llm.sharding import op1_sharding
from clickloom.llm.spelling import op11_spelling_groups
from clickloom.llm.sql import OP11, OP12, OP13
from clickloom.llm.suffixes import op6_suffix_dedup
from clickloom.llm.toxicity import op3_toxicity
from clickloom.llm.windows import op13_substring_dedup


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_sharding, op2_packing, op3_toxicity, op4_quality, op5_chat_format, op6_suffix_dedup, op7_licenses, op8_near_dedup,
        op9_neighbours, op10_mixing, op11_spelling_groups, op12_collocations, op13_substring_dedup)}


def oracle_sql() -> dict[str, str]:
    return {"op11_spelling_groups": OP11, "op12_collocations": OP12, "op13_substring_dedup": OP13}

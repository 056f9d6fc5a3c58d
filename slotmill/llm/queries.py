"""The operators of this folder as queries over the shared tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from slotmill.llm.collocations import ORACLE as COLLOCATIONS_SQL
from slotmill.llm.collocations import op11_collocations
from slotmill.llm.decontaminate import op5_benchmark_decontamination
from slotmill.llm.hard_negatives import ORACLE as HARD_NEGATIVES_SQL
from slotmill.llm.hard_negatives import op13_hard_negatives
from slotmill.llm.language import op1_language_id
from slotmill.llm.licences import op8_licence_scan
from slotmill.llm.mixing import op12_mixing
from slotmill.llm.packing import op2_best_fit_packing
from slotmill.llm.quality_pu import op4_quality_classifier
from slotmill.llm.quality_rules import op10_quality_rules
from slotmill.llm.sharding import op6_sharding
from slotmill.llm.simhash import op3_simhash_near_dedup
from slotmill.llm.toxicity import op7_toxicity
from slotmill.llm.wrappers import op9_html_extraction

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language_id": op1_language_id,
    "op2_best_fit_packing": op2_best_fit_packing,
    "op3_simhash_near_dedup": op3_simhash_near_dedup,
    "op4_quality_classifier": op4_quality_classifier,
    "op5_benchmark_decontamination": op5_benchmark_decontamination,
    "op6_sharding": op6_sharding,
    "op7_toxicity": op7_toxicity,
    "op8_licence_scan": op8_licence_scan,
    "op9_html_extraction": op9_html_extraction,
    "op10_quality_rules": op10_quality_rules,
    "op11_collocations": op11_collocations,
    "op12_mixing": op12_mixing,
    "op13_hard_negatives": op13_hard_negatives,
}

#: the others cannot be written in SQL; the tests compare with brute force, round trips or held-out rows
ORACLE_SQL: dict[str, str] = {
    "op11_collocations": COLLOCATIONS_SQL,
    "op13_hard_negatives": HARD_NEGATIVES_SQL,
}

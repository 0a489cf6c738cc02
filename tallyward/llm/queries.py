"""The operators over their whole tables, and what DuckDB can say of them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from tallyward.llm.attention import op10_lm_scoring
from tallyward.llm.decontaminate import op8_decontamination
from tallyward.llm.html import op1_html_extraction
from tallyward.llm.language import op4_language_id
from tallyward.llm.linededup import op9_line_dedup
from tallyward.llm.manifest import op13_merkle_manifest
from tallyward.llm.maxsketch import op12_sketch_search
from tallyward.llm.mixing import op11_source_mixing
from tallyward.llm.oracles import MERKLE_MANIFEST, SKETCH_SEARCH
from tallyward.llm.packing import op2_packing
from tallyward.llm.pii import op6_pii_surrogates
from tallyward.llm.search import op5_topk_search
from tallyward.llm.setsketch import op7_near_dedup
from tallyward.llm.sharding import op3_sharding

LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_html_extraction": op1_html_extraction,
    "op2_packing": op2_packing,
    "op3_sharding": op3_sharding,
    "op4_language_id": op4_language_id,
    "op5_topk_search": op5_topk_search,
    "op6_pii_surrogates": op6_pii_surrogates,
    "op7_near_dedup": op7_near_dedup,
    "op8_decontamination": op8_decontamination,
    "op9_line_dedup": op9_line_dedup,
    "op10_lm_scoring": op10_lm_scoring,
    "op11_source_mixing": op11_source_mixing,
    "op12_sketch_search": op12_sketch_search,
    "op13_merkle_manifest": op13_merkle_manifest,
    "pipeline": corpus_pipeline.run,
}

LLM_ORACLES: dict[str, str] = {
    "op12_sketch_search": SKETCH_SEARCH,
    "op13_merkle_manifest": MERKLE_MANIFEST,
}

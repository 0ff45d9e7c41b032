"""The registered queries of this package and their SQL."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from tallyrill.llm import (
    alignment,
    decontaminate,
    grades,
    gram_join,
    html_text,
    impact_search,
    repair,
    repeats,
    secret_scan,
    toxicity,
    warc,
)
from tallyrill.llm.packing import op9_bounded_space_packing
from tallyrill.llm.store import ship
from tallyrill.llm.token_files import op3_bit_packed_ids
from tallyrill.session import sweeping


def shipped(query: Callable) -> Callable:
    """The query, with this library at hand in every task; tables of its last call are removed."""

    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return query(spark, sf_dir)

    return sweeping(run)


_QUERIES = {
    "pipeline": corpus_pipeline.run,
    "op10_gram_jaccard_join": gram_join.op10_gram_jaccard_join,
    "op11_external_alignment": alignment.op11_external_alignment,
    "op12_column_wise_repeats": repeats.op12_column_wise_repeats,
    "op13_conversation_repair": repair.op13_conversation_repair,
    "op1_line_blocks": html_text.op1_line_blocks,
    "op2_wu_manber_windows": decontaminate.op2_wu_manber_windows,
    "op3_bit_packed_ids": op3_bit_packed_ids,
    "op4_indexed_archives": warc.op4_indexed_archives,
    "op5_kneser_ney_toxicity": toxicity.op5_kneser_ney_toxicity,
    "op6_entropy_secrets": secret_scan.op6_entropy_secrets,
    "op7_impact_ordered": impact_search.op7_impact_ordered,
    "op8_cumulative_link": grades.op8_cumulative_link,
    "op9_bounded_space_packing": op9_bounded_space_packing,
}

QUERIES = {name: shipped(query) for name, query in _QUERIES.items()}

ORACLES: dict[str, str] = {
    "op10_gram_jaccard_join": gram_join.ORACLE,
    "op12_column_wise_repeats": repeats.ORACLE,
    "op13_conversation_repair": repair.ORACLE,
    "op2_wu_manber_windows": decontaminate.ORACLE,
    "op4_indexed_archives": warc.ORACLE,
    "op7_impact_ordered": impact_search.ORACLE,
}

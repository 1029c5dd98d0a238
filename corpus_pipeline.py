"""A training corpus from documents: five stages, each written as Parquet and read again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from linkwright.llm import decontaminate, mixing, near_dedup, token_output, toxicity
from linkwright.llm.common import stage, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity.keep_clean),
    ("near_dedup", near_dedup.keep_one),
    ("decontamination", decontaminate.keep_clean),
    ("mixing", mixing.keep_mixed),
    ("token_output", token_output.encoded_documents),
]

#: The first two stages learn a model and follow links; SQL can't express them.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage, from the documents of sf_dir.

    Each stage states what it does with nulls, empty texts and repeated rows; an empty table
    of documents, of labels or of benchmark items goes through all of them.
    """
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

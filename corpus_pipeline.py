"""From raw documents to token files: the operators of ``viewtide.llm`` one after another.

Each stage takes what its predecessor kept, written as Parquet and read again, and all but
the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from viewtide.llm import decontamination, language, mixing, near_duplicates, wavelet
from viewtide.llm.tables import table, written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("language_id", language.stage),
    ("near_duplicates", near_duplicates.stage),
    ("decontamination", decontamination.stage),
    ("mixing", mixing.stage),
    ("token_files", wavelet.stage),
]

# The first stage learns classifiers, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document in the token files."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs

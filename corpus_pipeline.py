"""From raw documents to token files, in five stages.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is
written as Parquet and read again as the next stage's ``docs``.  All but the
last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from atelier.llm.common import shared_dir, table, written
from atelier.llm.decontaminate import decontaminate
from atelier.llm.mixing import mixed_documents
from atelier.llm.near_dedup import deduplicated
from atelier.llm.quality_rules import quality_rules
from atelier.llm.token_files import read_token_files, write_token_files

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    verdict = "_rules"
    return quality_rules(docs, out=verdict).filter(f"{verdict}.kept").select(*docs.columns)


def _near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five-word shingles, 0.8) stays."""
    return deduplicated(docs)


def _decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go."""
    hits = "_hits"
    return decontaminate(docs, table(spark, sf_dir, "benchmark"), out=hits).filter(f"size({hits}) = 0").select(*docs.columns)


def _mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per document and pass of the mix over its source; a source above
    its target loses words, one below it repeats."""
    return mixed_documents(docs)


def _tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the mix, and their documents as read back."""
    import public_tokenizers

    return read_token_files(write_token_files(docs, shared_dir(spark, "tokens"), public_tokenizers.path("word_bpe_49k.json")))


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", _quality),
    ("near_dedup", _near_dedup),
    ("decontaminate", _decontaminate),
    ("mix_sources", _mix),
    ("token_files", _tokens),
]

#: The mix draws multinomial counts and the token files need a tokenizer:
#: SQL can't express these, so tests hold run() against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

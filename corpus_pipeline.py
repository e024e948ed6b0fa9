"""A training corpus from raw documents, in five stages.

1. toxicity: documents that the ordinal model rejects go.
2. lines: lines on more than a tenth of a source's documents go, except from documents of nothing else; no document goes.
3. near duplicates: of documents whose SimHash fingerprints are linked, the one of the smallest doc_id stays.
4. decontamination: documents with a twentieth of their words in benchmark windows go.
5. mixing: sources get near their target weights; `copies` says how often a document is taken, and documents that aren't taken go.

Each stage works on all that the one before it kept, which is written as Parquet and read again. Nulls, empty tables, ties and
repeated rows are treated as the operators' docstrings say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cytospark.llm import decontaminate, lines, mixing, simhash, toxicity
from cytospark.llm.common import materialize, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.remove_toxic(docs, table(spark, sf_dir, "labels"))


def drop_boilerplate_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return lines.drop_lines(docs, keep_whole=True)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.copies(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_boilerplate_lines),
    ("simhash_near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("source_mix", mix_sources),
]

#: Neither the model of the first stage nor the fingerprints of the third are for SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows that all stages keep, with `copies`."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

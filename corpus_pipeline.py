"""Corpus pipeline: quality rules, line dedup, near-duplicate removal, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes it as
Parquet into the shared folder and rereads it as the next stage's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from scriptorium.llm import linededup, ngramjoin, packing, quality
from scriptorium.llm.common import Scratch, table
from scriptorium.llm.registry import tokenizer_path


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality.quality_filter(docs)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found in ten documents or more go; every document stays."""
    return linededup.dedup_lines(docs, min_docs=10)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies stays."""
    return ngramjoin.keep_one(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents, packed into sequences of 2048 tokens."""
    return packing.pack(docs, tokenizer_path("byte_bpe_50k.json"))


STAGES = [
    ("quality rules", keep_quality),
    ("line dedup", drop_lines),
    ("n-gram Jaccard join", drop_near_copies),
    ("best-fit packing", pack_sequences),
]

#: Packing by an online best fit can't be expressed in SQL; tests/llm/test_pipeline.py holds
#: the rows of ``run`` against a brute-force version of all four stages instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages, each on all that the one before kept.  What a stage wrote on its way goes
    as soon as its result is written, a result as soon as the next one is."""
    docs, scratch = table(spark, sf_dir, "documents"), Scratch(spark, "pipeline")
    for k, (name, stage) in enumerate(STAGES):
        with Scratch.dropped():
            done = scratch.write(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        if k:
            scratch.drop_df(docs)
        docs = done
    return docs

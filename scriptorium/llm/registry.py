"""The operators' queries over the standard tables, and the SQL for their results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import bpe, embed, htmltext, linededup, ngramjoin, packing, quality, sharding, sqltext, toolchat, urlfilter
from .common import table


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngramjoin.ngram_components(table(spark, sf_dir, "documents"))


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return bpe.round_trip(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.line_digests(table(spark, sf_dir, "documents"), min_docs=10)


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.judge_urls(table(spark, sf_dir, "pages").select("page_id", "url")).select("page_id", "host", "path", "rule", "verdict")


def op5_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


def op6_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed.near_vectors(table(spark, sf_dir, "embeddings"))


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmltext.page_texts(table(spark, sf_dir, "pages"))


def op8_tool_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toolchat.tool_chat(toolchat.turns_as_tools(table(spark, sf_dir, "conversations")))


def op9_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_digests(table(spark, sf_dir, "documents"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    judged = quality.assess(docs, keep=["doc_id", "lang"])
    numbers = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return judged.select("doc_id", *[f"measures.{n}" for n in numbers], "quality.base_failed", "quality.kept")


QUERIES = {
    "op1_ngram_join": op1_ngram_join,
    "op2_bpe": op2_bpe,
    "op3_line_dedup": op3_line_dedup,
    "op4_url_filter": op4_url_filter,
    "op5_pack": op5_pack,
    "op6_embedding_dedup": op6_embedding_dedup,
    "op7_html_text": op7_html_text,
    "op8_tool_chat": op8_tool_chat,
    "op9_shard": op9_shard,
    "op10_quality": op10_quality,
    "pipeline": pipeline,
}

ORACLE_SQL: dict[str, str] = {
    "op1_ngram_join": sqltext.NGRAM_JOIN,
    "op3_line_dedup": sqltext.LINE_DEDUP,
    "op4_url_filter": sqltext.url_filter(),
    "op6_embedding_dedup": sqltext.EMBEDDING_DEDUP,
    "op8_tool_chat": toolchat.SQL,
    "op10_quality": sqltext.quality_rules(),
}

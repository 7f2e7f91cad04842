"""The operators applied to the whole tables, as registered queries, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tracelake.llm import bpe, ctw, mixing, mpeg_audio, ngram_quality, piece_bpe, secrets, simhash, source_tries, unigram_count, warc, whitening, wrappers
from tracelake.llm.common import table


def op1_ctw_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ctw.score(table(spark, sf_dir, "documents"), held_out=ctw.held_out_rows())


def op2_media_audio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mpeg_audio.features(table(spark, sf_dir, "documents"))


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unigram_count.count_tokens(table(spark, sf_dir, "documents"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive(table(spark, sf_dir, "pages")).select("page_id", *warc.DIGEST)


def op6_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrappers.main_text(table(spark, sf_dir, "pages"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_quality.report(table(spark, sf_dir, "documents"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.report(table(spark, sf_dir, "documents"))


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.report(table(spark, sf_dir, "documents"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op12_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_bpe.round_trip(table(spark, sf_dir, "documents"))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_tries.audit(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = [op1_ctw_scores, op2_media_audio, op3_bpe, op4_token_counts, op5_warc, op6_html_text, op7_quality, op8_simhash, op9_mixing, op10_secrets, op11_whitening, op12_sentencepiece, op13_source_divergence]
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return {"op5_warc": warc.oracle(), "op9_mixing": mixing.oracle(), "op10_secrets": secrets.oracle(), "op13_source_divergence": source_tries.oracle()}

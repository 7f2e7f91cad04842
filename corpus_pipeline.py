"""Corpus preparation in stages; each takes documents and gives documents.

Quality rules drop what they reject, near-duplicates leave one document of each group,
secrets in texts give way to a marker, sources are mixed to their target weights
(documents come as often as their leaf's epochs say), and texts become token ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracelake.llm import bpe, common, mixing, ngram_quality, secrets, simhash


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or lie outside their language's bands go.

    Null and empty texts fail; a null language is a language of its own; repeated rows
    share a verdict; ids don't matter; an empty table stays empty; further columns stay.
    """
    return ngram_quality.filtered(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates stays, that with the least id.

    Null and empty texts are one group; rows without an id stay only where no row of
    their group has one; rows that share an id but not a text are documents of their
    own; of repeated rows one stays; an empty table stays empty; further columns stay.
    """
    return simhash.representatives(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays; a text with secrets has a marker in each one's place, and its n_chars follow.

    Null texts stay null and empty ones empty; repeated rows change alike; an empty
    table stays empty; further columns stay, whatever their names.
    """
    packed = docs.select(F.struct("*").alias("row"), F.col("text").cast("string").alias("text"))
    clean = secrets.redact(packed)
    changed = ~F.col("text").eqNullSafe(F.col("row.text").cast("string"))
    row = F.col("row").withField("text", F.when(changed, F.col("text")).otherwise(F.col("row.text")))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        row = row.withField("n_chars", F.when(changed, F.length("text").cast(kind)).otherwise(F.col("row.n_chars")))
    return clean.select(row.alias("row")).select("row.*")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents come as often as their leaf's budget says, up to three times.

    Null domains, languages and sources are leaves of their own; documents without words
    come with whole epochs; repeated rows count each time; rows without an id come in one
    block; an empty table stays empty; further columns stay.
    """
    return mixing.mixed(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row of token ids for each document, with its id, language and source.

    Null and empty texts have no tokens; repeated rows give equal rows; a null id stays
    null; an empty table gives an empty result; further columns are left out.
    """
    return bpe.round_trip(docs, keep=("lang", "source"), with_ids=True)


STAGES = [
    ("quality rules", quality),
    ("SimHash near-dedup", near_duplicates),
    ("secret scans", secret_scan),
    ("mixing to target weights", mix),
    ("byte-level BPE", encode),
]
#: The perplexity of the first stage and the ids of the last can't be had in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over the documents; what a stage was made from goes when it is written."""
    docs, before = common.table(spark, sf_dir, "documents"), None
    for _, stage in STAGES:
        with common.scope(spark) as tables:
            docs = common.stored(stage(spark, docs, sf_dir), "stage")
            written = tables.pop()
        if before is not None:
            common.remove(spark, before)
        before = written
    return docs

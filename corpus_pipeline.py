"""From raw documents to token ids: language, exact and near duplicates, benchmark passages, tokens."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from massloom.llm import bpe, decontaminate, language
from massloom.llm.common import in_held_out, only, table, written
from massloom.llm.exact_dedup import exact_dedup
from massloom.llm.near_dedup import jaccard_groups
from massloom.llm.queries import tokenizer_path


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents that a learned language explains better than uniform n-grams do.

    Null texts and texts without a letter are rejected. Rows that repeat doc_id and text are kept once; a null doc_id is
    no reason to reject. Where no document has a language, and for an empty table, no rows are left.
    """
    languages, probabilities = language.train(docs.filter(~in_held_out()))
    found = language.identify(docs, languages, probabilities)
    return only(docs, found.filter((F.col("lang_pred") != language.UNDETERMINED) & (F.col("gain") > 0)))


def drop_exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the largest doc_id of each group of texts that are equal with A-Z in lower case.

    Null and empty texts are one group, and a group of null doc_ids alone keeps its rows once for each text. Other columns
    stay as they are, whatever their names. An empty table gives no rows.
    """
    return only(docs, exact_dedup(docs).filter("kept"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of texts that share four fifths of their five-word shingles: the smallest doc_id,
    and of several texts under it one.

    Texts without words are one group; a group of null doc_ids alone keeps one text. An empty table gives no rows.
    """
    return only(docs, jaccard_groups(docs).filter("kept"))


def drop_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents with a benchmark passage.

    A row is known by doc_id, null too, and text, so another text under the same id stays. Null and empty texts hold no
    passage; repeated rows go or stay together. An empty table or benchmark drops nothing.
    """
    found = decontaminate.contaminated(docs, table(spark, sf_dir, "benchmark")).select(F.col("doc_id").alias("found_id"), F.col("text_key").alias("found_key")).distinct()
    rows = docs.select(F.col("doc_id").cast("long").alias("id"), F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("key"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    return rows.join(found, rows["id"].eqNullSafe(found["found_id"]) & (rows["key"] == found["found_key"]), "left_anti").select("row.*")


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids of each document, and whether they decode to its text.

    Null and empty texts have no tokens. One row per row, repeated ones and null ids too; an empty table gives none.
    """
    coded = bpe.encode_decode(docs, tokenizer_path())
    return coded.select("doc_id", "n_tokens", "ids", (F.xxhash64("decoded") == F.col("text_key")).alias("round_trip"))


STAGES = [
    ("language", identify_language),
    ("exact_dedup", drop_exact_duplicates),
    ("near_dedup", drop_near_duplicates),
    ("decontaminate", drop_benchmark_passages),
    ("tokenize", tokenize),
]

#: Language inference, near-duplicate components and byte-pair merges are no SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's result is a Parquet table in the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)

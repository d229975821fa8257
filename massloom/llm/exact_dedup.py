"""Exact duplicates by content-defined chunk recipes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from massloom.llm.common import lower_ascii, slim, written

#: A chunk ends behind "vowel, white space" before a letter of b-t once it has MIN_CHUNK characters, else at MAX_CHUNK.
MIN_CHUNK, MAX_CHUNK = 512, 2048


def chunk_pattern(least: int = MIN_CHUNK, most: int = MAX_CHUNK) -> str:
    return rf"(?s).{{{least},{most}}}?(?<=[aeiou]\s)(?=[b-t])|.{{1,{most}}}"


def _chunks(text: Column, least: int, most: int) -> Column:
    return F.regexp_extract_all(text, F.lit(chunk_pattern(least, most)), F.lit(0))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, min_chunk: int = MIN_CHUNK, max_chunk: int = MAX_CHUNK, hash_bits: int = 64) -> DataFrame:
    """Which documents have equal texts, A-Z in lower case, and which one of each group stays.

    Every text is cut into content-defined chunks. Chunks are deduplicated by their content, which gives
    each distinct chunk a verified identifier: its 64-bit hash, or hash and rank where two contents share
    a hash. Documents are then compared by their ordered identifier lists, about one hundredth of the
    text; a long text is moved once at most, as distinct chunks.

    Result: doc_id, text_key (hash of the text as given, null when rows of one id differ in case only),
    keep_id (largest doc_id of the group), group_size (rows), kept, text_sha256. Null and empty texts
    are one group. Rows that repeat a doc_id with an equal text give one result row and count in
    group_size. A null doc_id stays only where its whole group has none. An empty table gives no rows.
    """
    base = slim(docs, id_col, text_col).withColumn("norm", lower_ascii(F.col("text")))
    chunk_hash = lambda c: F.xxhash64(c) if hash_bits == 64 else F.xxhash64(c) % (1 << hash_bits)
    pieces = _chunks(F.col("norm"), min_chunk, max_chunk)
    contents = base.select(F.explode(pieces).alias("chunk")).select(chunk_hash(F.col("chunk")).alias("h"), "chunk").groupBy("h", "chunk").agg(F.count("*").alias("uses"))
    shared = written(contents.groupBy("h").agg(F.count("*").alias("contents")).filter("contents > 1"))
    rows = base.select("doc_id", F.xxhash64("text").alias("text_key"), F.sha2("norm", 256).alias("text_sha256"), F.transform(pieces, chunk_hash).alias("recipe"))
    lists = ["doc_id", "text_sha256", "recipe"]
    if shared.isEmpty():
        rows = rows.withColumn("ranks", F.array().cast("array<struct<pos:int,rank:int>>"))
    else:
        ranked = contents.join(shared, "h", "left_semi").withColumn("rank", F.row_number().over(Window.partitionBy("h").orderBy("chunk"))).select("h", "chunk", "rank")
        placed = base.select("doc_id", F.sha2("norm", 256).alias("text_sha256"), F.posexplode(pieces).alias("pos", "chunk")).withColumn("h", chunk_hash(F.col("chunk")))
        placed = placed.join(ranked, ["h", "chunk"]).select("doc_id", "text_sha256", "pos", "rank").distinct()
        ranks = placed.groupBy("doc_id", "text_sha256").agg(F.array_sort(F.collect_list(F.struct("pos", "rank"))).alias("ranks"))
        rows, other = rows.alias("r"), ranks.alias("o")
        rows = rows.join(other, F.col("r.doc_id").eqNullSafe(F.col("o.doc_id")) & (F.col("r.text_sha256") == F.col("o.text_sha256")), "left").select(
            "r.doc_id", "r.text_key", "r.text_sha256", "r.recipe", F.coalesce("o.ranks", F.array().cast("array<struct<pos:int,rank:int>>")).alias("ranks"))
    lists.append("ranks")
    one = rows.groupBy(*lists).agg(F.count("*").alias("copies"), F.min("text_key").alias("text_key"))
    groups = one.groupBy("recipe", "ranks").agg(F.max("doc_id").alias("keep_id"), F.sum("copies").alias("group_size"))
    return one.join(groups, ["recipe", "ranks"]).select("doc_id", "text_key", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")

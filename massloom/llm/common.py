"""Shared pieces: written tables, text normalisation, row keys."""

from __future__ import annotations

import gc
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from massloom.session import shared_folder

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Rows of an Arrow batch handled at once inside a task.
SLICE = 512


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame) -> DataFrame:
    """``df`` as a Parquet table in the shared folder, removed when the driver's JVM ends or by ``dropped``."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/massloom-{uuid.uuid4().hex}"
    df.write.parquet(path)
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(jvm_path)
    out = spark.read.schema(df.schema).parquet(path)
    out._written_path = path
    return out


def dropped(*tables: DataFrame) -> None:
    """Removes ``written`` tables that nothing reads any more."""
    for df in tables:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df._written_path)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def release(spark: SparkSession) -> None:
    """Lets Spark's cleaner drop the shuffle files of steps whose results are written; it acts on collected garbage only."""
    gc.collect()
    spark._jvm.System.gc()


def text_of(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, every other character as it is."""
    ascii_only = F.octet_length(text) == F.char_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def slim(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, text only; extra columns, whatever their names, go no further."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text, text_key: a row is known by its doc_id and its text, so one id may carry two texts."""
    return slim(docs, id_col, text_col).withColumn("text_key", F.xxhash64("text"))


def only(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """One row of ``docs``, all columns, for each (doc_id, text_key) in ``kept``; columns of any name are left as they are."""
    rows = docs.select(F.col("doc_id").cast("long").alias("id"), F.xxhash64(text_of("text")).alias("key"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    wanted = kept.select(F.col("doc_id").alias("kept_id"), F.col("text_key").alias("kept_key"))
    rows = rows.join(wanted, rows["id"].eqNullSafe(wanted["kept_id"]) & (rows["key"] == wanted["kept_key"]), "left_semi")
    return rows.dropDuplicates(["id", "key"]).select("row.*")


def in_held_out(doc_id: str = "doc_id") -> Column:
    """The held-out quarter: crc32 of the id as text leaves remainder 2."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


def slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut so that a task holds the intermediate arrays of few rows at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)

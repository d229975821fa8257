"""Session defaults and lineage cutting."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def build_session(app: str = "massloom", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings the operators are planned for; ``conf`` overrides them.

    Adaptive execution splits skewed join partitions and coalesces small ones, so the shuffle
    partition count only has to be an upper bound.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.execution.arrow.maxRecordsPerBatch": "4096",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    settings.update({k.replace("__", "."): str(v) for k, v in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``, which driver and executors share.

    Only where a session has none and everything runs in one machine's process (``local`` masters, as
    in tests) is a temporary folder made and set.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if folder is None and context._jsc.sc().getCheckpointDir().isDefined():
        folder = context._jsc.sc().getCheckpointDir().get()
    if folder is None:
        if context.master != "local" and not context.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can read")
        folder = tempfile.mkdtemp(prefix="massloom-ckpt-")
        context.setCheckpointDir(folder)
    return folder


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint of ``df`` in the shared folder, under fresh column identities, so that it may be joined with
    what it came from."""
    spark = df.sparkSession
    folder = shared_folder(spark)
    if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(folder)
    return df.select(*[F.col(f"`{c}`").alias(c) for c in df.columns]).checkpoint(eager=True)


#: Drops the shuffle files of a job when it ends; else they stay until the driver's JVM collects garbage, which may be after the last job.
SHUFFLES_END = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_end(spark: SparkSession) -> Iterator[None]:
    """Within it, a job's shuffle files go with the job; the session's own setting is put back afterwards."""
    before = spark.conf.get(SHUFFLES_END, "false")
    spark.conf.set(SHUFFLES_END, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLES_END, before)


def next_round(df: DataFrame, *older: DataFrame) -> DataFrame:
    """``df`` as a Parquet table in the shared folder, for loops whose rounds join what earlier rounds left, and for results that
    are read more than once.

    A checkpoint keeps the planner's size estimate and joins multiply estimates, so in a loop the digits of that number
    grow exponentially and planning stalls; a table has the size of its files.  ``older`` are tables of earlier
    rounds that nothing reads any more: they are removed once ``df`` is written.  The rest goes when the driver's JVM ends.
    The shuffles that made ``df`` leave the disk as soon as it is written.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/massloom-round-{uuid.uuid4().hex}"
    with shuffles_end(spark):
        df.write.parquet(path)
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    files.deleteOnExit(folder)
    for table in older:
        files.delete(spark._jvm.org.apache.hadoop.fs.Path(table._round_path), True)
    out = spark.read.schema(df.schema).parquet(path)
    out._round_path = path
    return out

"""Shared helpers: words, checkpoints, model files."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Characters between words: space and U+0009 to U+000D; every other code point is part of a word.
SPACES = " \t\n\u000b\f\r"
#: Spark drops the shuffle files of a query when the query has ended.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
SPACE_CLASS = r"[\x20\x09-\x0D]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column) -> Column:
    """The words of a text in order; an empty array for a null or blank text."""
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(
        F.split(bare, f"{SPACE_CLASS}+"))


def word_count(text: Column) -> Column:
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(bare == "", 0).otherwise(F.size(F.split(bare, f"{SPACE_CLASS}+"))).cast("long")


def held_out(doc_id: Column) -> Column:
    """The fifth of the documents that no model learns from; a null id counts as held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir.

    Only a local-mode session may do without the setting; it gets a temporary
    folder, since executors of a cluster could not read one.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        shared = spark.conf.get("spark.checkpoint.dir", None)
        if not shared:
            if not context.master.startswith("local") or context.master.startswith("local-cluster"):
                raise ValueError("set spark.checkpoint.dir to a folder all executors share")
            shared = tempfile.mkdtemp(prefix="gleanery-")
        context.setCheckpointDir(shared)
    return context.getCheckpointDir()


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage in the shared folder; Spark can remove the files with the last reference."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def written(df: DataFrame, **options: str) -> DataFrame:
    """df as a table in the shared folder, written with `options`: columnar, for what is large or read in parts.

    The table stays until the folder of the application is removed; what was shuffled
    to make it goes as soon as it is written.
    """
    path = f"{shared_folder(df.sparkSession)}/table-{uuid.uuid4().hex}"
    conf, was = df.sparkSession.conf, df.sparkSession.conf.get(_CLEANUP)
    conf.set(_CLEANUP, "true")
    try:
        df.write.options(**options).parquet(path)
    finally:
        conf.set(_CLEANUP, was)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def model_bytes(path: str, limit: int = 64 << 20) -> bytes:
    """A vocabulary file of the driver, to be broadcast; its size is checked."""
    with open(path, "rb") as f:
        data = f.read(limit + 1)
    if len(data) > limit:
        raise ValueError(f"{path} exceeds {limit} bytes")
    return data

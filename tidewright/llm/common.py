"""What several operators share: tables, words, and results kept in the shared folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewright.session import scratch_path

#: The white space that separates words: space and U+0009 to U+000D.
SPACE = " \t\n\x0b\f\r"
SPACE_CLASS = r"[\x20\x09-\x0D]"
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, read whole."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(name: str = "text") -> Column:
    """The text; null counts as empty."""
    return F.coalesce(F.col(name), F.lit(""))


def words(text: Column) -> Column:
    """The words of a text as an array, in order and unchanged."""
    bare = F.trim(text, F.lit(SPACE))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, f"{SPACE_CLASS}+"))


def sha256_hex(text: Column) -> Column:
    """Lowercase hex digest of the UTF-8 bytes."""
    return F.sha2(F.encode(text, "UTF-8"), 256)


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write `df` to the shared folder, give back its shuffle files, and read it again.

    The written copy survives lost executors and cuts the lineage, so the shuffles behind it are
    no longer needed. Removing them at once keeps the peak of disk use at one step of a job.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)

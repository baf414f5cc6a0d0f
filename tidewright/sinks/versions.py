"""Tables of which every write is all or nothing.

A table is a folder with `data`, whose subfolders never change once they are written, and `commits`. A
commit is one row in one small file: a version number and the data folders that make up the table from
then on. A write first stores its data, which nobody sees, and then its commit; a killed write leaves the
table as it was. Readers take the folders of the latest commit and keep them while others write.

Of two writers that commit the same version the one with the smaller name wins; the other sees that and
puts its change on top of the winner's, or raises if it was made from what the winner replaced.
Folders that no commit names any more may be expired by age.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

COMMIT = "version long, writer string, schema string, folders array<struct<part: string, folder: string>>"
#: Data folders are named like partitions, so that several of them are one table to Spark.
FOLDER = "_folder"
Folders = list[tuple[str | None, str]]


class ConflictError(RuntimeError):
    """Another write changed what this one was made from."""


def folder_exists(spark: SparkSession, path: str) -> bool:
    """Whether a folder is there."""
    try:
        # a read checks its path while it is planned; no file is opened
        spark.read.schema("_ int").parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return True


def begun(spark: SparkSession, target: str) -> bool:
    """Whether writes with commits were begun here, with or without success."""
    return folder_exists(spark, _commits(target)) or folder_exists(spark, f"{target.rstrip('/')}/data")


def _commits(target: str) -> str:
    return f"{target.rstrip('/')}/commits"


def latest(spark: SparkSession, target: str) -> Row | None:
    """The commit that holds now; None where there is none."""
    if not folder_exists(spark, _commits(target)):
        return None
    commits = spark.read.schema(COMMIT).parquet(_commits(target))
    # the names alone are read of all commits, the folders of one
    last = commits.agg(F.max("version")).first()[0]
    if last is None:
        return None
    return commits.where(F.col("version") == last).orderBy("writer").first()


def version(spark: SparkSession, target: str) -> int:
    """The number of the latest commit; 0 where there is none."""
    found = latest(spark, target)
    return found["version"] if found else 0


def read(
    spark: SparkSession,
    target: str,
    schema: T.StructType | None = None,
    part: Callable[[str | None], bool] | None = None,
    at: Row | None = None,
) -> DataFrame:
    """The table as of its latest commit, or of the commit `at`; with `part`, the folders of some parts only."""
    found = at or latest(spark, target)
    if found is None:
        raise FileNotFoundError(f"no commit below {target}")
    schema = schema or T.StructType.fromJson(json.loads(found["schema"]))
    folders = [f["folder"] for f in found["folders"] if part is None or part(f["part"])]
    if not folders:
        return spark.createDataFrame([], schema)
    base = f"{target.rstrip('/')}/data"
    return spark.read.schema(schema).option("basePath", base).parquet(*(f"{base}/{f}" for f in folders)).drop(FOLDER)


def store(
    df: DataFrame, target: str, partition_by: Sequence[str] = (), options: Mapping[str, str] | None = None
) -> str:
    """Write data that no commit names yet; returns its folder below the table."""
    folder = f"{FOLDER}=v{uuid.uuid4().hex}"
    writer = df.write.mode("errorifexists").options(**(options or {}))
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(f"{target.rstrip('/')}/data/{folder}")
    return folder


def commit(
    spark: SparkSession,
    target: str,
    change: Callable[[Folders], Folders],
    schema: T.StructType,
    made_from: int | None = None,
) -> int:
    """Make the table the folders that `change` makes of the present ones; returns the new version.

    `change` is applied again if another writer was faster; a change that was `made_from` the content of
    a version raises then, and nothing of it is seen.
    """
    while True:
        now = latest(spark, target)
        base = now["version"] if now else 0
        if made_from is not None and base != made_from:
            raise ConflictError(f"{target} is at version {base}; the change was made from {made_from}")
        folders = change([(f["part"], f["folder"]) for f in now["folders"]] if now else [])
        writer = uuid.uuid4().hex
        row = (base + 1, writer, schema.json(), folders)
        spark.createDataFrame([row], COMMIT).coalesce(1).write.mode("append").parquet(_commits(target))
        commits = spark.read.schema(COMMIT).parquet(_commits(target)).where(F.col("version") == base + 1)
        if commits.agg(F.min("writer")).first()[0] == writer:
            return base + 1


def replace(df: DataFrame, target: str, partition_by: Sequence[str] = (), made_from: int | None = None) -> int:
    """`df`, which may read from the table, becomes the whole of it."""
    folder = store(df, target, partition_by)
    return commit(df.sparkSession, target, lambda _: [(None, folder)], df.schema, made_from)


def append(
    df: DataFrame,
    target: str,
    partition_by: Sequence[str] = (),
    part: str | None = None,
    options: Mapping[str, str] | None = None,
) -> int:
    """The rows of `df` come to the table, as a folder of `part`."""
    folder = store(df, target, partition_by, options)
    return commit(df.sparkSession, target, lambda there: [*there, (part, folder)], df.schema)


def rewrite(df: DataFrame, target: str, part: str, partition_by: Sequence[str] = ()) -> int:
    """The rows of `df` become the whole of `part`; other parts stay."""
    folder = store(df, target, partition_by)
    return commit(df.sparkSession, target, lambda there: [*(f for f in there if f[0] != part), (part, folder)], df.schema)


def drop_part(spark: SparkSession, target: str, part: str, schema: T.StructType) -> int:
    """`part` becomes empty."""
    return commit(spark, target, lambda there: [f for f in there if f[0] != part], schema)

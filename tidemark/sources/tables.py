"""Parquet tables written one micro-batch at a time.

A table that takes batches is a folder of ``batch_id=<n>`` folders. A batch is in the table
once its folder holds Spark's ``_SUCCESS`` marker; writing it again is then a no-op, so a
replayed micro-batch changes nothing. ``upto=<n>`` folders beside the table hold the combined
content of all batches up to ``n``. The batch ids are those of the streaming query, so
a table and the checkpoint of the query that fills it belong together.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

COMMIT_MARKER = "_SUCCESS"


def _path(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path, hadoop_path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def exists(spark: SparkSession, path: str) -> bool:
    hadoop_path, fs = _path(spark, path)
    return fs.exists(hadoop_path)


def create_if_missing(
    spark: SparkSession, path: str, schema: T.StructType, partition_by: str | None = None
) -> bool:
    """Writes an empty table of the declared schema; false if there is one already."""
    if exists(spark, path):
        return False
    # Parquet keeps no "not null"; nulls are kept out by the filters of each layer.
    writer = spark.createDataFrame([], schema).write
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
    return True


def folders_last(schema: T.StructType, folder_column: str) -> T.StructType:
    """The schema with the column that folder names carry at its end, where Spark puts it once
    it sees such folders. A stream started on an empty table then keeps its schema."""
    own = [f for f in schema.fields if f.name == folder_column]
    rest = [f for f in schema.fields if f.name != folder_column]
    return T.StructType([*rest, *(own or [T.StructField(folder_column, T.LongType())])])


def ensure_folder(spark: SparkSession, path: str) -> None:
    """Makes the folder of a table that takes batches, so that a stream can be started on it."""
    hadoop_path, fs = _path(spark, path)
    fs.mkdirs(hadoop_path)


def numbered(spark: SparkSession, path: str, prefix: str = "batch_id") -> list[int]:
    """Numbers of the ``<prefix>=<n>`` folders, ascending: one listing of names."""
    hadoop_path, fs = _path(spark, path)
    if not fs.exists(hadoop_path):
        return []
    names = [status.getPath().getName() for status in fs.listStatus(hadoop_path)]
    found = [re.fullmatch(rf"{prefix}=(\d+)", name) for name in names]
    return sorted(int(match.group(1)) for match in found if match)


def committed(spark: SparkSession, path: str, prefix: str) -> list[int]:
    """Batches come one after the other, so only the newest can be unfinished."""
    found = numbered(spark, path, prefix)
    while found and not exists(spark, f"{path}/{prefix}={found[-1]}/{COMMIT_MARKER}"):
        found.pop()
    return found


def committed_batches(spark: SparkSession, path: str) -> list[int]:
    return committed(spark, path, "batch_id")


def is_committed(spark: SparkSession, path: str, batch_id: int) -> bool:
    return exists(spark, f"{path}/batch_id={batch_id}/{COMMIT_MARKER}")


def batch_after(spark: SparkSession, path: str, instant_ms: int) -> int:
    """The first batch committed after an instant, or one more than the last. Batches come in
    order, so few markers are looked at."""
    done = committed_batches(spark, path)
    low, high = 0, len(done)
    while low < high:
        middle = (low + high) // 2
        marker, fs = _path(spark, f"{path}/batch_id={done[middle]}/{COMMIT_MARKER}")
        if fs.getFileStatus(marker).getModificationTime() > instant_ms:
            high = middle
        else:
            low = middle + 1
    return done[low] if low < len(done) else (done[-1] + 1 if done else 0)


def write_batch(
    df: DataFrame, path: str, batch_id: int, partition_by: str | None = None
) -> bool:
    """Writes one batch unless it is committed. What an interrupted attempt left is replaced."""
    if is_committed(df.sparkSession, path, batch_id):
        return False
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(f"{path}/batch_id={batch_id}")
    return True


def read_folders(spark: SparkSession, schema: T.StructType, paths: list[str]) -> DataFrame:
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*paths)


def compacted_path(path: str) -> str:
    return f"{path.rstrip('/')}_compacted"


def newest_compaction(
    spark: SparkSession, path: str, schema: T.StructType, before: int | None = None
) -> tuple[int, DataFrame]:
    """The last batch in the newest compaction and its rows; -1 and no rows if there is none."""
    done = [
        n
        for n in committed(spark, compacted_path(path), "upto")
        if before is None or n < before
    ]
    if not done:
        return -1, spark.createDataFrame([], schema)
    return done[-1], read_folders(spark, schema, [f"{compacted_path(path)}/upto={done[-1]}"])


def read_parts(
    spark: SparkSession, path: str, schema: T.StructType, before: int | None = None
) -> tuple[DataFrame | None, DataFrame]:
    """The newest compaction (None if there is none) and the batches after it.

    With ``before``, only what was committed before that batch.
    """
    upto, base = newest_compaction(spark, path, schema, before)
    batches = [
        n
        for n in committed_batches(spark, path)
        if n > upto and (before is None or n < before)
    ]
    recent = read_folders(spark, schema, [f"{path}/batch_id={n}" for n in batches])
    return (None if upto < 0 else base), recent


def compact(spark: SparkSession, path: str, combined: DataFrame) -> int | None:
    """Stores ``combined``, the fold of everything :func:`read_parts` returned, as the new base.

    Returns the last batch in it, or None if nothing new was there. Call it between batches.
    """
    batches = committed_batches(spark, path)
    if not batches:
        return None
    upto = batches[-1]
    target = f"{compacted_path(path)}/upto={upto}"
    if exists(spark, f"{target}/{COMMIT_MARKER}"):
        return None
    combined.write.mode("overwrite").parquet(target)
    return upto

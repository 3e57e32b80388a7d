"""Keyed Parquet tables in buckets: a version rewrites the buckets it touches and no others.

A version is a folder ``upto=<n>`` of ``bucket=<k>`` folders, in the table once it holds Spark's
``_SUCCESS`` marker. The content of a bucket is what its newest version holds; older ones stay for
reads of the table as it was. The number of buckets belongs to the table and cannot change.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources import tables

BUCKET = "bucket"
VERSION = "upto"


def bucket_of(key: str | Column, n_buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(n_buckets)).cast("int")


def versions(spark: SparkSession, path: str, before: int | None = None) -> list[int]:
    found = tables.committed(spark, path, VERSION)
    return [n for n in found if before is None or n < before]


def folders(
    spark: SparkSession, path: str, n_buckets: int, before: int | None = None
) -> dict[int, str]:
    """The folder of each bucket that has rows, going back through versions only until all are found."""
    out: dict[int, str] = {}
    for n in reversed(versions(spark, path, before)):
        inside = f"{path}/{VERSION}={n}"
        for k in tables.numbered(spark, inside, BUCKET):
            out.setdefault(k, f"{inside}/{BUCKET}={k}")
        if len(out) == n_buckets:
            break
    return dict(sorted(out.items()))


def read(
    spark: SparkSession, path: str, schema: T.StructType, chosen: dict[int, str]
) -> DataFrame:
    """Rows of some :func:`folders`, with their ``bucket``; only their files are listed."""
    own = [T.StructField(VERSION, T.LongType()), T.StructField(BUCKET, T.IntegerType())]
    whole = T.StructType([*schema.fields, *own])
    if not chosen:
        return spark.createDataFrame([], whole).drop(VERSION)
    reader = spark.read.schema(whole).option("basePath", path)
    return reader.parquet(*chosen.values()).drop(VERSION)


PIECES = 4
"""Parts of a bucket that tasks may take one by one."""
PIECE = "_piece"


def gather(rows: DataFrame, key: str) -> DataFrame:
    """Rows (bucket, key, ...) brought together by bucket and ``PIECE``, a part of it by the key.

    Aggregated by (bucket, piece, key) they need no other shuffle, and come out in the order in
    which :func:`write` wants them.
    """
    piece = F.pmod(F.xxhash64(F.lit(211), key), F.lit(PIECES)).cast("int")
    return rows.withColumn(PIECE, piece).repartition(BUCKET, PIECE)


def write(rows: DataFrame, path: str, version: int, gathered: bool = False) -> None:
    """Writes a version from the new content of whole buckets, ``bucket`` among the columns.

    Unless :func:`gather` has done so before, rows are brought together by bucket; adaptive
    execution cuts a large bucket into several files and lets small ones share a task.
    """
    (
        (rows if gathered else rows.hint("rebalance", F.col(BUCKET)))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .partitionBy(BUCKET)
        .parquet(f"{path}/{VERSION}={version}")
    )


# --- key summaries -----------------------------------------------------------------------------
#
# A Bloom filter per bucket, in slots of a bitmap function's size. All bits of a key lie in one slot.

SLOT_BITS = 32768
BITS_PER_KEY = 16
PROBES = 6

SUMMARY_SCHEMA = T.StructType(
    [
        T.StructField("slot", T.IntegerType()),
        T.StructField("n_slots", T.IntegerType()),
        T.StructField("bits", T.BinaryType()),
    ]
)


def _slot(key: str, n_slots: str) -> Column:
    return F.pmod(F.xxhash64(F.lit(101), key), F.col(n_slots)).cast("int")


def _places(key: str) -> list[Column]:
    return [F.pmod(F.xxhash64(F.lit(7 * k + 1), key), F.lit(SLOT_BITS)) for k in range(PROBES)]


def summary(keyed: DataFrame, key: str) -> DataFrame:
    """Rows (bucket, key) to the filters of their buckets: (bucket, slot, n_slots, bits)."""
    sizes = keyed.groupBy(BUCKET).agg(
        F.ceil(F.count(F.lit(1)) * BITS_PER_KEY / SLOT_BITS).cast("int").alias("n_slots")
    )
    return (
        keyed.join(F.broadcast(sizes), BUCKET)  # a row a bucket
        .select(
            BUCKET,
            _slot(key, "n_slots").alias("slot"),
            "n_slots",
            F.explode(F.array(*_places(key))).alias("place"),
        )
        .groupBy(BUCKET, "slot", "n_slots")
        .agg(F.bitmap_construct_agg("place").alias("bits"))
    )


def _is_set(bits: str, place: Column) -> Column:
    byte = F.substring(F.col(bits), (F.floor(place / 8) + 1).cast("int"), F.lit(1))
    number = F.conv(F.hex(byte), 16, 10).cast("int")
    return F.call_function("shiftright", number, (place % 8).cast("int")).bitwiseAND(1) == 1


def maybe_known(keys: DataFrame, key: str, filters: DataFrame) -> DataFrame:
    """The rows (bucket, key, ...) that the filters of their buckets do not rule out."""
    sizes = filters.select(BUCKET, "n_slots").distinct()
    probes = F.lit(True)
    for place in _places(key):
        probes &= _is_set("bits", place)
    return (
        keys.join(F.broadcast(sizes), BUCKET)  # a row a bucket
        .withColumn("slot", _slot(key, "n_slots"))
        .join(filters.select(BUCKET, "slot", "bits"), [BUCKET, "slot"])
        .where(probes)
        .select(*keys.columns)
    )

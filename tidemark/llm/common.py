"""Small helpers shared by the operators: tables, stored steps, id rules."""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import new_run_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Writes a step to the shared folder and reads it back.

    Cuts the lineage, so a lost executor does not make Spark repeat the work before it, and
    gives rows that stay the same however often the table is read.
    """
    spark = df.sparkSession
    path = new_run_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def id_remainder(column: str, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``; a null id counts as empty text."""
    text = F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")
    return F.crc32(text) % divisor


def slices(batches: Iterable[pa.RecordBatch], limit: int, column: str) -> Iterator[pa.RecordBatch]:
    """Cuts batches into runs of rows whose texts take about ``limit`` bytes together.

    A single longer text makes a run of its own; no text is cut.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0)
        total, start = 0, 0
        for i, size in enumerate(sizes.to_pylist()):
            if total and total + size > limit:
                yield batch.slice(start, i - start)
                total, start = 0, i
            total += size
        yield batch.slice(start)


_kept: dict[str, object] = {}


def worker_cache(name: str, make: Callable[[], object]):
    """An object that a Python worker keeps from task to task under ``name``."""
    if name not in _kept:
        _kept[name] = make()
    return _kept[name]


def _release(name: str | None) -> None:
    """Drops what other operators' tasks have left in this worker, which Spark uses again."""
    others = [k for k in _kept if k != name]
    for k in others:
        del _kept[k]
    if others:
        gc.collect()
    pa.default_memory_pool().release_unused()


def map_batches(
    df: DataFrame,
    work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
    schema,
    cache: str | None = None,
) -> DataFrame:
    """``mapInArrow``; ``cache`` names the :func:`worker_cache` that ``work`` uses."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _release(cache)
        yield from work(batches)

    return df.mapInArrow(run, schema)

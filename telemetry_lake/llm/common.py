"""Helpers the text operators share: written intermediate tables, sized joins, components, Arrow slices."""

from __future__ import annotations

import ctypes
import gc
import time
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from telemetry_lake.session import scratch_dir

# White space that separates words: blank and the controls from tab to carriage return.
SPACES = r"[\x20\x09-\x0D]+"

# Rows of a join side that are broadcast at most; each such row is a few numbers wide.
BROADCAST_ROWS, BROADCAST_NUMBERS = 1_000_000, 4_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, purpose: str) -> DataFrame:
    """The rows of ``df`` as a table in the shared folder: cuts lineage and survives lost executors."""
    path = scratch_dir(df.sparkSession, purpose)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def sized(df: DataFrame, weight: Column | None = None) -> DataFrame:
    """Mark a written table for broadcast if it is small; a larger one is left to a shuffled join.

    Small means at most ``BROADCAST_ROWS`` rows, and at most ``BROADCAST_NUMBERS`` numbers in the arrays that ``weight``
    measures.
    """
    found = df.agg(F.count("*").alias("rows"), F.sum(F.lit(0) if weight is None else weight).alias("numbers")).first()
    small = found.rows <= BROADCAST_ROWS and (found.numbers or 0) <= BROADCAST_NUMBERS
    return F.broadcast(df) if small else df


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished steps, whose frames are no longer referred to."""
    for _ in range(2):  # Python lets go of the frames first, which the JVM learns a moment later
        gc.collect()
        time.sleep(0.2)
        spark.sparkContext._jvm.System.gc()


def give_back() -> None:
    """Return the memory that earlier steps of this Python worker have freed to the system, which else counts as theirs."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError, TypeError):  # another C library
        pass


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, every other character as it is."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words_of(text: Column) -> Column:
    """Words of a text, as an array; none for NULL."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACES), lambda w: w != "")


def components(edges: DataFrame, purpose: str = "components") -> DataFrame:
    """Connected components of an edge list ``(a, b)`` of longs: ``(node, component)``, smallest node first.

    Alternates two contractions until nothing changes: every node hangs its larger neighbours below its
    smallest one, then its smaller neighbours below the smallest. A hub's edges are never paired with each
    other, so the edge list does not grow, and the rounds are logarithmic in the number of nodes.
    """
    state = [F.count("*").alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x"), F.sum(F.xxhash64("a", "b") % 65_521).alias("s")]
    current = written(
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct(), purpose
    )
    while True:
        both = current.union(current.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.filter("a <> b")
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).union(low.select("a", "m"))
        small = small.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        following = written(small.distinct(), purpose)
        before, current = current.agg(*state).first(), following
        if before == current.agg(*state).first():
            break
    labels = current.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return labels.union(labels.select("component", "component").distinct())


def slices(batch: pa.RecordBatch, column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """A batch in runs of rows whose ``column`` has about ``limit`` bytes at most; a longer row stands alone."""
    sizes = np.fromiter((0 if v is None else v for v in lengths(batch.column(column))), dtype=np.int64)
    first, total = 0, 0
    for i, size in enumerate(sizes.tolist()):
        if i > first and total + size > limit:
            yield batch.slice(first, i - first)
            first, total = i, 0
        total += size
    if first < batch.num_rows:
        yield batch.slice(first)


def lengths(column: pa.Array) -> list[int | None]:
    import pyarrow.compute as pc

    return pc.binary_length(column).to_pylist()


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a binary column end to end, and the offset of each value and of the end; NULL is empty."""
    values = column.fill_null(b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    wide = values.cast(pa.large_binary())
    offsets = np.frombuffer(wide.buffers()[1], np.int64, len(wide) + 1, wide.offset * 8)
    data = wide.buffers()[2]
    if data is None or not len(wide) or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), np.zeros(len(wide) + 1, np.int64)
    return np.frombuffer(data, np.uint8, int(offsets[-1] - offsets[0]), int(offsets[0])), offsets - offsets[0]

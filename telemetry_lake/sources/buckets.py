"""Parquet tables in buckets: a write replaces only the buckets it touches.

A row's bucket follows from its key: the values of some key columns, such as the day, or a hash of all of them. Below
the table's folder lie

- ``data/write=<n>/_bucket=<name>``: the rows of one bucket as the n-th write left them, and
- ``manifest/version=<n>``: which folder each bucket has after the n-th write, with the table's layout and schema.

The newest manifest that Spark marked as committed is the table. A write puts new folders beside the old ones and
commits by writing the next manifest, so a failed write stays invisible and readers never see half of one. Folders
that none of the last manifests names are deleted after the commit, which bounds their number by the number of buckets.
One writer at a time; a second one that took the same number fails instead of undoing the first.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Collection, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from telemetry_lake.sources.files import delete, found
from telemetry_lake.sources.versions import latest_version

BUCKET = "_bucket"
# Manifests kept for readers that still work on an older state of the table.
KEEP = 2


@dataclass(frozen=True)
class Layout:
    """Key columns of a table and what decides about a row's bucket: the columns ``by``, or a hash of the key."""

    keys: tuple[str, ...]
    by: tuple[str, ...] = ()
    count: int = 64

    def __post_init__(self) -> None:
        if not set(self.by) <= set(self.keys) or not self.keys or self.count < 1:
            raise ValueError("a layout has key columns, buckets by some of them, and at least one bucket")

    def bucket(self) -> Column:
        if not self.by:
            return F.pmod(F.xxhash64(*self.keys), F.lit(self.count)).cast("string")
        return bucket_name(*[F.col(c) for c in self.by])


def bucket_name(*values: Column) -> Column:
    """The bucket of these values; different values may share one where a path could not hold them."""
    texts = [F.coalesce(value.cast("string"), F.lit("none")) for value in values]
    return F.regexp_replace(F.concat_ws("-", *texts), "[^A-Za-z0-9.-]", "_")


@dataclass(frozen=True)
class Snapshot:
    """One state of a table."""

    version: int
    layout: Layout
    schema: StructType
    folders: dict[str, str] = field(repr=False)

    def read(self, spark: SparkSession, path: str, buckets: Collection[str] | None = None) -> DataFrame:
        chosen = [folder for name, folder in sorted(self.folders.items()) if buckets is None or name in buckets]
        if not chosen:
            return spark.createDataFrame([], self.schema)
        return spark.read.schema(self.schema).parquet(*[f"{path}/{folder}" for folder in chosen])


def snapshot(spark: SparkSession, path: str, version: int | None = None) -> Snapshot | None:
    """The current state of the table, or that of a ``version``; None if there is none."""
    path = path.rstrip("/")
    if version is None:
        version = latest_version(spark, f"{path}/manifest")
    if version is None:
        return None
    rows = spark.read.schema("bucket string, folder string").parquet(f"{path}/manifest/version={version}").collect()
    head = json.loads(next(row.folder for row in rows if row.bucket is None))
    layout = Layout(tuple(head["keys"]), tuple(head["by"]), head["count"])
    folders = {row.bucket: row.folder for row in rows if row.bucket is not None}
    return Snapshot(version, layout, StructType.fromJson(head["schema"]), folders)


def read_buckets(spark: SparkSession, path: str, buckets: Collection[str] | None = None) -> DataFrame:
    """Rows of the table, or of some buckets only."""
    state = snapshot(spark, path)
    if state is None:
        raise FileNotFoundError(f"no committed table under {path}")
    return state.read(spark, path.rstrip("/"), buckets)


def overwrite_buckets(df: DataFrame, path: str, layout: Layout) -> None:
    """Make ``df`` the whole table."""
    spark, path = df.sparkSession, path.rstrip("/")
    before = latest_version(spark, f"{path}/manifest")
    version = 0 if before is None else before + 1
    _commit(spark, path, Snapshot(version, layout, df.schema, _write(df, path, layout, version)))


def replace_buckets(df: DataFrame, path: str, buckets: Collection[str]) -> None:
    """Put the rows of ``df`` in the place of these buckets; one without rows vanishes, all others stay."""
    spark, path = df.sparkSession, path.rstrip("/")
    state = snapshot(spark, path)
    if state is None:
        raise FileNotFoundError(f"no committed table under {path}")
    written = _write(_as(df, state.schema), path, state.layout, state.version + 1)
    if strange := set(written) - set(buckets):
        raise ValueError(f"rows of buckets that are not replaced: {sorted(strange)[:3]}")
    kept = {name: folder for name, folder in state.folders.items() if name not in set(buckets)}
    _commit(spark, path, Snapshot(state.version + 1, state.layout, state.schema, {**kept, **written}))


def upsert_buckets(
    updates: DataFrame,
    path: str,
    layout: Layout,
    combine: Callable[[DataFrame, DataFrame], DataFrame],
) -> None:
    """Rewrite the buckets that ``updates`` touch as ``combine(their rows, updates)``.

    The layout of an existing table stays; ``layout`` is for a new one. ``updates`` are computed once and staged.
    """
    spark, path = updates.sparkSession, path.rstrip("/")
    state = snapshot(spark, path)
    if state is None:
        overwrite_buckets(updates, path, layout)
        return
    version = state.version + 1
    staged = _write(_as(updates, state.schema), path, state.layout, version, "staged")
    if not staged:
        return
    fresh = spark.read.schema(state.schema).parquet(*[f"{path}/{folder}" for folder in staged.values()])
    merged = combine(state.read(spark, path, staged), fresh)
    written = _write(_as(merged, state.schema), path, state.layout, version)
    untouched = {name: folder for name, folder in state.folders.items() if name not in staged}
    _commit(spark, path, Snapshot(version, state.layout, state.schema, {**untouched, **written}))


def _as(df: DataFrame, schema: StructType) -> DataFrame:
    """Columns of ``df`` in the order and types of the table; hashes of keys depend on the type."""
    if set(df.columns) != set(schema.fieldNames()):
        raise ValueError(f"the table has columns {schema.fieldNames()}, not {df.columns}")
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def _write(df: DataFrame, path: str, layout: Layout, version: int, kind: str = "write") -> dict[str, str]:
    """Write rows by bucket and return the folders; a bucket too large for one task takes several."""
    spark, folder = df.sparkSession, f"data/{kind}={version}"
    delete(spark, f"{path}/{folder}")  # of an attempt that was never committed
    rows = df.withColumn(BUCKET, layout.bucket())
    rows.hint("rebalance", BUCKET).write.partitionBy(BUCKET).parquet(f"{path}/{folder}")
    names = [each.rsplit("/", 1)[1] for each in found(spark, f"{path}/{folder}/{BUCKET}=*")]
    return {name.split("=", 1)[1]: f"{folder}/{name}" for name in names}


def _commit(spark: SparkSession, path: str, state: Snapshot) -> None:
    target = f"{path}/manifest/version={state.version}"
    if not found(spark, f"{target}/_SUCCESS"):
        delete(spark, target)
    layout = state.layout
    head = {"keys": layout.keys, "by": layout.by, "count": layout.count, "schema": state.schema.jsonValue()}
    rows: Sequence[tuple] = [(None, json.dumps(head)), *sorted(state.folders.items())]
    spark.createDataFrame(rows, "bucket string, folder string").coalesce(1).write.parquet(target)
    _drop_stale(spark, path, state.version)


def _drop_stale(spark: SparkSession, path: str, newest: int) -> None:
    """Delete manifests before the last ``KEEP`` and the folders that none of these names."""
    named: set[str] = set()
    for mark in found(spark, f"{path}/manifest/version=*"):
        version = int(mark.rsplit("=", 1)[1])
        if version <= newest - KEEP:
            delete(spark, mark)
        elif (state := snapshot(spark, path, version)) is not None:
            named |= set(state.folders.values())
    kept_writes = {folder.split("/")[1] for folder in named}
    for write in found(spark, f"{path}/data/*=*"):
        name = write.rsplit("/", 1)[1]
        if name not in kept_writes:
            delete(spark, write)
            continue
        for folder in found(spark, f"{write}/{BUCKET}=*"):
            if f"data/{name}/{folder.rsplit('/', 1)[1]}" not in named:
                delete(spark, folder)

"""Overwritable tables: Delta when asked for, otherwise Parquet folders.

A Parquet table is a folder of complete snapshots, ``<path>/version=<n>``, or one in buckets (see ``buckets``). A
snapshot counts once its job has committed, which Spark marks with ``_SUCCESS``; readers take the newest such
snapshot, so a table can be rewritten from its own contents and a failed write stays invisible. Upserts keep tables
in buckets and rewrite only those they touch.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from telemetry_lake.sources.buckets import Layout, snapshot, upsert_buckets
from telemetry_lake.sources.files import delete, found
from telemetry_lake.sources.versions import latest_version

FORMATS = ("parquet", "delta")


def check_format(fmt: str) -> str:
    if fmt not in FORMATS:
        raise ValueError(f"table format must be one of {FORMATS}, not {fmt!r}")
    return fmt


def has_delta(spark: SparkSession) -> bool:
    """Whether the session was started with the Delta extension."""
    return "io.delta" in (spark.conf.get("spark.sql.extensions", "") or "")


def read_table(
    spark: SparkSession, path: str, fmt: str = "parquet", schema: StructType | None = None
) -> DataFrame:
    """The current snapshot; an empty frame when there is none yet and ``schema`` is given."""
    if check_format(fmt) == "delta":
        return spark.read.format("delta").load(path)
    if (state := snapshot(spark, path)) is not None:
        return state.read(spark, path.rstrip("/"))
    version = latest_version(spark, path)
    if version is None:
        if schema is None:
            raise FileNotFoundError(f"no committed snapshot under {path}")
        return spark.createDataFrame([], schema)
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(f"{path.rstrip('/')}/version={version}")


def overwrite_table(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    if check_format(fmt) == "delta":
        df.write.format("delta").mode("overwrite").save(path)
        return
    version = latest_version(df.sparkSession, path)
    target = 0 if version is None else version + 1
    # A folder left by a failed attempt has no mark, so it is safe to overwrite.
    df.write.mode("overwrite").parquet(f"{path.rstrip('/')}/version={target}")


def drop_old_versions(spark: SparkSession, path: str, keep: int = 2) -> None:
    """Delete snapshots that are no longer current, sparing the newest for running readers."""
    newest = latest_version(spark, path)
    if newest is None:
        return
    for folder in found(spark, f"{path.rstrip('/')}/version=*"):
        if int(folder.split("/version=")[-1]) <= newest - keep:
            delete(spark, folder)


def upsert_table(
    updates: DataFrame, path: str, keys: list[str], fmt: str = "parquet", by: Sequence[str] = (), buckets: int = 64
) -> None:
    """Insert new keys and replace existing ones. ``updates`` holds one row per key.

    A new Parquet table is laid out in buckets of the columns ``by``, or in so many of the hashed key.
    """
    spark = updates.sparkSession
    if check_format(fmt) == "delta":
        view = f"table_updates_{uuid.uuid4().hex}"
        updates.createOrReplaceTempView(view)
        match = " AND ".join(f"t.{k} <=> u.{k}" for k in keys)
        spark.sql(
            f"MERGE INTO delta.`{path}` t USING {view} u ON {match} "
            "WHEN MATCHED THEN UPDATE SET * WHEN NOT MATCHED THEN INSERT *"
        )
        spark.catalog.dropTempView(view)
        return
    layout = Layout(tuple(keys), tuple(by), buckets)
    upsert_buckets(updates, path, layout, lambda current, fresh: merged(current, fresh, keys))


def merged(current: DataFrame, updates: DataFrame, keys: list[str]) -> DataFrame:
    """``updates`` plus the rows of ``current`` whose key they do not touch.

    An anti-join on null-safe key equality: Spark broadcasts the updates when they are small
    and otherwise sort-merges both sides on the key.
    """
    left, right = current.alias("c"), updates.select(*keys).alias("u")
    same = None
    for k in keys:
        term = F.col(f"c.{k}").eqNullSafe(F.col(f"u.{k}"))
        same = term if same is None else same & term
    kept = left.join(right, same, "left_anti")
    return kept.unionByName(updates)

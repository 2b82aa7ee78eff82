"""Feature views: point-in-time training joins and latest-value lookups."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from telemetry_lake.functions.time import seconds_of, shift
from telemetry_lake.schema import DAY_COLUMNS
from telemetry_lake.sources.landing import between_days
from telemetry_lake.sources.buckets import Layout, upsert_buckets
from telemetry_lake.sources.tables import check_format, overwrite_table, read_table

# Slices of a key's timeline that a block holds, and buckets of an online table.
BLOCK, BUCKETS = 4096, 64

@dataclass(frozen=True)
class Entity:
    """What features describe, and the column that identifies it."""

    name: str
    join_key: str


@dataclass(frozen=True)
class Field:
    name: str
    dtype: str = "bigint"


@dataclass(frozen=True, eq=False)
class FeatureView:
    """Time-stamped feature rows of one entity.

    ``ttl`` of ``None`` or zero never expires. ``tie_break`` orders rows of equal time; the
    higher value is the newer one. ``where`` restricts the rows of a source that several views share.
    ``stored_by_day`` says that the source reads a table partitioned by year, month and day, so that
    bounds on these columns spare files. Only ``online`` views are materialised and looked up.
    """

    name: str
    entity: Entity
    source: DataFrame
    fields: Sequence[Field]
    timestamp_field: str = "parsed_timestamp"
    ttl: timedelta | None = timedelta(days=1)
    tie_break: str | None = "event_id"
    online: bool = True
    where: str | None = None
    stored_by_day: bool = False

    @property
    def key(self) -> str:
        return self.entity.join_key

    def field_named(self, name: str) -> Field:
        for candidate in self.fields:
            if candidate.name == name:
                return candidate
        raise KeyError(f"feature view {self.name!r} has no field {name!r}")

    def typed(self) -> list[Column]:
        return [F.col(f.name).cast(f.dtype).alias(f.name) for f in self.fields]

    def tie(self) -> Column:
        return F.col(self.tie_break).cast("string") if self.tie_break else F.lit(None).cast("string")

    def usable(self) -> DataFrame:
        rows = self.source.filter(F.col(self.key).isNotNull() & F.col(self.timestamp_field).isNotNull())
        return rows.filter(self.where) if self.where else rows

    def order(self) -> Column:
        """What makes one of two rows of a key the newer one."""
        return F.struct(F.col(self.timestamp_field).cast("timestamp").alias("at"), self.tie().alias("tie"))


SRC_IP = Entity("src_ip", "src_ip")


def daily_ip_traffic(silver: DataFrame, stored: bool = False) -> FeatureView:
    """Per-event traffic features of a source, fresh for one day; ``stored`` says that ``silver`` is a table by day."""
    return FeatureView(
        name="daily_ip_traffic",
        entity=SRC_IP,
        source=silver,
        fields=(Field("bytes_sent"), Field("latency_ms")),
        stored_by_day=stored,
    )


@dataclass(frozen=True)
class _Wanted:
    view: FeatureView
    fields: tuple[Field, ...]
    outputs: tuple[str, ...]


def resolve(
    refs: Sequence[str], views: Sequence[FeatureView], full_names: bool = False
) -> list[_Wanted]:
    """``view:field`` references grouped by view. An unknown name or a name clash raises."""
    known = {view.name: view for view in views}
    chosen: dict[str, list[Field]] = {}
    for ref in refs:
        view_name, colon, field_name = ref.partition(":")
        if not colon or view_name not in known:
            raise KeyError(f"unknown feature reference {ref!r}")
        chosen.setdefault(view_name, []).append(known[view_name].field_named(field_name))
    wanted = []
    for name, fields in chosen.items():
        outputs = tuple(f"{name}__{f.name}" if full_names else f.name for f in fields)
        wanted.append(_Wanted(known[name], tuple(fields), outputs))
    names = [out for w in wanted for out in w.outputs]
    if len(set(names)) != len(names):
        raise ValueError(f"feature names clash, ask for full names: {sorted(names)}")
    return wanted


def historical_features(
    spine: DataFrame,
    refs: Sequence[str],
    views: Sequence[FeatureView],
    slice_width: str = "1 minute",
    prune: bool = False,
    timestamp: str = "event_timestamp",
    full_names: bool = False,
) -> DataFrame:
    """As-of left join: each spine row gets the newest feature row not later than itself.

    A feature older than its view's ttl yields NULL; every spine row and column is kept.

    The timeline of each key is cut into slices and the join runs inside (key, slice), so one
    key holding most of the rows is spread over its slices. What a slice needs from the past
    is a single row: the last feature before it, taken from a per-slice summary that is
    combined on the map side. That row is carried in two levels: slices are put into blocks, each block gets
    the last feature before it from one row per block, and each slice from the slices of its block. So a
    task holds the slices of a block or the blocks of a key, never a key's whole history.

    A source stored by day is read from the day of the first spine row, less the ttl, to the day of the
    last one: the bounds are one scalar subquery, so that building the frame starts no job.

    ``prune`` drops feature rows of keys and slices the spine does not mention before they are shuffled. That
    pays for a spine of few keys and moments.
    """
    wanted = resolve(refs, views, full_names)
    if clash := {out for w in wanted for out in w.outputs} & set(spine.columns):
        raise ValueError(f"the spine already has columns {sorted(clash)}, ask for full names")
    key = wanted[0].view.key
    if any(w.view.key != key for w in wanted):
        raise ValueError("views in one request must share their join key")
    width = seconds_of(slice_width) * 1_000_000

    def slice_of(ts: str) -> Column:
        return F.floor(F.unix_micros(F.col(ts)) / width).cast("bigint")

    packed = F.struct(*[F.col(c) for c in spine.columns])
    asked = spine.select(
        F.col(key).alias("k"),
        slice_of(timestamp).alias("s"),
        F.col(timestamp).cast("timestamp").alias("t"),
        F.lit(1).alias("side"),
        F.lit(None).cast("string").alias("tie"),
        packed.alias("spine"),
    )
    keys, places = asked.select("k").distinct(), asked.select("k", "s").distinct()

    inside, summarised = asked, asked.drop("spine")
    for i, w in enumerate(wanted):
        ts = w.view.timestamp_field
        values = [F.col(f.name).cast(f.dtype).alias(f.name) for f in w.fields]
        rows = _days_of(w.view, spine, timestamp).select(
            F.col(key).alias("k"),
            slice_of(ts).alias("s"),
            F.col(ts).cast("timestamp").alias("t"),
            F.lit(0).alias("side"),
            w.view.tie().alias("tie"),
            F.struct(F.col(ts).cast("timestamp").alias("at"), *values).alias(f"f{i}"),
        )
        near = rows.join(places, ["k", "s"], "left_semi") if prune else rows
        past = rows.join(keys, "k", "left_semi") if prune else rows
        inside = inside.unionByName(near, allowMissingColumns=True)
        summarised = summarised.unionByName(past, allowMissingColumns=True)

    slots = [f"f{i}" for i in range(len(wanted))]
    newest = [
        F.max_by(slot, F.when(F.col(slot).isNotNull(), F.struct("t", "tie"))).alias(slot) for slot in slots
    ]
    blocks = summarised.filter("k IS NOT NULL").withColumn("b", F.floor(F.col("s") / BLOCK))
    summary = blocks.groupBy("k", "b", "s").agg(F.max("side").alias("side"), *newest)
    known = F.coalesce(*[F.col(f"{slot}.at") for slot in slots]).isNotNull()
    # A carried row has no time of its own and therefore sorts to the start of its slice.
    carried = _carried(summary, slots).filter((F.col("side") == 1) & known).withColumn("side", F.lit(0))

    order = Window.partitionBy("k", "s").orderBy(F.asc_nulls_first("t"), "side", F.asc_nulls_first("tie"))
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    joined = inside.unionByName(carried, allowMissingColumns=True).select(
        "side", "t", "spine", *[F.last(slot, ignorenulls=True).over(so_far).alias(slot) for slot in slots]
    )
    outputs = []
    for slot, w in zip(slots, wanted, strict=True):
        ttl = int(w.view.ttl.total_seconds() * 1_000_000) if w.view.ttl else None
        fresh = F.lit(True) if not ttl else F.unix_micros("t") - F.unix_micros(f"{slot}.at") <= ttl
        for f, out in zip(w.fields, w.outputs, strict=True):
            outputs.append(F.when(fresh, F.col(f"{slot}.{f.name}")).alias(out))
    return joined.filter("side = 1").select("spine.*", *outputs)


def _carried(summary: DataFrame, slots: list[str]) -> DataFrame:
    """The newest value of each slot before a key's slice: ``(k, s, side, *slots)`` from ``(k, b, s, side, *slots)``."""

    def before(*keys: str, order: Column) -> list[Column]:
        earlier = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        return [F.last(slot, ignorenulls=True).over(earlier).alias(slot) for slot in slots]

    newest = [F.max_by(slot, F.when(F.col(slot).isNotNull(), F.col("s"))).alias(slot) for slot in slots]
    per_block = summary.groupBy("k", "b").agg(F.max("side").alias("side"), *newest)
    into = per_block.select("k", "b", "side", *before("k", order=F.col("b"))).filter("side = 1")
    # What comes into a block stands before its first slice.
    rows = summary.unionByName(into.withColumn("side", F.lit(0)), allowMissingColumns=True)
    return rows.select("k", "s", "side", *before("k", "b", order=F.asc_nulls_first("s")))


def _days_of(view: FeatureView, spine: DataFrame, timestamp: str) -> DataFrame:
    """Rows of the view that a spine can ask for, by day, if its source is stored by day."""
    source = view.usable()
    if not view.stored_by_day:
        return source
    day = lambda ts: F.struct(F.year(ts).alias("year"), F.month(ts).alias("month"), F.dayofmonth(ts).alias("day"))
    moment, triple = F.col(timestamp).cast("timestamp"), F.struct(*DAY_COLUMNS)
    first = shift(F.min(moment), view.ttl, back=True) if view.ttl else F.min(moment)
    bounds = spine.select(F.struct(day(first).alias("first"), day(F.max(moment)).alias("last"))).scalar()
    source = source.filter(triple <= bounds.getField("last"))
    return source.filter(triple >= bounds.getField("first")) if view.ttl else source


def materialize(
    view: FeatureView, start: datetime | str, end: datetime | str
) -> DataFrame:
    """The newest feature row of every key in ``[start, end)``.

    Each task keeps one row per key before the shuffle. A source stored by day is pruned to the
    days of the range.
    """
    ts = F.col(view.timestamp_field)
    rows = _within(view.usable(), view, start, end).select(
        F.col(view.key), ts.cast("timestamp").alias("event_timestamp"), view.tie().alias("tie"), *view.typed()
    )
    return _newest(rows, view.key)


def _within(rows: DataFrame, view: FeatureView, start: datetime | str, end: datetime | str) -> DataFrame:
    first, last = (datetime.fromisoformat(t) if isinstance(t, str) else t for t in (start, end))
    if view.stored_by_day:
        rows = between_days(rows, first.date(), last.date())
    ts = F.col(view.timestamp_field)
    low, high = (F.lit(t.isoformat()).cast("timestamp") for t in (first, last))
    return rows.filter((ts >= low) & (ts < high))


def materialize_views(views: Sequence[FeatureView], start: datetime | str, end: datetime | str) -> DataFrame:
    """The newest rows of all online views of an entity in ``[start, end)``, side by side.

    One row per key with a column per view, a struct of ``event_timestamp``, ``tie`` and the fields, or NULL. Views
    that share a source (the same frame) and its time column share its scan; the newest rows of all views come out of one
    aggregation, combined on the map side. Views that are not online are left out.
    """
    chosen = [view for view in views if view.online]
    if not chosen or len({view.key for view in chosen}) > 1 or len({view.name for view in chosen}) < len(chosen):
        raise ValueError("materialise one or more online views of one entity, of different names")
    key = chosen[0].key
    scans: dict[tuple, list[FeatureView]] = {}
    for view in chosen:
        scans.setdefault((id(view.source), view.timestamp_field, view.stored_by_day), []).append(view)
    parts = []
    for shared in scans.values():
        first = shared[0]
        rows = first.source.filter(F.col(key).isNotNull() & F.col(first.timestamp_field).isNotNull())
        slots = []
        for view in shared:
            at, where = view.order(), F.expr(view.where) if view.where else F.lit(True)
            row = F.struct(at.getField("at").alias("event_timestamp"), at.getField("tie").alias("tie"), *view.typed())
            slots.append(F.when(where, row).alias(view.name))
        parts.append(_within(rows, first, start, end).select(F.col(key), *slots))
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part, allowMissingColumns=True)
    newest = [_latest_of(view.name) for view in chosen]
    anything = F.coalesce(*[F.col(f"{view.name}.event_timestamp") for view in chosen]).isNotNull()
    return rows.filter(anything).groupBy(key).agg(*newest)


def _latest_of(slot: str) -> Column:
    at = F.when(F.col(slot).isNotNull(), F.struct(f"{slot}.event_timestamp", f"{slot}.tie"))
    return F.max_by(slot, at).alias(slot)


def view_of(table: DataFrame, view: FeatureView) -> DataFrame:
    """The online table of one view, out of one that holds several side by side."""
    return table.filter(F.col(view.name).isNotNull()).select(view.key, f"{view.name}.*")


def _newest(rows: DataFrame, key: str) -> DataFrame:
    """One row per key, cut to one per task before the shuffle (``WindowGroupLimit``)."""
    order = Window.partitionBy(key).orderBy(F.desc("event_timestamp"), F.desc_nulls_last("tie"))
    return rows.withColumn("_place", F.row_number().over(order)).filter("_place = 1").drop("_place")


def write_online(
    latest: DataFrame, path: str, key: str = "src_ip", fmt: str = "parquet", buckets: int = BUCKETS
) -> None:
    """Merge ``latest`` into the online table; the newest event time of a key wins, in each view.

    ``latest`` comes from ``materialize`` or ``materialize_views``. A Parquet table lies in buckets of the hashed key,
    of which only those that ``latest`` has keys of are read and written.
    """
    sides = [name for name in latest.columns if name != key]
    several = "event_timestamp" not in sides

    def combine(current: DataFrame, fresh: DataFrame) -> DataFrame:
        rows = current.unionByName(fresh)
        return rows.groupBy(key).agg(*[_latest_of(name) for name in sides]) if several else _newest(rows, key)

    if check_format(fmt) == "delta":
        overwrite_table(combine(read_table(latest.sparkSession, path, fmt), latest), path, fmt)
    else:
        upsert_buckets(latest, path, Layout((key,), count=buckets), combine)


def online_features(
    entities: DataFrame,
    refs: Sequence[str],
    views: Sequence[FeatureView],
    snapshots: Mapping[str, DataFrame],
    as_of: Column | None = None,
    enforce_ttl: bool = True,
    full_names: bool = False,
) -> DataFrame:
    """Latest feature values of each entity row; an unknown key gives NULLs.

    ``snapshots`` maps a view to its online table. With ``enforce_ttl``, values older than the
    ttl at ``as_of`` (now by default) are withheld. The table is first reduced to the requested
    keys: when those are few, Spark broadcasts them and the table is not shuffled.
    """
    now = F.current_timestamp() if as_of is None else as_of
    result = entities
    for i, w in enumerate(resolve(refs, views, full_names)):
        if not w.view.online:
            raise ValueError(f"feature view {w.view.name!r} is not online")
        key, at = w.view.key, f"_at{i}"
        asked = entities.select(key).distinct()
        found = snapshots[w.view.name].join(asked, key, "left_semi").select(
            key,
            F.col("event_timestamp").alias(at),
            *[F.col(f.name).alias(out) for f, out in zip(w.fields, w.outputs, strict=True)],
        )
        result = result.join(found, key, "left")
        if enforce_ttl and w.view.ttl:
            ttl = int(w.view.ttl.total_seconds() * 1_000_000)
            fresh = F.unix_micros(now) - F.unix_micros(at) <= ttl
            result = result.withColumns({out: F.when(fresh, F.col(out)) for out in w.outputs})
        result = result.drop(at)
    return result

"""Tables in buckets, Bronze in batches and refreshes of touched days."""

import os
from datetime import date, datetime, timedelta

import pytest
from conftest import record, write_lines
from pyspark.sql import functions as F

from telemetry_lake.operators import (
    FeatureView, Field, daily_ip_traffic, materialize_views, online_features, to_gold, to_silver, view_of, write_online,
)
from telemetry_lake.operators.features import SRC_IP
from telemetry_lake.plans.medallion import refine_lake, refresh_days, refresh_touched_days
from telemetry_lake.sinks import upsert_gold, write_gold, write_landing
from telemetry_lake.sinks.files import replace_gold_days
from telemetry_lake.sources import read_bronze, read_gold, read_raw, read_table, upsert_table
from telemetry_lake.sources.bronze import Bronze
from telemetry_lake.sources.buckets import Layout, overwrite_buckets, read_buckets, replace_buckets, snapshot, upsert_buckets
from telemetry_lake.sources.landing import days_from, housekeeping, landing_folder, on_days
from telemetry_lake.streaming import ingest_bronze

DDL = "k string, v int"


def files(path):
    found = {}
    for folder, _, names in os.walk(path):
        for name in names:
            if name.endswith(".parquet"):
                found[f"{folder}/{name}"] = os.stat(f"{folder}/{name}").st_mtime_ns
    return found


def rows(df):
    return sorted((tuple(row) for row in df.collect()), key=lambda row: [(v is None, v) for v in row])


def test_upserts_of_one_key_leave_other_buckets_alone(spark, folder):
    path, n = f"{folder}/t", 8
    table = spark.createDataFrame([(f"k{i}", i) for i in range(200)], DDL)
    upsert_table(table, path, ["k"], buckets=n)
    first = files(f"{path}/data")
    own = snapshot(spark, path).folders
    for i in range(10):
        upsert_table(spark.createDataFrame([("k7", 1000 + i)], DDL), path, ["k"])
    state = snapshot(spark, path)
    changed = {name for name, where in state.folders.items() if own[name] != where}
    assert len(changed) == 1 and state.version == 10 and state.layout == Layout(("k",), (), n)
    kept = {name: stamp for name, stamp in first.items() if not any(f"_bucket={b}/" in name for b in changed)}
    assert kept and kept.items() <= files(f"{path}/data").items()
    assert rows(read_table(spark, path)) == sorted([(f"k{i}", i) for i in range(200) if i != 7] + [("k7", 1009)])
    assert len(os.listdir(f"{path}/manifest")) == 2
    assert len([f for f in os.listdir(f"{path}/data") if not f.startswith(".")]) <= 3


def test_keys_may_be_null_and_types_follow_the_table(spark, folder):
    path = f"{folder}/t"
    upsert_table(spark.createDataFrame([(None, 1), ("a", 2)], DDL), path, ["k"])
    upsert_table(spark.createDataFrame([(None, 5), ("b", 6)], "k string, v bigint").select("v", "k"), path, ["k"])
    assert sorted((r.k or "", r.v) for r in read_table(spark, path).collect()) == [("", 5), ("a", 2), ("b", 6)]
    assert read_table(spark, path).schema.simpleString() == "struct<k:string,v:int>"
    upsert_table(spark.createDataFrame([], DDL), path, ["k"])
    assert read_table(spark, path).count() == 3
    with pytest.raises(ValueError):
        upsert_table(spark.createDataFrame([("b",)], "k string"), path, ["k"])


def test_a_failed_write_stays_invisible(spark, folder):
    path = f"{folder}/t"
    overwrite_buckets(spark.createDataFrame([("a", 1)], DDL), path, Layout(("k",), count=4))
    broken = spark.range(50).select(F.col("id").cast("string").alias("k"), F.when(F.col("id") < 49, 1).otherwise(F.raise_error(F.lit("disk full")).cast("int")).alias("v"))
    with pytest.raises(Exception, match="disk full"):
        upsert_buckets(broken, path, Layout(("k",)), lambda current, fresh: current.unionByName(fresh))
    assert rows(read_buckets(spark, path)) == [("a", 1)]
    os.makedirs(f"{path}/manifest/version=1")
    upsert_table(spark.createDataFrame([("b", 2)], DDL), path, ["k"])
    assert rows(read_buckets(spark, path)) == [("a", 1), ("b", 2)]
    with pytest.raises(FileNotFoundError):
        read_buckets(spark, f"{folder}/none")
    with pytest.raises(FileNotFoundError):
        replace_buckets(spark.createDataFrame([("b", 2)], DDL), f"{folder}/none", ["1"])
    for bad in ({"keys": ()}, {"keys": ("k",), "by": ("v",)}, {"keys": ("k",), "count": 0}):
        with pytest.raises(ValueError):
            Layout(**bad)


GOLD = "year int, month int, day int, src_ip string, total_bytes_transferred bigint, total_connections bigint"


def test_gold_lies_in_days(spark, folder):
    path = f"{folder}/gold"
    write_gold(spark.createDataFrame([(2024, 1, d, ip, d, 1) for d in (1, 2, 31) for ip in "ab"] + [(None, None, None, "n", 9, 1)], GOLD), path)
    assert set(snapshot(spark, path).folders) == {"2024-1-1", "2024-1-2", "2024-1-31", "none-none-none"}
    before = files(path)
    upsert_gold(spark.createDataFrame([(2024, 1, 2, "b", 50, 1), (2024, 2, 1, "c", 7, 1)], GOLD), path)
    part = read_gold(spark, path, first_day="2024-01-02", last_day="2024-01-31")
    assert sorted((r.day, r.src_ip, r.total_bytes_transferred) for r in part.collect()) == [(2, "a", 2), (2, "b", 50), (31, "a", 31), (31, "b", 31)]
    assert not any("2024-1-1/" in name or "2024-2-1/" in name for name in part.inputFiles())
    assert {n: s for n, s in before.items() if "2024-1-31" in n}.items() <= files(path).items()
    replace_gold_days(spark.createDataFrame([(2024, 1, 1, "z", 3, 1)], GOLD), path, days_from("2024-01-01", "2024-01-02"))
    assert sorted((r.day or 0, r.src_ip) for r in read_gold(spark, path).collect()) == [(0, "n"), (1, "c"), (1, "z"), (31, "a"), (31, "b")]
    with pytest.raises(ValueError):
        replace_gold_days(spark.createDataFrame([(2024, 1, 9, "z", 3, 1)], GOLD), path, [date(2024, 1, 1)])


def land(folder, name, *events):
    write_lines(f"{folder}/ingest/{name}.json.gz", [record(src_ip=ip, event_id=e, timestamp=t, bytes_sent=b) for ip, e, t, b in events])


def day(n, hour=10):
    return f"2024-01-{n:02}T{hour:02}:00:00Z"


def whole(spark, lake, dedupe):
    """Gold of a whole rebuild."""
    return rows(to_gold(to_silver(read_bronze(spark, f"{lake}/bronze"), dedupe)))


@pytest.mark.parametrize("dedupe", [True, False])
def test_nightly_refresh_finds_its_days(spark, folder, dedupe):
    lake, raw = f"{folder}/lake", f"{folder}/ingest"
    land(folder, "1", ("a", "1", day(10), 1), ("b", "2", day(11), 2), ("c", "3", day(12), 4), ("d", "4", "soon", 8))
    refine_lake(spark, raw, lake, dedupe=dedupe)
    silver, gold = files(f"{lake}/silver"), files(f"{lake}/gold")
    land(folder, "2", ("a", "5", day(10), 16), ("a", "1", day(10), 1), ("e", "6", day(13), 32), ("d", "7", "later", 64))
    got = refresh_touched_days(spark, raw, lake)
    assert rows(got) == whole(spark, lake, dedupe)
    assert {(r.day, r.src_ip): r.total_bytes_transferred for r in got.collect()}[10, "a"] == (17 if dedupe else 18)
    for before, layer in ((silver, "silver"), (gold, "gold")):
        untouched = {name: stamp for name, stamp in before.items() if "day=11" in name or "day=12" in name or "-11/" in name or "-12/" in name}
        assert untouched and untouched.items() <= files(f"{lake}/{layer}").items()
    assert refresh_touched_days(spark, raw, lake).count() == got.count()
    layer = Bronze(spark, f"{lake}/bronze")
    assert layer.pending().count() == 0 and layer.last()[0] == 1


def test_a_refresh_opens_only_batches_with_rows_of_its_days(spark, folder):
    for n in range(3):
        land(folder, n, *[(f"s{n}", f"{n}-{d}", day(d), 1) for d in (n, n + 1) if d])
        ingest_bronze(spark, f"{folder}/ingest", f"{folder}/bronze", f"{folder}/cp")
    layer = Bronze(spark, f"{folder}/bronze")
    touched = sorted((r.batch, r.day, r.rows) for r in layer.touched().filter("rows > 0").collect())
    assert touched == [(0, 1, 1), (1, 1, 1), (1, 2, 1), (2, 2, 1), (2, 3, 1)]
    part = layer.rows_touching([date(2024, 1, 3)])
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "batch#" in plan.split("PartitionFilters: ")[1].split("]")[0]
    assert sorted(r.event_id for r in part.collect()) == ["2-2", "2-3"] and len(layer.rows_touching([date(2024, 1, 1)]).collect()) == 3


def test_half_a_batch_is_not_read_and_is_replaced(spark, folder):
    land(folder, "1", ("a", "1", day(1), 1))
    ingest_bronze(spark, f"{folder}/ingest", f"{folder}/bronze", f"{folder}/cp")
    layer = Bronze(spark, f"{folder}/bronze")
    extra = read_bronze(spark, f"{folder}/bronze").drop("batch").withColumn("event_id", F.lit("half"))
    staged = extra.withColumn("batch", F.lit(1))
    staged.write.mode("append").partitionBy("ingest_date", "batch").parquet(f"{folder}/bronze")
    assert rows(layer.rows().select("event_id")) == [("1",)]
    land(folder, "2", ("a", "2", day(2), 1))
    ingest_bronze(spark, f"{folder}/ingest", f"{folder}/bronze", f"{folder}/cp")
    assert rows(layer.rows().select("event_id")) == [("1",), ("2",)]


def test_a_failed_refresh_leaves_its_batches_pending(spark, folder, monkeypatch):
    from telemetry_lake.plans import medallion

    lake, raw = f"{folder}/lake", f"{folder}/ingest"
    land(folder, "1", ("a", "1", day(10), 1))
    refine_lake(spark, raw, lake)
    land(folder, "2", ("a", "2", day(10), 2))

    def fail(*_, **__):
        raise OSError("lost")

    with monkeypatch.context() as patched:
        patched.setattr(medallion, "write_silver", fail)
        with pytest.raises(OSError):
            refresh_touched_days(spark, raw, lake)
    assert [r.total_bytes_transferred for r in refresh_touched_days(spark, raw, lake).collect()] == [3]


def test_refresh_of_days_keeps_the_deduplication_and_empties_days(spark, folder):
    lake, raw = f"{folder}/lake", f"{folder}/ingest"
    land(folder, "1", *[(ip, e, t, 1) for ip, e, t in (("a", "1", day(10)), ("b", "2", day(11)), ("c", "3", day(12))) for _ in range(2)])
    refine_lake(spark, raw, lake, dedupe=True)
    count = spark.read.parquet(f"{lake}/silver").count()
    gold = rows(refresh_days(spark, None, lake, "2024-01-09", "2024-01-12"))
    assert spark.read.parquet(f"{lake}/silver").count() == count == 3 and [r[4] for r in gold] == [1, 1, 1]
    assert [r[4] for r in rows(refresh_days(spark, None, lake, "2024-01-10", "2024-01-10", dedupe=False))] == [2, 1, 1]
    without = read_bronze(spark, f"{lake}/bronze").filter("src_ip <> 'b'")
    gold = refresh_days(spark, without, lake, "2024-01-10", "2024-01-12")
    assert sorted((r.day, r.src_ip, r.total_connections) for r in gold.collect()) == [(10, "a", 1), (12, "c", 1)]
    assert not os.path.exists(f"{lake}/silver/year=2024/month=1/day=11")


def test_days_as_filters(spark):
    df = spark.createDataFrame([(2024, 1, 31), (2024, 2, 1), (2023, 1, 31), (None, None, None)], "year int, month int, day int")
    assert df.filter(on_days([date(2024, 1, 31), date(2024, 2, 2)])).count() == 1
    assert df.filter(~on_days([date(2024, 1, 31)])).count() == 3
    assert df.filter(on_days([None, date(2023, 1, 31)])).count() == 2 and df.filter(on_days([])).count() == 0
    assert days_from("2024-02-28", "2024-03-01") == [date(2024, 2, 28), date(2024, 2, 29), date(2024, 3, 1)]


def test_landing_housekeeping(spark, folder):
    assert housekeeping() == {} and housekeeping(delete=True, max_age="3d") == {"cleanSource": "delete", "maxFileAge": "3d"}
    assert housekeeping(archive="/a") == {"cleanSource": "archive", "sourceArchiveDir": "/a"}
    with pytest.raises(ValueError):
        housekeeping(archive="/a", delete=True)
    hours = [landing_folder(f"{folder}/ingest", datetime(2024, 2, 1, hour)) for hour in (5, 23)]
    assert hours[0].endswith("/date=2024-02-01/hour=05")
    for i, hour in enumerate(hours):
        df = spark.createDataFrame([(f"e{i}", "s", 1)], "event_id string, src_ip string, bytes_sent bigint")
        write_landing(df.coalesce(1), hour)
    assert rows(read_raw(spark, f"{folder}/ingest").select("event_id")) == [("e0",), ("e1",)]
    ingest_bronze(spark, f"{folder}/ingest", f"{folder}/bronze", f"{folder}/cp", max_files=1, keeping=housekeeping(delete=True))
    assert rows(read_bronze(spark, f"{folder}/bronze").select("event_id", "batch")) == [("e0", 0), ("e1", 1)]


SILVER = "event_id string, src_ip string, parsed_timestamp timestamp, bytes_sent bigint, latency_ms int"
START = datetime(2024, 1, 10)


def test_views_are_materialised_side_by_side(spark, folder):
    events = [("1", "a", 0, 1, 50), ("2", "a", 10, 2, 5), ("3", "b", 5, 3, 5), ("4", "c", 86_400 * 3, 4, 70)]
    silver = spark.createDataFrame([(e, ip, START + timedelta(seconds=s), b, ms) for e, ip, s, b, ms in events], SILVER)
    slow = FeatureView("slow", SRC_IP, silver, (Field("latency_ms", "int"),), where="latency_ms >= 30")
    other = FeatureView("other", SRC_IP, silver.filter("src_ip = 'b'"), (Field("bytes_sent"),))
    hidden = FeatureView("hidden", SRC_IP, silver, (Field("bytes_sent"),), online=False)
    views = [daily_ip_traffic(silver), slow, hidden]
    shared = materialize_views(views, START, START + timedelta(days=1))
    assert shared.columns == ["src_ip", "daily_ip_traffic", "slow"]
    plan = shared._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Union" not in plan
    write_online(materialize_views([*views, other], START, START + timedelta(days=1)), f"{folder}/online")
    write_online(materialize_views([*views, other], START + timedelta(days=1), START + timedelta(days=9)), f"{folder}/online")
    table = read_table(spark, f"{folder}/online")
    assert rows(view_of(table, views[0]).select("src_ip", "bytes_sent")) == [("a", 2), ("b", 3), ("c", 4)]
    assert rows(view_of(table, slow).select("src_ip", "latency_ms")) == [("a", 50), ("c", 70)]
    assert rows(view_of(table, other).select("src_ip", "bytes_sent")) == [("b", 3)]
    asked = spark.createDataFrame([("a",), ("x",)], "src_ip string")
    found = online_features(asked, ["slow:latency_ms"], [slow], {"slow": view_of(table, slow)}, as_of=F.lit(START.isoformat()).cast("timestamp"))
    assert [r.latency_ms for r in found.orderBy("src_ip").collect()] == [50, None]
    with pytest.raises(ValueError):
        online_features(asked, ["hidden:bytes_sent"], [hidden], {"hidden": table})
    for bad in ([], [hidden], [slow, slow]):
        with pytest.raises(ValueError):
            materialize_views(bad, START, START)

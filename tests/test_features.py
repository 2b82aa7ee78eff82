import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from telemetry_lake.operators import (
    FeatureView, Field, daily_ip_traffic, historical_features, materialize, online_features, write_online,
)
from telemetry_lake.operators.features import SRC_IP
from telemetry_lake.sources import read_table

START = datetime(2024, 1, 10)
SILVER = "event_id string, src_ip string, parsed_timestamp timestamp, bytes_sent bigint, latency_ms int"
SPINE = "event_timestamp timestamp, src_ip string, label_is_anomaly int"
REFS = ["daily_ip_traffic:bytes_sent", "daily_ip_traffic:latency_ms"]
DAY = 86_400


def silver(spark, rows):
    return spark.createDataFrame([(e, ip, START + timedelta(seconds=s), b, 1) for e, ip, s, b in rows], SILVER)


def spine(spark, rows):
    return spark.createDataFrame([(START + timedelta(seconds=s), ip, label) for s, ip, label in rows], SPINE)


def as_of(spark, features, asked, **options):
    view = daily_ip_traffic(silver(spark, features))
    return {r.label_is_anomaly: r.bytes_sent for r in historical_features(spine(spark, asked), REFS, [view], **options).collect()}


@pytest.mark.parametrize("slice_width", ["1 second", "1 minute", "1 day"])
@pytest.mark.parametrize("prune", [None, True, False])
def test_point_in_time_cases(spark, slice_width, prune):
    features = [
        ("1", "at", 0, 10), ("1", "before", -1, 11), ("1", "after", 1, 12),
        ("2", "tie", -5, 21), ("1", "tie", -5, 20), ("1", "old", -DAY, 13), ("1", "stale", -DAY - 1, 14),
        ("1", "two", -50, 15), ("2", "two", -40, 16),
    ]
    keys = ["at", "before", "after", "tie", "old", "stale", "two", "unknown"]
    got = as_of(spark, features, [(0, k, i) for i, k in enumerate(keys)], slice_width=slice_width, prune=prune)
    assert [got[i] for i in range(len(keys))] == [10, 11, None, 21, 13, None, 16, None]


@pytest.mark.parametrize("ttl", [None, timedelta(minutes=20)])
def test_against_a_simple_loop_with_one_hot_key(spark, ttl):
    rng = random.Random(11)
    ip = lambda: "hot" if rng.random() < 0.6 else f"ip{rng.randrange(6)}"
    features = [(f"{i:05}", ip(), rng.randrange(20_000), i) for i in range(1_500)]
    asked = [(rng.randrange(20_000), ip(), i) for i in range(700)]
    view = FeatureView("daily_ip_traffic", SRC_IP, silver(spark, features), (Field("bytes_sent"),), ttl=ttl)
    result = historical_features(spine(spark, asked), REFS[:1], [view], slice_width="5 minutes")
    got = {r.label_is_anomaly: r.bytes_sent for r in result.collect()}
    for s, key, label in asked:
        past = [(t, e, b) for e, k, t, b in features if k == key and t <= s]
        newest = max(past, default=None)
        if newest and ttl and s - newest[0] > ttl.total_seconds():
            newest = None
        assert got[label] == (newest[2] if newest else None)
    assert len(got) == len(asked)


def test_history_is_carried_through_blocks(spark, monkeypatch):
    """Many blocks of few slices, most of them empty: what a slice needs lies blocks before it."""
    from telemetry_lake.operators import features as module

    monkeypatch.setattr(module, "BLOCK", 3)
    rng = random.Random(12)
    rows = [(f"{i:04}", rng.choice("ab"), rng.randrange(9_000), i) for i in range(60)]
    asked = [(rng.randrange(12_000), rng.choice("abc"), i) for i in range(300)]
    view = FeatureView("daily_ip_traffic", SRC_IP, silver(spark, rows), (Field("bytes_sent"),), ttl=None)
    result = historical_features(spine(spark, asked), REFS[:1], [view])
    for row in result.collect():
        moment = (row.event_timestamp - START).total_seconds()
        past = [(t, e, b) for e, k, t, b in rows if k == row.src_ip and t <= moment]
        assert row.bytes_sent == (max(past)[2] if past else None)
    plan = result._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    # A window over a key alone sees one row per block; slices are walked within their block. Both read one summary.
    assert plan.count("Window [last") == 3 and "ReusedExchange" in plan


def test_plan_has_no_range_join_and_cuts_keys_into_slices(spark):
    view = daily_ip_traffic(silver(spark, [("1", "a", 0, 1)]))
    plan = historical_features(spine(spark, [(0, "a", 1)]), REFS, [view])._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan and "Python" not in plan
    assert "windowspecdefinition(k#" in plan and ", s#" in plan


def test_pruning_is_asked_for(spark):
    view = daily_ip_traffic(silver(spark, [("1", "a", 0, 1), ("1", "b", 0, 2)]))
    asked = spine(spark, [(5, "a", 1), (5, "b", 2)])
    plans = []
    for prune in (True, False):
        result = historical_features(asked, REFS, [view], prune=prune)
        assert sorted((r.src_ip, r.bytes_sent) for r in result.collect()) == [("a", 1), ("b", 2)]
        plans.append(result._jdf.queryExecution().executedPlan().toString())
    assert "LeftSemi" in plans[0] and "LeftSemi" not in plans[1]


def test_days_of_a_stored_silver_are_pruned(spark, folder):
    from telemetry_lake.functions.time import date_parts
    from telemetry_lake.sinks import write_silver
    from telemetry_lake.sources import read_silver

    rows = [("1", "a", 0, 1), ("2", "a", 86_400 * 3, 2), ("3", "a", 86_400 * 9, 3)]
    write_silver(silver(spark, rows).withColumns(date_parts(F.col("parsed_timestamp"))), f"{folder}/silver")
    view = daily_ip_traffic(read_silver(spark, f"{folder}/silver"), stored=True)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("build", "frame only")
    result = historical_features(spine(spark, [(86_400 * 3 + 5, "a", 1)]), REFS, [view])
    assert tracker.getJobIdsForGroup("build") == []
    assert [r.bytes_sent for r in result.collect()] == [2]
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: []" not in plan


def test_a_spine_column_may_not_hide_a_feature(spark):
    view = daily_ip_traffic(silver(spark, [("1", "a", 0, 1)]))
    asked = spine(spark, [(0, "a", 1)]).withColumn("bytes_sent", F.lit(1))
    with pytest.raises(ValueError):
        historical_features(asked, REFS, [view])
    assert "daily_ip_traffic__bytes_sent" in historical_features(asked, REFS, [view], full_names=True).columns


def test_spine_rows_and_types_are_kept(spark):
    asked = spine(spark, [(0, "a", 1), (0, "a", 1), (0, None, 2)])
    view = daily_ip_traffic(silver(spark, [("1", "a", 0, 7), ("1", None, 0, 9)]))
    result = historical_features(asked, REFS, [view])
    assert sorted((r.label_is_anomaly, r.bytes_sent) for r in result.collect() if r.src_ip) == [(1, 7), (1, 7)]
    assert result.filter("src_ip IS NULL").first().bytes_sent is None
    assert dict(result.dtypes)["latency_ms"] == "bigint" and result.columns[:3] == asked.columns


def test_references_are_checked(spark):
    view = daily_ip_traffic(silver(spark, [("1", "a", 0, 1)]))
    asked = spine(spark, [(0, "a", 1)])
    for bad in ("bytes_sent", "other:bytes_sent", "daily_ip_traffic:nothing"):
        with pytest.raises(KeyError):
            historical_features(asked, [bad], [view])
    twin = FeatureView("twin", SRC_IP, view.source, (Field("bytes_sent"),))
    with pytest.raises(ValueError):
        historical_features(asked, ["daily_ip_traffic:bytes_sent", "twin:bytes_sent"], [view, twin])
    full = historical_features(asked, ["daily_ip_traffic:bytes_sent", "twin:bytes_sent"], [view, twin], full_names=True)
    assert full.columns[3:] == ["daily_ip_traffic__bytes_sent", "twin__bytes_sent"]


def test_materialise_range_and_ties(spark):
    rows = [("1", "a", 0, 1), ("2", "a", 0, 2), ("3", "a", 10, 3), ("9", "b", -1, 4)]
    view = daily_ip_traffic(silver(spark, rows))
    end = START + timedelta(seconds=10)
    latest = materialize(view, START, end)
    assert [(r.src_ip, r.bytes_sent) for r in latest.collect()] == [("a", 2)]
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert plan.index("WindowGroupLimit") < plan.index("Exchange") < plan.rindex("WindowGroupLimit")


def test_online_lookup(spark, folder):
    rows = [("1", "192.168.1.100", 0, 1), ("2", "192.168.1.100", 60, 3698), ("1", "old", 0, 5)]
    view = daily_ip_traffic(silver(spark, rows).withColumn("latency_ms", F.lit(16)))
    write_online(materialize(view, "2024-01-10", "2024-01-11"), f"{folder}/online")
    table = read_table(spark, f"{folder}/online")
    entities = spark.createDataFrame([("10.0.0.1",), ("192.168.1.100",), ("old",)], "src_ip string")

    def look(now, **options):
        found = online_features(entities, REFS, [view], {view.name: table}, as_of=F.lit(now).cast("timestamp"), **options)
        return {r.src_ip: (r.bytes_sent, r.latency_ms) for r in found.collect()}

    assert look("2024-01-10 01:00:00") == {"10.0.0.1": (None, None), "192.168.1.100": (3698, 16), "old": (5, 16)}
    assert look("2024-01-11 00:00:01") == {"10.0.0.1": (None, None), "192.168.1.100": (3698, 16), "old": (None, None)}
    assert look("2030-01-01 00:00:00", enforce_ttl=False)["old"] == (5, 16)


def test_online_table_keeps_the_newest(spark, folder):
    view = daily_ip_traffic(silver(spark, [("1", "a", 0, 1), ("1", "b", 0, 2), ("2", "a", 3 * DAY, 9)]))
    write_online(materialize(view, "2024-01-12", "2024-01-20"), f"{folder}/online")
    write_online(materialize(view, "2024-01-01", "2024-01-12"), f"{folder}/online")
    assert {(r.src_ip, r.bytes_sent) for r in read_table(spark, f"{folder}/online").collect()} == {("a", 9), ("b", 2)}


def test_materialise_prunes_days(spark, folder):
    from telemetry_lake.operators import to_silver
    from telemetry_lake.functions.time import date_parts
    from telemetry_lake.sinks import write_silver
    from telemetry_lake.sources import read_silver

    rows = [(f"2024-01-1{d}T00:00:00Z", f"{d}", "a", "d", d, 1) for d in range(5)]
    ddl = "timestamp string, event_id string, src_ip string, dst_ip string, bytes_sent bigint, latency_ms int"
    write_silver(to_silver(spark.createDataFrame(rows, ddl)), f"{folder}/silver")
    latest = materialize(daily_ip_traffic(read_silver(spark, f"{folder}/silver"), stored=True), "2024-01-10", "2024-01-12")
    assert latest.first().bytes_sent == 1
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan

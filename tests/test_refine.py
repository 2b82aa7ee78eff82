import os

import pytest
from conftest import record, write_lines
from pyspark.sql import functions as F

from telemetry_lake.operators import to_gold, to_silver, top_ip_days, top_per_day, top_talkers
from telemetry_lake.plans.medallion import refine_lake, refresh_days
from telemetry_lake.schema import CORRUPT, SILVER_COLUMNS
from telemetry_lake.sinks import upsert_gold, write_gold, write_landing, write_silver
from telemetry_lake.sources import overwrite_table, read_bronze, read_gold, read_raw, read_silver, read_table
from telemetry_lake.sources.tables import drop_old_versions, latest_version
from telemetry_lake.streaming import ingest_bronze

DDL = "timestamp string, event_id string, src_ip string, dst_ip string, bytes_sent bigint, latency_ms int"


def bronze_rows(spark, rows):
    return spark.createDataFrame(rows, DDL)


def test_null_handling(spark):
    rows = [
        ("2024-01-01T00:00:00Z", "a", None, "d", 1, 1),
        ("2024-01-01T00:00:00Z", "b", "s", "d", None, 1),
        ("garbage", "c", "s", "d", 5, 1),
        ("2024-01-01T00:00:00Z", None, "s", "d", 7, 1),
        ("1704067200", "e", "s", "d", 9, 1),
    ]
    silver = to_silver(bronze_rows(spark, rows))
    kept = {r.event_id: r for r in silver.collect()}
    assert set(kept) == {"c", None, "e"}
    assert kept["c"].parsed_timestamp is None and kept["c"].year is None
    assert (kept["e"].year, kept["e"].month, kept["e"].day) == (2024, 1, 1)
    gold = {r.year: r for r in to_gold(silver).collect()}
    assert (gold[2024].total_bytes_transferred, gold[2024].total_connections) == (16, 1)
    assert (gold[None].total_bytes_transferred, gold[None].total_connections) == (5, 1)


def test_unparsed_day_survives_the_table(spark, folder):
    rows = [("garbage", "c", "s", "d", 5, 1), ("2024-01-02T00:00:00Z", "d", "s", "d", 6, 1)]
    write_silver(to_silver(bronze_rows(spark, rows)), f"{folder}/silver")
    assert "year=__HIVE_DEFAULT_PARTITION__" in os.listdir(f"{folder}/silver")
    back = {r.event_id: r.year for r in read_silver(spark, f"{folder}/silver").collect()}
    assert back == {"c": None, "d": 2024}


def test_pruning_reads_only_the_days(spark, folder):
    rows = [(f"2024-0{m}-{d:02}T01:00:00Z", f"{m}{d}", "s", "d", 1, 1) for m in (1, 2) for d in (1, 15, 28)]
    write_silver(to_silver(bronze_rows(spark, rows)), f"{folder}/silver")
    part = read_silver(spark, f"{folder}/silver", "2024-01-28", "2024-02-01")
    assert {r.event_id for r in part.collect()} == {"128", "21"}
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan
    assert len(part.inputFiles()) >= 2
    two = part.select("bytes_sent")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<bytes_sent:bigint>" in two


def test_dynamic_overwrite_leaves_other_days(spark, folder):
    path = f"{folder}/silver"
    rows = [(f"2024-01-0{d}T00:00:00Z", f"{d}", "s", "d", d, 1) for d in (1, 2, 3)]
    write_silver(to_silver(bronze_rows(spark, rows)), path)
    write_silver(to_silver(bronze_rows(spark, [("2024-01-02T00:00:00Z", "new", "s", "d", 50, 1)])), path, "dynamic", False)
    assert {r.event_id for r in read_silver(spark, path).collect()} == {"1", "new", "3"}
    with pytest.raises(ValueError):
        write_silver(to_silver(bronze_rows(spark, rows)), path, "append")


def test_landing_files(spark, folder):
    df = spark.range(5_000).select(F.col("id").cast("string").alias("event_id")).coalesce(1)
    write_landing(df, f"{folder}/ingest")
    files = [f for f in os.listdir(f"{folder}/ingest") if f.endswith(".json.gz")]
    assert len(files) == 3
    sizes = sorted(spark.read.text(f"{folder}/ingest/{f}").count() for f in files)
    assert sizes == [1_000, 2_000, 2_000]
    write_landing(df.limit(0), f"{folder}/ingest")
    assert read_raw(spark, f"{folder}/ingest").count() == 5_000


def test_bronze_reruns_add_only_new_files(spark, folder):
    raw, bronze, checkpoint = f"{folder}/ingest", f"{folder}/bronze", f"{folder}/cp"
    write_lines(f"{raw}/a.json.gz", [record(event_id="a"), "broken line"])
    write_lines(f"{raw}/b.json.gz", [record(event_id="b", timestamp=1_704_067_200)])
    counts = []
    for extra in (None, None, "c"):
        if extra:
            write_lines(f"{raw}/{extra}.json.gz", [record(event_id=extra)])
        query = ingest_bronze(spark, raw, bronze, checkpoint, max_files=1)
        assert not query.isActive
        counts.append(read_bronze(spark, bronze).count())
    assert counts == [3, 3, 4]
    rows = {r.event_id: r for r in read_bronze(spark, bronze).collect()}
    assert rows[None][CORRUPT] == "broken line"
    assert rows["b"].timestamp == "1704067200" and rows["b"].flags == ["ACK", "PSH"]
    assert rows["c"].source_file.endswith("c.json.gz")


def test_whole_lake_and_daily_refresh(spark, folder):
    write_lines(f"{folder}/ingest/a.json.gz", [record(event_id=f"a{i}", bytes_sent=10) for i in range(3)])
    gold = refine_lake(spark, f"{folder}/ingest", f"{folder}/lake")
    assert [(r.src_ip, r.total_bytes_transferred, r.total_connections) for r in gold.collect()] == [("192.168.1.100", 30, 3)]
    fixed = read_bronze(spark, f"{folder}/lake/bronze").withColumn("bytes_sent", F.lit(4).cast("bigint"))
    gold = refresh_days(spark, fixed, f"{folder}/lake", "2024-01-01", "2024-01-01")
    assert [(r.src_ip, r.total_bytes_transferred) for r in gold.collect()] == [("192.168.1.100", 12)]


def test_a_refresh_keeps_the_other_days(spark, folder):
    lake, day = f"{folder}/lake", "2024-01-{:02d}T10:00:00Z".format
    first = [record(event_id="a", timestamp=day(10), src_ip="a", bytes_sent=1), record(event_id="b", timestamp=day(10), src_ip="b", bytes_sent=2),
             record(event_id="c", timestamp=day(11), src_ip="c", bytes_sent=3), record(event_id="d", timestamp="soon", src_ip="d", bytes_sent=4)]
    write_lines(f"{folder}/ingest/1.json.gz", first)
    refine_lake(spark, f"{folder}/ingest", lake)
    late = [record(event_id="e", timestamp=day(10), src_ip="a", bytes_sent=10), record(event_id="f", timestamp=day(11), src_ip="b", bytes_sent=20),
            record(event_id="g", timestamp="07:15:00", src_ip="d", bytes_sent=40)]
    write_lines(f"{folder}/ingest/2.json.gz", late)
    ingest_bronze(spark, f"{folder}/ingest", f"{lake}/bronze", f"{lake}/checkpoints/bronze")
    rows = read_bronze(spark, f"{lake}/bronze").filter("src_ip <> 'c'")
    gold = refresh_days(spark, rows, lake, "2024-01-11", "2024-01-11")
    # The late row of the 10th waits for its own refresh, c has vanished from the 11th, rows without a day stay.
    totals = {(r.day, r.src_ip): r.total_bytes_transferred for r in gold.collect()}
    assert totals == {(10, "a"): 1, (10, "b"): 2, (11, "b"): 20, (None, "d"): 4}
    assert spark.read.parquet(f"{lake}/silver").filter("day = 10").count() == 2
    gold = refresh_days(spark, None, lake, "2024-01-10", "2024-01-11")
    totals = {(r.day, r.src_ip): r.total_bytes_transferred for r in gold.collect()}
    assert totals == {(10, "a"): 11, (10, "b"): 2, (11, "b"): 20, (11, "c"): 3, (None, "d"): 4}


def test_a_time_of_day_is_no_timestamp(spark):
    from telemetry_lake.functions.time import event_timestamp

    texts = ["12:30:00", "T07", "2024-01-01", " 2024-01-01T00:00:00Z ", "1704067200", "x"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(event_timestamp(F.col("t")).alias("ts")).collect()
    assert [r.ts is None for r in rows] == [True, True, False, False, False, True]


def test_upsert_and_versions(spark, folder):
    path = f"{folder}/gold"
    ddl = "year int, month int, day int, src_ip string, total_bytes_transferred bigint, total_connections bigint"
    write_gold(spark.createDataFrame([(2024, 1, 1, "a", 1, 1), (None, None, None, "n", 2, 1)], ddl), path)
    upsert_gold(spark.createDataFrame([(2024, 1, 1, "b", 5, 1), (None, None, None, "n", 7, 1)], ddl), path)
    assert {(r.src_ip, r.total_bytes_transferred) for r in read_gold(spark, path).collect()} == {("a", 1), ("b", 5), ("n", 7)}
    gold, path = path, f"{folder}/other"
    for _ in range(3):
        overwrite_table(read_gold(spark, gold).filter("src_ip = 'a'"), path)
    assert read_table(spark, path).count() == 1
    os.makedirs(f"{path}/version=9/_temporary")
    assert latest_version(spark, path) == 2
    drop_old_versions(spark, path)
    assert not os.path.exists(f"{path}/version=0") and os.path.exists(f"{path}/version=1")
    with pytest.raises(FileNotFoundError):
        read_table(spark, f"{folder}/none")
    with pytest.raises(ValueError):
        read_table(spark, path, "csv")


def test_dedupe(spark):
    rows = [("2024-01-01T00:00:00Z", "a", "s", "d", 1, 1)] * 3 + [("2024-01-01T00:00:00Z", None, "s", "d", 1, 1)] * 2
    assert to_silver(bronze_rows(spark, rows)).count() == 5
    unique = to_silver(bronze_rows(spark, rows), dedupe=True)
    assert unique.count() == 3 and set(SILVER_COLUMNS) <= set(unique.columns)


def test_rankings_break_ties_by_key(spark):
    rows = [("2024-01-01T00:00:00Z", f"{ip}{i}", ip, "d", 5, 1) for ip in ("c", "a", "b") for i in range(2)]
    gold = to_gold(to_silver(bronze_rows(spark, rows)))
    assert [r.src_ip for r in top_ip_days(gold, 2).collect()] == ["a", "b"]
    assert [r.src_ip for r in top_talkers(bronze_rows(spark, rows), 2).collect()] == ["a", "b"]
    ranked = top_per_day(gold, 2)
    assert {(r.src_ip, r["rank"]) for r in ranked.collect()} == {("a", 1), ("b", 2)}
    assert "WindowGroupLimit" in ranked._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in top_ip_days(gold)._jdf.queryExecution().executedPlan().toString()


def test_a_day_holding_most_rows_is_split(spark, folder):
    """Adaptive execution cuts a large day into several tasks; small days stay whole."""
    day = F.when(F.col("id") % 10 < 8, 15).otherwise(F.col("id") % 7 + 1)
    rows = spark.range(400_000).select(
        F.format_string("2024-01-%02dT00:00:00Z", day).alias("timestamp"),
        F.sha2(F.col("id").cast("string"), 256).alias("event_id"),
        F.lit("s").alias("src_ip"), F.lit("d").alias("dst_ip"),
        F.col("id").alias("bytes_sent"), F.lit(1).alias("latency_ms"),
    )
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "4MB")
    try:
        write_silver(to_silver(rows), f"{folder}/silver")
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    day_files = lambda d: [f for f in os.listdir(f"{folder}/silver/year=2024/month=1/day={d}") if f.endswith(".parquet")]
    assert len(day_files(15)) > 3
    assert len(day_files(1)) == 1
    assert read_silver(spark, f"{folder}/silver").count() == 400_000

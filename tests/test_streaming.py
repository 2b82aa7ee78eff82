import os

import pytest
from conftest import record, write_lines

from telemetry_lake.operators import port_scans, to_silver
from telemetry_lake.operators.validate import validate
from telemetry_lake.sources import read_bronze, read_raw
from telemetry_lake.streaming import (
    alert_sink, detect, exact_lateness, ingest_bronze, read_checked, rows_dropped_late, run_available, start_detector,
    start_landing,
)

MB = 1_000_000


def texts(spark, path, max_files=1):
    return spark.readStream.option("maxFilesPerTrigger", max_files).text(path)


def sent(ip, minute_second, megabytes):
    return record(src_ip=ip, timestamp=f"2024-01-01T00:{minute_second}Z", bytes_sent=megabytes * MB)


def late_files(folder):
    batches = [
        [sent("A", "00:05", 30), sent("A", "00:15", 30)],
        [sent("B", "05:00", 1)],
        [sent("A", "00:06", 90)],
        [sent("B", "10:00", 1)],
    ]
    for i, batch in enumerate(batches):
        write_lines(f"{folder}/in/{i}.json.gz", batch, at=i)


def test_late_rows_are_dropped(spark, folder):
    late_files(folder)
    with exact_lateness(spark):
        query = run_available(detect(texts(spark, f"{folder}/in")), f"{folder}/out", f"{folder}/cp")
    assert rows_dropped_late(query) == 6
    assert [r.total_bytes for r in spark.read.parquet(f"{folder}/out").collect()] == [60 * MB] * 5


def test_late_rows_lag_one_batch_by_default(spark, folder):
    late_files(folder)
    query = run_available(detect(texts(spark, f"{folder}/in")), f"{folder}/out", f"{folder}/cp")
    assert rows_dropped_late(query) == 1
    assert [r.total_bytes for r in spark.read.parquet(f"{folder}/out").collect()] == [150 * MB] * 5


def test_open_windows_are_not_emitted(spark, folder):
    write_lines(f"{folder}/in/0.json.gz", [sent("A", "00:05", 30), sent("A", "00:15", 30)])
    run_available(detect(texts(spark, f"{folder}/in")), f"{folder}/out", f"{folder}/cp")
    assert spark.read.parquet(f"{folder}/out").count() == 0


def test_bad_lines_do_not_stop_the_detector(spark, folder):
    write_lines(f"{folder}/in/0.json.gz", ["{", sent("A", "00:05", 60), "[]", record(timestamp="?")], at=0)
    write_lines(f"{folder}/in/1.json.gz", [sent("B", "10:00", 1)], at=1)
    run_available(detect(texts(spark, f"{folder}/in")), f"{folder}/out", f"{folder}/cp")
    assert spark.read.parquet(f"{folder}/out").count() == 6


def test_detector_feeds_the_alert_sink(spark, folder):
    for i, batch in enumerate([[sent("A", "00:05", 60)], [sent("A", "20:05", 60)], [sent("B", "59:00", 1)]]):
        write_lines(f"{folder}/in/{i}.json.gz", batch, at=i)
    handle = alert_sink(lambda payload: True, f"{folder}/outbox", f"{folder}/locks")
    start_detector(detect(texts(spark, f"{folder}/in")), handle, f"{folder}/cp", trigger=None).awaitTermination()
    ends = sorted(r.window_end.strftime("%M:%S") for r in spark.read.parquet(f"{folder}/outbox").collect())
    assert ends == ["00:10", "20:10"]


def test_landing_sink_splits_and_resumes(spark, folder):
    good = [record(event_id=f"e{i}") for i in range(5)]
    write_lines(f"{folder}/in/0.json.gz", [*good[:3], "junk", record(src_ip=None)], at=0)
    args = (f"{folder}/ingest", f"{folder}/cp")
    start_landing(texts(spark, f"{folder}/in"), *args, max_records=2, delay=None).awaitTermination()
    write_lines(f"{folder}/in/1.json.gz", good[3:], at=1)
    start_landing(texts(spark, f"{folder}/in"), *args, max_records=2, delay=None).awaitTermination()
    assert sorted(r.event_id for r in read_checked(spark, f"{folder}/ingest").collect()) == [f"e{i}" for i in range(5)]
    rejects = read_checked(spark, f"{folder}/ingest", valid=False).collect()
    assert sorted(r.reject_reasons[0] for r in rejects) == ["not_json", "src_ip: missing"]
    names = [f for f in os.listdir(f"{folder}/ingest/valid=true") if not f.startswith(".")]
    assert names and all(f.endswith(".json.gz") for f in names)
    ingest_bronze(spark, f"{folder}/ingest", f"{folder}/bronze", f"{folder}/cp2", checked=True)
    assert read_bronze(spark, f"{folder}/bronze").count() == 5


def test_landing_sink_runs_on_a_timer_and_stops(spark, folder):
    write_lines(f"{folder}/in/0.json.gz", [record(event_id="x")])
    query = start_landing(texts(spark, f"{folder}/in"), f"{folder}/ingest", f"{folder}/cp", delay="1 second")
    query.processAllAvailable()
    query.stop()
    assert read_checked(spark, f"{folder}/ingest").count() == 1


def test_failed_write_halts_and_loses_nothing(spark, folder):
    write_lines(f"{folder}/in/0.json.gz", [record(event_id="x")])
    seen = []

    def fail_once(df, batch_id):
        seen.append(batch_id)
        if len(seen) == 1:
            raise OSError("disk full")
        df.write.mode("overwrite").parquet(f"{folder}/out/batch={batch_id}")

    def run():
        valid, _ = validate(texts(spark, f"{folder}/in"))
        writer = valid.writeStream.foreachBatch(fail_once).option("checkpointLocation", f"{folder}/cp")
        writer.trigger(availableNow=True).start().awaitTermination()

    with pytest.raises(Exception, match="disk full"):
        run()
    run()
    assert seen == [0, 0]
    assert spark.read.parquet(f"{folder}/out").count() == 1


def test_streaming_dedupe(spark, folder):
    for i in range(2):
        write_lines(f"{folder}/in/{i}.json.gz", [record(event_id="same"), record(event_id=f"own{i}")], at=i)
    rows = read_raw(spark, f"{folder}/in", streaming=True, max_files=1)
    run_available(to_silver(rows, dedupe=True, watermark="1 hour"), f"{folder}/out", f"{folder}/cp")
    assert sorted(r.event_id for r in spark.read.parquet(f"{folder}/out").collect()) == ["own0", "own1", "same"]
    with pytest.raises(ValueError):
        to_silver(rows, dedupe=True)


def test_port_scan_stream(spark, folder):
    scan = [record(dst_port=p, flags=["SYN"], timestamp="2024-01-01T00:00:01Z") for p in range(20, 120)]
    write_lines(f"{folder}/in/0.json.gz", scan, at=0)
    for i in (1, 2):
        write_lines(f"{folder}/in/{i}.json.gz", [record(timestamp=f"2024-01-01T0{i}:00:00Z")], at=i)
    rows = to_silver(
        read_raw(spark, f"{folder}/in", streaming=True, max_files=1),
        columns=["timestamp", "src_ip", "dst_ip", "dst_port", "flags"],
    ).withColumnRenamed("parsed_timestamp", "ts")
    run_available(port_scans(rows), f"{folder}/out", f"{folder}/cp")
    assert [(r.distinct_ports, r.packets) for r in spark.read.parquet(f"{folder}/out").collect()] == [(100, 100)]


def test_rows_of_one_row_group_are_checked_by_several_tasks(spark):
    from conftest import SMALL

    from telemetry_lake.plans.queries import _checked_folder

    assert spark.read.parquet(f"{SMALL}/events.parquet").rdd.getNumPartitions() == 1
    assert len(os.listdir(f"{_checked_folder(spark, SMALL)}/valid=true".replace("file:", ""))) > 4


def test_state_stores_do_not_count_their_rows(spark, folder):
    from telemetry_lake.session import apply_settings

    source = write_lines(f"{folder}/in/a.json.gz", [sent("A", "00:05", 30), sent("B", "00:15", 30)])
    counts = detect(texts(apply_settings(spark), os.path.dirname(source)))
    query = run_available(counts, f"{folder}/out", f"{folder}/checkpoint")
    state = [operator for progress in query.recentProgress for operator in progress["stateOperators"]]
    assert sum(operator["numRowsUpdated"] for operator in state) > 0
    assert all(operator["numRowsTotal"] == 0 for operator in state)

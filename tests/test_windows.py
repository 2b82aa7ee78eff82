import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from telemetry_lake.operators import (
    anomaly_rates, events_per_second, exfil_alerts, label_anomalies, port_scans, sliding_bandwidth,
)

DDL = "ts timestamp, src_ip string, bytes_sent bigint"
START = datetime(2024, 1, 1)


def frame(spark, rows):
    return spark.createDataFrame([(START + timedelta(seconds=s), ip, b) for s, ip, b in rows], DDL)


def key(r):
    return (r.src_ip, r.window_start, r.window_end, r.total_bytes, r.packet_count, r.avg_bytes_per_sec)


@pytest.mark.parametrize("second, first_start", [(0, -50), (9.999, -50), (10, -40), (59.999, 0)])
def test_six_windows_start_included_end_excluded(spark, second, first_start):
    for panes in (True, False):
        got = sorted(key(r) for r in sliding_bandwidth(frame(spark, [(second, "a", 60)]), panes=panes).collect())
        starts = [START + timedelta(seconds=first_start + 10 * i) for i in range(6)]
        assert [g[1] for g in got] == starts
        assert all(g[2] - g[1] == timedelta(seconds=60) and g[3:] == (60, 1, 1.0) for g in got)


def test_threshold_is_strict(spark):
    rows = [(0, f"ip{b}", b) for b in (49_999_999, 50_000_000, 50_000_001)]
    alerts = exfil_alerts(frame(spark, rows)).collect()
    assert {a.src_ip for a in alerts} == {"ip50000001"} and len(alerts) == 6
    assert alerts[0].message == "DATA EXFILTRATION DETECTED! IP: ip50000001 transferred 50000001 bytes in 60s."


def test_panes_equal_direct_and_a_simple_loop(spark):
    rng = random.Random(7)
    rows = [(rng.randrange(0, 600), rng.choice("aaaaab"), rng.randrange(1000)) for _ in range(800)] + [(5, "z", None)]
    df = frame(spark, rows)
    panes = sorted(key(r) for r in sliding_bandwidth(df, panes=True).collect())
    direct = sorted(key(r) for r in sliding_bandwidth(df, panes=False).collect())
    expected = {}
    for s, ip, b in rows:
        for start in range(s // 10 * 10 - 50, s // 10 * 10 + 1, 10):
            total, n = expected.get((ip, start), (0, 0))
            expected[ip, start] = (total + (b or 0), n + 1)
    assert panes == direct
    assert {(k[0], (k[1] - START).total_seconds()): k[3:5] for k in panes} == expected
    assert sum(k[3] for k in panes) == 6 * sum(b or 0 for _, _, b in rows)


def test_rows_without_time_or_source_are_left_out(spark):
    df = frame(spark, [(0, "a", 1), (0, None, 1)]).unionByName(frame(spark, [(0, "a", 1)]).withColumn("ts", F.lit(None).cast("timestamp")))
    assert sliding_bandwidth(df).agg(F.sum("packet_count")).first()[0] == 6
    with pytest.raises(ValueError):
        sliding_bandwidth(df, "60 seconds", "7 seconds", panes=True)


def test_partial_sums_happen_before_the_shuffle(spark):
    plan = sliding_bandwidth(frame(spark, [(0, "a", 1)]))._jdf.queryExecution().executedPlan().toString()
    first = plan.rindex("Exchange")
    assert "partial_sum" in plan[first:]


def test_events_per_second(spark):
    got = {(r.second - START).total_seconds(): r.events for r in events_per_second(frame(spark, [(0, "a", 1), (0.9, "b", 1), (1, "a", 1)])).collect()}
    assert got == {0: 2, 1: 1}


LABEL_DDL = (
    "ts timestamp, src_ip string, dst_ip string, dst_port int, protocol string, bytes_sent bigint, latency_ms int, "
    "flags array<string>, app_layer struct<status_code:int>"
)


def labelled(spark, rows):
    return spark.createDataFrame([(START, "s", "d", *r) for r in rows], LABEL_DDL)


def test_labels(spark):
    rows = [
        (443, "TCP", 100, 49, ["ACK"], (200,)),
        (443, "TCP", 100, 1_999, ["ACK"], (499,)),
        (443, "TCP", 100, 2_000, ["ACK"], (200,)),
        (53, "UDP", 10_000_000, 10, ["ACK"], (200,)),
        (53, "TCP", 10_000_000, 10, ["ACK"], (200,)),
        (443, "TCP", 1, 10, ["RST", "ACK"], (200,)),
        (443, "TCP", 1, 10, ["ACK"], (500,)),
        (53, "UDP", 20_000_000, 3_000, ["RST", "ACK"], (503,)),
        (None, None, None, None, None, None),
    ]
    got = [r.labels for r in label_anomalies(labelled(spark, rows)).collect()]
    assert got == [
        [], [], ["latency_spike"], ["exfiltration"], [], ["connection_reset"], ["connection_reset"],
        ["latency_spike", "exfiltration", "connection_reset"], [],
    ]
    rates = anomaly_rates(labelled(spark, rows)).first()
    assert rates.events == 9
    assert rates.connection_reset_rate == pytest.approx(3 / 9)


def test_port_scan(spark):
    scan = [(port, "TCP", 64, 2, ["SYN"], (0,)) for port in range(20, 120)]
    repeat = [(20, "TCP", 64, 2, ["SYN"], (0,))] * 50
    busy = [(port, "TCP", 64, 2, ["SYN", "ACK"], (0,)) for port in range(200, 400)]
    few = labelled(spark, scan[:5]).withColumn("src_ip", F.lit("other"))
    found = port_scans(labelled(spark, scan + repeat + busy).unionByName(few)).collect()
    assert [(r.src_ip, r.distinct_ports, r.packets) for r in found] == [("s", 100, 150)]
    assert port_scans(labelled(spark, scan), min_ports=101).count() == 0

import json
import os
import random
import time
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from telemetry_lake.operators import new_locks, throttle, unlocked
from telemetry_lake.operators.throttle import LOCKS, chain, throttle_batch
from telemetry_lake.sinks import to_outbox
from telemetry_lake.sources import read_table
from telemetry_lake.streaming import alert_sink, run_available, throttle_stream

START = datetime(2024, 1, 1)
DDL = "src_ip string, window_end timestamp, total_bytes bigint, message string"
SECONDS = [0, 10, 890, 900, 910, 1799, 1800]


def alerts(spark, seconds, ip="a"):
    rows = [(ip, START + timedelta(seconds=s), 60_000_000, f'say "{s}"') for s in seconds]
    return spark.createDataFrame(rows, DDL)


def at(df):
    return sorted((r.src_ip, int((r.window_end - START).total_seconds())) for r in df.collect())


def test_fires(spark):
    assert at(throttle(alerts(spark, SECONDS))) == [("a", 0), ("a", 900), ("a", 1800)]


def test_failed_delivery_does_not_lock(spark):
    tried = alerts(spark, SECONDS).withColumn("delivered", F.col("window_end") > START)
    sent = throttle(tried, delivered="delivered")
    assert at(sent) == [("a", 0), ("a", 10), ("a", 910)]
    assert at(sent.filter("delivered")) == [("a", 10), ("a", 910)]


def test_equal_times_fire_once(spark):
    assert at(throttle(alerts(spark, [5, 5, 5]))) == [("a", 5)]


def test_many_sources_against_a_simple_loop(spark):
    rng = random.Random(3)
    rows = [(f"ip{rng.randrange(5) * rng.randrange(2)}", rng.randrange(40_000), rng.random() < 0.6) for _ in range(3_000)]
    rows = list({(ip, t): ok for ip, t, ok in rows}.items())
    df = spark.createDataFrame([(ip, START + timedelta(seconds=t), ok) for (ip, t), ok in rows], "src_ip string, window_end timestamp, ok boolean")
    expected, last = [], {}
    for (ip, t), ok in sorted(rows):
        if ip not in last or t - last[ip] >= 900:
            expected.append((ip, t))
            if ok:
                last[ip] = t
    assert at(throttle(df.repartition(7), delivered="ok")) == sorted(expected)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        assert at(throttle(df, delivered="ok")) == sorted(expected)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_lock_check(spark):
    locks = spark.createDataFrame([("a", START)], LOCKS)
    both = alerts(spark, SECONDS).unionByName(alerts(spark, [10], "b"))
    assert at(unlocked(both, locks)) == [("a", 900), ("a", 910), ("a", 1799), ("a", 1800), ("b", 10)]


def test_stream_equals_batch(spark, folder):
    rng = random.Random(5)
    rows = [(f"ip{rng.randrange(3)}", START + timedelta(seconds=10 * rng.randrange(1_000))) for _ in range(400)]
    df = spark.createDataFrame(sorted(set(rows), key=lambda r: r[1]), "src_ip string, window_end timestamp")
    schema = df.schema
    parts = [df.filter(F.col("window_end") < START + timedelta(seconds=4_000)), df.filter(F.col("window_end") >= START + timedelta(seconds=4_000))]
    for i, part in enumerate(parts):
        part.coalesce(1).write.mode("append").parquet(f"{folder}/in")
        stream = spark.readStream.schema(schema).parquet(f"{folder}/in")
        run_available(throttle_stream(stream), f"{folder}/out", f"{folder}/cp")
    assert at(spark.read.parquet(f"{folder}/out")) == at(throttle(df))


def test_alerts_in_any_order_wait_for_the_watermark(spark, folder):
    rng = random.Random(6)
    rows = sorted({(f"ip{rng.randrange(3)}", 10 * rng.randrange(1_000)) for _ in range(400)})
    rng.shuffle(rows)
    df = spark.createDataFrame([(ip, START + timedelta(seconds=t)) for ip, t in rows], "src_ip string, window_end timestamp")
    parts = [df.filter(F.col("window_end") >= START + timedelta(seconds=6_000)), df.filter(F.col("window_end") < START + timedelta(seconds=6_000)),
             spark.createDataFrame([("end", START + timedelta(days=9))], df.schema), spark.createDataFrame([("late", START)], df.schema)]
    for part in parts:
        part.coalesce(1).write.mode("append").parquet(f"{folder}/in")
        stream = spark.readStream.schema(df.schema).parquet(f"{folder}/in")
        run_available(throttle_stream(stream, lateness="3 hours"), f"{folder}/out", f"{folder}/cp")
    # What comes before a source's alerts in time was read after them; the last two alerts are not due, or too late.
    assert at(spark.read.parquet(f"{folder}/out")) == at(throttle(df))


def test_a_hundred_thousand_alerts_of_one_source(spark, folder):
    n = 100_000
    df = spark.range(n).select(F.lit("a").alias("src_ip"), F.timestamp_seconds(F.lit(1_704_067_200) + F.col("id") * 10 % (10 * n)).alias("window_end"))
    df.repartition(1).write.parquet(f"{folder}/in")
    began = time.time()
    run_available(throttle_stream(spark.readStream.schema(df.schema).parquet(f"{folder}/in")), f"{folder}/out", f"{folder}/cp")
    assert time.time() - began < 60
    sent = at(spark.read.parquet(f"{folder}/out"))
    assert sent == [("a", t) for t in range(0, 10 * n, 900)] == at(throttle(df))


def test_chain_equals_a_simple_loop():
    rng = np.random.default_rng(4)
    for _ in range(300):
        clocks = np.sort(rng.integers(0, 60, rng.integers(0, 40)))
        ok, hold, fired = rng.random(len(clocks)) < rng.choice([0.2, 0.8, 1.0]), int(rng.integers(1, 12)), rng.choice([None, -3])
        expected, last = [], fired
        for clock, good in zip(clocks.tolist(), ok.tolist(), strict=True):
            expected.append(last is None or clock - last >= hold)
            if expected[-1] and good:
                last = clock
        attempted, locked = chain(clocks, ok, hold, fired)
        assert attempted.tolist() == expected and locked == last


def test_alerts_without_a_clock_are_not_sent(spark):
    df = spark.createDataFrame([("a", None), ("a", START), (None, START), (None, START)], "src_ip string, window_end timestamp")
    assert at(throttle(df).filter("src_ip IS NOT NULL")) == [("a", 0)] and throttle(df).count() == 2


def test_batches_outside_of_a_stream_name_their_query(spark, folder):
    with pytest.raises(ValueError):
        alert_sink(lambda payload: True, f"{folder}/outbox", f"{folder}/locks")(alerts(spark, [0]), 0)


def test_delivery_on_the_executors(spark):
    locks = spark.createDataFrame([], LOCKS)

    def refuse_first(payload):
        return "say \\\"0\\\"" not in payload

    tried = throttle_batch(locks, to_outbox(alerts(spark, SECONDS)), refuse_first).cache()
    assert sorted((int((r.window_end - START).total_seconds()), r.delivered) for r in tried.collect()) == [(0, False), (10, True), (910, True)]
    assert [(r.src_ip, (r.fired_at - START).total_seconds()) for r in new_locks(tried).collect()] == [("a", 910)]


def test_payload_is_valid_json(spark):
    row = to_outbox(alerts(spark, [0])).first()
    assert json.loads(row.payload) == {"content": '🚨 **say "0"**'}
    assert (row.lock_key, row.status) == ("alert:throttle:a", "pending")


def test_sink_keeps_locks_between_batches_and_survives_a_rerun(spark, folder):
    log = f"{folder}/posts"
    os.makedirs(log)

    def deliver(payload):
        import uuid

        with open(f"{log}/{uuid.uuid4().hex}", "w") as out:
            out.write(payload)
        return True

    handle = alert_sink(deliver, f"{folder}/outbox", f"{folder}/locks", query="q")
    handle(alerts(spark, [0, 10, 890]), 0)
    handle(alerts(spark, [900, 910, 1799, 1800]), 1)
    handle(alerts(spark, [900, 910, 1799, 1800]), 1)
    handle(alerts(spark, [1810]), 2)
    assert at(spark.read.parquet(f"{folder}/outbox")) == [("a", 0), ("a", 900), ("a", 1800)]
    assert len(os.listdir(log)) == 3
    lock = read_table(spark, f"{folder}/locks").first()
    assert (lock.fired_at - START).total_seconds() == 1800


def test_a_new_checkpoint_does_not_hide_alerts_and_locks_run_out(spark, folder):
    handle = alert_sink(lambda payload: True, f"{folder}/outbox", f"{folder}/locks", query="first")
    handle(alerts(spark, [0]), 0)
    handle = alert_sink(lambda payload: True, f"{folder}/outbox", f"{folder}/locks", query="second")
    handle(alerts(spark, [5000]), 0)
    assert at(spark.read.parquet(f"{folder}/outbox")) == [("a", 0), ("a", 5000)]
    handle(alerts(spark, []), 1)
    assert not os.path.exists(f"{folder}/outbox/query=second/batch=1")
    other = alerts(spark, [9000]).withColumn("src_ip", F.lit("b"))
    handle(other, 2)
    assert [r.src_ip for r in read_table(spark, f"{folder}/locks").collect()] == ["b"]


def test_failing_delivery_is_retried_by_the_next_alert(spark, folder):
    def never(payload):
        return False

    handle = alert_sink(never, f"{folder}/outbox", f"{folder}/locks", query="q")
    handle(alerts(spark, [0, 10]), 0)
    rows = spark.read.parquet(f"{folder}/outbox").collect()
    assert [r.delivered for r in rows] == [False, False]
    assert read_table(spark, f"{folder}/locks", schema=LOCKS).count() == 0


def test_broken_delivery_stops_the_batch(spark, folder):
    def explode(payload):
        raise OSError("no route")

    handle = alert_sink(explode, f"{folder}/outbox", f"{folder}/locks", query="q")
    with pytest.raises(Exception, match="no route"):
        handle(alerts(spark, [0]), 0)
    assert read_table(spark, f"{folder}/locks", schema=LOCKS).count() == 0


def test_delivery_client_is_opened_and_closed_per_task(spark, folder):
    class Client:
        def open(self):
            self.mark("open")

        def close(self):
            self.mark("close")

        def __call__(self, payload):
            self.mark("post")
            return True

        def mark(self, what):
            with open(f"{folder}/calls", "a") as out:
                out.write(what + "\n")

    locks = spark.createDataFrame([], LOCKS)
    tried = throttle_batch(locks, to_outbox(alerts(spark, SECONDS)), Client()).coalesce(1)
    tried.write.parquet(f"{folder}/out")
    calls = open(f"{folder}/calls").read().split()
    assert calls.count("open") == calls.count("close") and calls.count("post") == 3
    assert calls.index("open") < calls.index("post") < len(calls) - 1 - calls[::-1].index("close")

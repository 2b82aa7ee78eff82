"""Time the headline queries and print one JSON line.

BENCH_SF_DIR    folder of the tables (default /root/testdata/sf0.1)
BENCH_CPUS      local threads (default 8)
BENCH_COPIES    how many time-identical copies of the events to work on (default 1); each copy has
                its own sources, so 320 copies of sf0.1 make a backlog of 32 million records
BENCH_REPEATS   timed runs after the warm-up (default 3)
BENCH_ONLY      comma-separated names to run
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telemetry_lake import build_session, scratch_dir
from telemetry_lake.operators import (
    anomaly_rates, check_records, daily_ip_traffic, events_per_second, exfil_alerts, historical_features,
    materialize, online_features, parse_events, port_scans, sliding_bandwidth, throttle, to_gold, to_silver,
    top_per_day, top_talkers,
)
from telemetry_lake.plans.queries import HOLD, QUERIES, REFS, SCAN_MIN, SCAN_WINDOW, SIZE, SLIDE
from telemetry_lake.schema import TELEMETRY
from telemetry_lake.sinks import write_landing, write_silver
from telemetry_lake.sources import as_telemetry, read_bronze, read_events, read_raw, read_silver
from telemetry_lake.streaming import ingest_bronze

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
COPIES = int(os.environ.get("BENCH_COPIES", "1"))
ONLY = [name for name in os.environ.get("BENCH_ONLY", "").split(",") if name]
REPEATS = int(os.environ.get("BENCH_REPEATS", "3"))
LANDING_FILE_ROWS = 10_000


def drain(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = build_session(
        "bench", f"local[{CPUS}]", spark__ui__enabled="false", spark__driver__memory="20g",
        spark__sql__shuffle__partitions=str(int(CPUS) * max(1, COPIES // 40)),
    )
    spark.sparkContext.setLogLevel("ERROR")
    base = scratch_dir(spark, "bench")

    events = read_events(spark, SF_DIR)
    if COPIES > 1:
        people = events.agg(F.max("user_id")).first()[0] + 1
        copy = F.explode(F.sequence(F.lit(0), F.lit(COPIES - 1)))
        events = events.repartition(int(CPUS) * 8).withColumn("copy", copy)
        events = events.withColumn("user_id", F.col("user_id") + F.col("copy") * people)
        events = events.withColumn("event_id", F.col("event_id") * COPIES + F.col("copy")).drop("copy")
        events.write.parquet(f"{base}/events")
        events = spark.read.parquet(f"{base}/events")
    records = as_telemetry(events)

    # The layers the queries read, written once.
    raw, silver_path = f"{base}/ingest", f"{base}/silver"
    write_landing(records.select(*TELEMETRY.fieldNames()), raw, LANDING_FILE_ROWS)
    write_silver(to_silver(records), silver_path)
    silver = read_silver(spark, silver_path)
    lines = spark.read.text(raw)
    view = daily_ip_traffic(silver)
    spine = records.filter(F.col("app_layer.host").isin("error", "signup")).select(
        F.col("ts").alias("event_timestamp"), "src_ip"
    )
    latest = materialize(view, "2024-01-01", "2024-02-01")
    asked = spine.select("src_ip").distinct()
    runs = iter(range(1_000))

    def catch_up() -> None:
        n = next(runs)
        ingest_bronze(spark, raw, f"{base}/bronze{n}", f"{base}/checkpoint{n}")

    checked, parsed = check_records(lines), parse_events(lines)[0]
    one_day = read_silver(spark, silver_path, "2024-01-15", "2024-01-15")
    alerts = exfil_alerts(records, size=SIZE, slide=SLIDE)
    tasks = {
        "top_talkers_raw_json": lambda: drain(top_talkers(read_raw(spark, raw))),
        "top_talkers_silver": lambda: drain(top_talkers(silver)),
        "top_talkers_silver_day": lambda: drain(top_talkers(one_day)),
        "ingest_validate": lambda: drain(checked),
        "detector_parse": lambda: drain(parsed),
        "bronze_catch_up": catch_up,
        "bronze_to_silver": lambda: write_silver(
            to_silver(read_bronze(spark, f"{base}/bronze0")), f"{base}/silver_again"
        ),
        "silver_to_gold": lambda: drain(to_gold(silver)),
        "top10_per_day": lambda: drain(top_per_day(to_gold(silver))),
        "sliding_direct": lambda: drain(sliding_bandwidth(records, SIZE, SLIDE, panes=False)),
        "sliding_panes": lambda: drain(sliding_bandwidth(records, SIZE, SLIDE)),
        "exfil_alerts": lambda: drain(alerts),
        "alert_throttle": lambda: drain(throttle(alerts, seconds=HOLD)),
        "pit_features": lambda: drain(historical_features(spine, REFS, [view])),
        "pit_features_bucketed": lambda: drain(
            historical_features(spine, REFS, [view], slice_width="1 day", prune=False)
        ),
        "materialize_latest": lambda: drain(latest),
        "online_lookup": lambda: drain(
            online_features(asked, REFS, [view], {view.name: latest}, as_of=F.lit("2024-01-31").cast("timestamp"))
        ),
        "eps": lambda: drain(events_per_second(records)),
        "anomaly_rates": lambda: drain(anomaly_rates(records, "1 hour")),
        "port_scan": lambda: drain(port_scans(records, SCAN_WINDOW, SCAN_MIN)),
        "exfil_alerts_stream": lambda: drain(QUERIES["exfil_alerts_stream"](spark, SF_DIR)),
    }
    seconds = {}
    for name, task in tasks.items():
        if ONLY and name not in ONLY:
            continue
        times = []
        for _ in range(1 + REPEATS):
            start = time.perf_counter()
            task()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times[1:] or times), 3)
        print(f"{name:24} {seconds[name]:8.3f} s", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "sum of median query times",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
                "copies": COPIES,
            }
        ),
        flush=True,
    )
    spark.stop()


if __name__ == "__main__":
    main()

"""Named queries over the ``events`` table seen as telemetry.

Each takes (spark, folder of the tables) and returns a frame over all rows of the table. The
data is sparse, at most a few events per source and hour, so windows are a day long and slide
by four hours: the same six-fold overlap as the detector's 60 and 10 seconds.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import StreamingQueryException

from telemetry_lake.functions import (
    epoch_millis,
    epoch_timestamp,
    event_timestamp,
    iso_utc,
    json_lines,
    lock_key,
    shift,
    utf8,
)
from telemetry_lake.operators import (
    FeatureView,
    Field,
    anomalous_daily,
    anomaly_rates,
    check_records,
    daily_ip_traffic,
    events_per_second,
    exfil_alerts,
    historical_features,
    label_anomalies,
    materialize,
    materialize_views,
    online_features,
    port_scans,
    sliding_bandwidth,
    throttle,
    to_gold,
    to_silver,
    top_ip_days,
    top_per_day,
    top_talkers,
    unlocked,
    validate,
    view_of,
    write_online,
)
from telemetry_lake.operators.features import SRC_IP
from telemetry_lake.schema import TELEMETRY
from telemetry_lake.session import apply_settings, scratch_dir
from telemetry_lake.sinks import to_outbox, upsert_gold, write_gold, write_landing, write_silver
from telemetry_lake.sources.landing import housekeeping, landing_folder
from telemetry_lake.sources import (
    as_telemetry,
    read_bronze,
    read_events,
    read_gold,
    read_raw,
    read_silver,
    read_table,
    stream_events,
    telemetry,
)
from telemetry_lake.streaming import (
    alert_sink,
    detect,
    ingest_bronze,
    exact_lateness,
    read_checked,
    replay,
    run_available,
    run_counting_late_rows,
    start_landing,
    stored_records,
    throttle_stream,
)

SIZE, SLIDE = "24 hours", "4 hours"
HOLD = 8 * 3_600
SCAN_WINDOW, SCAN_MIN = "1 day", 3
REFS = ["daily_ip_traffic:bytes_sent", "daily_ip_traffic:latency_ms"]
LANDING_FILE_ROWS = 100_000

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    """Register a query; its timestamps leave as wall-clock UTC without a zone."""

    def register(build: Callable[[SparkSession, str], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            df = build(apply_settings(spark), sf_dir)
            zoned = [f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampType)]
            return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in zoned})

        QUERIES[name] = run
        return build

    return register


# ---- parsing and validation -------------------------------------------------------------


def flat(df: DataFrame) -> DataFrame:
    """Nested fields as plain columns, for comparison."""
    return df.select(
        "timestamp", "event_id", "src_ip", "dst_ip", "src_port", "dst_port", "protocol", "bytes_sent",
        "bytes_received", "latency_ms", "packets_sent",
        F.array_join("flags", ",").alias("flags"),
        F.col("app_layer.protocol").alias("app_protocol"),
        F.col("app_layer.method").alias("method"),
        F.col("app_layer.host").alias("host"),
        F.col("app_layer.status_code").alias("status_code"),
        F.col("tags.env").alias("env"),
        F.col("tags.region").alias("region"),
        F.col("tags.security_group").alias("security_group"),
    )


def wire_lines(records: DataFrame) -> DataFrame:
    """Telemetry as JSON text in which some records, told by their source port, are defective."""
    text = F.to_json(F.struct(*TELEMETRY.fieldNames()))
    k = F.col("src_port") - 1024

    def swap(pattern: str, by: str | Column) -> Column:
        return F.regexp_replace(text, F.lit(pattern), F.lit(by) if isinstance(by, str) else by)

    sent = '"bytes_sent":([0-9]+)'
    stamp = '"timestamp":"[^"]*"'
    epoch = F.concat(F.lit('"timestamp":'), F.unix_seconds("ts").cast("string"))
    line = (
        F.when(k == 0, F.concat(F.lit("not json "), F.col("event_id")))
        .when(k == 1, swap('"src_ip":"[^"]*",', ""))
        .when(k == 2, swap(sent, '"bytes_sent":null'))
        .when(k == 3, swap('"src_ip":"[^"]*"', '"src_ip":12'))
        .when(k == 4, swap(sent, '"bytes_sent":"$1"'))
        .when(k == 5, swap(sent, '"bytes_sent":$1.5'))
        .when(k == 6, swap(r'"flags":\[[^\]]*\]', '"flags":[1]'))
        .when(k == 7, swap(',"status_code":[0-9]+', ""))
        .when(k == 8, swap(r"^\{", '{"extra":1,'))
        .when(k == 9, swap(stamp, '"timestamp":"yesterday"'))
        .when(k == 10, swap(stamp, epoch))
        .when(k == 11, swap(r',"tags":\{[^}]*\}', ""))
        .otherwise(text)
    )
    return records.select(line.alias("value"))


def reject_rows(rejects: DataFrame) -> DataFrame:
    return rejects.select(
        F.regexp_extract("raw", r'(?:"event_id":"|not json )([0-9]+)', 1).alias("event_id"),
        F.array_join("reject_reasons", "; ").alias("reasons"),
    )


@query("telemetry_view")
def telemetry_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat(telemetry(spark, sf_dir))


@query("ingest_valid")
def ingest_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat(validate(wire_lines(telemetry(spark, sf_dir)))[0])


@query("ingest_rejects")
def ingest_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reject_rows(validate(wire_lines(telemetry(spark, sf_dir)))[1])


@query("ingest_rejects_strict")
def ingest_rejects_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reject_rows(validate(wire_lines(telemetry(spark, sf_dir)), mode="strict")[1])


@query("reject_reason_counts")
def reject_reason_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = check_records(wire_lines(telemetry(spark, sf_dir)))
    reasons = checked.select(F.explode("reject_reasons").alias("reason"))
    return reasons.groupBy("reason").agg(F.count("*").alias("records"))


def _checked_folder(spark: SparkSession, sf_dir: str) -> str:
    base = scratch_dir(spark, "landing")
    events = stream_events(spark, sf_dir, read_events(spark, sf_dir).schema)
    # Dealt evenly: a file of few row groups would have its rows checked by as few tasks.
    events = events.repartition(3 * spark.sparkContext.defaultParallelism)
    lines = wire_lines(as_telemetry(events))
    start_landing(
        lines, f"{base}/ingest", f"{base}/checkpoint", max_records=LANDING_FILE_ROWS, delay=None
    ).awaitTermination()
    return f"{base}/ingest"


@query("landing_stream")
def landing_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat(read_checked(spark, _checked_folder(spark, sf_dir)))


@query("landing_stream_rejects")
def landing_stream_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reject_rows(read_checked(spark, _checked_folder(spark, sf_dir), valid=False))


@query("landing_restart")
def landing_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A landing stream that is stopped between micro-batches, fails in the middle of writing, and is run again."""
    base, records = scratch_dir(spark, "restart"), telemetry(spark, sf_dir)
    middle = F.col("ts") < F.lit("2024-01-16").cast("timestamp")
    place = (f"{base}/ingest", f"{base}/checkpoint")

    def land(part: Column) -> None:
        wire_lines(records.filter(part)).write.mode("append").text(f"{base}/in")

    land(middle)
    lines = spark.readStream.text(f"{base}/in")
    running = start_landing(lines, *place, max_records=LANDING_FILE_ROWS, delay="1 second")
    running.processAllAvailable()
    running.stop()
    land(~middle)
    bad = F.when(F.col("value").contains('"src_port":1044'), F.raise_error(F.lit("disk full")).cast("string"))
    try:
        start_landing(lines.select(bad.otherwise(F.col("value")).alias("value")), *place, delay=None).awaitTermination()
    except StreamingQueryException:
        pass
    else:
        raise RuntimeError("the failing run was expected to fail")
    start_landing(lines, *place, max_records=LANDING_FILE_ROWS, delay=None).awaitTermination()
    return flat(read_checked(spark, f"{base}/ingest"))


@contextmanager
def _cleaning_at_once(spark: SparkSession) -> Iterator[None]:
    """Clean landing files within the micro-batch that follows them, not in a thread of its own."""
    name = "spark.sql.streaming.fileSource.cleaner.numThreads"
    before = spark.conf.get(name, "1")
    spark.conf.set(name, "0")
    try:
        yield
    finally:
        spark.conf.set(name, before)


@query("landing_archived")
def landing_archived(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three landings of ten days, each taken into Bronze: files of the first two have moved to the archive."""
    base, records = scratch_dir(spark, "archived"), telemetry(spark, sf_dir)
    day = F.dayofmonth("ts")
    for hour, part in enumerate((day <= 10, (day > 10) & (day <= 20), day > 20)):
        folder = landing_folder(f"{base}/ingest", datetime(2024, 2, 1, hour))
        write_landing(records.filter(part).select(*TELEMETRY.fieldNames()), folder, LANDING_FILE_ROWS)
        with _cleaning_at_once(spark):
            ingest_bronze(
                spark, f"{base}/ingest", f"{base}/bronze", f"{base}/checkpoint",
                keeping=housekeeping(archive=f"{base}/archive", max_age="7d"),
            )
    places = read_raw(spark, f"{base}/archive").select("event_id", F.lit(True).alias("archived")).unionByName(
        read_raw(spark, f"{base}/ingest").select("event_id", F.lit(False).alias("archived"))
    )
    bronze = stored_records(read_bronze(spark, f"{base}/bronze"))
    return bronze.select("event_id", "src_ip", "bytes_sent").join(places, "event_id")


@query("scalar_functions")
def scalar_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Time, text and JSON expressions side by side."""
    t = telemetry(spark, sf_dir)
    epoch = F.unix_seconds("ts").cast("string")
    return t.select(
        "event_id",
        event_timestamp(F.col("timestamp")).alias("from_iso"),
        event_timestamp(epoch).alias("from_epoch"),
        epoch_timestamp(epoch_millis(F.col("ts")).cast("string")).alias("from_millis"),
        event_timestamp(F.col("event_id")).alias("from_id"),
        event_timestamp(F.col("src_ip")).alias("from_text"),
        iso_utc(F.col("ts")).alias("iso"),
        epoch_millis(F.col("ts")).alias("millis"),
        shift(F.col("ts"), "15 minutes", back=True).alias("quarter_before"),
        lock_key(F.col("src_ip")).alias("lock_key"),
        utf8(F.encode(F.col("app_layer.host"), "UTF-8")).alias("decoded"),
    )


@query("json_records")
def json_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records as the JSON text a queue would carry."""
    columns = ["timestamp", "event_id", "src_ip", "bytes_sent", "flags", "tags"]
    return json_lines(telemetry(spark, sf_dir), columns)


# ---- landing, Bronze, Silver, Gold ------------------------------------------------------


def _landed(spark: SparkSession, records: DataFrame, purpose: str) -> str:
    path = f"{scratch_dir(spark, purpose)}/ingest"
    write_landing(records.select(*TELEMETRY.fieldNames()), path, LANDING_FILE_ROWS)
    return path


@query("raw_json_roundtrip")
def raw_json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat(read_raw(spark, _landed(spark, telemetry(spark, sf_dir), "roundtrip")))


@query("bronze_incremental")
def bronze_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half the month lands and is ingested, then the rest; a last run finds nothing new."""
    records = telemetry(spark, sf_dir)
    base = scratch_dir(spark, "bronze")
    middle = F.col("ts") < F.lit("2024-01-16").cast("timestamp")
    for part in (middle, ~middle):
        rows = records.filter(part).select(*TELEMETRY.fieldNames())
        write_landing(rows, f"{base}/ingest", LANDING_FILE_ROWS)
        ingest_bronze(spark, f"{base}/ingest", f"{base}/bronze", f"{base}/checkpoint")
    ingest_bronze(spark, f"{base}/ingest", f"{base}/bronze", f"{base}/checkpoint")
    return flat(stored_records(read_bronze(spark, f"{base}/bronze")))


@query("silver")
def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_silver(telemetry(spark, sf_dir))


@query("silver_dedupe")
def silver_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every record arrives again unchanged, as after a repeated upload, and once more with a later time and other
    numbers; the earliest copy stays."""
    records = telemetry(spark, sf_dir)
    later = records.withColumn("timestamp", iso_utc(shift(F.col("ts"), "1 hour"))).withColumn("bytes_sent", F.col("bytes_sent") + 1)
    return to_silver(later.unionByName(records).unionByName(records), dedupe=True)


def _silver_table(spark: SparkSession, sf_dir: str) -> str:
    path = f"{scratch_dir(spark, 'silver')}/silver"
    write_silver(to_silver(telemetry(spark, sf_dir)), path)
    return path


@query("silver_partition_prune")
def silver_partition_prune(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_silver(spark, _silver_table(spark, sf_dir), "2024-01-10", "2024-01-16")


@query("silver_dynamic_overwrite")
def silver_dynamic_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One day is rewritten with doubled byte counts; the other days stay as they are."""
    path = _silver_table(spark, sf_dir)
    day = to_silver(telemetry(spark, sf_dir)).filter("year = 2024 AND month = 1 AND day = 15")
    write_silver(day.withColumn("bytes_sent", F.col("bytes_sent") * 2), path, mode="dynamic")
    return read_silver(spark, path)


@query("gold_daily_ip")
def gold_daily_ip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_gold(to_silver(telemetry(spark, sf_dir)))


@query("gold_upsert")
def gold_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold up to the 15th, then an upsert of doubled totals from the 10th on."""
    path = f"{scratch_dir(spark, 'gold')}/gold"
    daily = to_gold(to_silver(telemetry(spark, sf_dir)))
    write_gold(daily.filter("day <= 15"), path)
    doubled = F.col("total_bytes_transferred") * 2
    upsert_gold(daily.filter("day >= 10").withColumn("total_bytes_transferred", doubled), path)
    return read_gold(spark, path)


@query("lake_gold")
def lake_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All layers from landing files to Gold."""
    from telemetry_lake.plans.medallion import refine_lake

    raw = _landed(spark, telemetry(spark, sf_dir), "lake")
    return refine_lake(spark, raw, raw.rsplit("/", 1)[0] + "/lake")


@query("lake_daily_refresh")
def lake_daily_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tenth of the records lands late, a fifth a second time; then the days from the 10th to the 20th are refreshed."""
    from telemetry_lake.plans.medallion import refine_lake, refresh_days

    records, base = telemetry(spark, sf_dir), scratch_dir(spark, "refresh")
    late, again = F.col("event_id").endswith("7"), F.col("event_id").rlike("[37]$")
    for part in (~late, again):
        write_landing(records.filter(part).select(*TELEMETRY.fieldNames()), f"{base}/ingest", LANDING_FILE_ROWS)
        if part is not again:
            refine_lake(spark, f"{base}/ingest", f"{base}/lake", dedupe=True)
    ingest_bronze(spark, f"{base}/ingest", f"{base}/lake/bronze", f"{base}/lake/checkpoints/bronze")
    return refresh_days(spark, None, f"{base}/lake", "2024-01-10", "2024-01-20")


@query("lake_touched_refresh")
def lake_touched_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two nights: all but the late records, then the late ones of ten days together with a second upload of others.

    The second night finds the days by itself, de-duplicates as the first did, and leaves the lake as a whole rebuild would.
    """
    from telemetry_lake.plans.medallion import refine_lake, refresh_touched_days

    records, base = telemetry(spark, sf_dir), scratch_dir(spark, "nights")
    day, last = F.dayofmonth("ts"), F.substring("event_id", -1, 1)
    late = (last == "7") & day.between(11, 20)
    again = (last == "3") & day.between(15, 22)

    def land(part: Column) -> None:
        write_landing(records.filter(part).select(*TELEMETRY.fieldNames()), f"{base}/ingest", LANDING_FILE_ROWS)

    land(~late)
    refine_lake(spark, f"{base}/ingest", f"{base}/lake", dedupe=True)
    land(late | again)
    return refresh_touched_days(spark, f"{base}/ingest", f"{base}/lake")


@query("top_ip_days")
def top_ip_day_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_ip_days(to_gold(to_silver(telemetry(spark, sf_dir))))


@query("top_talkers")
def top_talker_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_talkers(to_silver(telemetry(spark, sf_dir)))


@query("top_talkers_raw_json")
def top_talkers_raw_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_talkers(read_raw(spark, _landed(spark, telemetry(spark, sf_dir), "talkers")))


@query("top10_per_day")
def top10_per_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_per_day(to_gold(to_silver(telemetry(spark, sf_dir))))


@query("top10_anomalous_per_day")
def top10_anomalous_per_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = to_silver(telemetry(spark, sf_dir), columns=TELEMETRY.fieldNames())
    return top_per_day(anomalous_daily(rows), measure="anomalies")


# ---- windows and alerts -----------------------------------------------------------------


def _alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exfil_alerts(telemetry(spark, sf_dir), size=SIZE, slide=SLIDE)


def _replay(spark: SparkSession, sf_dir: str, build, purpose: str, exact: bool = False) -> DataFrame:
    """``build`` over the table as a stream, all windows closed by one event of the year 2100."""
    schema = read_events(spark, sf_dir).schema
    closing = spark.sql(
        "SELECT -1L AS event_id, TIMESTAMP_NTZ'2100-01-01' AS ts, -1L AS user_id, 'view' AS event_type, "
        "0.0D AS value, '{\"k\": 50}' AS props"
    )
    return replay(stream_events(spark, sf_dir, schema), closing, build, purpose, exact)


@query("sliding_bandwidth")
def sliding_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sliding_bandwidth(telemetry(spark, sf_dir), SIZE, SLIDE, panes=False)


@query("sliding_bandwidth_panes")
def sliding_windows_panes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sliding_bandwidth(telemetry(spark, sf_dir), SIZE, SLIDE, panes=True)


@query("sliding_bandwidth_minute")
def sliding_windows_minute(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The detector's own windows of 60 seconds sliding by 10."""
    return sliding_bandwidth(telemetry(spark, sf_dir))


@query("exfil_alerts")
def exfiltration_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _alerts(spark, sf_dir)


@query("exfil_alerts_stream")
def exfiltration_alerts_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    def build(events: DataFrame) -> DataFrame:
        return exfil_alerts(as_telemetry(events), size=SIZE, slide=SLIDE)

    return _replay(spark, sf_dir, build, "alerts", exact=True)


@query("detect_text_stream")
def detect_text_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The detector from JSON text, defective lines included."""

    def build(events: DataFrame) -> DataFrame:
        return detect(wire_lines(as_telemetry(events)), size=SIZE, slide=SLIDE)

    return _replay(spark, sf_dir, build, "detect", exact=True)


@query("alert_throttle")
def alert_throttle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return throttle(_alerts(spark, sf_dir), seconds=HOLD)


@query("alert_throttle_retry")
def alert_throttle_retry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deliveries before eight in the morning fail: such an alert is sent but sets no lock."""
    alerts = _alerts(spark, sf_dir).withColumn("delivered", F.hour("window_end") >= 8)
    return throttle(alerts, seconds=HOLD, delivered="delivered")


@query("alert_throttle_stream")
def alert_throttle_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    def build(events: DataFrame) -> DataFrame:
        return throttle_stream(exfil_alerts(as_telemetry(events), size=SIZE, slide=SLIDE), seconds=HOLD)

    return _replay(spark, sf_dir, build, "throttle")


@query("alert_throttle_ordered")
def alert_throttle_ordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alerts of the later half of the month arrive before those of the earlier half; a last one moves the clock on."""
    base, alerts = scratch_dir(spark, "ordered"), _alerts(spark, sf_dir)
    middle = F.col("window_end") < F.lit("2024-01-16").cast("timestamp")
    last = spark.sql("SELECT 'end' AS src_ip, TIMESTAMP'2100-01-01' AS window_end")
    empty = alerts.limit(0)
    for part in (alerts.filter(~middle), alerts.filter(middle), empty.unionByName(last, allowMissingColumns=True)):
        part.write.mode("append").parquet(f"{base}/in")
        stream = spark.readStream.schema(alerts.schema).parquet(f"{base}/in")
        run_available(throttle_stream(stream, seconds=HOLD, lateness="40 days"), f"{base}/out", f"{base}/checkpoint")
    return spark.read.schema(alerts.schema).parquet(f"{base}/out")


@query("alert_lock_check")
def alert_lock_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alerts not covered by the lock of their source's first alert."""
    alerts = _alerts(spark, sf_dir)
    locks = alerts.groupBy("src_ip").agg(F.min("window_end").alias("fired_at"))
    return unlocked(alerts, locks, seconds=HOLD)


@query("alert_outbox")
def alert_outbox(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_outbox(throttle(_alerts(spark, sf_dir), seconds=HOLD))


@query("alert_delivery")
def alert_delivery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alert windows handed to the delivering sink in two micro-batches, then its outbox."""
    base = scratch_dir(spark, "delivery")

    def accept(payload: str) -> bool:
        return True

    handle = alert_sink(accept, f"{base}/outbox", f"{base}/locks", seconds=HOLD, query="replayed")
    alerts = _alerts(spark, sf_dir)
    middle = F.col("window_end") < F.lit("2024-01-16").cast("timestamp")
    for batch_id, part in enumerate((middle, ~middle)):
        handle(alerts.filter(part), batch_id)
    sent = spark.read.parquet(f"{base}/outbox")
    return sent.select("src_ip", "window_end", "total_bytes", "payload", "delivered")


# ---- features ---------------------------------------------------------------------------


def _traffic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_silver(telemetry(spark, sf_dir))


def _spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled moments a quarter of an hour after each event: those after errors are anomalies."""
    return telemetry(spark, sf_dir).select(
        shift(F.col("ts"), "15 minutes").alias("event_timestamp"),
        "src_ip",
        F.when(F.col("app_layer.host") == "error", 1).otherwise(0).alias("label_is_anomaly"),
    )


@query("pit_features")
def pit_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return historical_features(_spine(spark, sf_dir), REFS, [daily_ip_traffic(_traffic(spark, sf_dir))])


@query("pit_features_bucketed")
def pit_features_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same join with slices as long as the ttl and no pruning by the spine."""
    view = daily_ip_traffic(_traffic(spark, sf_dir))
    return historical_features(_spine(spark, sf_dir), REFS, [view], slice_width="1 day", prune=False)


@query("pit_features_two_views")
def pit_features_two_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Traffic that expires after six hours beside scans that never do."""
    traffic = _traffic(spark, sf_dir)
    short = FeatureView("recent", SRC_IP, traffic, (Field("bytes_sent"),), ttl=timedelta(hours=6))
    slow = traffic.filter("latency_ms >= 30")
    ever = FeatureView("slow", SRC_IP, slow, (Field("latency_ms", "int"),), ttl=None)
    return historical_features(_spine(spark, sf_dir), ["recent:bytes_sent", "slow:latency_ms"], [short, ever])


@query("pit_features_silver")
def pit_features_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Moments of one week against a stored Silver, of which the week and the day before are read."""
    view = daily_ip_traffic(read_silver(spark, _silver_table(spark, sf_dir)), stored=True)
    week = F.col("event_timestamp").between(F.lit("2024-01-10").cast("timestamp"), F.lit("2024-01-17").cast("timestamp"))
    return historical_features(_spine(spark, sf_dir).filter(week), REFS, [view])


@query("materialize_latest")
def materialize_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return materialize(daily_ip_traffic(_traffic(spark, sf_dir)), "2024-01-01", "2024-01-20").drop("tie")


def _online_table(spark: SparkSession, sf_dir: str, view: FeatureView) -> DataFrame:
    """Two materialisation runs merged into one online table, the older range last."""
    path = f"{scratch_dir(spark, 'online')}/online"
    write_online(materialize(view, "2024-01-10", "2024-01-20"), path)
    write_online(materialize(view, "2024-01-01", "2024-01-12"), path)
    return read_table(spark, path)


@query("online_table_upsert")
def online_table_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _online_table(spark, sf_dir, daily_ip_traffic(_traffic(spark, sf_dir))).drop("tie")


@query("materialize_views")
def materialize_two_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Traffic and slow traffic of a source out of one scan, in two runs, beside a view that is not online."""
    silver, path = _traffic(spark, sf_dir), f"{scratch_dir(spark, 'views')}/online"
    views = [
        daily_ip_traffic(silver),
        FeatureView("slow", SRC_IP, silver, (Field("latency_ms", "int"),), where="latency_ms >= 30"),
        FeatureView("offline", SRC_IP, silver, (Field("bytes_sent"),), online=False),
    ]
    write_online(materialize_views(views, "2024-01-10", "2024-01-20"), path)
    write_online(materialize_views(views, "2024-01-01", "2024-01-12"), path)
    table = read_table(spark, path)
    traffic, slow = (view_of(table, view) for view in views[:2])
    return traffic.select("src_ip", "event_timestamp", "bytes_sent").join(
        slow.select("src_ip", F.col("event_timestamp").alias("slow_at"), F.col("latency_ms").alias("slow_latency_ms")), "src_ip", "full"
    )


def _lookup(spark: SparkSession, sf_dir: str, enforce_ttl: bool, as_of: str | None = "2024-01-20") -> DataFrame:
    view = daily_ip_traffic(_traffic(spark, sf_dir))
    table = materialize(view, "2024-01-01", "2024-01-20")
    asked = _spine(spark, sf_dir).select("src_ip").distinct()
    unknown = asked.select(F.concat(F.lit("x"), F.col("src_ip")).alias("src_ip"))
    return online_features(
        asked.unionByName(unknown), REFS, [view], {view.name: table},
        as_of=F.lit(as_of).cast("timestamp") if as_of else None, enforce_ttl=enforce_ttl,
    )


@query("online_lookup")
def online_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lookup(spark, sf_dir, enforce_ttl=False)


@query("online_lookup_ttl")
def online_lookup_ttl(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lookup(spark, sf_dir, enforce_ttl=True)


@query("online_lookup_now")
def online_lookup_now(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lookup by the clock on the wall, for which all of the table has long expired."""
    return _lookup(spark, sf_dir, enforce_ttl=True, as_of=None)


# ---- rates, labels and scans ------------------------------------------------------------


@query("eps")
def eps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events_per_second(telemetry(spark, sf_dir))


@query("eps_stream")
def eps_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _replay(spark, sf_dir, lambda e: events_per_second(as_telemetry(e)), "eps", exact=True)


@query("late_rows_dropped")
def late_rows_dropped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tenth of the first half of the month arrives with the second half: how many rows each arrival lost to the
    watermark, beside the events per hour that were kept."""
    base, records = scratch_dir(spark, "late"), telemetry(spark, sf_dir)
    middle, last = F.col("ts") < F.lit("2024-01-16").cast("timestamp"), F.substring("event_id", -1, 1)
    late = (last == "3") & (F.col("ts") < F.lit("2024-01-15").cast("timestamp"))
    for part in (middle & ~late, ~middle | late):
        write_landing(records.filter(part).select(*TELEMETRY.fieldNames()), f"{base}/in", LANDING_FILE_ROWS)
        stream = to_silver(read_raw(spark, f"{base}/in", streaming=True), dedupe=True, watermark="1 hour")
        with exact_lateness(spark):
            run_counting_late_rows(stream, f"{base}/out", f"{base}/checkpoint", f"{base}/late")
    arrivals = spark.read.parquet(f"{base}/late").filter("rows_in > 0").groupBy("run").agg(
        F.min("batch").alias("first"), F.sum("late_rows").alias("n")
    )
    kept = spark.read.schema(stream.schema).parquet(f"{base}/out")
    hours = kept.groupBy((F.unix_seconds("parsed_timestamp") - F.unix_seconds("parsed_timestamp") % 3600).alias("place")).agg(F.count("*").alias("n"))
    after_first = F.when(F.col("first") > 0, 1).otherwise(0).cast("long")
    return hours.select(F.lit("hour").alias("kind"), "place", "n").unionByName(
        arrivals.select(F.lit("arrival").alias("kind"), after_first.alias("place"), "n")
    )


@query("anomaly_labels")
def anomaly_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = label_anomalies(telemetry(spark, sf_dir))
    return labelled.select(
        "event_id", "latency_spike", "exfiltration", "connection_reset",
        F.array_join("labels", ",").alias("labels"),
    )


@query("anomaly_rates")
def anomaly_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return anomaly_rates(telemetry(spark, sf_dir), "1 hour")


@query("anomaly_rates_stream")
def anomaly_shares_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _replay(spark, sf_dir, lambda e: anomaly_rates(as_telemetry(e), "1 hour"), "rates", exact=True)


def _by_network(records: DataFrame) -> DataFrame:
    """Targets collapsed into one network, so that scans of the sparse data show."""
    return records.withColumn("dst_ip", F.substring_index("dst_ip", ".", 3))


@query("port_scan")
def port_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return port_scans(_by_network(telemetry(spark, sf_dir)), SCAN_WINDOW, SCAN_MIN)


@query("port_scan_stream")
def port_scan_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    def build(events: DataFrame) -> DataFrame:
        return port_scans(_by_network(as_telemetry(events)), SCAN_WINDOW, SCAN_MIN)

    return _replay(spark, sf_dir, build, "scan")

"""Optional edges: Kafka, Delta, web delivery, and the shared scratch folder."""

import pytest
from conftest import record

from telemetry_lake import scratch_dir
from telemetry_lake.functions import json_lines, seconds_of
from telemetry_lake.sinks import http_delivery, publish_json
from telemetry_lake.sources import kafka_options, read_kafka
from telemetry_lake.sources.tables import has_delta


def test_kafka_options():
    detector = kafka_options("b1:9092,b2:9092")
    assert detector == {
        "kafka.bootstrap.servers": "b1:9092,b2:9092", "subscribe": "network-telemetry", "startingOffsets": "latest",
    }
    sink = kafka_options("b:9092", starting="earliest", min_rows=2_000, max_delay="5s", max_rows=10_000_000)
    assert sink["minOffsetsPerTrigger"] == "2000" and sink["maxTriggerDelay"] == "5s"
    assert sink["startingOffsets"] == "earliest" and sink["maxOffsetsPerTrigger"] == "10000000"


def test_kafka_without_its_package_says_so(spark):
    with pytest.raises(RuntimeError, match="spark-sql-kafka"):
        read_kafka(spark, "b:9092")
    with pytest.raises(RuntimeError, match="spark-sql-kafka"):
        publish_json(spark.createDataFrame([("a",)], "src_ip string"), "b:9092")


def test_json_lines(spark):
    df = spark.createDataFrame([(1, "a")], "n int, s string")
    assert json_lines(df).first().value == '{"n":1,"s":"a"}'
    assert record()["src_ip"]


def test_delta_is_reported_absent(spark):
    assert not has_delta(spark)


def test_web_delivery_counts_2xx_as_success(monkeypatch):
    import urllib.error
    import urllib.request

    answers = iter([204, 500, None])
    posted = []

    class Answer:
        def __init__(self, status):
            self.status = status

        def __enter__(self):
            return self

        def __exit__(self, *_):
            return False

    def fake(request, timeout):
        posted.append((request.get_method(), request.data))
        status = next(answers)
        if status is None:
            raise urllib.error.URLError("no route")
        return Answer(status)

    monkeypatch.setattr(urllib.request, "urlopen", fake)
    deliver = http_delivery("http://alerts.example/hook")
    assert [deliver("{}") for _ in range(3)] == [True, False, False]
    assert posted[0] == ("POST", b"{}")


def test_scratch_is_shared_and_new_each_time(spark):
    first, second = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert first != second
    assert first.startswith(spark.conf.get("spark.checkpoint.dir"))


def test_durations():
    assert [seconds_of(d) for d in ("1 second", "60 seconds", "2 hours", "1 day", 7)] == [1, 60, 7_200, 86_400, 7]
    with pytest.raises(ValueError):
        seconds_of("soon")

import json

import pytest
from conftest import record

from telemetry_lake.operators import check_records, parse_events, validate
from telemetry_lake.schema import TELEMETRY


def nested(**changes):
    layer = {"protocol": "HTTP/1.1", "method": "GET", "host": "h", "status_code": 200}
    layer.update(changes)
    return {k: v for k, v in layer.items() if v is not ...}


LAX = [
    # (record, reasons)
    (record(), []),
    (record(timestamp=1_704_067_200), []),
    (record(timestamp="1704067200"), []),
    (record(timestamp="2024-01-01T00:00:00+02:00"), []),
    (record(timestamp="2024-01-01"), []),
    (record(timestamp="10:30:00"), ["timestamp: wrong type"]),
    (record(timestamp="yesterday"), ["timestamp: wrong type"]),
    (record(timestamp=True), ["timestamp: wrong type"]),
    (record(timestamp=None), ["timestamp: missing"]),
    ("not json", ["not_json"]),
    ("", ["not_json"]),
    ("[1]", ["not_json"]),
    (record(src_ip=...), ["src_ip: missing"]),
    (record(src_ip=None), ["src_ip: missing"]),
    (record(src_ip=12), ["src_ip: wrong type"]),
    (record(bytes_sent="12"), []),
    (record(bytes_sent=12.0), []),
    (record(bytes_sent="12.0"), []),
    (record(bytes_sent=12.5), ["bytes_sent: wrong type"]),
    (record(bytes_sent="12.5"), ["bytes_sent: wrong type"]),
    (record(bytes_sent="many"), ["bytes_sent: wrong type"]),
    (record(bytes_sent=10**30), ["bytes_sent: wrong type"]),
    (record(src_port=2**40), ["src_port: wrong type"]),
    (record(bytes_sent=2**40), []),
    (record(flags=[1]), ["flags: wrong type"]),
    (record(flags=["ACK", None]), ["flags: wrong type"]),
    (record(flags="ACK"), ["flags: wrong type"]),
    (record(flags=[]), []),
    (record(app_layer=nested(host=...)), ["app_layer.host: missing"]),
    (record(app_layer=nested(status_code="200")), []),
    (record(app_layer="none"), ["app_layer: wrong type"]),
    (record(app_layer=...), ["app_layer: missing"]),
    (record(tags=...), ["tags: missing"]),
    (record(extra=1), []),
    (json.dumps(record())[:-1] + ', "src_ip": "again"}', []),
    (record(bytes_sent=True), []),
    (record(app_layer=nested(extra="x")), []),
    (record(src_ip=..., tags=..., latency_ms="x"), ["src_ip: missing", "latency_ms: wrong type", "tags: missing"]),
]


def lines(spark, cases):
    rows = [(i, c if isinstance(c, str) else json.dumps(c)) for i, c in enumerate(cases)]
    return spark.createDataFrame(rows, "i int, value string").coalesce(1)


def test_reasons(spark):
    checked = check_records(lines(spark, [c for c, _ in LAX])).collect()
    assert [r.reject_reasons for r in checked] == [reasons for _, reasons in LAX]
    for row, (case, reasons) in zip(checked, LAX, strict=True):
        assert row.valid == (not reasons)
        assert (row.raw is None) == row.valid
        if not row.valid:
            assert row.raw == (case if isinstance(case, str) else json.dumps(case))


def test_strict_refuses_coercion(spark):
    cases = [record(bytes_sent="12"), record(bytes_sent=12.0), record(bytes_sent=12), record(extra=1)]
    assert [r.valid for r in check_records(lines(spark, cases), mode="strict").collect()] == [False, False, True, True]
    with pytest.raises(ValueError):
        check_records(lines(spark, cases), mode="loose")


def test_values_come_out_typed(spark):
    cases = [record(bytes_sent="12", timestamp=1_704_067_200), record(latency_ms=3.0, extra=1), record()]
    valid, rejects = validate(lines(spark, cases))
    assert valid.schema == TELEMETRY or [f.dataType for f in valid.schema] == [f.dataType for f in TELEMETRY]
    first, second, third = valid.collect()
    assert (first.bytes_sent, first.timestamp) == (12, "2024-01-01T00:00:00Z")
    assert second.latency_ms == 3 and second.flags == ["ACK", "PSH"]
    assert third.app_layer.status_code == 200 and third.tags.env == "Production"
    assert rejects.count() == 0


def test_split_loses_nothing(spark):
    df = lines(spark, [c for c, _ in LAX])
    valid, rejects = validate(df)
    assert valid.count() + rejects.count() == len(LAX)


def test_timestamps_are_normalised(spark):
    cases = [
        record(timestamp="2024-01-01T00:00:00+02:00"),
        record(timestamp="2024-01-01T00:00:00.5Z"),
        record(timestamp=1_704_067_200_250),
        record(timestamp="2024-01-01"),
    ]
    stamps = [r.timestamp for r in validate(lines(spark, cases))[0].collect()]
    assert stamps == [
        "2023-12-31T22:00:00Z", "2024-01-01T00:00:00.500000Z", "2024-01-01T00:00:00.250000Z", "2024-01-01T00:00:00Z",
    ]


def test_checks_run_once(spark):
    """The filter on validity is not pushed into a second evaluation of the parse."""
    valid, _ = validate(lines(spark, [record()]))
    plan = valid._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parseJson") == 1
    assert "Exchange" not in valid._jdf.queryExecution().executedPlan().toString()


def test_detector_parse(spark):
    cases = [
        record(), record(bytes_sent="7"), record(bytes_sent=7.9), record(bytes_sent=...), record(src_ip=5),
        "not json", record(timestamp="?"), record(src_ip=...), record(bytes_sent="x"), record(timestamp=1_704_067_200),
    ]
    events, rejects = parse_events(lines(spark, cases))
    assert [(r.src_ip, r.bytes_sent) for r in events.collect()] == [
        ("192.168.1.100", 3698), ("192.168.1.100", 7), ("192.168.1.100", 7), ("192.168.1.100", 0), ("5", 3698),
        ("192.168.1.100", 3698),
    ]
    assert rejects.count() == 4

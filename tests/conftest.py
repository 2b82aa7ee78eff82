from __future__ import annotations

import gzip
import json
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from telemetry_lake import build_session

    session = build_session(
        "tests",
        "local[4]",
        spark__ui__enabled="false",
        spark__sql__shuffle__partitions="4",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path)


def record(**changes) -> dict:
    """A complete wire record; a value of ``...`` removes the field."""
    full = {
        "timestamp": "2024-01-01T00:00:00Z",
        "event_id": "e1",
        "src_ip": "192.168.1.100",
        "dst_ip": "10.0.5.55",
        "src_port": 40000,
        "dst_port": 443,
        "protocol": "TCP",
        "bytes_sent": 3698,
        "bytes_received": 500,
        "latency_ms": 16,
        "packets_sent": 5,
        "flags": ["ACK", "PSH"],
        "app_layer": {"protocol": "HTTP/1.1", "method": "GET", "host": "h", "status_code": 200},
        "tags": {"env": "Production", "region": "us-east-1", "security_group": "sg-1"},
    }
    full.update(changes)
    return {k: v for k, v in full.items() if v is not ...}


def write_lines(path: str, lines: list, at: int | None = None) -> str:
    """A gzip JSON-lines file; ``at`` sets its age order for streaming sources."""
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with gzip.open(path, "wt", encoding="utf-8") as out:
        for line in lines:
            out.write((line if isinstance(line, str) else json.dumps(line)) + "\n")
    if at is not None:
        os.utime(path, (1_700_000_000 + at, 1_700_000_000 + at))
    return path

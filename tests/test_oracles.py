"""Every named query equals its SQL counterpart, in values, column names and types."""

import pytest
from conftest import SMALL
from differential import compare, connect, types_differ

from __spark_entry__ import entry
from telemetry_lake.plans.oracles import ORACLES
from telemetry_lake.plans.queries import QUERIES


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, con, name):
    problem, rows = compare(spark, con, name, QUERIES[name], ORACLES[name], SMALL)
    assert not problem
    assert rows > 0


@pytest.mark.parametrize("name", ["telemetry_view", "silver", "gold_upsert", "top10_per_day", "exfil_alerts",
                                  "alert_outbox", "alert_throttle_retry", "pit_features_two_views", "online_lookup",
                                  "eps", "anomaly_labels", "anomaly_rates", "port_scan", "scalar_functions",
                                  "ingest_valid", "alert_delivery", "top10_anomalous_per_day", "materialize_latest"])
def test_types_match_sql(spark, con, name):
    assert types_differ(spark, con, QUERIES[name], ORACLES[name], SMALL) == []


def test_entry_runs(spark):
    assert entry(spark).count() == 13

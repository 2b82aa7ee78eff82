from telemetry_lake.operators.features import (
    Entity,
    FeatureView,
    Field,
    daily_ip_traffic,
    historical_features,
    materialize,
    materialize_views,
    online_features,
    view_of,
    write_online,
)
from telemetry_lake.operators.labels import anomalous_daily, anomaly_rates, label_anomalies, port_scans
from telemetry_lake.operators.ranking import top_ip_days, top_per_day, top_talkers
from telemetry_lake.operators.refine import to_gold, to_silver, unique_events
from telemetry_lake.operators.throttle import new_locks, throttle, throttle_batch, unlocked
from telemetry_lake.operators.validate import check_records, parse_events, validate
from telemetry_lake.operators.windows import (
    assign_event_time,
    events_per_second,
    exfil_alerts,
    sliding_bandwidth,
)

__all__ = [
    "Entity",
    "FeatureView",
    "Field",
    "anomalous_daily",
    "anomaly_rates",
    "assign_event_time",
    "check_records",
    "daily_ip_traffic",
    "events_per_second",
    "exfil_alerts",
    "historical_features",
    "label_anomalies",
    "materialize",
    "materialize_views",
    "new_locks",
    "online_features",
    "parse_events",
    "port_scans",
    "sliding_bandwidth",
    "throttle",
    "throttle_batch",
    "to_gold",
    "to_silver",
    "top_ip_days",
    "top_per_day",
    "top_talkers",
    "unique_events",
    "unlocked",
    "validate",
    "view_of",
    "write_online",
]

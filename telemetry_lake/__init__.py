"""Network-telemetry analytics on Spark DataFrames and Structured Streaming."""

from telemetry_lake.session import apply_settings, build_session, scratch_dir

__all__ = ["apply_settings", "build_session", "scratch_dir"]

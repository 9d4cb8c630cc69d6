"""Drift of a stream against a fixed baseline."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tallyward.operators.drift import distance_by_window, drift_by_window


def start_drift(stream: DataFrame, profile: DataFrame, features: list[str], ts: str, out: str,
                checkpoint: str, width: str = "7 days", latency: str = "24 hours",
                trigger: dict | None = None):
    """Write the index of each closed window to a Parquet table, each window once.

    The profile is computed once, before the stream starts. Rows later than ``latency`` behind the newest one are left out. The state is one row of bin counts
    per open window and feature, whatever the volume.
    """
    fixed = stream.sparkSession.createDataFrame(profile.collect(), profile.schema)  # one row per column of the table
    index = drift_by_window(stream, fixed, features, ts, width, latency)
    return (index.writeStream.format("parquet").outputMode("append").option("path", out)
            .option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start())


def start_distance(stream: DataFrame, profile: DataFrame, features: list[str], ts: str, out: str, checkpoint: str, width: str = "7 days",
                   latency: str = "24 hours", trigger: dict | None = None):
    """Write the distance of each closed window to a Parquet table, each window once.

    The profile, a row per column, is computed once, before the stream starts. The state is one sketch per open window and feature.
    """
    found = distance_by_window(stream, profile, features, ts, width, latency)
    return (found.writeStream.format("parquet").outputMode("append").option("path", out)
            .option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start())

"""Cutting the lineage through a table in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tallyward.session import scratch_path


def stage(df: DataFrame, name: str) -> DataFrame:
    """The same rows from a table in the shared folder.

    Cuts the lineage before work that reads the rows many times, and outlives lost executors.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def released(df: DataFrame, name: str) -> DataFrame:
    """The same rows from a table in the shared folder; the files of the exchanges that made them are removed once it is written.

    Nothing reads these files again, as the table cuts the lineage. Elsewhere they wait until the driver collects garbage.
    """
    conf = df.sparkSession.conf
    before = conf.get(_CLEANUP, None)
    conf.set(_CLEANUP, "true")
    try:
        return stage(df, name)
    finally:
        conf.unset(_CLEANUP) if before is None else conf.set(_CLEANUP, before)

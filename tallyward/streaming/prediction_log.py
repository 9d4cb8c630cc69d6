"""Append-only table of scored rows, in folders by day or another period."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

DAY = "yyyy-MM-dd"


def _write(df: DataFrame, ts: str, folder: str, period: str) -> None:
    """Rows by period. The engine splits busy periods over tasks and joins quiet ones."""
    rows = df.withColumn("period", F.date_format(ts, period))
    rows.hint("rebalance", "period").write.mode("overwrite").partitionBy("period").parquet(folder)


def append(df: DataFrame, ts: str, out: str, period: str = DAY) -> None:
    """Add a batch of scored rows, in a folder of its own."""
    _write(df, ts, f"{out}/run={uuid.uuid4().hex}/batch=0", period)


def start_log(scored: DataFrame, ts: str, out: str, checkpoint: str, period: str = DAY,
              trigger: dict | None = None) -> StreamingQuery:
    """Log a stream of scored rows.

    A micro-batch writes the folder of its query and number, and nothing else does: a batch that runs again after a failure replaces
    what it left, and a query with a new checkpoint, whose batches count from 0 again, adds to the log.
    """
    spark = scored.sparkSession

    def write(batch: DataFrame, number: int) -> None:
        run = json.loads(spark.read.text(f"{checkpoint}/metadata").first()["value"])["id"]
        _write(batch, ts, f"{out}/run={run}/batch={number}", period)

    return (scored.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start())


def read_log(spark: SparkSession, out: str) -> DataFrame:
    """All logged rows; folder names may read as dates, so the period is turned back into text."""
    rows = spark.read.parquet(out)
    return rows.drop("run", "batch").withColumn("period", F.col("period").cast("string"))

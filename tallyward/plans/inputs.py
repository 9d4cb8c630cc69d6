"""Input frames shared by the registered queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyward.functions import values as V
from tallyward.operators import clean
from tallyward.operators.split import hash_split
from tallyward.sources.discharges import discharges, with_duplicates

AMOUNTS = ("length_of_stay", "total_charges", "total_costs")


def typed(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Discharge columns with amounts as numbers."""
    return clean.convert_types(discharges(spark, sf_dir, *columns), clean.COST_TYPES, V.STAY_TOPCODE)


def repeated(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Discharge columns with some rows twice."""
    wanted = columns or ()
    return with_duplicates(discharges(spark, sf_dir, *wanted))


def predicted(spark: SparkSession, sf_dir: str, *extra: str) -> DataFrame:
    """Actual and predicted log costs, the prediction being a closed form of the charges."""
    df = typed(spark, sf_dir, "discharge_key", "total_costs", "total_charges", *extra)
    df = df.where(F.col("total_costs") > 0)
    df = df.select("discharge_key", *extra, F.log(1 + F.col("total_costs")).alias("y"),
                   F.log(1 + F.lit(0.9) * F.col("total_charges")).alias("yhat"))
    return hash_split(df, "discharge_key")


def drift_pair(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Earlier rows as the baseline, later rows with costs raised by half as the current side."""
    df = typed(spark, sf_dir, "discharge_ts", *AMOUNTS, "apr_drg_code")
    early = F.col("discharge_ts") < F.lit("1998-07-01").cast("timestamp_ntz")
    later = df.where(~early).withColumn("total_costs", F.col("total_costs") * 1.5)
    return df.where(early).drop("discharge_ts"), later.drop("discharge_ts")


def rounded(df: DataFrame, digits: int | None = 6, **special: int) -> DataFrame:
    """Round the doubles, so that the order of summation does not show.

    With no ``digits`` only the named columns are rounded.
    """
    out: list[Column] = []
    for f in df.schema.fields:
        c = F.col(f.name)
        places = special.get(f.name, digits)
        if places is not None and f.dataType.typeName() in ("double", "float"):
            # Adding zero turns -0.0 into 0.0.
            c = (F.round(c, places) + F.lit(0.0)).alias(f.name)
        out.append(c)
    return df.select(*out)

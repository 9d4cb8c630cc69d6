"""Discharge records derived from the star schema of orders, customers, suppliers and parts.

Only the dimension tables that the wanted columns need are joined. That gives the same rows because
every foreign key of the star schema resolves (``tests/test_sources.py`` checks it).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# column -> (expression, tables it needs beyond the line items)
_COLUMNS: dict[str, tuple[str, tuple[str, ...]]] = {
    "discharge_key": (
        "md5(concat(cast(l_orderkey AS string), '-', cast(l_partkey AS string), '-', "
        "cast(l_suppkey AS string), '-', cast(l_linenumber AS string), '-', "
        "cast(cast(l_quantity AS int) AS string)))",
        (),
    ),
    "order_no": ("l_orderkey", ()),
    "health_service_area": ("r_name", ("region",)),
    "hospital_county": ("CASE WHEN l_orderkey % 19 = 0 THEN NULL ELSE n_name END", ("nation",)),
    "facility_name": ("s_name", ("supplier",)),
    "permanent_facility_id": ("l_suppkey", ()),
    "age_group": (
        "CASE o_custkey % 6 WHEN 0 THEN '0-17' WHEN 1 THEN '18-29' WHEN 2 THEN '30-49' "
        "WHEN 3 THEN '50-69' WHEN 4 THEN '70 or Older' ELSE '70+' END",
        ("orders",),
    ),
    "gender": (
        "CASE WHEN o_custkey % 50 = 0 THEN 'U' WHEN o_custkey % 2 = 0 THEN 'F' ELSE 'M' END",
        ("orders",),
    ),
    "type_of_admission": (
        "CASE o_orderpriority WHEN '1-URGENT' THEN 'Urgent' WHEN '2-HIGH' THEN 'Emergency' "
        "WHEN '3-MEDIUM' THEN 'Elective' WHEN '5-LOW' THEN '  Newborn ' ELSE NULL END",
        ("orders",),
    ),
    "emergency_department_indicator": ("CASE WHEN l_returnflag = 'R' THEN 'Y' ELSE 'N' END", ()),
    "length_of_stay": (
        "CASE WHEN l_quantity >= 50 THEN '120+' WHEN l_orderkey % 211 = 0 THEN 'n/a' "
        "ELSE cast(cast(l_quantity AS int) - 1 AS string) END",
        (),
    ),
    "total_charges": ("cast(l_extendedprice AS string)", ()),
    "total_costs": (
        "CASE WHEN l_orderkey % 101 = 0 THEN NULL WHEN l_orderkey % 103 = 0 THEN '-1.0' "
        "ELSE cast(l_extendedprice * (1 - l_discount) AS string) END",
        (),
    ),
    "apr_severity_of_illness_description": (
        "CASE WHEN l_extendedprice < 20000 THEN 'Minor' WHEN l_extendedprice < 45000 THEN 'Moderate' "
        "WHEN l_extendedprice < 70000 THEN 'Major' WHEN l_orderkey % 97 = 0 THEN 'Unclassified' "
        "ELSE 'Extreme' END",
        (),
    ),
    "apr_risk_of_mortality": (
        "CASE WHEN l_quantity < 15 THEN 'Minor' WHEN l_quantity < 30 THEN 'Moderate' "
        "WHEN l_quantity < 43 THEN 'Major' ELSE 'Extreme' END",
        (),
    ),
    "apr_medical_surgical_description": (
        "CASE WHEN p_type IN ('PROMO', 'LARGE') THEN 'Surgical' WHEN p_type = 'SMALL' "
        "THEN 'Not Applicable' ELSE 'Medical' END",
        ("part",),
    ),
    "apr_mdc_description": ("p_type", ("part",)),
    "ccsr_diagnosis_description": ("p_name", ("part",)),
    "ccsr_procedure_description": ("CASE WHEN l_linenumber % 3 = 0 THEN NULL ELSE p_brand END", ("part",)),
    "apr_drg_code": ("p_size", ("part",)),
    "payment_typology_1": (
        "CASE WHEN l_orderkey % 7 = 0 THEN NULL WHEN c_mktsegment = 'HOUSEHOLD' THEN 'Medicare' "
        "WHEN c_mktsegment = 'MACHINERY' THEN 'Medicaid' "
        "WHEN c_mktsegment = 'FURNITURE' THEN 'Private Health Insurance' ELSE 'Self-Pay' END",
        ("customer",),
    ),
    "payment_typology_2": ("CASE WHEN l_orderkey % 14 = 0 THEN NULL ELSE 'Medicaid' END", ()),
    "payment_typology_3": ("CASE WHEN l_orderkey % 28 = 0 THEN NULL ELSE 'Self-Pay' END", ()),
    "birth_weight": (
        "CASE WHEN l_linenumber = 1 AND l_orderkey % 20 = 0 THEN l_partkey + 500 ELSE NULL END",
        (),
    ),
    "discharge_ts": ("l_shipdate", ()),
}

COLUMNS = tuple(_COLUMNS)

# table -> (left key, right key, table that carries the left key)
_JOINS = {
    "orders": ("l_orderkey", "o_orderkey", None),
    "customer": ("o_custkey", "c_custkey", "orders"),
    "supplier": ("l_suppkey", "s_suppkey", None),
    "nation": ("s_nationkey", "n_nationkey", "supplier"),
    "region": ("n_regionkey", "r_regionkey", "nation"),
    "part": ("l_partkey", "p_partkey", None),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def discharges(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """The named columns (all by default), one row per line item.

    Rows are dealt out by order, as the join with the orders needs them. The other tables are joined from the left on their unique
    keys, so that the rows are the same whichever columns are asked.
    """
    wanted = columns or COLUMNS
    needed: set[str] = set()
    for c in wanted:
        for t in _COLUMNS[c][1]:
            while t is not None:
                needed.add(t)
                t = _JOINS[t][2]
    df = table(spark, sf_dir, "lineitem").repartition("l_orderkey")
    for name, (left, right, _) in _JOINS.items():
        if name in needed:
            other = table(spark, sf_dir, name)
            df = df.join(other, F.col(left) == F.col(right), "left")
    return df.select([F.expr(_COLUMNS[c][0]).alias(c) for c in wanted])


def with_duplicates(df: DataFrame) -> DataFrame:
    """Every fiftieth order twice; needs ``order_no``."""
    return df.unionAll(df.where(F.col("order_no") % 50 == 0))

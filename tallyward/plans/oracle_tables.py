"""Common table expressions that the SQL oracles read, in terms of the given tables."""

from __future__ import annotations

import re

_DISCHARGES = """
SELECT
  md5(concat(CAST(l_orderkey AS STRING), '-', CAST(l_partkey AS STRING), '-', CAST(l_suppkey AS STRING), '-',
             CAST(l_linenumber AS STRING), '-', CAST(CAST(l_quantity AS INT) AS STRING))) AS discharge_key,
  l_orderkey AS order_no,
  r_name AS health_service_area,
  CASE WHEN l_orderkey % 19 = 0 THEN NULL ELSE n_name END AS hospital_county,
  s_name AS facility_name,
  l_suppkey AS permanent_facility_id,
  CASE c_custkey % 6 WHEN 0 THEN '0-17' WHEN 1 THEN '18-29' WHEN 2 THEN '30-49'
       WHEN 3 THEN '50-69' WHEN 4 THEN '70 or Older' ELSE '70+' END AS age_group,
  CASE WHEN c_custkey % 50 = 0 THEN 'U' WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'Urgent' WHEN '2-HIGH' THEN 'Emergency'
       WHEN '3-MEDIUM' THEN 'Elective' WHEN '5-LOW' THEN '  Newborn ' ELSE NULL END AS type_of_admission,
  CASE WHEN l_returnflag = 'R' THEN 'Y' ELSE 'N' END AS emergency_department_indicator,
  CASE WHEN l_quantity >= 50 THEN '120+' WHEN l_orderkey % 211 = 0 THEN 'n/a'
       ELSE CAST(CAST(l_quantity AS INT) - 1 AS STRING) END AS length_of_stay,
  CAST(l_extendedprice AS STRING) AS total_charges,
  CASE WHEN l_orderkey % 101 = 0 THEN NULL WHEN l_orderkey % 103 = 0 THEN '-1.0'
       ELSE CAST(l_extendedprice * (1 - l_discount) AS STRING) END AS total_costs,
  CASE WHEN l_extendedprice < 20000 THEN 'Minor' WHEN l_extendedprice < 45000 THEN 'Moderate'
       WHEN l_extendedprice < 70000 THEN 'Major' WHEN l_orderkey % 97 = 0 THEN 'Unclassified'
       ELSE 'Extreme' END AS apr_severity_of_illness_description,
  CASE WHEN l_quantity < 15 THEN 'Minor' WHEN l_quantity < 30 THEN 'Moderate'
       WHEN l_quantity < 43 THEN 'Major' ELSE 'Extreme' END AS apr_risk_of_mortality,
  CASE WHEN p_type IN ('PROMO', 'LARGE') THEN 'Surgical' WHEN p_type = 'SMALL' THEN 'Not Applicable'
       ELSE 'Medical' END AS apr_medical_surgical_description,
  p_type AS apr_mdc_description,
  p_name AS ccsr_diagnosis_description,
  CASE WHEN l_linenumber % 3 = 0 THEN NULL ELSE p_brand END AS ccsr_procedure_description,
  p_size AS apr_drg_code,
  CASE WHEN l_orderkey % 7 = 0 THEN NULL WHEN c_mktsegment = 'HOUSEHOLD' THEN 'Medicare'
       WHEN c_mktsegment = 'MACHINERY' THEN 'Medicaid' WHEN c_mktsegment = 'FURNITURE' THEN 'Private Health Insurance'
       ELSE 'Self-Pay' END AS payment_typology_1,
  CASE WHEN l_orderkey % 14 = 0 THEN NULL ELSE 'Medicaid' END AS payment_typology_2,
  CASE WHEN l_orderkey % 28 = 0 THEN NULL ELSE 'Self-Pay' END AS payment_typology_3,
  CASE WHEN l_linenumber = 1 AND l_orderkey % 20 = 0 THEN l_partkey + 500 ELSE NULL END AS birth_weight,
  l_shipdate AS discharge_ts
FROM lineitem
JOIN orders ON o_orderkey = l_orderkey
JOIN customer ON c_custkey = o_custkey
JOIN supplier ON s_suppkey = l_suppkey
JOIN nation ON n_nationkey = s_nationkey
JOIN region ON r_regionkey = n_regionkey
JOIN part ON p_partkey = l_partkey
"""

# Amounts as numbers, the open-ended stay read as 120.
_TYPED_COLUMNS = """* REPLACE (
  CASE WHEN length_of_stay = '120+' THEN 120.0 ELSE TRY_CAST(length_of_stay AS DOUBLE) END AS length_of_stay,
  TRY_CAST(total_charges AS DOUBLE) AS total_charges,
  TRY_CAST(total_costs AS DOUBLE) AS total_costs)"""

# Bin of a value: how many of the nine inner edges of [lo, hi] are at or below it.
EDGE_BIN = " + ".join(f"CAST(lo + {i} * ((hi - lo) / 10) <= value AS INT)" for i in range(1, 10))

_TABLES = {
    "discharges": _DISCHARGES,
    "typed": f"SELECT {_TYPED_COLUMNS} FROM discharges",
    "repeated": "SELECT * FROM discharges UNION ALL SELECT * FROM discharges WHERE order_no % 50 = 0",
    "valid": f"""SELECT * FROM (SELECT {_TYPED_COLUMNS} FROM (SELECT DISTINCT * FROM repeated)) AS t
  WHERE total_costs > 0 AND total_costs < 10000000 AND length_of_stay >= 0""",
    # A closed-form stand-in for a model's output on the log scale.
    "predicted": """SELECT discharge_key, order_no, discharge_ts, ln(1 + total_costs) AS y, ln(1 + 0.9 * total_charges) AS yhat,
  CASE WHEN CAST('0x' || substr(md5('42-' || discharge_key), 1, 8) AS BIGINT) % 10000 < 2000
       THEN 'test' ELSE 'train' END AS split
  FROM typed WHERE total_costs > 0""",
    # Long form of the drift pair: costs of the later rows are raised by half.
    "sides": """SELECT CASE WHEN discharge_ts < TIMESTAMP '1998-07-01' THEN 'baseline' ELSE 'current' END AS side,
  length_of_stay, total_charges,
  CASE WHEN discharge_ts < TIMESTAMP '1998-07-01' THEN total_costs ELSE total_costs * 1.5 END AS total_costs,
  CAST(apr_drg_code AS DOUBLE) AS apr_drg_code FROM typed""",
    "drift_long": """SELECT side, 'length_of_stay' AS feature, length_of_stay AS value FROM sides WHERE length_of_stay IS NOT NULL
  UNION ALL SELECT side, 'total_charges', total_charges FROM sides WHERE total_charges IS NOT NULL
  UNION ALL SELECT side, 'total_costs', total_costs FROM sides WHERE total_costs IS NOT NULL
  UNION ALL SELECT side, 'apr_drg_code', apr_drg_code FROM sides WHERE apr_drg_code IS NOT NULL""",
    "psi": f"""SELECT feature, sum((a - e) * ln(a / e)) AS psi FROM (
    SELECT b.feature, b.bin,
      CASE WHEN coalesce(ne, 0) = 0 THEN 0.0001 ELSE CAST(ne AS DOUBLE) / total_e END AS e,
      CASE WHEN coalesce(na, 0) = 0 THEN 0.0001 ELSE CAST(na AS DOUBLE) / total_a END AS a
    FROM (SELECT feature, unnest(range(0, 10)) AS bin, total_e, total_a FROM (
            SELECT feature, count(*) FILTER (side = 'baseline') AS total_e,
                   count(*) FILTER (side = 'current') AS total_a FROM drift_long GROUP BY feature) AS t) AS b
    LEFT JOIN (
      SELECT feature, bin, count(*) FILTER (side = 'baseline') AS ne, count(*) FILTER (side = 'current') AS na
      FROM (SELECT d.feature, side, {EDGE_BIN} AS bin
            FROM drift_long AS d JOIN (SELECT feature, min(value) AS lo, max(value) AS hi FROM drift_long
                                       WHERE side = 'baseline' GROUP BY feature) AS r ON r.feature = d.feature) AS p
      GROUP BY feature, bin) AS c ON c.feature = b.feature AND c.bin = b.bin) AS s GROUP BY feature""",
    "ks": """SELECT feature, d AS ks_statistic,
    CASE WHEN lam < 0.2 THEN 1.0 ELSE greatest(0.0, least(1.0, 2 * (SELECT
      sum((CASE WHEN k % 2 = 1 THEN 1.0 ELSE -1.0 END) * exp(-2.0 * k * k * lam * lam)) FROM range(1, 101) AS g (k)))) END AS ks_pvalue
  FROM (
    SELECT feature, max(abs(CAST(ce AS DOUBLE) / te - CAST(ca AS DOUBLE) / ta)) AS d,
      max(abs(CAST(ce AS DOUBLE) / te - CAST(ca AS DOUBLE) / ta)) * sqrt(CAST(max(te) AS DOUBLE) * max(ta) / (max(te) + max(ta))) AS lam
    FROM (
      SELECT feature, value, sum(ne) OVER w AS ce, sum(na) OVER w AS ca,
        sum(ne) OVER (PARTITION BY feature) AS te, sum(na) OVER (PARTITION BY feature) AS ta
      FROM (SELECT feature, value, count(*) FILTER (side = 'baseline') AS ne,
                   count(*) FILTER (side = 'current') AS na FROM drift_long GROUP BY feature, value) AS v
      WINDOW w AS (PARTITION BY feature ORDER BY value ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) AS c
    GROUP BY feature) AS k""",
    "side_stats": """SELECT feature, avg(value) FILTER (side = 'baseline') AS baseline_mean,
    avg(value) FILTER (side = 'current') AS current_mean,
    stddev_samp(value) FILTER (side = 'baseline') AS baseline_std,
    stddev_samp(value) FILTER (side = 'current') AS current_std FROM drift_long GROUP BY feature""",
    "drift": """SELECT p.feature, p.psi > 0.1 OR ks_pvalue < 0.05 AS drift_detected, psi, ks_statistic, ks_pvalue,
    baseline_mean, current_mean, baseline_std, current_std
  FROM psi AS p JOIN ks AS k ON k.feature = p.feature JOIN side_stats AS s ON s.feature = p.feature""",
}


def _uses(sql: str) -> set[str]:
    """Tables named in the text, with the tables those read."""
    found: set[str] = set()
    stack = [sql]
    while stack:
        text = stack.pop()
        for name, body in _TABLES.items():
            if name not in found and re.search(rf"\b(FROM|JOIN)\s+{name}\b", text):
                found.add(name)
                stack.append(body)
    return found


def with_tables(sql: str) -> str:
    """Put the common table expressions that the query needs in front of it."""
    used = _uses(sql)
    if not used:
        return sql
    heads = ",\n".join(f"{name} AS ({body})" for name, body in _TABLES.items() if name in used)
    text = sql.strip()
    if text.upper().startswith("WITH "):
        return f"WITH {heads},\n{text[5:]}"
    return f"WITH {heads}\n{text}"

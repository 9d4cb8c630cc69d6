"""Registered queries of the cleaning operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyward.functions import values as V
from tallyward.operators import clean
from tallyward.plans.catalog import query
from tallyward.plans.inputs import AMOUNTS, repeated, rounded, typed
from tallyward.sources.discharges import discharges

_GAPS = ("discharge_key", *AMOUNTS, "hospital_county", "type_of_admission", "payment_typology_1", "birth_weight")


@query("""SELECT discharge_key, length_of_stay, total_charges, total_costs, hospital_county, type_of_admission,
  payment_typology_1 FROM discharges""")
def drop_sparse_columns(spark, sf_dir):
    return clean.drop_sparse_columns(discharges(spark, sf_dir, *_GAPS), 0.5)


def _imputed(spark, sf_dir, strategy):
    return rounded(clean.impute(typed(spark, sf_dir, *_GAPS), strategy, drop_threshold=0.7))


_FILLED = """SELECT discharge_key, round(coalesce(length_of_stay, (SELECT {fn} FROM typed)), 6) AS length_of_stay,
  round(total_charges, 6) AS total_charges,
  round(coalesce(total_costs, (SELECT {fn2} FROM typed)), 6) AS total_costs,
  coalesce(hospital_county, 'Unknown') AS hospital_county,
  coalesce(type_of_admission, 'Unknown') AS type_of_admission,
  coalesce(payment_typology_1, 'Unknown') AS payment_typology_1 FROM typed"""


@query(_FILLED.format(fn="avg(length_of_stay)", fn2="avg(total_costs)"))
def impute_mean(spark, sf_dir):
    return _imputed(spark, sf_dir, "mean")


@query(_FILLED.format(fn="quantile_cont(length_of_stay, 0.5)", fn2="quantile_cont(total_costs, 0.5)"))
def impute_median(spark, sf_dir):
    return _imputed(spark, sf_dir, "median")


def _mode_sql(c: str) -> str:
    return f"(SELECT {c} FROM typed WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)"


@query(f"""SELECT discharge_key, length_of_stay, total_charges, round(total_costs, 6) AS total_costs,
  coalesce(hospital_county, {_mode_sql('hospital_county')}) AS hospital_county,
  coalesce(type_of_admission, {_mode_sql('type_of_admission')}) AS type_of_admission,
  coalesce(payment_typology_1, {_mode_sql('payment_typology_1')}) AS payment_typology_1 FROM typed""")
def impute_mode(spark, sf_dir):
    return _imputed(spark, sf_dir, "mode")


@query("""SELECT discharge_key, TRY_CAST(length_of_stay AS DOUBLE) AS length_of_stay,
  TRY_CAST(total_charges AS DOUBLE) AS total_charges, round(TRY_CAST(total_costs AS DOUBLE), 6) AS total_costs,
  CAST(apr_drg_code AS VARCHAR) AS apr_drg_code, CAST(permanent_facility_id AS DOUBLE) AS permanent_facility_id
  FROM discharges""")
def convert_types(spark, sf_dir):
    df = discharges(spark, sf_dir, "discharge_key", *AMOUNTS, "apr_drg_code", "permanent_facility_id")
    kinds = {**clean.COST_TYPES, "apr_drg_code": "category", "permanent_facility_id": "float", "absent": "numeric"}
    return rounded(clean.convert_types(df, kinds))


_FEW = ("discharge_key", "order_no", "hospital_county", "length_of_stay", "total_costs")


@query(f"SELECT DISTINCT {', '.join(_FEW)} FROM repeated")
def dedup_rows(spark, sf_dir):
    return clean.drop_duplicates(repeated(spark, sf_dir, *_FEW))


@query(f"""SELECT {', '.join(_FEW)} FROM (
  SELECT *, row_number() OVER (PARTITION BY order_no ORDER BY discharge_key) AS place FROM repeated) AS t
  WHERE place = 1""")
def dedup_subset_first(spark, sf_dir):
    return clean.drop_duplicates(repeated(spark, sf_dir, *_FEW), ["order_no"], ["discharge_key"])


@query("""WITH a AS (SELECT quantile_cont(total_costs, 0.25) AS q1, quantile_cont(total_costs, 0.75) AS q3 FROM typed),
  kept AS (SELECT t.* FROM typed AS t, a WHERE total_costs BETWEEN q1 - 0.5 * (q3 - q1) AND q3 + 0.5 * (q3 - q1)),
  b AS (SELECT quantile_cont(length_of_stay, 0.25) AS q1, quantile_cont(length_of_stay, 0.75) AS q3 FROM kept)
  SELECT discharge_key, total_costs, length_of_stay FROM kept, b
  WHERE length_of_stay BETWEEN q1 - 0.5 * (q3 - q1) AND q3 + 0.5 * (q3 - q1)""")
def outliers_iqr(spark, sf_dir):
    df = typed(spark, sf_dir, "discharge_key", "total_costs", "length_of_stay")
    return clean.remove_outliers(df, ["total_costs", "absent", "length_of_stay"], "iqr", 0.5)


@query("""WITH a AS (SELECT avg(total_costs) AS m, stddev_samp(total_costs) AS s FROM typed),
  kept AS (SELECT t.* FROM typed AS t, a WHERE abs((total_costs - m) / s) < 1.5),
  b AS (SELECT avg(length_of_stay) AS m, stddev_samp(length_of_stay) AS s FROM kept)
  SELECT discharge_key, total_costs, length_of_stay FROM kept, b WHERE abs((length_of_stay - m) / s) < 1.5""")
def outliers_zscore(spark, sf_dir):
    df = typed(spark, sf_dir, "discharge_key", "total_costs", "length_of_stay")
    return clean.remove_outliers(df, ["total_costs", "length_of_stay"], "zscore", 1.5)


@query("""WITH a AS (SELECT quantile_cont(total_costs, 0.01) AS lo1, quantile_cont(total_costs, 0.99) AS hi1,
    quantile_cont(length_of_stay, 0.01) AS lo2, quantile_cont(length_of_stay, 0.99) AS hi2 FROM typed)
  SELECT discharge_key,
    round(CASE WHEN total_costs IS NOT NULL THEN least(greatest(total_costs, lo1), hi1) END, 6) AS total_costs,
    round(CASE WHEN length_of_stay IS NOT NULL THEN least(greatest(length_of_stay, lo2), hi2) END, 6) AS length_of_stay
  FROM typed, a""")
def cap_outliers(spark, sf_dir):
    df = typed(spark, sf_dir, "discharge_key", "total_costs", "length_of_stay")
    return rounded(clean.cap_outliers(df, ["total_costs", "length_of_stay"]))


@query("""SELECT discharge_key,
  replace(regexp_replace(regexp_replace(lower(type_of_admission), '^\\s+', ''), '\\s+$', ''), ' ', '_') AS type_of_admission,
  replace(regexp_replace(regexp_replace(lower(payment_typology_1), '^\\s+', ''), '\\s+$', ''), ' ', '_') AS payment_typology_1
  FROM discharges""")
def standardize_text(spark, sf_dir):
    df = discharges(spark, sf_dir, "discharge_key", "type_of_admission", "payment_typology_1")
    return clean.standardize_text(df, ["type_of_admission", "payment_typology_1", "absent"], replace_spaces=True)


@query("""SELECT doc_id, replace(regexp_replace(regexp_replace(lower(text), '^\\s+', ''), '\\s+$', ''), ' ', '_') AS text,
  regexp_replace(regexp_replace(lower(source), '^\\s+', ''), '\\s+$', '') AS source FROM documents""")
def standardize_documents(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source")
    return clean.standardize_text(clean.standardize_text(df, ["text"], replace_spaces=True), ["source"])


@query("""SELECT discharge_key, length_of_stay, round(total_costs, 6) AS total_costs, gender FROM typed
  WHERE length_of_stay >= 3 AND total_costs < 50000 AND gender = 'F'""")
def filter_rows(spark, sf_dir):
    df = typed(spark, sf_dir, "discharge_key", "length_of_stay", "total_costs", "gender")
    return rounded(clean.filter_rows(df, {
        "length_of_stay": lambda c: c >= 3, "total_costs": lambda c: c < 50_000, "gender": "F", "absent": 1}))


@query("""SELECT * EXCLUDE (birth_weight, total_costs, order_no, permanent_facility_id, apr_drg_code, discharge_ts,
    hospital_county, type_of_admission, ccsr_procedure_description, payment_typology_1, payment_typology_2, payment_typology_3),
  round(total_costs, 6) AS total_costs, CAST(order_no AS DOUBLE) AS order_no,
  CAST(permanent_facility_id AS DOUBLE) AS permanent_facility_id, CAST(apr_drg_code AS DOUBLE) AS apr_drg_code,
  coalesce(hospital_county, 'Unknown') AS hospital_county, coalesce(type_of_admission, 'Unknown') AS type_of_admission,
  coalesce(ccsr_procedure_description, 'Unknown') AS ccsr_procedure_description,
  coalesce(payment_typology_1, 'Unknown') AS payment_typology_1,
  coalesce(payment_typology_2, 'Unknown') AS payment_typology_2,
  coalesce(payment_typology_3, 'Unknown') AS payment_typology_3 FROM valid""")
def clean_discharges(spark, sf_dir):
    return rounded(clean.clean_discharges(repeated(spark, sf_dir)).drop("discharge_ts"))


@query("SELECT discharge_key, round(total_costs, 6) AS total_costs FROM typed WHERE total_costs IS NOT NULL")
def drop_null_target(spark, sf_dir):
    return rounded(clean.drop_null_target(typed(spark, sf_dir, "discharge_key", "total_costs"), "total_costs"))


@query("SELECT discharge_key, length_of_stay FROM typed")
def topcode_los(spark, sf_dir):
    df = discharges(spark, sf_dir, "discharge_key", "length_of_stay")
    return clean.convert_types(df, {"length_of_stay": "numeric"}, V.STAY_TOPCODE)


@query("""SELECT discharge_key, coalesce(payment_typology_1, payment_typology_2, payment_typology_3, 'Unknown') AS payment
  FROM discharges""")
def payment_coalesce(spark, sf_dir):
    payments = ["payment_typology_1", "payment_typology_2", "payment_typology_3"]
    df = discharges(spark, sf_dir, "discharge_key", *payments)
    return clean.first_present(df, payments, "payment").select("discharge_key", "payment")


@query("""SELECT length_of_stay, total_charges, round(total_costs, 6) AS total_costs, apr_drg_code FROM typed""")
def project_features(spark, sf_dir):
    df = typed(spark, sf_dir, "discharge_key", "order_no", *AMOUNTS, "facility_name", "permanent_facility_id",
               "apr_drg_code")
    return rounded(clean.project_features(df, ["order_no", "permanent_facility_id", "absent"]))


@query("""SELECT discharge_key, coalesce(hospital_county, 'Unknown') AS hospital_county,
  coalesce(ccsr_procedure_description, 'Unknown') AS ccsr_procedure_description,
  coalesce(CAST(birth_weight AS VARCHAR), 'Unknown') AS birth_weight FROM discharges""")
def fill_unknown(spark, sf_dir):
    columns = ["hospital_county", "ccsr_procedure_description", "birth_weight"]
    return clean.fill_unknown(discharges(spark, sf_dir, "discharge_key", *columns), columns)


_REPORTED = ("discharge_key", "order_no", *AMOUNTS, "hospital_county", "payment_typology_1", "birth_weight")


@query(f"""WITH r AS (SELECT {', '.join(_REPORTED)} FROM repeated),
  d AS (SELECT DISTINCT * FROM r),
  t AS (SELECT * REPLACE (
      CASE WHEN length_of_stay = '120+' THEN 120.0 ELSE TRY_CAST(length_of_stay AS DOUBLE) END AS length_of_stay,
      TRY_CAST(total_charges AS DOUBLE) AS total_charges, TRY_CAST(total_costs AS DOUBLE) AS total_costs) FROM d),
  v AS (SELECT * FROM t WHERE total_costs > 0 AND total_costs < 10000000 AND length_of_stay >= 0),
  s AS (SELECT (SELECT count(*) FROM r) AS r, (SELECT count(*) FROM d) AS d, count(*) AS v,
    count(*) FILTER (hospital_county IS NULL) + count(*) FILTER (payment_typology_1 IS NULL)
      + count(*) FILTER (birth_weight IS NULL) AS gaps FROM v)
  SELECT CAST(0 AS INT) AS step, 'input' AS operation, 'rows' AS metric, CAST(r AS DOUBLE) AS value, CAST(NULL AS VARCHAR) AS detail FROM s
  UNION ALL SELECT 0, 'input', 'columns', 8, NULL FROM s
  UNION ALL SELECT 1, 'drop_duplicates', 'rows_removed', r - d, NULL FROM s
  UNION ALL SELECT 2, 'convert_types', 'columns_converted', 3, 'total_costs,total_charges,length_of_stay' FROM s
  UNION ALL SELECT 3, 'filter_rows', 'rows_removed', d - v, 'total_costs,length_of_stay' FROM s
  UNION ALL SELECT 4, 'impute', 'missing_before', gaps, NULL FROM s
  UNION ALL SELECT 4, 'impute', 'missing_after', 0, NULL FROM s
  UNION ALL SELECT 4, 'impute', 'columns_dropped', 1, 'birth_weight' FROM s
  UNION ALL SELECT 5, 'output', 'rows', v, NULL FROM s
  UNION ALL SELECT 5, 'output', 'columns', 7, NULL FROM s""")
def cleaning_report(spark, sf_dir):
    return clean.cleaning_report(repeated(spark, sf_dir, *_REPORTED))


@query("""SELECT 'total_costs' AS "column", 'min' AS rule, count(*) FILTER (total_costs < 0) AS violations FROM typed
  UNION ALL SELECT 'total_costs', 'max', count(*) FILTER (total_costs > 100000) FROM typed
  UNION ALL SELECT 'total_costs', 'required', count(*) FILTER (total_costs IS NULL) FROM typed
  UNION ALL SELECT 'length_of_stay', 'min', count(*) FILTER (length_of_stay < 0) FROM typed
  UNION ALL SELECT 'length_of_stay', 'max', count(*) FILTER (length_of_stay > 100) FROM typed
  UNION ALL SELECT 'gender', 'allowed', count(*) FILTER (gender NOT IN ('M', 'F')) FROM typed""")
def validate_rules(spark, sf_dir):
    df = typed(spark, sf_dir, "total_costs", "length_of_stay", "gender")
    return clean.validate(df, {
        "total_costs": {"min": 0, "max": 100_000, "required": True},
        "length_of_stay": {"min": 0, "max": 100},
        "gender": {"allowed": ["M", "F"]},
        "absent": {"required": True},
    })

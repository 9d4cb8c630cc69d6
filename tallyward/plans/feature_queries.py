"""Registered queries of the derived columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyward.operators import clean, features, profile
from tallyward.plans.catalog import query
from tallyward.plans.inputs import AMOUNTS, repeated, rounded, typed
from tallyward.sources.discharges import discharges

_RANK = """CASE age_group WHEN '0-17' THEN 1 WHEN '18-29' THEN 2 WHEN '30-49' THEN 3 WHEN '50-69' THEN 4
  WHEN '70 or Older' THEN 5 WHEN '70+' THEN 5 END"""
_RISK = f"CASE WHEN {_RANK} <= 2 THEN 'Low' WHEN {_RANK} <= 4 THEN 'Medium' WHEN {_RANK} <= 6 THEN 'High' END"
_LEVEL = "CASE {c} WHEN 'Minor' THEN 1 WHEN 'Moderate' THEN 2 WHEN 'Major' THEN 3 WHEN 'Extreme' THEN 4 END"
_SEVERITY = _LEVEL.format(c="apr_severity_of_illness_description")
_MORTALITY = _LEVEL.format(c="apr_risk_of_mortality")
_BAND = """CASE WHEN length_of_stay <= -1 THEN NULL WHEN length_of_stay <= 1 THEN '{0}' WHEN length_of_stay <= 3 THEN '{1}'
  WHEN length_of_stay <= 7 THEN '{2}' WHEN length_of_stay <= 14 THEN '{3}' WHEN length_of_stay IS NOT NULL THEN '{4}' END"""
_DAYS = _BAND.format("Very Short (0-1)", "Short (2-3)", "Medium (4-7)", "Long (8-14)", "Very Long (15+)")
_PLAIN = _BAND.format("Very Short", "Short", "Medium", "Long", "Very Long")


def _flag(test: str) -> str:
    return f"CASE WHEN {test} THEN 1 ELSE 0 END"


def _has(c: str, text: str) -> str:
    return _flag(f"lower({c}) LIKE '%{text}%'")


_AGE = f"""{_RANK} AS age_risk_score, {_flag("age_group = '0-17'")} AS is_pediatric,
  {_flag("age_group IN ('70 or Older', '70+')")} AS is_elderly, {_flag("age_group = '50-69'")} AS is_middle_aged"""
_RATIOS = """total_costs / NULLIF(length_of_stay + 1, 0) AS cost_per_day,
  total_costs / NULLIF(total_charges + 1, 0) AS cost_to_charge_ratio"""
_EFFICIENCY = "1 / NULLIF(length_of_stay + 1, 0) * total_costs AS cost_efficiency"
_STAY = f"""{_DAYS} AS los_category, {_flag('length_of_stay > 7')} AS extended_stay,
  {_flag('length_of_stay <= 3')} AS short_stay"""
_LEVELS = f"{_SEVERITY} AS severity_encoded, {_MORTALITY} AS mortality_risk_encoded"
_MIX = f"{_SEVERITY} * CAST(0.6 AS DOUBLE) + {_MORTALITY} * CAST(0.4 AS DOUBLE) AS combined_risk_score"
_PRODUCTS = f"""{_SEVERITY} * length_of_stay AS severity_los_interaction,
  {_SEVERITY} * {_RANK} AS severity_age_interaction"""
_ADMISSION = f"""{_has('type_of_admission', 'emergency')} AS is_emergency, {_has('type_of_admission', 'elective')} AS is_elective,
  {_has('type_of_admission', 'urgent')} AS is_urgent, {_flag("emergency_department_indicator = 'Y'")} AS ed_visit"""
_MEDSURG = f"""{_has('apr_medical_surgical_description', 'surgical')} AS is_surgical,
  {_has('apr_medical_surgical_description', 'medical')} AS is_medical"""
_PAYMENT = f"""{_has('payment_typology_1', 'medicare')} AS is_medicare, {_has('payment_typology_1', 'medicaid')} AS is_medicaid,
  {_has('payment_typology_1', 'private')} AS is_private"""
_COSTS = "length_of_stay, total_charges, total_costs"

_SOURCES = ("age_group", "apr_severity_of_illness_description", "apr_risk_of_mortality", "type_of_admission",
            "emergency_department_indicator", "apr_medical_surgical_description", "payment_typology_1")


@query(f"SELECT discharge_key, age_group, {_AGE}, {_RISK} AS age_risk_category FROM discharges")
def feat_age(spark, sf_dir):
    return features.age(discharges(spark, sf_dir, "discharge_key", "age_group"), category=True)


@query(f"SELECT discharge_key, {_COSTS}, {_RATIOS}, {_EFFICIENCY} FROM typed")
def feat_cost_ratios(spark, sf_dir):
    return features.cost_ratios(discharges(spark, sf_dir, "discharge_key", *AMOUNTS))


@query("""SELECT discharge_key, round(CASE WHEN total_costs > -1 THEN ln(1 + total_costs) END, 6) AS log_total_costs,
  round(CASE WHEN length_of_stay > -1 THEN ln(1 + length_of_stay) END, 6) AS los_log,
  round(CASE WHEN total_costs >= 0 THEN sqrt(total_costs) END, 6) AS cost_root,
  round(CASE WHEN total_costs > 0 THEN ln(total_costs) END, 6) AS cost_ln,
  round(CASE WHEN total_costs > -1 THEN total_costs END, 4) AS restored FROM typed""")
def feat_log(spark, sf_dir):
    df = typed(spark, sf_dir, "discharge_key", "total_costs", "length_of_stay")
    for column, name, method in (("total_costs", "log_total_costs", "log1p"), ("length_of_stay", "los_log", "log1p"),
                                 ("total_costs", "cost_root", "sqrt"), ("total_costs", "cost_ln", "log")):
        df = features.transform_target(df, column, name, method)
    df = features.restore_target(df, "log_total_costs", "restored")
    return rounded(df.drop("total_costs", "length_of_stay"), restored=4)


@query(f"SELECT discharge_key, length_of_stay, {_STAY}, {_PLAIN} AS los_label FROM typed")
def feat_los(spark, sf_dir):
    df = features.stay(discharges(spark, sf_dir, "discharge_key", "length_of_stay"))
    return df.withColumn("los_label", features.cut(F.col("length_of_stay"), features.V.STAY_EDGES, features.V.STAY_LABELS))


@query(f"SELECT discharge_key, {_LEVELS}, {_MIX}, {_PRODUCTS} FROM typed")
def feat_severity(spark, sf_dir):
    df = discharges(spark, sf_dir, "discharge_key", "length_of_stay", *_SOURCES[:3])
    df = features.severity(features.age(df, flags=False))
    return df.drop("length_of_stay", "age_risk_score", *_SOURCES)


@query(f"SELECT discharge_key, {_ADMISSION} FROM discharges")
def feat_admission(spark, sf_dir):
    df = discharges(spark, sf_dir, "discharge_key", "type_of_admission", "emergency_department_indicator")
    return features.admission(df).drop(*_SOURCES)


@query(f"SELECT discharge_key, {_MEDSURG} FROM discharges")
def feat_medsurg(spark, sf_dir):
    df = discharges(spark, sf_dir, "discharge_key", "apr_medical_surgical_description")
    return features.medical_surgical(df).drop(*_SOURCES)


@query(f"SELECT discharge_key, {_PAYMENT} FROM discharges")
def feat_payment(spark, sf_dir):
    return features.payment(discharges(spark, sf_dir, "discharge_key", "payment_typology_1")).drop(*_SOURCES)


@query(f"""SELECT discharge_key, {_COSTS}, {_AGE}, {_RATIOS}, {_EFFICIENCY}, {_LEVELS}, {_MIX}, {_PRODUCTS}, {_ADMISSION},
  {_MEDSURG}, {_PAYMENT}, {_STAY} FROM typed""")
def feat_all_sql(spark, sf_dir):
    df = features.all_groups(discharges(spark, sf_dir, "discharge_key", *AMOUNTS, *_SOURCES))
    return df.drop(*_SOURCES)


@query(f"""SELECT discharge_key, {_COSTS}, {_RANK} AS age_risk_score, {_RATIOS}, {_SEVERITY} AS severity_encoded,
  {_SEVERITY} * length_of_stay AS severity_los_interaction FROM typed""")
def feat_sql_text(spark, sf_dir):
    df = typed(spark, sf_dir, "discharge_key", *AMOUNTS, *_SOURCES[:2])
    return features.sql_features(df, "age", "cost_ratios", "severity").drop(*_SOURCES)


@query(f"""SELECT discharge_key, {_COSTS}, {_RANK} AS age_encoded, {_RISK} AS age_risk_category, {_PLAIN} AS los_category,
  round(ln(1 + length_of_stay), 6) AS los_log, {_flag('length_of_stay > 7')} AS extended_stay_flag,
  round(ln(1 + total_costs), 6) AS log_total_costs, {_RATIOS}, {_LEVELS}, {_MIX},
  {_has('type_of_admission', 'emergency')} AS emergency_admission,
  {_flag("emergency_department_indicator = 'Y'")} AS ed_flag FROM valid""")
def engineer_features(spark, sf_dir):
    df = repeated(spark, sf_dir, "discharge_key", "order_no", *AMOUNTS, *_SOURCES[:5]).drop("order_no")
    return rounded(features.engineer_features(clean.clean_discharges(df)).drop(*_SOURCES), None, los_log=6, log_total_costs=6)


@query("""SELECT apr_severity_of_illness_description, round(avg(total_costs), 4) AS mean,
  round(quantile_cont(total_costs, 0.5), 6) AS median, count(total_costs) AS rows FROM valid GROUP BY ALL""")
def severity_costs(spark, sf_dir):
    df = repeated(spark, sf_dir, "discharge_key", "order_no", *AMOUNTS, *_SOURCES[:5])
    df = features.engineer_features(clean.clean_discharges(df))
    return rounded(profile.group_stats(df, ["apr_severity_of_illness_description"], "total_costs"), mean=4)

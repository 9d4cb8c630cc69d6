"""Registered queries of the profiling operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyward.functions import values as V
from tallyward.operators import profile, split
from tallyward.operators.features import transform_target
from tallyward.plans.catalog import query
from tallyward.plans.inputs import AMOUNTS, rounded, typed
from tallyward.sources.discharges import COLUMNS, discharges

_WIDE = tuple(c for c in COLUMNS if c != "discharge_ts")


@query(f"SELECT count(*) AS rows, {len(COLUMNS)} AS columns FROM discharges")
def profile_shape(spark, sf_dir):
    return profile.shape(discharges(spark, sf_dir))


def _per_column(fn: str, name: str, columns) -> str:
    return " UNION ALL ".join(f"SELECT '{c}' AS \"column\", {fn.format(c=c)} AS {name} FROM discharges" for c in columns)


_TYPES = {c: "string" for c in _WIDE} | {"order_no": "bigint", "permanent_facility_id": "bigint",
                                          "apr_drg_code": "int", "birth_weight": "bigint"}


@query(" UNION ALL ".join(f"SELECT '{c}' AS \"column\", '{t}' AS type, count({c}) AS filled FROM discharges"
                          for c, t in _TYPES.items()))
def profile_columns(spark, sf_dir):
    return profile.column_info(discharges(spark, sf_dir, *_WIDE))


@query(_per_column("count(*) - count({c})", "nulls", _WIDE))
def profile_nulls(spark, sf_dir):
    return profile.null_counts(discharges(spark, sf_dir, *_WIDE))


@query(_per_column("count(DISTINCT {c})", '"distinct"', _WIDE))
def profile_nunique(spark, sf_dir):
    return profile.distinct_counts(discharges(spark, sf_dir, *_WIDE))


@query("""SELECT count(*) FILTER (hospital_county IS NULL) AS nulls,
  count(*) FILTER (hospital_county IS NULL AND payment_typology_1 IS NULL) AS both FROM discharges""")
def profile_null_overlap(spark, sf_dir):
    return profile.null_overlap(discharges(spark, sf_dir, "hospital_county", "payment_typology_1"),
                                "hospital_county", "payment_typology_1")


@query("""SELECT hospital_county, count(*) AS count FROM discharges WHERE hospital_county IS NOT NULL GROUP BY ALL""")
def value_counts(spark, sf_dir):
    return profile.value_counts(discharges(spark, sf_dir, "hospital_county"), ["hospital_county"])


@query("""SELECT apr_mdc_description, apr_drg_code, count(*) AS count FROM discharges GROUP BY ALL""")
def value_counts_multi(spark, sf_dir):
    keys = ["apr_mdc_description", "apr_drg_code"]
    return profile.value_counts(discharges(spark, sf_dir, *keys), keys)


@query("""SELECT age_group, count(*) AS count, CAST(CASE age_group WHEN '0-17' THEN 1 WHEN '18-29' THEN 2 WHEN '30-49' THEN 3
  WHEN '50-69' THEN 4 WHEN '70 or Older' THEN 5 WHEN '70+' THEN 6 END AS INT) AS place FROM discharges GROUP BY ALL""")
def value_counts_ordered(spark, sf_dir):
    return profile.value_counts_ordered(discharges(spark, sf_dir, "age_group"), "age_group", V.AGE_ORDER)


@query("""SELECT health_service_area, count(*) AS count, round(count(*) * 100.0 / (SELECT count(*) FROM discharges), 6) AS share
  FROM discharges GROUP BY ALL""")
def value_share(spark, sf_dir):
    return rounded(profile.value_share(discharges(spark, sf_dir, "health_service_area"), "health_service_area"))


@query("""SELECT health_service_area, round(avg(total_costs), 4) AS mean FROM typed GROUP BY ALL""")
def group_mean(spark, sf_dir):
    return rounded(profile.group_mean(typed(spark, sf_dir, "health_service_area", "total_costs"),
                                      "health_service_area", "total_costs"), 4)


_COUNTED = ("age_group", "length_of_stay", "total_costs", "type_of_admission", "birth_weight")


@query(f"""SELECT hospital_county, {', '.join(f'count({c}) AS {c}' for c in _COUNTED)} FROM discharges
  WHERE hospital_county IS NOT NULL GROUP BY hospital_county""")
def group_count_all(spark, sf_dir):
    return profile.group_count_all(discharges(spark, sf_dir, "hospital_county", *_COUNTED), "hospital_county")


def _stats_sql(key: str) -> str:
    return (f"SELECT {key}, round(avg(total_costs), 4) AS mean, round(quantile_cont(total_costs, 0.5), 6) AS median, "
            f"count(total_costs) AS rows FROM typed WHERE {key} IS NOT NULL GROUP BY {key}")


@query(_stats_sql("apr_severity_of_illness_description"))
def group_stats(spark, sf_dir):
    key = "apr_severity_of_illness_description"
    return rounded(profile.group_stats(typed(spark, sf_dir, key, "total_costs"), [key], "total_costs"), mean=4)


_DIMENSIONS = ("age_group", "gender", "type_of_admission", "apr_mdc_description", "apr_severity_of_illness_description",
               "apr_risk_of_mortality", "apr_medical_surgical_description", "emergency_department_indicator",
               "health_service_area", "payment_typology_1")


@query(f"""SELECT * FROM (SELECT CASE {' '.join(f"WHEN GROUPING({d}) = 0 THEN '{d}'" for d in _DIMENSIONS)} END AS dimension,
    CASE {' '.join(f"WHEN GROUPING({d}) = 0 THEN {d}" for d in _DIMENSIONS)} END AS level,
    round(avg(total_costs), 4) AS mean, round(quantile_cont(total_costs, 0.5), 6) AS median, count(total_costs) AS rows
  FROM typed GROUP BY GROUPING SETS ({', '.join(f'({d})' for d in _DIMENSIONS)})) AS g WHERE level IS NOT NULL""")
def group_stats_all_dims(spark, sf_dir):
    df = typed(spark, sf_dir, "total_costs", *_DIMENSIONS)
    return rounded(profile.group_stats_by_dimension(df, list(_DIMENSIONS), "total_costs"), mean=4)


@query(f"""SELECT * FROM (SELECT CASE {' '.join(f"WHEN GROUPING({d}) = 0 THEN '{d}'" for d in _DIMENSIONS)} END AS dimension,
    CASE {' '.join(f"WHEN GROUPING({d}) = 0 THEN {d}" for d in _DIMENSIONS)} END AS level,
    round(avg(length_of_stay), 6) AS mean, count(length_of_stay) AS rows
  FROM typed GROUP BY GROUPING SETS ({', '.join(f'({d})' for d in _DIMENSIONS)})) AS g WHERE level IS NOT NULL""")
def group_mean_all_dims(spark, sf_dir):
    df = typed(spark, sf_dir, "length_of_stay", *_DIMENSIONS)
    return rounded(profile.mean_by_dimension(df, list(_DIMENSIONS), "length_of_stay"))


_RISKS = ["Minor", "Moderate", "Major", "Extreme"]


@query(f"""SELECT age_group, {', '.join(f"round(avg(total_costs) FILTER (apr_risk_of_mortality = '{v}'), 4) AS \"{v}\"" for v in _RISKS)}
  FROM typed GROUP BY age_group""")
def pivot_mean(spark, sf_dir):
    df = typed(spark, sf_dir, "age_group", "apr_risk_of_mortality", "total_costs")
    return rounded(profile.pivot_mean(df, "age_group", "apr_risk_of_mortality", "total_costs", _RISKS), 4)


def _describe_sql(name: str, c: str) -> str:
    return f"""SELECT '{name}' AS feature, count({c}) AS rows, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std,
      round(min({c}), 4) AS min, round(quantile_cont({c}, 0.25), 4) AS q1, round(quantile_cont({c}, 0.5), 4) AS median,
      round(quantile_cont({c}, 0.75), 4) AS q3, round(max({c}), 4) AS max FROM typed"""


@query(f"""SELECT * REPLACE (round(median, 3) AS median, round(q1, 3) AS q1, round(q3, 3) AS q3) FROM (
  {_describe_sql('total_costs', 'total_costs')} UNION ALL {_describe_sql('length_of_stay', 'length_of_stay')} UNION ALL
  {_describe_sql('log_total_costs', '(CASE WHEN total_costs > -1 THEN ln(1 + total_costs) END)')}) AS d""")
def describe_target(spark, sf_dir):
    df = transform_target(typed(spark, sf_dir, "total_costs", "length_of_stay"), "total_costs", "log_total_costs")
    return rounded(rounded(profile.describe(df, ["total_costs", "length_of_stay", "log_total_costs"]), 4),
                   4, median=3, q1=3, q3=3)


_NUMERIC = ("length_of_stay", "total_charges", "total_costs", "apr_drg_code")


@query(" UNION ALL ".join(f"SELECT '{a}' AS x, '{b}' AS y, round(corr({a}, {b}), 6) AS r FROM typed"
                          for a in _NUMERIC for b in _NUMERIC))
def corr_matrix(spark, sf_dir):
    df = typed(spark, sf_dir, *AMOUNTS, "apr_drg_code", "permanent_facility_id", "gender")
    return rounded(profile.correlations(df, drop=["permanent_facility_id"]))


@query("SELECT round(corr(total_costs, length_of_stay), 6) AS r FROM typed")
def corr_pair(spark, sf_dir):
    return rounded(profile.correlation(typed(spark, sf_dir, "total_costs", "length_of_stay"),
                                       "total_costs", "length_of_stay"))


@query("""WITH r AS (SELECT min(length_of_stay) AS lo, max(length_of_stay) AS hi FROM typed),
  b AS (SELECT greatest(1, least(10, CAST(ceil((length_of_stay - lo) / ((hi - lo) / 10)) AS INT))) AS bin, total_costs, lo, hi
        FROM typed, r WHERE length_of_stay IS NOT NULL)
  SELECT bin, count(*) AS rows, round(avg(total_costs), 4) AS mean, round(max(lo) + (bin - 1) * ((max(hi) - max(lo)) / 10), 6) AS low,
    round(max(lo) + bin * ((max(hi) - max(lo)) / 10), 6) AS high FROM b GROUP BY bin""")
def equal_width_bin_mean(spark, sf_dir):
    df = typed(spark, sf_dir, "length_of_stay", "total_costs")
    return rounded(profile.binned_mean(df, "length_of_stay", "total_costs"), mean=4)


@query("""WITH r AS (SELECT min(total_costs) AS lo, max(total_costs) AS hi FROM typed),
  b AS (SELECT greatest(1, least(100, CAST(floor((total_costs - lo) / ((hi - lo) / 100)) AS INT) + 1)) AS bin
        FROM typed, r WHERE total_costs IS NOT NULL),
  c AS (SELECT bin, count(*) AS n FROM b GROUP BY bin)
  SELECT CAST(g.bin AS INT) AS bin, round(lo + (g.bin - 1) * ((hi - lo) / 100), 4) AS low, coalesce(n, 0) AS rows
  FROM (SELECT unnest(range(1, 101)) AS bin) AS g LEFT JOIN c ON c.bin = g.bin, r""")
def histogram(spark, sf_dir):
    return rounded(profile.histogram(typed(spark, sf_dir, "total_costs"), "total_costs"), 4)


@query("""WITH f AS (SELECT age_group, quantile_cont(total_costs, 0.25) AS q1, quantile_cont(total_costs, 0.5) AS median,
    quantile_cont(total_costs, 0.75) AS q3 FROM typed GROUP BY age_group)
  SELECT t.age_group, count(*) AS rows, round(max(q1), 6) AS q1, round(max(median), 6) AS median, round(max(q3), 6) AS q3,
    round(min(total_costs) FILTER (total_costs BETWEEN q1 - 0.5 * (q3 - q1) AND q3 + 0.5 * (q3 - q1)), 6) AS whisker_low,
    round(max(total_costs) FILTER (total_costs BETWEEN q1 - 0.5 * (q3 - q1) AND q3 + 0.5 * (q3 - q1)), 6) AS whisker_high,
    count(*) FILTER (NOT (total_costs BETWEEN q1 - 0.5 * (q3 - q1) AND q3 + 0.5 * (q3 - q1))) AS outliers
  FROM typed AS t JOIN f ON f.age_group = t.age_group WHERE total_costs IS NOT NULL GROUP BY t.age_group""")
def box_stats(spark, sf_dir):
    df = typed(spark, sf_dir, "age_group", "total_costs")
    return rounded(profile.box_stats(df, "total_costs", "age_group", 0.5))


def _top(name: str, key: str, k: int) -> None:
    def run(spark, sf_dir):
        return rounded(profile.top_means(typed(spark, sf_dir, key, "total_costs"), key, "total_costs", k), 4)

    run.__name__ = name
    query(f"""SELECT {key}, round(mean, 4) AS mean, rows FROM (SELECT {key}, avg(total_costs) AS mean,
      count(total_costs) AS rows FROM typed WHERE {key} IS NOT NULL GROUP BY {key}
      ORDER BY mean DESC NULLS LAST, {key} LIMIT {k}) AS t""")(run)


_top("topk_diagnoses", "ccsr_diagnosis_description", 15)
_top("topk_procedures", "ccsr_procedure_description", 15)
_top("topk_drg", "apr_drg_code", 15)
_top("topk_counties", "hospital_county", 10)


@query("""SELECT discharge_key, apr_drg_code, round(total_costs, 6) AS total_costs FROM typed WHERE apr_drg_code IN (
  SELECT apr_drg_code FROM (SELECT apr_drg_code, avg(total_costs) AS mean FROM typed GROUP BY apr_drg_code
                            ORDER BY mean DESC, apr_drg_code LIMIT 10) AS t)""")
def semi_topk(spark, sf_dir):
    df = typed(spark, sf_dir, "discharge_key", "apr_drg_code", "total_costs")
    return rounded(profile.keep_top(df, "apr_drg_code", "total_costs", 10)
                   .select("discharge_key", "apr_drg_code", "total_costs"))


@query("""SELECT 'head' AS part, * FROM (SELECT discharge_key, order_no, gender FROM discharges ORDER BY discharge_key LIMIT 5) AS h
  UNION ALL SELECT 'tail', * FROM (SELECT discharge_key, order_no, gender FROM discharges ORDER BY discharge_key DESC LIMIT 5) AS t""")
def head_tail(spark, sf_dir):
    df = discharges(spark, sf_dir, "discharge_key", "order_no", "gender")
    first = profile.head(df, 5, "discharge_key").select(F.lit("head").alias("part"), "*")
    last = profile.tail(df, 5, "discharge_key").select(F.lit("tail").alias("part"), "*")
    return first.unionByName(last)


@query("""SELECT discharge_key, length_of_stay, total_charges FROM typed
  ORDER BY md5('42-' || discharge_key), discharge_key LIMIT 50000""")
def sample_n(spark, sf_dir):
    return split.sample_rows(typed(spark, sf_dir, "discharge_key", "length_of_stay", "total_charges"), "discharge_key")

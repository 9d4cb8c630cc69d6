"""Registered queries of encoding, scaling and selection."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tallyward.operators import encode
from tallyward.plans.catalog import query
from tallyward.plans.inputs import AMOUNTS, rounded, typed
from tallyward.sources.discharges import discharges

_SEVERITY = "apr_severity_of_illness_description"
_LEVELS = ("Major", "Minor", "Moderate", "Unclassified")
_COUNTIES = "(SELECT DISTINCT coalesce(hospital_county, 'nan') AS v FROM discharges)"


@query(f"""SELECT discharge_key, gender, {_SEVERITY}, hospital_county,
  {', '.join(f"CASE WHEN {_SEVERITY} = '{v}' THEN 1 ELSE 0 END AS \"{_SEVERITY}_{v}\"" for v in _LEVELS)},
  CASE WHEN gender = 'M' THEN 1 ELSE 0 END AS "gender_M", CASE WHEN gender = 'U' THEN 1 ELSE 0 END AS "gender_U",
  CAST((SELECT count(*) FROM {_COUNTIES} AS c WHERE c.v < coalesce(hospital_county, 'nan')) AS INT) AS hospital_county_encoded
  FROM discharges""")
def encode_onehot(spark, sf_dir):
    columns = ["gender", _SEVERITY, "hospital_county"]
    return encode.encode(discharges(spark, sf_dir, "discharge_key", *columns), [*columns, "absent"], coded=["hospital_county"])


@query(f"""SELECT d.discharge_key, d.ccsr_procedure_description, l.code AS ccsr_procedure_description_encoded FROM discharges AS d
  JOIN (SELECT v, CAST(row_number() OVER (ORDER BY v) - 1 AS INT) AS code FROM
        (SELECT DISTINCT coalesce(ccsr_procedure_description, 'nan') AS v FROM discharges) AS x) AS l
  ON l.v = coalesce(d.ccsr_procedure_description, 'nan')""")
def encode_label(spark, sf_dir):
    df = discharges(spark, sf_dir, "discharge_key", "ccsr_procedure_description")
    return encode.encode(df, ["ccsr_procedure_description"], "label")


@query("""SELECT discharge_key, hospital_county, round(coalesce(mean, (SELECT avg(total_costs) FROM typed)), 4) AS hospital_county_target
  FROM discharges LEFT JOIN (SELECT hospital_county AS c, avg(total_costs) AS mean FROM typed WHERE hospital_county IS NOT NULL
                             GROUP BY hospital_county) AS m ON m.c = hospital_county""")
def encode_target(spark, sf_dir):
    df = typed(spark, sf_dir, "discharge_key", "hospital_county", "total_costs")
    return rounded(encode.encode(df, ["hospital_county"], "target", target="total_costs").drop("total_costs"), 4)


def _scaled_sql(shift: str, width: str) -> str:
    columns = ", ".join(f"round(({c} - (SELECT {shift.format(c=c)} FROM typed)) / (SELECT {width.format(c=c)} FROM typed), 6) "
                        f"AS {c}_scaled" for c in ("length_of_stay", "total_charges"))
    return f"SELECT discharge_key, {columns} FROM typed"


def _scaled(spark, sf_dir, method):
    columns = ["length_of_stay", "total_charges"]
    df = encode.scale(typed(spark, sf_dir, "discharge_key", *columns), columns, method)
    return rounded(df.drop(*columns))


@query(_scaled_sql("avg({c})", "stddev_pop({c})"))
def scale_standard(spark, sf_dir):
    return _scaled(spark, sf_dir, "standard")


@query(_scaled_sql("min({c})", "max({c}) - min({c})"))
def scale_minmax(spark, sf_dir):
    return _scaled(spark, sf_dir, "minmax")


@query(_scaled_sql("0 * max({c})", "max(abs({c}))"))
def scale_maxabs(spark, sf_dir):
    return _scaled(spark, sf_dir, "maxabs")


@query("""SELECT discharge_key, CASE WHEN birth_weight IS NULL THEN 1 ELSE 0 END AS birth_weight_missing,
  CASE WHEN hospital_county IS NULL THEN 1 ELSE 0 END AS hospital_county_missing FROM discharges""")
def impute_marker(spark, sf_dir):
    columns = ["birth_weight", "hospital_county"]
    return encode.mark_missing(discharges(spark, sf_dir, "discharge_key", *columns), columns).drop(*columns)


_CANDIDATES = ("length_of_stay", "total_charges", "apr_drg_code", "permanent_facility_id", "birth_weight")


def _candidates(spark, sf_dir):
    return typed(spark, sf_dir, "length_of_stay", "total_charges", "apr_drg_code", "permanent_facility_id",
                 "birth_weight", "total_costs")


@query(f"""WITH f AS (SELECT {', '.join(f'coalesce(CAST({c} AS DOUBLE), 0) AS {c}' for c in (*_CANDIDATES, 'total_costs'))} FROM typed),
  s AS ({' UNION ALL '.join(f"SELECT {i} AS place, '{c}' AS feature, corr({c}, total_costs) AS r, count(*) AS n FROM f" for i, c in enumerate(_CANDIDATES))})
  SELECT CAST(place AS INT) AS place, feature, round(r * r * (n - 2) / (1 - r * r), 4) AS score,
    CAST(row_number() OVER (ORDER BY r * r DESC) <= 3 AS INT) AS chosen FROM s""")
def select_f_regression(spark, sf_dir):
    df = _candidates(spark, sf_dir)
    chosen = encode.select_features(df, "total_costs", 3)
    scores = encode.f_scores(df, "total_costs")
    return rounded(scores, 4).withColumn("chosen", F.col("feature").isin(*chosen).cast("int"))



_SHARES = [i / 20 for i in range(1, 20)]


def _information_sql(place: int, c: str) -> str:
    bin_of = "len(list_filter(list_distinct({c}_edges), lambda e: {c} > e))"
    return f"""SELECT {place} AS place, '{c}' AS feature, sum(n / total * ln(n * total / (nx * ny))) AS score FROM (
      SELECT n, sum(n) OVER () AS total, sum(n) OVER (PARTITION BY x) AS nx, sum(n) OVER (PARTITION BY y) AS ny FROM (
        SELECT {bin_of.format(c=c)} AS x, {bin_of.format(c='total_costs')} AS y, CAST(count(*) AS DOUBLE) AS n FROM f, edges GROUP BY 1, 2))"""


@query(f"""WITH f AS (SELECT {', '.join(f'coalesce(CAST({c} AS DOUBLE), 0) AS {c}' for c in (*_CANDIDATES, 'total_costs'))} FROM typed),
  edges AS (SELECT {', '.join(f'quantile_cont({c}, {_SHARES}) AS {c}_edges' for c in (*_CANDIDATES, 'total_costs'))} FROM f),
  s AS ({' UNION ALL '.join(_information_sql(i, c) for i, c in enumerate(_CANDIDATES))})
  SELECT CAST(place AS INT) AS place, feature, round(score, 6) AS score, CAST(row_number() OVER (ORDER BY score DESC, place) <= 3 AS INT) AS chosen FROM s""")
def select_mutual_info(spark, sf_dir):
    df = _candidates(spark, sf_dir)
    scores = encode.mutual_information(df, "total_costs")
    chosen = [r["feature"] for r in scores.orderBy(F.desc("score"), "place").limit(3).collect()]
    return rounded(scores).withColumn("chosen", F.col("feature").isin(*chosen).cast("int"))


_TOKENS = ["health_service_area", "hospital_county", "age_group", "gender", "type_of_admission", "apr_mdc_description",
           _SEVERITY, "apr_risk_of_mortality", "apr_medical_surgical_description", "payment_typology_1",
           "payment_typology_2", "payment_typology_3"]


def _tokens_sql() -> str:
    """Rows, vector size and set cells per encoded column; unseen values have one slot of their own."""
    parts = [f"""SELECT '{c}' AS feature, count(*) AS rows, count(DISTINCT lower(coalesce({c}, 'Unknown'))) + 1 AS slots,
      CAST(count(*) AS DOUBLE) AS ones FROM discharges""" for c in _TOKENS]
    return " UNION ALL ".join(parts)


@query(_tokens_sql())
def encode_token_onehot(spark, sf_dir):
    df = encode.lower_text(discharges(spark, sf_dir, *_TOKENS), _TOKENS)
    out = encode.token_onehot(_TOKENS).fit(df).transform(df)
    cells = out.select([F.struct(F.size(vector_to_array(f"{c}_vector")).cast("long").alias("slots"),
                                 F.aggregate(vector_to_array(f"{c}_vector"), F.lit(0.0), lambda a, x: a + x).alias("ones"))
                        .alias(c) for c in _TOKENS])
    long = cells.unpivot([], _TOKENS, "feature", "cell")
    return long.groupBy("feature").agg(F.count(F.lit(1)).alias("rows"), F.max("cell.slots").alias("slots"),
                                       F.sum("cell.ones").alias("ones"))


_HASHED = {"facility_hash": ("facility_name",), "code_hash": ("ccsr_diagnosis_description", "ccsr_procedure_description")}


def _filled(columns, tail: str) -> str:
    return " || '|' || ".join(f"coalesce({c}, 'Unknown')" for c in columns) + tail


@query(" UNION ALL ".join(f"""SELECT '{name}' AS block, {_filled(columns, '')} AS cells, count(*) AS rows, CAST(1 AS BIGINT) AS vectors,
  CAST({len(columns)} AS DOUBLE) AS ones FROM discharges GROUP BY 2""" for name, columns in _HASHED.items()))
def encode_hash(spark, sf_dir):
    """Equal cells have equal vectors, with one slot for each cell."""
    names = [c for columns in _HASHED.values() for c in columns]
    df = discharges(spark, sf_dir, *names).fillna("Unknown")
    parts = []
    for name, columns in _HASHED.items():
        # The cells of the sparse vector; 256 numbers a row would be for the zeros.
        vector = F.unwrap_udt(name)
        out = encode.hash_encode(df, columns, name, 256).select(
            F.lit(name).alias("block"), F.concat_ws("|", *columns).alias("cells"), vector.alias("vector"),
            F.aggregate(vector["values"], F.lit(0.0), lambda a, x: a + x).alias("ones"))
        parts.append(out.groupBy("block", "cells").agg(
            F.count(F.lit(1)).alias("rows"), F.count_distinct(F.xxhash64("vector")).alias("vectors"), F.max("ones").alias("ones")))
    return parts[0].unionByName(parts[1])


_BLOCKS = ("gender", "age_group", _SEVERITY)


def _assembled_sql() -> str:
    """Slots of the one-hot blocks: each has one slot more than categories, for those unseen."""
    text = "lower(coalesce({c}, 'Unknown'))"
    numbers = ", ".join(f"n{i} AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS i, count(*) OVER () + 1 AS slots FROM "
                        f"(SELECT DISTINCT {text.format(c=c)} AS v FROM t))" for i, c in enumerate(_BLOCKS))
    size = [f"(SELECT max(slots) FROM n{i})" for i in range(len(_BLOCKS))]
    slots = ", ".join(f"CAST({' + '.join(['2', *size[:i]])} + n{i}.i AS INT) AS {c}_slot" for i, c in enumerate(_BLOCKS))
    joins = " ".join(f"JOIN n{i} ON n{i}.v = {text.format(c=c)}" for i, c in enumerate(_BLOCKS))
    return f"""WITH t AS (SELECT * FROM typed WHERE length_of_stay IS NOT NULL), {numbers}
      SELECT discharge_key, CAST({' + '.join(['2', *size])} AS INT) AS size, CAST(length_of_stay AS DOUBLE) AS stay,
        round(CAST(total_charges AS DOUBLE), 6) AS charges, {slots} FROM t {joins}"""


@query(_assembled_sql())
def ml_assemble(spark, sf_dir):
    """The assembled vector: its size, its numbers and which slots are set."""
    df = typed(spark, sf_dir, "discharge_key", *AMOUNTS, *_BLOCKS).na.drop(subset=["length_of_stay"])
    df = encode.lower_text(df, _BLOCKS)
    out = encode.assembler(["length_of_stay", "total_charges"], _BLOCKS).fit(df).transform(df)
    cells = out.select("discharge_key", vector_to_array("features").alias("v"))
    set_slots = F.filter(F.sequence(F.lit(2), F.size("v") - 1), lambda i: F.get("v", i) == 1)
    marked = cells.withColumn("slots", set_slots)
    return rounded(marked.select(
        "discharge_key", F.size("v").alias("size"), F.col("v")[0].alias("stay"), F.col("v")[1].alias("charges"),
        *[F.col("slots")[i].alias(f"{c}_slot") for i, c in enumerate(_BLOCKS)]))

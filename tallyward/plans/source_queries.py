"""Registered queries of sources and sinks. Files are written to the shared folder and read back."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyward.operators import evaluate
from tallyward.operators.features import cost_ratios
from tallyward.plans.catalog import query
from tallyward.plans.evaluate_queries import METRICS
from tallyward.plans.inputs import predicted, rounded, typed
from tallyward.session import scratch_path
from tallyward.sources import readers, writers
from tallyward.sources.discharges import discharges

_COLUMNS = ("discharge_key", "order_no", "hospital_county", "type_of_admission", "length_of_stay", "total_costs")
_SCHEMA = "discharge_key string, order_no bigint, hospital_county string, type_of_admission string, " \
          "length_of_stay string, total_costs double"


def _landed(spark, sf_dir, ending, **options):
    df = discharges(spark, sf_dir, *_COLUMNS)
    path = f"{scratch_path(spark, 'landed')}.{ending}"
    writers.write_file(df, path, **options)
    return path


_LANDED_SQL = """SELECT discharge_key, order_no, hospital_county, type_of_admission, length_of_stay,
  CAST(total_costs AS DOUBLE) AS total_costs FROM discharges"""


@query(_LANDED_SQL)
def scan_csv(spark, sf_dir):
    return readers.read_source(spark, "file", path=_landed(spark, sf_dir, "csv"), schema=_SCHEMA)


@query(_LANDED_SQL)
def scan_json(spark, sf_dir):
    df = readers.read_file(spark, _landed(spark, sf_dir, "json"), schema=_SCHEMA.replace("costs double", "costs string"))
    return df.withColumn("total_costs", F.col("total_costs").cast("double"))


@query("SELECT l_orderkey, l_quantity, l_extendedprice FROM lineitem WHERE l_quantity < 10 AND l_discount > 0.05")
def scan_parquet(spark, sf_dir):
    df = readers.read_source(spark, "file", path=f"{sf_dir}/lineitem.parquet")
    return df.where("l_quantity < 10 AND l_discount > 0.05D").select("l_orderkey", "l_quantity", "l_extendedprice")


@query("""SELECT discharge_key, CASE WHEN order_no % 17 = 0 THEN NULL ELSE TRY_CAST(length_of_stay AS INT) END AS length_of_stay,
  CASE WHEN order_no % 17 = 0 THEN NULL ELSE CAST(total_charges AS DOUBLE) END AS total_charges,
  (SELECT count(*) FROM discharges WHERE order_no % 13 = 0 AND order_no % 17 <> 0) AS rejected
  FROM discharges WHERE NOT (order_no % 13 = 0 AND order_no % 17 <> 0)""")
def scan_csv_bad_lines(spark, sf_dir):
    """Some lines have one cell only, some have one too many, and some stays are no numbers."""
    df = discharges(spark, sf_dir, "discharge_key", "order_no", "length_of_stay", "total_charges")
    whole = F.concat_ws(",", "discharge_key", "length_of_stay", "total_charges")
    line = (F.when(F.col("order_no") % 17 == 0, F.col("discharge_key"))
            .when(F.col("order_no") % 13 == 0, F.concat(whole, F.lit(",extra"))).otherwise(whole))
    path = scratch_path(spark, "lines")
    df.select(line.alias("value")).write.text(path)
    schema = T.StructType().add("discharge_key", "string").add("length_of_stay", "integer").add("total_charges", "double")
    rows, rejected = readers.read_csv_tolerant(spark, path, schema, header=False)
    return rows.withColumn("rejected", F.lit(rejected.count()))


@query(_LANDED_SQL)
def scan_delimited(spark, sf_dir):
    path = _landed(spark, sf_dir, "csv", sep="|")
    root = scratch_path(spark, "datasets")
    readers.publish_version(readers.read_delimited(spark, path, "|", _SCHEMA), root, "discharges")
    return readers.read_source(spark, "dataset", root=root, name="discharges")


@query("""SELECT event_id, user_id, value FROM events WHERE event_type = 'view' ORDER BY event_id LIMIT 500 OFFSET 300""")
def page_read(spark, sf_dir):
    page = readers.read_source(spark, "page", path=f"{sf_dir}/events.parquet", order="event_id", limit=500, offset=300,
                               filters={"event_type": "view", "absent": 1})
    return page.select("event_id", "user_id", "value")


@query("""SELECT 1 AS version, count(*) AS rows, round(sum(total_charges), 2) AS charges FROM typed WHERE order_no % 2 = 0
  UNION ALL SELECT 2, count(*), round(sum(total_charges), 2) FROM typed""")
def versioned_read(spark, sf_dir):
    df = typed(spark, sf_dir, "order_no", "total_charges")
    root = scratch_path(spark, "datasets")
    readers.publish_version(df.where("order_no % 2 = 0"), root, "charges")
    readers.publish_version(df, root, "charges")
    parts = []
    for version in (1, None):
        found = readers.read_version(spark, root, "charges", version)
        number = version or readers.latest_version(spark, root, "charges")
        parts.append(found.agg(F.lit(number).alias("version"), F.count(F.lit(1)).alias("rows"),
                               F.sum("total_charges").alias("charges")))
    return rounded(parts[0].unionByName(parts[1]), 2)


REQUEST_ROW = T.StructType().add("discharge_key", "string").add("length_of_stay", "double").add("total_charges", "double")


def requests(spark, sf_dir):
    """A JSON request per order; every twenty-ninth one is cut short."""
    df = typed(spark, sf_dir, "order_no", *REQUEST_ROW.fieldNames())
    rows = F.array_sort(F.collect_list(F.struct(*REQUEST_ROW.fieldNames())))
    text = F.to_json(F.struct(rows.alias("data")))
    grouped = df.groupBy("order_no").agg(text.alias("request"))
    cut = F.substring("request", 1, 12)
    return grouped.withColumn("request", F.when(F.col("order_no") % 29 == 0, cut).otherwise(F.col("request")))


@query("""SELECT order_no, CAST(row_number() OVER (PARTITION BY order_no ORDER BY discharge_key) - 1 AS INT) AS position, discharge_key,
    length_of_stay, total_charges, CAST(NULL AS VARCHAR) AS error FROM typed WHERE order_no % 29 <> 0
  UNION ALL SELECT DISTINCT order_no, CAST(NULL AS INT), NULL, NULL, NULL, 'malformed request' FROM typed WHERE order_no % 29 = 0""")
def json_requests_parse(spark, sf_dir):
    return readers.parse_requests(requests(spark, sf_dir), "request", REQUEST_ROW, ["order_no"])


_TOTALS = "count(*) AS rows, count(hospital_county) AS counties, round(sum(CAST(total_costs AS DOUBLE)), 2) AS costs"


@query(" UNION ALL ".join(f"SELECT '{k}' AS format, {_TOTALS} FROM discharges" for k in ("csv", "json", "parquet")))
def sink_roundtrip(spark, sf_dir):
    parts = []
    for kind in ("csv", "json", "parquet"):
        path = _landed(spark, sf_dir, kind, compression="snappy" if kind == "parquet" else "gzip")
        schema = _SCHEMA.replace("costs double", "costs string")
        back = readers.read_file(spark, path, schema=schema)
        parts.append(back.agg(F.lit(kind).alias("format"), F.count(F.lit(1)).alias("rows"),
                              F.count("hospital_county").alias("counties"),
                              F.sum(F.col("total_costs").cast("double")).alias("costs")))
    return rounded(parts[0].unionByName(parts[1]).unionByName(parts[2]), 2)


@query("""SELECT split, count(*) AS rows, round(sum(ln(1 + total_costs)), 3) AS target, round(sum(total_charges), 2) AS charges,
  'length_of_stay,total_charges' AS features
  FROM (SELECT *, CASE WHEN CAST('0x' || substr(md5('42-' || discharge_key), 1, 8) AS BIGINT) % 10000 < 2000
                       THEN 'test' ELSE 'train' END AS split FROM typed WHERE total_costs > 0) AS t GROUP BY split""")
def split_sink(spark, sf_dir):
    df = typed(spark, sf_dir, "discharge_key", "length_of_stay", "total_charges", "total_costs").where("total_costs > 0")
    out = scratch_path(spark, "split")
    writers.write_split(cost_ratios(df, log_cost=True), out, "log_total_costs", "discharge_key")
    names = readers.read_file(spark, f"{out}/features", "parquet").orderBy("place").collect()
    back = writers.read_split(spark, out).groupBy("split").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("target").alias("target"), F.sum("total_charges").alias("charges"))
    return rounded(back.withColumn("features", F.lit(",".join(r["feature"] for r in names))), target=3, charges=2)


@query("SELECT count(*) AS rows, " + ", ".join(f"round({x}, 6) AS {m}" for m, x in METRICS.items() if m != "median_ae") + " FROM predicted")
def metrics_sink(spark, sf_dir):
    """Metrics written as JSON rows and read back."""
    path = f"{scratch_path(spark, 'metrics')}.json"
    wide = evaluate.wide_metrics(predicted(spark, sf_dir), "y", "yhat", median=False)
    writers.write_file(wide, path)
    return rounded(readers.read_file(spark, path, schema=wide.schema))

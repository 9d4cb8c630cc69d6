"""Sources, sinks, streams and whole jobs."""

import datetime
import json

from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyward.operators import drift
from tallyward.plans import jobs
from tallyward.session import scratch_path
from tallyward.sources import readers, writers
from tallyward.sources.discharges import COLUMNS, discharges, table
from tallyward.streaming.drift import start_drift
from tallyward.streaming.prediction_log import append, read_log, start_log

SF = "/root/testdata/sf0.001"


def test_star_schema_keys_resolve(spark):
    n = table(spark, SF, "lineitem").count()
    assert discharges(spark, SF).count() == n
    assert discharges(spark, SF, "order_no").count() == n
    assert discharges(spark, SF).columns == list(COLUMNS)
    assert discharges(spark, SF, "discharge_key").distinct().count() == n


def test_formats(spark):
    with pytest.raises(ValueError):
        readers.read_file(spark, "/tmp/x.xlsx")
    with pytest.raises(ValueError):
        readers.read_source(spark, "ftp")
    with pytest.raises(FileNotFoundError):
        readers.read_file(spark, "/tmp/nothing-here.parquet")
    df = spark.createDataFrame([('a "quoted", text', 1), ("", 2), (None, 3), ("  x ", 4)], "s string, i int")
    for kind in ("csv", "json", "parquet"):
        path = f"{scratch_path(spark, 'formats')}.{kind}"
        writers.write_file(df, path)
        back = readers.read_file(spark, path, schema="s string, i int").orderBy("i").collect()
        empty = None if kind == "csv" else ""  # an empty cell of a CSV table is a gap
        assert [tuple(r) for r in back] == [('a "quoted", text', 1), (empty, 2), (None, 3), ("  x ", 4)], kind


def lines_at(spark, name, *files):
    path = scratch_path(spark, name)
    for lines in files:
        spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode("append").text(path)
    return path


def by_a(rows):
    return sorted((tuple(r) for r in rows.collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))


AB = T.StructType().add("a", "integer").add("b", "string")


def test_broken_lines(spark):
    path = lines_at(spark, "broken", ["a,b", '1,"x,y"', "2", "3,p,q", '4,"p,""q"",r",s', "z,w", ""])
    rows, rejected = readers.read_csv_tolerant(spark, path, AB)
    assert by_a(rows) == [(1, "x,y"), (2, None), (None, "w")]
    assert sorted(r["line"] for r in rejected.collect()) == ["3,p,q", '4,"p,""q"",r",s'] and rejected.count() == 2 and rows.count() == 3


def test_headers_of_several_files(spark):
    path = lines_at(spark, "headers", ["a,b", "1,x", "a,b"], ["A,B", "2,y"])
    rows, rejected = readers.read_csv_tolerant(spark, path, AB)
    assert by_a(rows) == [(1, "x"), (2, "y"), (None, "b")] and rejected.count() == 0


def test_line_breaks_in_cells(spark):
    path = lines_at(spark, "breaks", ["a,b", '1,"x', 'y"', "2,z", '3,"p', 'q",r'])
    rows, rejected = readers.read_csv_tolerant(spark, path, AB, multi_line=True)
    assert by_a(rows) == [(1, "x\ny"), (2, "z")]
    assert rejected.count() == 1


def test_pages(spark):
    df = spark.range(100).select("id", (F.col("id") % 2).alias("k"))
    page = [r["id"] for r in readers.read_page(df, "id", 5, 10, {"k": 1}).collect()]
    assert page == [21, 23, 25, 27, 29]
    assert [r["id"] for r in readers.read_page(df, "id", 5, after=19, filters={"k": 1}).collect()] == page
    assert [r["id"] for r in readers.read_page(df, "id", 7, 95).collect()] == [95, 96, 97, 98, 99]
    assert readers.read_page(df, "id", 5, 1000).count() == 0
    named = df.select(F.concat(F.lit("n"), F.lpad(F.col("id").cast("string"), 3, "0")).alias("name"))
    assert [r["name"] for r in readers.read_page(named, "name", 2, 50).collect()] == ["n050", "n051"]


def test_versions(spark):
    root = scratch_path(spark, "versions")
    assert readers.latest_version(spark, root, "t") is None
    with pytest.raises(FileNotFoundError):
        readers.read_version(spark, root, "t")
    assert readers.publish_version(spark.range(3), root, "t") == 1
    assert readers.publish_version(spark.range(5), root, "t") == 2
    assert readers.read_version(spark, root, "t").count() == 5
    assert readers.read_version(spark, root, "t", 1).count() == 3
    # What a write that died has left is in nobody's way.
    spark.range(1).write.parquet(f"{root}/t/data/left-over")
    assert readers.publish_version(spark.range(7), root, "t") == 3
    assert readers.read_version(spark, root, "t").count() == 7


@pytest.mark.parametrize("links", [True, False])
def test_many_publishers_at_once(spark, monkeypatch, links):
    """Each gets a number of its own (where files can be linked), and each version holds what was published as it."""
    monkeypatch.setattr(readers, "_has_links", lambda files: links)
    root = scratch_path(spark, "versions")
    with ThreadPoolExecutor(8) as pool:
        found = list(pool.map(lambda n: (readers.publish_version(spark.range(n), root, "t"), n), range(1, 9) if links else range(1, 2)))
    assert sorted(v for v, _ in found) == list(range(1, len(found) + 1))
    for version, n in found:
        assert readers.read_version(spark, root, "t", version).count() == n
    assert readers.publish_version(spark.range(20), root, "t") == len(found) + 1
    # Somebody else took the number between looking and creating.
    assert not readers._create_listing(spark, f"{root}/t/versions", 1, "other")


def test_a_publisher_that_dies_while_listing(spark):
    root = scratch_path(spark, "versions")
    readers.publish_version(spark.range(3), root, "t")
    readers._create_listing(spark, f"{root}/t/versions", 2, "")
    assert readers.latest_version(spark, root, "t") == 1 and readers.read_version(spark, root, "t").count() == 3
    with pytest.raises(FileNotFoundError):
        readers.read_version(spark, root, "t", 2)
    assert readers.publish_version(spark.range(4), root, "t") == 3


def test_requests_and_responses(spark):
    row = T.StructType().add("x", "double")
    texts = [(1, '{"data":[{"x":1.5},{"x":2}]}'), (2, "{oops"), (3, '{"other":1}')]
    df = spark.createDataFrame(texts, "id int, t string")
    parsed = readers.parse_requests(df, "t", row, ["id"])
    answers = {r["id"]: json.loads(r["response"]) for r in
               readers.respond(parsed.withColumn("p", F.col("x") * 2), ["id"], "p").collect()}
    assert answers == {1: {"predictions": [3.0, 4.0]}, 2: {"error": "malformed request"}, 3: {"error": "no data"}}


def test_prediction_log_appends(spark):
    out = scratch_path(spark, "log")
    df = spark.createDataFrame([(datetime.datetime(2024, 1, d, 5), float(d)) for d in (1, 1, 2)], "ts timestamp, p double")
    append(df, "ts", out)
    append(df, "ts", out)
    assert {(r["period"], r["count"]) for r in read_log(spark, out).groupBy("period").count().collect()} == {
        ("2024-01-01", 4), ("2024-01-02", 2)}


def test_prediction_log_of_streams_that_start_anew(spark):
    """A batch that repeats adds nothing; a second checkpoint, whose batches count from 0 again, adds its rows."""
    source, out = scratch_path(spark, "scored"), scratch_path(spark, "log")
    schema = "ts timestamp, p double"

    def land(days):
        rows = [(datetime.datetime(2024, 1, d, 5), float(d)) for d in days]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)

    def run(progress):
        start_log(spark.readStream.schema(schema).parquet(source), "ts", out, progress).awaitTermination()

    def rows():
        return {(r["period"], r["count"]) for r in read_log(spark, out).groupBy("period").count().collect()}

    first = scratch_path(spark, "progress")
    land([1, 1, 2])
    run(first)
    run(first)
    assert rows() == {("2024-01-01", 2), ("2024-01-02", 1)}
    land([2, 3])
    run(first)
    assert rows() == {("2024-01-01", 2), ("2024-01-02", 2), ("2024-01-03", 1)}
    run(scratch_path(spark, "progress"))
    assert rows() == {("2024-01-01", 4), ("2024-01-02", 4), ("2024-01-03", 2)}


def test_stream_leaves_late_rows_out(spark):
    day = lambda d, h=0: datetime.datetime(2024, 1, d, h)
    base = spark.createDataFrame([(float(i),) for i in range(100)], "x double")
    profile = drift.baseline_profile(base, ["x"])
    source = scratch_path(spark, "stream")
    out = scratch_path(spark, "stream-out")
    batches = [[(day(1), 1.0), (day(1, 3), 55.0)], [(day(9), 5.0)], [(day(1, 4), 99.0), (day(20), 7.0)]]
    schema = "ts timestamp, x double"
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).parquet(source)
        start_drift(stream, profile, ["x"], "ts", f"{out}/rows", f"{out}/progress", "1 day").awaitTermination()
    got = {str(r["window_start"])[:10]: r["rows"] for r in spark.read.parquet(f"{out}/rows").collect()}
    assert got["2024-01-01"] == 2 and got["2024-01-09"] == 1


def test_whole_jobs(spark):
    out = scratch_path(spark, "jobs")
    rows = discharges(spark, SF, "discharge_key", "total_costs", "total_charges", "length_of_stay", "age_group",
                      "apr_severity_of_illness_description", "apr_risk_of_mortality", "type_of_admission",
                      "emergency_department_indicator")
    jobs.prepare(rows, "discharge_key", f"{out}/prepared")
    back = writers.read_split(spark, f"{out}/prepared")
    assert not {"total_costs", "cost_per_day", "cost_to_charge_ratio", "log_total_costs"} & set(back.columns)
    found = jobs.train(spark, f"{out}/prepared", f"{out}/model", n_estimators=4, max_depth=4, learning_rate=0.4)
    r2 = {r["split"]: r["value"] for r in found.where("metric = 'r2_score'").collect()}
    assert r2["train"] > 0.7 and r2["test"] > 0.6
    test = writers.read_split(spark, f"{out}/prepared", "test")
    summary = jobs.score(spark, f"{out}/model", test, f"{out}/scored").first()
    assert summary["rows"] == test.count() and summary["min"] > 0
    seen = jobs.watch(test, test.withColumn("total_charges", F.col("total_charges") * 3), f"{out}/drift").first()
    assert seen["drifted_features"] == 1 and seen["top_drifted"][0]["feature"] == "total_charges"

"""Reading tables: files by extension, tolerant CSV, pages, named versions and JSON requests."""

from __future__ import annotations

import os
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyward.operators.order_stats import part_offsets, ranged_counts

_BY_EXTENSION = {"csv": "csv", "parquet": "parquet", "json": "json"}
_CSV = {"header": "true", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
        "escape": '"'}


def file_format(path: str, given: str | None = None) -> str:
    """Format by name or by the extension of the path."""
    name = (given or path.rstrip("/").rsplit(".", 1)[-1]).lower()
    if name not in _BY_EXTENSION:
        raise ValueError(f"unsupported file type: {name}")
    return _BY_EXTENSION[name]


def read_file(spark: SparkSession, path: str, file_type: str | None = None,
              schema: T.StructType | str | None = None, **options) -> DataFrame:
    """A CSV, Parquet or JSON table. Without a schema, CSV types are inferred by an extra pass."""
    kind = file_format(path, file_type)
    reader = spark.read.format(kind)
    if kind == "csv":
        reader = reader.options(**_CSV)
        if schema is None:
            reader = reader.option("inferSchema", "true")
    if schema is not None:
        reader = reader.schema(schema)
    try:
        return reader.options(**options).load(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e):
            raise FileNotFoundError(path) from e
        raise


def read_delimited(spark: SparkSession, path: str, sep: str = "\t",
                   schema: T.StructType | str | None = None, **options) -> DataFrame:
    return read_file(spark, path, "csv", schema, sep=sep, **options)


_REJECT = "_line"


def read_csv_tolerant(spark: SparkSession, path: str, schema: T.StructType, header: bool = True,
                      multi_line: bool = False) -> tuple[DataFrame, DataFrame]:
    """Rows of a CSV table with broken records, and the rejected records.

    Records with too many cells are rejected. Short ones are padded with NULL, and a cell of the wrong type becomes NULL. With
    ``header`` the first line of each file holds names, whatever they are. ``multi_line`` lets quoted cells hold line breaks;
    each file is then read by one task, so large tables should come in many files.
    """
    wide = T.StructType([*schema.fields, T.StructField(_REJECT, T.StringType())])
    read = (spark.read.schema(wide).options(**{**_CSV, "header": str(header).lower()}).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", _REJECT).option("multiLine", str(multi_line).lower())
            .option("enforceSchema", "true").csv(path))
    # Only records that do not fit are looked at again: their cells are what commas outside quotes part.
    plain = F.regexp_replace(_REJECT, '"(?:[^"]|"")*"', "")
    too_long = F.coalesce(F.size(F.split(plain, ",", -1)) > len(schema.fields), F.lit(False))
    # The engine finds a record out only if all its cells are read.
    read_all = F.hash(*schema.names) >= F.lit(-(1 << 31))
    return read.where(~too_long & read_all).drop(_REJECT), read.where(too_long & read_all).select(F.col(_REJECT).alias("line"))


def read_page(df: DataFrame, order: str, limit: int = 10_000, offset: int = 0,
              filters: dict[str, object] | None = None, after: object = None) -> DataFrame:
    """Rows ``offset`` to ``offset + limit`` by a unique key, after equality filters on known columns.

    ``after`` continues behind the last key of the page before. Keys are dealt to partitions by ranges and counted; the first
    and the last key of the page are looked up in the partitions that hold them, and only rows between them are ordered. Rows with
    a NULL key are on no page.
    """
    for name, value in (filters or {}).items():
        if name in df.columns:
            df = df.where(F.col(name) == F.lit(value))
    df = df.where(F.col(order).isNotNull() if after is None else F.col(order) > F.lit(after))
    one = {"n": F.lit(1).cast("long")}
    keys = ranged_counts(df.select(F.col(order).alias("_key")), "_key", [], one)
    held = part_offsets(keys, [], one).where((F.col("_n_off") < offset + limit) & (F.col("_n_off") + F.col("_n_part") > offset))
    before = Window.partitionBy("_part").orderBy("_key").rowsBetween(Window.unboundedPreceding, -1)
    near = (keys.join(held, "_part").withColumn("_from", F.col("_n_off") + F.coalesce(F.sum("n").over(before), F.lit(0)))
            .where((F.col("_from") < offset + limit) & (F.col("_from") + F.col("n") > offset)))
    ends = near.agg(F.min("_key").alias("lo"), F.max("_key").alias("hi"), F.min("_from").alias("first")).first()
    if ends["lo"] is None:
        return df.limit(0)
    page = df.where(F.col(order).between(F.lit(ends["lo"]), F.lit(ends["hi"])))
    return page.orderBy(order).offset(max(0, offset - ends["first"])).limit(limit)


def publish_version(df: DataFrame, root: str, name: str) -> int:
    """Write the table as the next version of a named dataset and return its number.

    The files go to a folder of their own. The version is then listed by a file named by its number, which only one publisher can
    create; one that comes too late takes the next number, so no version is lost. Readers never see half of a version: a listing is there whole
    or is not read, and a write that dies leaves at most a number that is skipped.
    """
    spark = df.sparkSession
    folder = uuid.uuid4().hex
    df.write.parquet(f"{root}/{name}/data/{folder}")
    version = max(_numbers(spark, root, name), default=0) + 1
    while not _create_listing(spark, f"{root}/{name}/versions", version, folder):
        version += 1
    return version


def _file_system(spark: SparkSession, path: str):
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()), found


def _has_links(files) -> bool:
    return files.getScheme() == "file"


def _create_listing(spark: SparkSession, folder: str, version: int, content: str) -> bool:
    """Create the file of a version; False if it is there already."""
    files, directory = _file_system(spark, folder)
    files.mkdirs(directory)
    path = spark._jvm.org.apache.hadoop.fs.Path(directory, str(version))
    if _has_links(files):  # Hadoop looks and then creates here; a link to a finished file does both at once
        here = directory.toUri().getPath()
        draft = f"{here}/.{uuid.uuid4().hex}"
        with open(draft, "w") as file:
            file.write(content)
        try:
            os.link(draft, f"{here}/{version}")
        except FileExistsError:
            return False
        finally:
            os.unlink(draft)
        return True
    try:
        out = files.create(path, False)
    except Py4JJavaError as e:
        if files.exists(path):
            return False
        raise e
    out.write(content.encode())
    out.close()
    return True


def _numbers(spark: SparkSession, root: str, name: str) -> list[int]:
    """The numbers that are taken, in order."""
    files, folder = _file_system(spark, f"{root}/{name}/versions")
    if not files.exists(folder):
        return []
    names = [status.getPath().getName() for status in files.listStatus(folder)]
    return sorted(int(n) for n in names if n.isdecimal())


def _folder_of(spark: SparkSession, root: str, name: str, version: int) -> str | None:
    """The folder of a version; None if its listing is not finished."""
    files, path = _file_system(spark, f"{root}/{name}/versions/{version}")
    if not files.exists(path):
        return None
    stream = files.open(path)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8").strip() or None
    finally:
        stream.close()


def latest_version(spark: SparkSession, root: str, name: str) -> int | None:
    return next((n for n in reversed(_numbers(spark, root, name)) if _folder_of(spark, root, name, n)), None)


def read_version(spark: SparkSession, root: str, name: str, version: int | None = None) -> DataFrame:
    """A version of a named dataset, the latest one by default."""
    wanted = latest_version(spark, root, name) if version is None else version
    folder = None if wanted is None else _folder_of(spark, root, name, wanted)
    if folder is None:
        raise FileNotFoundError(f"{root}/{name}")
    return read_file(spark, f"{root}/{name}/data/{folder}", "parquet")


def read_source(spark: SparkSession, source: str, **where) -> DataFrame:
    """Open a source by kind: 'file', 'delimited', 'dataset' or 'page'."""
    kinds = {
        "file": lambda path, **kw: read_file(spark, path, **kw),
        "delimited": lambda path, **kw: read_delimited(spark, path, **kw),
        "dataset": lambda root, name, version=None: read_version(spark, root, name, version),
        "page": lambda path, order, file_type=None, **kw: read_page(read_file(spark, path, file_type), order, **kw),
    }
    if source not in kinds:
        raise ValueError(f"unknown source: {source}")
    return kinds[source](**where)


def parse_requests(df: DataFrame, text: str, row: T.StructType, keys: list[str]) -> DataFrame:
    """Rows of JSON requests ``{"data": [row, ...]}``.

    A request that does not parse gives one row with its error and NULL fields.
    """
    bad = "_corrupt_record"
    schema = T.StructType([T.StructField("data", T.ArrayType(row)), T.StructField(bad, T.StringType())])
    parsed = F.from_json(F.col(text), schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": bad})
    df = df.select(*keys, parsed.alias("_request"))
    error: Column = (F.when(F.col(f"_request.{bad}").isNotNull(), "malformed request")
                     .when(F.col("_request.data").isNull(), "no data"))
    rows = df.select(*keys, error.alias("error"),
                     F.posexplode_outer(F.when(error.isNull(), F.col("_request.data"))).alias("position", "_row"))
    return rows.select(*keys, "position", *[F.col(f"_row.{f.name}").alias(f.name) for f in row.fields], "error")


def respond(df: DataFrame, keys: list[str], prediction: str, error: str = "error",
            position: str = "position") -> DataFrame:
    """One JSON response per request: its predictions in order, or its error.

    A group is no larger than the request it answers, which came as one text.
    """
    item = F.struct(F.col(position).alias("p"), F.col(prediction).alias("v"))
    grouped = df.groupBy(*keys).agg(F.max(error).alias("_error"), F.array_sort(F.collect_list(item)).alias("_items"))
    good = F.to_json(F.struct(F.transform("_items", lambda i: i["v"]).alias("predictions")))
    bad = F.to_json(F.struct(F.col("_error").alias("error")))
    return grouped.select(*keys, F.when(F.col("_error").isNotNull(), bad).otherwise(good).alias("response"))

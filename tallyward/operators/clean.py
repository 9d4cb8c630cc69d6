"""Cleaning: typed coercion, missing values, duplicates, outliers, text and row filters.

Operators skip columns that the frame does not have. Statistics of several columns are fitted in one
aggregation; ``fit_on`` lets them come from other rows, such as the training part.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyward.functions import values as V
from tallyward.functions.expr import (
    all_of, flag, number, numeric_columns, present, ratio, string_columns, strip,
)
from tallyward.operators.order_stats import column_quantiles, melt, quantile_rows
from tallyward.operators.staging import released


def null_counts(df: DataFrame, columns: Iterable[str], means: Iterable[str] = ()) -> dict:
    """Rows, NULLs per column and means of some columns, in one aggregation."""
    return df.agg(F.count(F.lit(1)).alias("rows"),
                  *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in columns],
                  *[F.avg(c).alias(f"mean_{c}") for c in means]).first().asDict()


def _sparse(counts: dict, columns: Iterable[str], threshold: float) -> list[str]:
    return [c for c in columns if counts["rows"] and counts[f"null_{c}"] / counts["rows"] > threshold]


def drop_sparse_columns(df: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Drop columns whose share of NULL is above the threshold."""
    return df.drop(*_sparse(null_counts(df, df.columns), df.columns, threshold))


def _fill_values(df: DataFrame, strategy: str, num: list[str], cat: list[str], counts: dict,
                 exact: bool) -> dict:
    """Mean or median for numbers, mode or 'Unknown' for text; only for columns with gaps."""
    gaps = {c for c in num + cat if counts[f"null_{c}"]}
    fill: dict = {}
    if strategy == "mean":
        fill = {c: counts[f"mean_{c}"] for c in num if c in gaps}
    elif strategy == "median":
        fitted = column_quantiles(df, [c for c in num if c in gaps], [0.5], exact)
        fill = {c: q[0] for c, q in fitted.items()}
    fill = {c: v for c, v in fill.items() if v is not None}
    if strategy == "mode":
        modes = column_modes(df, [c for c in cat if c in gaps])
        fill.update({c: modes.get(c, "Unknown") for c in cat if c in gaps})
    else:
        fill.update({c: "Unknown" for c in cat})
    return fill


def column_modes(df: DataFrame, columns: list[str]) -> dict[str, str]:
    """Most frequent value of each text column, the smallest one among ties."""
    if not columns:
        return {}
    counts = (df.select(*columns).unpivot([], columns, "feature", "value")
              .where(F.col("value").isNotNull()).groupBy("feature", "value").count())
    order = F.struct((-F.col("count")).alias("n"), F.col("value").alias("v"))
    best = counts.groupBy("feature").agg(F.min(order).alias("best"))
    return {r["feature"]: r["best"]["v"] for r in best.collect()}


def apply_imputation(df: DataFrame, fill: dict, as_double: Iterable[str] = ()) -> DataFrame:
    """Fill NULLs with the fitted values; the named numeric columns become doubles."""
    double = set(as_double)
    out = []
    for c in df.columns:
        col = F.col(c).cast("double") if c in double else F.col(c)
        out.append((F.coalesce(col, F.lit(fill[c])) if c in fill else col).alias(c))
    return df.select(*out)


def impute(df: DataFrame, strategy: str = "mean", numerical: Iterable[str] | None = None,
           categorical: Iterable[str] | None = None, drop_threshold: float = 0.5,
           fit_on: DataFrame | None = None, exact: bool = True) -> DataFrame:
    """Drop sparse columns, then fill what is missing.

    ``mode`` and ``drop`` leave numbers alone; ``drop`` fills text with 'Unknown' and removes no rows.
    Numeric columns that are filled become doubles. One aggregation finds the gaps of all columns; the
    median and the mode take one more job, and only for columns that have gaps.
    """
    base = df if fit_on is None else fit_on
    num = present(base, numerical) if numerical is not None else numeric_columns(base)
    cat = present(base, categorical) if categorical is not None else string_columns(base)
    num = num if strategy in ("mean", "median") else []
    counts = null_counts(base, base.columns, num if strategy == "mean" else ())
    sparse = set(_sparse(counts, base.columns, drop_threshold))
    num, cat = [c for c in num if c not in sparse], [c for c in cat if c not in sparse]
    fill = _fill_values(base, strategy, num, cat, counts, exact)
    return apply_imputation(df.drop(*sparse), fill, num)


def convert_types(df: DataFrame, kinds: dict[str, str], topcode: dict[str, str] | None = None) -> DataFrame:
    """Coerce columns: 'numeric', 'datetime', 'category' or any Spark type name.

    A value that cannot be converted becomes NULL.
    """
    changed = {}
    for c, kind in kinds.items():
        if c not in df.columns:
            continue
        if kind == "numeric":
            changed[c] = number(df, c, topcode)
        elif kind == "datetime":
            changed[c] = F.try_to_timestamp(F.col(c).cast("string"))
        elif kind in ("category", "str"):
            changed[c] = F.col(c).cast("string")
        else:
            name = {"float": "double", "float64": "double", "int64": "bigint"}.get(kind, kind)
            changed[c] = F.col(c).try_cast(name)
    return df.withColumns(changed) if changed else df


def drop_duplicates(df: DataFrame, subset: Iterable[str] | None = None,
                    order_by: Iterable[str] | None = None) -> DataFrame:
    """Remove repeated rows; with a subset, keep the first row by ``order_by`` in each group.

    The first row is found by an aggregate, which combines on the map side, so a key that holds a
    large part of all rows is no burden for one task.
    """
    if subset is None:
        return df.dropDuplicates()
    keys = present(df, subset)
    order = list(order_by or ())
    if not order:
        raise ValueError("the first row of a group needs an order: give order_by")
    rest = [c for c in df.columns if c not in keys]
    first = F.min_by(F.struct(*rest), F.struct(*order)) if rest else F.lit(None)
    kept = df.groupBy(*keys).agg(first.alias("_first"))
    return kept.select(*[F.col(c) if c in keys else F.col(f"_first.{c}") for c in df.columns])


def iqr_bounds(df: DataFrame, columns: list[str], threshold: float = 1.5, exact: bool = True) -> dict:
    out = {}
    for c, (q1, q3) in column_quantiles(df, columns, [0.25, 0.75], exact).items():
        if q1 is not None:
            out[c] = (q1 - threshold * (q3 - q1), q3 + threshold * (q3 - q1))
    return out


def remove_outliers(df: DataFrame, columns: Iterable[str], method: str = "iqr",
                    threshold: float = 1.5, sequential: bool = True, exact: bool = True) -> DataFrame:
    """Keep rows inside the fences of every column; NULL is outside.

    By default each column's statistics come from the rows that the columns before it left over. ``sequential=False`` takes all
    statistics from the given rows in one pass.
    """
    names = present(df, columns)
    if method not in ("iqr", "zscore"):
        raise ValueError(f"unknown outlier method: {method}")
    if method == "iqr" and sequential and exact and len(names) > 1:
        return _inside_fences(df, names, threshold)
    steps = [[c] for c in names] if sequential else [names]
    for group in steps:
        if method == "iqr":
            bounds = iqr_bounds(df, group, threshold, exact)
            tests = [_between(c, bounds.get(c)) for c in group]
        else:
            aggs = []
            for c in group:
                aggs += [F.avg(c).alias(f"m_{c}"), F.stddev_samp(c).alias(f"s_{c}")]
            row = df.agg(*aggs).first()
            tests = [F.abs(ratio(F.col(c) - F.lit(row[f"m_{c}"]).cast("double"),
                                 F.lit(row[f"s_{c}"]).cast("double"))) < threshold for c in group]
        if tests:
            df = df.where(all_of(tests))
    return df


def _between(column: str, bounds: tuple[float, float] | None) -> Column:
    return F.lit(False) if bounds is None else F.coalesce(F.col(column).between(*bounds), F.lit(False))


def _inside_fences(df: DataFrame, names: list[str], threshold: float) -> DataFrame:
    """Sequential fences that read ``df`` once.

    The rows are staged, and their values are counted for all columns together. What a fence removes is counted too, and taken off the
    counts of the columns after it, whose quartiles follow from the counts that are left.
    """
    rows = released(df, "rows")
    inside = F.lit(True)
    counts = released(_value_counts(rows, names, 1), "counts")
    for i, c in enumerate(names):
        quarts = {r["place"]: r["quantile"] for r in quantile_rows(counts.where(F.col("feature") == c), "value", [0.25, 0.75], weight="n").collect()}
        bounds = None
        if quarts:
            reach = threshold * (quarts[1] - quarts[0])
            bounds = quarts[0] - reach, quarts[1] + reach
        test = _between(c, bounds)
        later = names[i + 1 :]
        if later:
            gone = _value_counts(rows.where(inside & ~test), later, -1)
            counts = counts.where(F.col("feature").isin(later)).unionByName(released(gone, "counts"))
        inside = inside & test
    return rows.where(inside)


def _value_counts(rows: DataFrame, names: list[str], sign: int) -> DataFrame:
    """How many rows hold each value of each column, times ``sign``."""
    long = melt(rows, names).where(F.col("value") <= float("inf"))
    return long.groupBy("feature", "value").agg((F.count(F.lit(1)) * sign).alias("n"))


def cap_outliers(df: DataFrame, columns: Iterable[str], lower: float = 0.01, upper: float = 0.99,
                 exact: bool = True, fit_on: DataFrame | None = None) -> DataFrame:
    """Pull values outside the two quantiles back to them; NULL stays."""
    names = present(df, columns)
    caps = column_quantiles(df if fit_on is None else fit_on, names, [lower, upper], exact)
    changed = {}
    for c, (lo, hi) in caps.items():
        if lo is not None:
            x = F.col(c).cast("double")
            changed[c] = F.when(x.isNotNull(), F.least(F.greatest(x, F.lit(lo)), F.lit(hi)))
    return df.withColumns(changed) if changed else df


def standardize_text(df: DataFrame, columns: Iterable[str], lowercase: bool = True,
                     trim: bool = True, replace_spaces: bool = False) -> DataFrame:
    """Lower-case, then strip, then turn blanks into underscores."""
    changed = {}
    for name in present(df, columns):
        c = F.col(name)
        c = F.lower(c) if lowercase else c
        c = strip(c) if trim else c
        c = F.replace(c, F.lit(" "), F.lit("_")) if replace_spaces else c
        changed[name] = c
    return df.withColumns(changed) if changed else df


def filter_rows(df: DataFrame, conditions: dict[str, Callable[[Column], Column] | object]) -> DataFrame:
    """Keep rows that meet every condition: a function of the column, or a value to equal."""
    tests = [c(F.col(n)) if callable(c) else F.col(n) == F.lit(c)
             for n, c in conditions.items() if n in df.columns]
    return df.where(all_of(tests)) if tests else df


def drop_null_target(df: DataFrame, target: str) -> DataFrame:
    return df.na.drop(subset=[target])


def first_present(df: DataFrame, columns: Iterable[str], name: str, default: str = "Unknown") -> DataFrame:
    """The first value that is not NULL, or the default."""
    return df.withColumn(name, F.coalesce(*[F.col(c) for c in present(df, columns)], F.lit(default)))


def fill_unknown(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """As text, with NULL spelled 'Unknown'."""
    names = present(df, columns)
    return df.withColumns({c: F.coalesce(F.col(c).cast("string"), F.lit("Unknown")) for c in names})


def project_features(df: DataFrame, drop: Iterable[str], numeric_only: bool = True) -> DataFrame:
    """Without the dropped columns, and with only the numeric ones if wanted."""
    kept = df.drop(*drop)
    return kept.select(*numeric_columns(kept)) if numeric_only else kept


COST_TYPES = {"total_costs": "numeric", "total_charges": "numeric", "length_of_stay": "numeric"}
VALID_ROWS: dict[str, Callable[[Column], Column]] = {
    "total_costs": lambda c: (c > V.COST_MIN) & (c < V.COST_MAX),
    "length_of_stay": lambda c: c >= 0,
}


def clean_discharges(df: DataFrame, topcode: dict[str, str] | None = V.STAY_TOPCODE,
                     drop_threshold: float = V.COLUMN_NULL_LIMIT, exact: bool = True, fit_where: Column | None = None) -> DataFrame:
    """Distinct rows with typed amounts in their valid range and no gaps.

    Medians come from the rows that meet ``fit_where``, such as those of the train part, or from all.

    ``topcode=None`` treats the open-ended stay as no number, so those rows are dropped. The valid rows
    are staged: they are read both for their gaps and for the result, and finding repeats is the
    costliest step, so it runs once.
    """
    valid = (df.transform(drop_duplicates)
             .transform(convert_types, COST_TYPES, topcode)
             .transform(filter_rows, VALID_ROWS)
             .transform(released, "valid"))
    fit_on = None if fit_where is None else valid.where(fit_where)
    return impute(valid, "median", drop_threshold=drop_threshold, fit_on=fit_on, exact=exact)


REPORT_SCHEMA = "step int, operation string, metric string, value double, detail string"


def cleaning_report(df: DataFrame, topcode: dict[str, str] | None = V.STAY_TOPCODE,
                    drop_threshold: float = V.COLUMN_NULL_LIMIT) -> DataFrame:
    """What ``clean_discharges`` does to the rows, counted in one job over the distinct rows."""
    columns = df.columns
    distinct = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_rows"))
    typed = convert_types(distinct, COST_TYPES, topcode)
    tests = [VALID_ROWS[c](F.col(c)) for c in VALID_ROWS if c in columns]
    valid = F.coalesce(all_of(tests), F.lit(False)) if tests else F.lit(True)
    row = typed.withColumn("_ok", valid).agg(
        F.sum("_rows").alias("initial"), F.count(F.lit(1)).alias("distinct"),
        F.count_if("_ok").alias("valid"),
        *[F.count_if(F.col("_ok") & F.col(c).isNull()).alias(f"null_{c}") for c in columns],
    ).first()
    nulls = {c: row[f"null_{c}"] for c in columns}
    rows = row["valid"]
    dropped = [c for c in columns if rows and nulls[c] / rows > drop_threshold]
    filled = set(numeric_columns(typed)) | set(string_columns(typed))
    left = [c for c in columns if c not in dropped and (c not in filled or nulls[c] == rows)]
    remaining = sum(nulls[c] for c in left if c not in string_columns(typed))
    facts = [
        (0, "input", "rows", row["initial"], None),
        (0, "input", "columns", len(columns), None),
        (1, "drop_duplicates", "rows_removed", row["initial"] - row["distinct"], None),
        (2, "convert_types", "columns_converted", len(present(df, COST_TYPES)), ",".join(present(df, COST_TYPES))),
        (3, "filter_rows", "rows_removed", row["distinct"] - rows, ",".join(present(df, VALID_ROWS))),
        (4, "impute", "missing_before", sum(nulls.values()), None),
        (4, "impute", "missing_after", remaining, None),
        (4, "impute", "columns_dropped", len(dropped), ",".join(dropped)),
        (5, "output", "rows", rows, None),
        (5, "output", "columns", len(columns) - len(dropped), None),
    ]
    return df.sparkSession.createDataFrame(
        [(s, o, m, float(v or 0), d) for s, o, m, v, d in facts], REPORT_SCHEMA)


def validate(df: DataFrame, rules: dict[str, dict]) -> DataFrame:
    """Rows that break each rule, counted in one pass.

    Rules per column: ``min``, ``max``, ``required`` and ``allowed``. Bounds and lists do not judge NULL.
    """
    checks = []
    for name, rule in rules.items():
        if name not in df.columns:
            continue
        c = F.col(name)
        if "min" in rule:
            checks.append((name, "min", c < rule["min"]))
        if "max" in rule:
            checks.append((name, "max", c > rule["max"]))
        if rule.get("required"):
            checks.append((name, "required", c.isNull()))
        if "allowed" in rule:
            checks.append((name, "allowed", ~c.isin(*rule["allowed"])))
    counted = df.agg(*[F.count_if(test).alias(f"c{i}") for i, (_, _, test) in enumerate(checks)])
    rows = [F.struct(F.lit(n).alias("column"), F.lit(r).alias("rule"), F.col(f"c{i}").alias("violations"))
            for i, (n, r, _) in enumerate(checks)]
    return counted.select(F.inline(F.array(*rows)))

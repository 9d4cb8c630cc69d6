"""Column expressions shared by the operators. All stay inside Spark's generated code."""

from __future__ import annotations

import math
import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def numeric_columns(df: DataFrame) -> list[str]:
    """Names of the numeric columns; booleans do not count."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def present(df: DataFrame, names) -> list[str]:
    """The given names that the frame has, in the given order."""
    have = set(df.columns)
    return [n for n in names if n in have]


def normalize_column_names(df: DataFrame) -> DataFrame:
    """Lower-case names with every other run of characters turned into one underscore."""
    names = [re.sub(r"[^0-9a-z]+", "_", n.lower()).strip("_") for n in df.columns]
    return df.toDF(*names)


def finite(c: Column) -> Column:
    """NaN becomes NULL, so that comparisons behave alike for both."""
    return F.when(~F.isnan(c), c)


# The cast alone would also take "10d", "NaN" and "Infinity" for numbers; without these letters it does not.
_NO_NUMBER = "dDfFnN"


def number(df: DataFrame, name: str, topcode: dict[str, str] | None = None) -> Column:
    """A double, with NULL where the cell holds no number.

    The cell occurs once in the expression, so a derived cell is not computed again for each test.
    """
    kind = df.schema[name].dataType
    c = F.col(name)
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return finite(c.cast("double"))
    if not isinstance(kind, T.StringType):
        return c.cast("double")
    for text, value in (topcode or {}).items():
        c = F.when(c == text, value).otherwise(c)
    return F.translate(c, _NO_NUMBER, "?" * len(_NO_NUMBER)).try_cast("double")


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it does not or is unknown."""
    return F.when(condition, 1).otherwise(0)


def contains(c: Column, text: str) -> Column:
    """Case-blind substring test; NULL contains nothing."""
    return F.coalesce(F.lower(c).contains(text.lower()), F.lit(False))


def ratio(top: Column, bottom: Column) -> Column:
    """Division with NULL instead of an error where the divisor is zero."""
    return F.try_divide(top.cast("double"), bottom.cast("double"))


def pearson(x: Column, y: Column) -> Column:
    """Correlation over the rows where both are filled; NULL instead of an error where one of them is constant."""
    x, y = x.cast("double"), y.cast("double")
    widths = F.stddev_pop(F.when(y.isNotNull(), x)) * F.stddev_pop(F.when(x.isNotNull(), y))
    return ratio(F.covar_pop(x, y), widths)


def lookup(c: Column, mapping: dict[str, int]) -> Column:
    """Code of a label; unknown labels give NULL."""
    rule = None
    for label, code in mapping.items():
        rule = F.when(c == label, code) if rule is None else rule.when(c == label, code)
    return rule


def cut(c: Column, edges, labels) -> Column:
    """Label of the right-closed interval holding the value; NULL outside all of them."""
    rule = F.when(c <= edges[0], F.lit(None).cast("string"))
    for upper, label in zip(edges[1:], labels):
        inside = c.isNotNull() if math.isinf(upper) else c <= upper
        rule = rule.when(inside, label)
    return rule


def strip(c: Column) -> Column:
    """Remove leading and trailing whitespace of any kind."""
    return F.regexp_replace(F.regexp_replace(c, r"^\s+", ""), r"\s+$", "")


def all_of(conditions) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def log1p(c: Column) -> Column:
    """ln(1 + x); NULL at and below -1."""
    return F.when(c > -1, F.log1p(c))

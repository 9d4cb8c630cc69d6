"""Derived columns. Each group adds its columns in one projection and skips what the frame lacks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyward.functions import values as V
from tallyward.functions.expr import contains, cut, flag, log1p, lookup, number, ratio


def _add(df: DataFrame, columns: dict) -> DataFrame:
    return df.withColumns(columns) if columns else df


def _have(df: DataFrame, *names: str) -> bool:
    return set(names) <= set(df.columns)


def numeric_amounts(df: DataFrame, names=("total_costs", "total_charges", "length_of_stay"),
                    topcode: dict[str, str] | None = V.STAY_TOPCODE) -> DataFrame:
    """Costs, charges and stay as doubles."""
    return _add(df, {c: number(df, c, topcode) for c in names if c in df.columns})


def age(df: DataFrame, column: str = "age_group", rank_name: str = "age_risk_score",
        flags: bool = True, category: bool = False) -> DataFrame:
    """Ordinal of the age band, with flags for its parts and a risk category if wanted."""
    if column not in df.columns:
        return df
    c = F.col(column)
    rank = lookup(c, V.AGE_RANK)
    new = {rank_name: rank}
    if category:
        new["age_risk_category"] = cut(rank, V.AGE_RISK_EDGES, V.AGE_RISK_LABELS)
    if flags:
        new["is_pediatric"] = flag(c.isin(*V.PEDIATRIC))
        new["is_elderly"] = flag(c.isin(*V.ELDERLY))
        new["is_middle_aged"] = flag(c.isin(*V.MIDDLE_AGED))
    return _add(df, new)


def cost_ratios(df: DataFrame, efficiency: bool = True, log_cost: bool = False) -> DataFrame:
    df = numeric_amounts(df)
    costs, charges, stay = F.col("total_costs"), F.col("total_charges"), F.col("length_of_stay")
    new = {}
    if log_cost and _have(df, "total_costs"):
        new["log_total_costs"] = log1p(costs)
    if _have(df, "total_costs", "length_of_stay"):
        new["cost_per_day"] = ratio(costs, stay + 1)
    if _have(df, "total_costs", "total_charges"):
        new["cost_to_charge_ratio"] = ratio(costs, charges + 1)
    if efficiency and _have(df, "total_costs", "length_of_stay"):
        new["cost_efficiency"] = ratio(F.lit(1.0), stay + 1) * costs
    return _add(df, new)


def transform_target(df: DataFrame, column: str, name: str, method: str = "log1p") -> DataFrame:
    """The column on another scale: log1p, log, sqrt or none."""
    c = F.col(column).cast("double")
    rules = {"log1p": log1p(c), "log": F.when(c > 0, F.log(c)), "sqrt": F.when(c >= 0, F.sqrt(c)), "none": c}
    return df.withColumn(name, rules[method])


def restore_target(df: DataFrame, column: str, name: str, method: str = "log1p") -> DataFrame:
    """Undo ``transform_target``."""
    c = F.col(column).cast("double")
    rules = {"log1p": F.expm1(c), "log": F.exp(c), "sqrt": c * c, "none": c}
    return df.withColumn(name, rules[method])


def stay(df: DataFrame, column: str = "length_of_stay", labels=V.STAY_LABELS_WITH_DAYS,
         extended_name: str = "extended_stay", short: bool = True, log: bool = False) -> DataFrame:
    """Band of the stay, flags for long and short stays and the logarithm if wanted."""
    if column not in df.columns:
        return df
    df = numeric_amounts(df, (column,))
    c = F.col(column)
    new = {"los_category": cut(c, V.STAY_EDGES, labels)}
    if log:
        new["los_log"] = log1p(c)
    new[extended_name] = flag(c > V.EXTENDED_STAY_OVER)
    if short:
        new["short_stay"] = flag(c <= V.SHORT_STAY_UP_TO)
    return _add(df, new)


def severity(df: DataFrame, severity_column: str = "apr_severity_of_illness_description",
             mortality_column: str = "apr_risk_of_mortality", interactions: bool = True) -> DataFrame:
    """Ordinals of severity and mortality risk, their weighted mix and products with stay and age."""
    new = {}
    if severity_column in df.columns:
        new["severity_encoded"] = lookup(F.col(severity_column), V.SEVERITY_RANK)
    if mortality_column in df.columns:
        new["mortality_risk_encoded"] = lookup(F.col(mortality_column), V.SEVERITY_RANK)
    df = _add(df, new)
    s, m = F.col("severity_encoded"), F.col("mortality_risk_encoded")
    new = {}
    if interactions and _have(df, "severity_encoded", "length_of_stay"):
        df = numeric_amounts(df, ("length_of_stay",))
        new["severity_los_interaction"] = s * F.col("length_of_stay")
    if interactions and _have(df, "severity_encoded", "age_risk_score"):
        new["severity_age_interaction"] = s * F.col("age_risk_score")
    if _have(df, "severity_encoded", "mortality_risk_encoded"):
        new["combined_risk_score"] = s * V.SEVERITY_WEIGHT + m * V.MORTALITY_WEIGHT
    return _add(df, new)


def admission(df: DataFrame, type_column: str = "type_of_admission",
              ed_column: str = "emergency_department_indicator", emergency_name: str = "is_emergency",
              ed_name: str = "ed_visit", all_types: bool = True) -> DataFrame:
    new = {}
    if type_column in df.columns:
        c = F.col(type_column)
        new[emergency_name] = flag(contains(c, "Emergency"))
        if all_types:
            new["is_elective"] = flag(contains(c, "Elective"))
            new["is_urgent"] = flag(contains(c, "Urgent"))
    if ed_column in df.columns:
        new[ed_name] = flag(F.col(ed_column) == "Y")
    return _add(df, new)


def medical_surgical(df: DataFrame, column: str = "apr_medical_surgical_description") -> DataFrame:
    if column not in df.columns:
        return df
    c = F.col(column)
    return _add(df, {"is_surgical": flag(contains(c, "Surgical")), "is_medical": flag(contains(c, "Medical"))})


def payment(df: DataFrame, column: str = "payment_typology_1") -> DataFrame:
    if column not in df.columns:
        return df
    c = F.col(column)
    return _add(df, {"is_medicare": flag(contains(c, "Medicare")), "is_medicaid": flag(contains(c, "Medicaid")),
                     "is_private": flag(contains(c, "Private"))})


GROUPS = {
    "age": age,
    "cost_ratios": cost_ratios,
    "severity": severity,
    "admission": admission,
    "medical_surgical": medical_surgical,
    "payment": payment,
    "stay": stay,
}


def all_groups(df: DataFrame, history: list[str] | None = None) -> DataFrame:
    """Every feature group in its order; ``history`` receives their names."""
    for name, group in GROUPS.items():
        df = group(df)
        if history is not None:
            history.append(name)
    return df


def engineer_features(df: DataFrame) -> DataFrame:
    """The columns a model is trained on: age, stay, cost, severity and admission."""
    return (df.transform(age, rank_name="age_encoded", flags=False, category=True)
            .transform(stay, labels=V.STAY_LABELS, extended_name="extended_stay_flag", short=False, log=True)
            .transform(cost_ratios, efficiency=False, log_cost=True)
            .transform(severity, interactions=False)
            .transform(admission, emergency_name="emergency_admission", ed_name="ed_flag", all_types=False))


def _case(column: str, mapping: dict[str, int]) -> str:
    whens = " ".join(f"WHEN '{k}' THEN {v}" for k, v in mapping.items())
    return f"CASE {column} {whens} ELSE NULL END"


def feature_sql(name: str, source: str = "{rows}") -> str:
    """A SQL query that adds one feature group to the rows of ``source``."""
    added = {
        "age": f"{_case('age_group', V.AGE_RANK)} AS age_risk_score",
        "cost_ratios": (
            "total_costs / NULLIF(length_of_stay + 1, 0) AS cost_per_day, "
            "total_costs / NULLIF(total_charges + 1, 0) AS cost_to_charge_ratio"),
        "severity": (
            f"{_case('apr_severity_of_illness_description', V.SEVERITY_RANK)} AS severity_encoded, "
            f"{_case('apr_severity_of_illness_description', V.SEVERITY_RANK)} * length_of_stay "
            "AS severity_los_interaction"),
    }
    if name not in added:
        raise KeyError(f"no SQL text for feature group {name}")
    return f"SELECT *, {added[name]} FROM {source}"


def sql_features(df: DataFrame, *names: str) -> DataFrame:
    """Feature groups through their SQL text; amounts must be numeric."""
    for name in names:
        df = df.sparkSession.sql(feature_sql(name), rows=df)
    return df

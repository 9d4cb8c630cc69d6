"""Fixed values that results depend on: codes, edges, labels, thresholds and weights."""

# Ordinal of each age band; the oldest band has two spellings.
AGE_RANK = {"0-17": 1, "18-29": 2, "30-49": 3, "50-69": 4, "70 or Older": 5, "70+": 5}
PEDIATRIC = ("0-17",)
MIDDLE_AGED = ("50-69",)
ELDERLY = ("70 or Older", "70+")
AGE_ORDER = ("0-17", "18-29", "30-49", "50-69", "70 or Older", "70+")
AGE_RISK_EDGES = (0, 2, 4, 6)
AGE_RISK_LABELS = ("Low", "Medium", "High")

# Ordinal shared by severity of illness and risk of mortality.
SEVERITY_RANK = {"Minor": 1, "Moderate": 2, "Major": 3, "Extreme": 4}
SEVERITY_WEIGHT = 0.6
MORTALITY_WEIGHT = 0.4

# Length-of-stay bands, right-closed; two label sets are in use.
STAY_EDGES = (-1, 1, 3, 7, 14, float("inf"))
STAY_LABELS = ("Very Short", "Short", "Medium", "Long", "Very Long")
STAY_LABELS_WITH_DAYS = (
    "Very Short (0-1)", "Short (2-3)", "Medium (4-7)", "Long (8-14)", "Very Long (15+)",
)
EXTENDED_STAY_OVER = 7
SHORT_STAY_UP_TO = 3
STAY_TOPCODE = {"120+": "120"}

# Valid range of the target and of the stay.
COST_MIN = 0
COST_MAX = 10_000_000
COLUMN_NULL_LIMIT = 0.7

# Binning and drift.
PSI_BINS = 10
PSI_EMPTY_SHARE = 0.0001
PSI_DRIFT = 0.1
PSI_SIGNIFICANT = 0.25
KS_ALPHA = 0.05

# Evaluation.
MAPE_FLOOR = 2.220446049250313e-16
GATES = (("r2_score", ">=", 0.80), ("mae", "<=", 0.5), ("rmse", "<=", 0.8), ("mape", "<=", 15.0))
R2_DROP_ALERT = 0.05
MAE_RISE_ALERT = 0.10

# Weighted vote of the two boosted models.
VOTE_WEIGHTS = (0.538, 0.462)

# Columns computed from the target; they must not reach a model.
LEAKAGE = ("total_costs", "log_total_costs", "cost_per_day", "cost_to_charge_ratio", "cost_efficiency")

# Defaults of the boosted model.
MODEL = {"n_estimators": 200, "learning_rate": 0.1, "max_depth": 7, "min_samples_split": 2, "min_samples_leaf": 1, "subsample": 0.8,
         "random_state": 42}
# The two boosters of the vote: one grows its best leaf first, one level by level with a regularised gain.
LEAF_WISE = {"n_estimators": 100, "learning_rate": 0.1, "max_depth": None, "max_leaves": 31, "min_samples_leaf": 20, "min_child_weight": 0.001, "subsample": 1.0}
LEVEL_WISE = {"n_estimators": 100, "learning_rate": 0.300000012, "max_depth": 6, "min_child_weight": 1.0, "reg_lambda": 1.0, "subsample": 1.0}
# Default grid and ranges of the search.
GRID = {
    "n_estimators": [100, 200, 300],
    "learning_rate": [0.01, 0.05, 0.1, 0.2],
    "max_depth": [3, 5, 7, 10],
    "min_samples_split": [2, 5, 10],
    "min_samples_leaf": [1, 2, 4],
    "subsample": [0.8, 0.9, 1.0],
    "max_features": ["sqrt", "log2", None],
}
RANGES = {
    "n_estimators": (100, 499),
    "learning_rate": (0.01, 0.31),
    "max_depth": (3, 14),
    "min_samples_split": (2, 19),
    "min_samples_leaf": (1, 9),
    "subsample": (0.6, 1.0),
    "max_features": ["sqrt", "log2", None],
}

"""Names, texts, thresholds and patterns results are compared by."""

# Metric names, in report order.
METRICS = (
    "mse",
    "rmse",
    "mae",
    "r2",
    "mape",
    "smape",
    "median_ae",
    "max_error",
    "explained_variance",
    "mean_absolute_scaled_error",
)

# The metrics for which a larger value is better; for all others smaller is better.
HIGHER_IS_BETTER = ("r2", "explained_variance")

# Split names, in report order.
SPLITS = ("train", "val", "test")

# Words that make a column name look personal.
PII_KEYWORDS = ("name", "email", "phone", "ssn", "id", "address", "zip")

# Patterns of personal data in text. The loose forms are the default test.
EMAIL_LOOSE = "@"
EMAIL_STRICT = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}"
PHONE_LOOSE = r"\d{3}-\d{3}-\d{4}"
PHONE_STRICT = r"(\+\d{1,2} )?(\(\d{3}\) |\d{3}-)\d{3}-\d{4}"

# Thresholds of the quality and bias checks.
HIGH_MISSING_SHARE = 0.5
OUTLIER_FENCE = 1.5
HIGH_OUTLIER_SHARE = 0.1
MAX_IMPORTANCE = 0.8
MAX_IMPORTANCE_STD = 0.3
MIN_PREDICTION_RANGE = 0.1

# Summary sentence per overall status.
SUMMARY = {
    "passed": "All safety checks passed. The system is ready for use.",
    "warning": "Some safety checks generated warnings. Review recommendations before proceeding.",
    "failed": "Safety checks failed. Address critical issues before proceeding.",
    "error": "Safety checks failed. Address critical issues before proceeding.",
}

# Advice given when a check finds something.
RECOMMENDATIONS = {
    "privacy": (
        "Remove or anonymize personally identifiable information",
        "Use data masking techniques for sensitive columns",
        "Implement data access controls and audit logging",
        "Consider differential privacy for sensitive datasets",
        "Review data retention policies",
    ),
    "bias": (
        "Review feature importance distribution",
        "Consider feature selection techniques to reduce bias",
        "Implement fairness constraints in model training",
        "Use diverse training data to reduce bias",
        "Monitor model performance across different groups",
        "Consider using bias-aware evaluation metrics",
    ),
    "quality": (
        "Address missing values using appropriate imputation strategies",
        "Remove or transform constant features",
        "Handle duplicate rows appropriately",
        "Consider outlier detection and treatment",
        "Implement data validation pipelines",
        "Use data quality monitoring tools",
    ),
}

# Two-sided 95 % points of Student's t for 1 to 30 degrees of freedom.
T_95 = (
    12.706, 4.303, 3.182, 2.776, 2.571, 2.447, 2.365, 2.306, 2.262, 2.228,
    2.201, 2.179, 2.160, 2.145, 2.131, 2.120, 2.110, 2.101, 2.093, 2.086,
    2.080, 2.074, 2.069, 2.064, 2.060, 2.056, 2.052, 2.048, 2.045, 2.042,
)

# Acklam's rational approximation of the inverse normal distribution.
INVERSE_NORMAL = {
    "a": (-3.969683028665376e01, 2.209460984245205e02, -2.759285104469687e02,
          1.383577518672690e02, -3.066479806614716e01, 2.506628277459239e00),
    "b": (-5.447609879822406e01, 1.615858368580409e02, -1.556989798598866e02,
          6.680131188771972e01, -1.328068155288572e01),
    "c": (-7.784894002430293e-03, -3.223964580411365e-01, -2.400758277161838e00,
          -2.549732539343734e00, 4.374664141464968e00, 2.938163982698783e00),
    "d": (7.784695709041462e-03, 3.224671290700398e-01, 2.445134137142996e00,
          3.754408661907416e00),
    "tail": 0.02425,
}

"""Schemas, column lists and the fixed values the results depend on."""

from __future__ import annotations

from pyspark.sql import types as T

ID = "accident_number"
PSEUDO_ID = "anonymous_patient_id"
LABEL = "nbe"
ACCIDENT_DATE = "accident_date"
CONTACT_DATE = "contact_date"

CONSULTATION_SCHEMA = T.StructType([
    T.StructField(ID, T.StringType(), True),
    T.StructField(ACCIDENT_DATE, T.DateType(), True),
    T.StructField(CONTACT_DATE, T.DateType(), True),
    T.StructField("fl_score", T.IntegerType(), True),
    T.StructField("fl_status", T.IntegerType(), True),
    T.StructField("p_score", T.IntegerType(), True),
    T.StructField("p_status", T.IntegerType(), True),
    T.StructField(LABEL, T.IntegerType(), True),
])

RAW_SCHEMA = T.StructType([T.StructField(f.name, T.StringType(), True)
                           for f in CONSULTATION_SCHEMA.fields])

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's for equal results)
# ---------------------------------------------------------------------------

# Core features, in model order.
BASELINE_FEATURES = ["p_score", "p_status", "fl_score", "fl_status"]
# Enhanced model input order (10 features).
ENHANCED_FEATURES = [
    "p_score", "p_status", "fl_score", "fl_status",
    "days_since_accident", "consultation_number",
    "p_score_fl_score_interaction", "severity_index",
    "both_improving", "high_severity",
]
# Enhanced training table column order: 6 features, label, id, 4 interactions.
ENHANCED_TABLE_ORDER = [
    "p_score", "p_status", "fl_score", "fl_status",
    "days_since_accident", "consultation_number", LABEL, PSEUDO_ID,
    "p_score_fl_score_interaction", "severity_index",
    "both_improving", "high_severity",
]

# Step-1 validation: required columns and accepted dtypes.
STEP1_REQUIRED = [ID, "p_score", "p_status", "fl_score", "fl_status", LABEL]
# Step-2 cleaning: required columns.
STEP2_REQUIRED = [ID, ACCIDENT_DATE, CONTACT_DATE,
                  "p_score", "p_status", "fl_score", "fl_status", LABEL]
# Spark types accepted for each required column (reference: object/string id,
# int64/int32/float64 numbers).
ACCEPTED_TYPES = {
    ID: ["string"],
    "p_score": ["bigint", "int", "double"],
    "p_status": ["bigint", "int", "double"],
    "fl_score": ["bigint", "int", "double"],
    "fl_status": ["bigint", "int", "double"],
    LABEL: ["bigint", "int", "double"],
    ACCIDENT_DATE: ["date", "timestamp", "timestamp_ntz"],
    CONTACT_DATE: ["date", "timestamp", "timestamp_ntz"],
}

# Data ranges (inclusive) for the five score / label columns.
FEATURE_RANGES = {
    "p_score": (0, 4),
    "p_status": (0, 2),
    "fl_score": (0, 4),
    "fl_status": (0, 2),
    "nbe": (0, 2),
}
PROFILE_COLUMNS = ["p_score", "p_status", "fl_score", "fl_status", "nbe"]
CRITICAL_COLUMNS = ["p_score", "p_status", "fl_score", "fl_status", "nbe"]

# Request ranges: (min, max, description), in validation order.
REQUEST_RANGES = [
    ("p_score", 0, 4, "Pain score"),
    ("p_status", 0, 2, "Pain status"),
    ("fl_score", 0, 4, "Function limitation score"),
    ("fl_status", 0, 2, "Function limitation status"),
    ("days_since_accident", 0, 1000, "Days since accident"),
    ("consultation_number", 1, 20, "Consultation sequence number"),
]
# Scoring defaults for absent / null optional inputs.
SCORING_DEFAULTS = {"days_since_accident": 21, "consultation_number": 2}
# Defaults used by the training pipeline when the temporal columns are absent.
TRAINING_DEFAULTS = {"days_since_accident": 14, "consultation_number": 1}

# Valid (p_status, fl_status) pairs and their descriptions.
STATUS_PAIRS = [
    (0, 0, "Both pain and function worsening"),
    (0, 1, "Pain worsening, function stable"),
    (0, 2, "Pain worsening, function improving"),
    (1, 0, "Pain stable, function worsening"),
    (1, 1, "Both pain and function stable"),
    (1, 2, "Pain stable, function improving"),
    (2, 0, "Pain improving, function worsening"),
    (2, 1, "Pain improving, function stable"),
    (2, 2, "Both pain and function improving"),
]
BUSINESS_RULES = [
    "Pain score (p_score) should generally correlate with function limitation (fl_score)",
    "Status values indicate change vs previous consultation",
    "First consultation typically occurs within 90 days of accident",
    "Multiple consultations should have reasonable spacing (7+ days apart)",
    "Very high pain (4) with no function limitation (0) is medically unusual",
]

# Confidence bands on |p - 0.5| * 2.
CONFIDENCE_HIGH = 0.7
CONFIDENCE_MEDIUM = 0.4

# Quality thresholds.
MIN_SAMPLES = 100
ADEQUATE_SAMPLES = 500
TARGET_MIN_COMPLETENESS = 95.0
BALANCE_THRESHOLD_VALIDATOR = 0.1
BALANCE_THRESHOLD_LOADER = 0.3
HIGH_FREQUENCY_VISITS = 5

# Split / folds.
TEST_FRACTION = 0.2
N_FOLDS = 5
SEED = 42

# Rate limits per minute by path (client side), and API permissions.
RATE_LIMITS = [
    ("/api/v1/nbe/predict/baseline", 100),
    ("/api/v1/nbe/predict/enhanced", 100),
    ("/api/v1/models/info", 60),
    ("/api/v1/health", 120),
]
PUBLIC_PATHS = ["/api/v1/health", "/docs", "/redoc", "/openapi.json", "/"]
PREDICT_PREFIX = "/api/v1/nbe/predict"

LOG_LOSS_EPS = 2.220446049250313e-16
DECISION_THRESHOLD = 0.5

# Texts of the exploration report.
REC_SAMPLES = "Increase sample size for better model performance"
REC_TARGET_MISSING = "Target variable has too many missing values"
REC_TARGET_CLASSES = "Target variable needs at least 2 classes"
REC_BALANCE = "Consider class balancing techniques"
REC_RANGES = "Clean data range violations before modeling"
REC_DUPLICATES = "Remove or investigate duplicate records"
REC_MISSING = "Address missing values before model training"
FINDING_VALID = "Data passes all validation checks and is ready for preprocessing"
NEXT_STEPS_VALID = [
    "Proceed to Step 2: Data Preprocessing & Anonymization",
    "Implement data cleaning strategies if needed",
    "Create anonymized patient identifiers",
    "Prepare data for feature engineering",
]
NEXT_STEPS_ISSUES = [
    "Address critical data issues identified in validation",
    "Re-run data exploration after fixing issues",
    "Consult with domain experts for business rule clarification",
]
NEXT_STEP_ALWAYS = "Document findings and share with stakeholders"

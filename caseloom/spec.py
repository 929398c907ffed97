"""Fixed values of the encounter data model.

Operators take all of these as parameters; nothing clinical is written into operator code.
"""

from __future__ import annotations

from dataclasses import dataclass

# ---------------------------------------------------------------------------
# Column names, tokens, band edges, labels and limits. They must
# stay as they are for results to agree with the tables they describe.
# ---------------------------------------------------------------------------

RACE_LABELS = {
    "race:AfricanAmerican": "AfricanAmerican",
    "race:Asian": "Asian",
    "race:Caucasian": "Caucasian",
    "race:Hispanic": "Hispanic",
    "race:Other": "Other",
}
RACE_FLAGS = list(RACE_LABELS)

RAW_COLUMNS = [
    "year",
    "gender",
    "age",
    "location",
    *RACE_FLAGS,
    "hypertension",
    "heart_disease",
    "smoking_history",
    "bmi",
    "hbA1c_level",
    "blood_glucose_level",
    "diabetes",
]
NUMERIC_COLUMNS = ["year", "age", "bmi", "hbA1c_level", "blood_glucose_level"]
BINARY_COLUMNS = ["hypertension", "heart_disease", "diabetes", *RACE_FLAGS]
FEATURES = ["hbA1c_level", "blood_glucose_level", "bmi", "age", "hypertension", "heart_disease"]
LABEL = "diabetes"
MODEL_COLUMNS = [*FEATURES, LABEL]

CLEAN_COLUMNS = [
    "year",
    "gender",
    "location",
    "race",
    "hypertension",
    "heart_disease",
    "smoking_history",
    "diabetes",
    "age_bucket",
    "bmi_bucket",
]
COHORT_DIMENSIONS = [
    "age_bucket",
    "race",
    "gender",
    "bmi_bucket",
    "hypertension",
    "heart_disease",
    "smoking_history",
    "location",
]
FREQUENCY_COLUMNS = ["race", "age_bucket", "bmi_bucket", "gender", "smoking_history", "location"]

# Blank markers after trimming and lower-casing. Profiling counts "unknown" as
# missing; cleaning keeps it as text.
CLEANING_BLANKS = ("", "na", "n/a", "null", "none", "nan")
PROFILE_BLANKS = (*CLEANING_BLANKS, "unknown")

SMOKING_GROUPS = {
    "never": "Never",
    "former": "Former",
    "ever": "Former",
    "not current": "Former",
    "current": "Current",
}

COHORT_TITLES = {
    "hba1c_bucket": "HbA1c",
    "glucose_bucket": "Blood Glucose",
    "age_bucket": "Age group",
    "bmi_bucket": "BMI category",
    "smoking_history": "Smoking status",
    "hypertension": "Hypertension",
    "heart_disease": "Heart disease",
    "race": "Race",
    "gender": "Gender",
}
YES_NO_DIMENSIONS = ("hypertension", "heart_disease")

FEATURE_TITLES = {
    "blood_glucose_level": "Blood Glucose Level",
    "hbA1c_level": "HbA1c Level",
    "age": "Age",
    "bmi": "BMI",
    "hypertension": "Hypertension",
    "heart_disease": "Heart Disease",
}
FLAG_TITLES = {
    "hypertension": {0: "No HTN", 1: "With HTN"},
    "heart_disease": {0: "No Heart Disease", 1: "Heart Disease"},
}

KEY_NAMES = ["id", "patient_id", "subject_id", "record_id"]
CATEGORY_NAMES = [
    "category",
    "diag",
    "diagnosis",
    "condition",
    "label",
    "disease",
    "cohort",
    "race",
    "age_bucket",
]

MIN_COHORT_SIZE = 500
TOP_PROFILES = 20
SPLIT_WEIGHTS = {"train": 0.7, "calibration": 0.1, "test": 0.2}


@dataclass(frozen=True)
class Bands:
    """Left-closed bands. `edges` are the inner cut points; `low`/`top` bound the outer bands if given."""

    edges: tuple[float, ...]
    labels: tuple[str, ...]
    null_label: str | None = None
    low: float | None = None
    top: float | None = None


AGE_COHORT = Bands((25, 40, 55, 70), ("0-24", "25-39", "40-54", "55-69", "70+"), "Unknown")
BMI_COHORT = Bands((18.5, 25, 30), ("Underweight", "Normal", "Overweight", "Obese"), "Unknown")

HBA1C_RANGE = Bands((5.7, 6.5), ("Normal (<5.7)", "Prediabetes (5.7-6.4)", "Diabetic (>=6.5)"))
GLUCOSE_RANGE = Bands((100, 126), ("Normal (<100)", "Prediabetes (100-125)", "High (>=126)"))
BMI_RANGE = Bands(
    (18.5, 25, 30),
    ("Underweight (<18.5)", "Normal (18.5-24.9)", "Overweight (25-29.9)", "Obese (>=30)"),
)
AGE_RANGE = Bands(
    (18, 35, 55), ("Children (<18)", "Young (18-34)", "Middle (35-54)", "Senior (>=55)")
)

# Closed forms: values outside [low, top) belong to no band.
AGE_STAGE = Bands((18, 35, 55), ("children", "youth", "adult", "senior"), low=0, top=120)
BMI_STAGE = Bands((18.5, 25, 30), ("underweight", "healthy", "overweight", "obese"), low=0, top=200)
HBA1C_STAGE = Bands(HBA1C_RANGE.edges, HBA1C_RANGE.labels, low=0)
GLUCOSE_STAGE = Bands(GLUCOSE_RANGE.edges, GLUCOSE_RANGE.labels, low=0)

COMORBIDITY_TIERS = ("no_comorbidity", "hypertension_only", "heart_disease_only", "both_conditions")
COMORBIDITY_TITLES = {
    "no_comorbidity": "No Comorbidity",
    "hypertension_only": "Hypertension Only",
    "heart_disease_only": "Heart Disease Only",
    "both_conditions": "Both Conditions",
}
RISK_BANDS = ("Low", "Medium", "High")


@dataclass(frozen=True)
class Limits:
    """Accepted interval of a measure; `open_low` leaves the lower end out."""

    low: float
    high: float
    open_low: bool = False


@dataclass(frozen=True)
class Validity:
    """A row rule set: required columns, 0/1 columns and accepted intervals."""

    ranges: dict[str, Limits]
    binary: tuple[str, ...] = ()
    required: tuple[str, ...] = ()


STRICT_VALIDITY = Validity(
    ranges={
        "bmi": Limits(10, 80),
        "age": Limits(0, 120),
        "hbA1c_level": Limits(3.5, 15),
        "blood_glucose_level": Limits(20, 600),
    },
    binary=("diabetes", "hypertension", "heart_disease"),
    required=tuple(MODEL_COLUMNS),
)
LOOSE_VALIDITY = Validity(
    ranges={
        "age": Limits(0, 120, open_low=True),
        "bmi": Limits(0, 50, open_low=True),
        "hbA1c_level": Limits(3, 15),
        "blood_glucose_level": Limits(50, 400),
    },
)

# name -> (column, lowest allowed, highest allowed)
RANGE_CHECKS = {
    "age outside [0, 120]": ("age", 0, 120),
    "negative bmi values": ("bmi", 0, None),
    "year outside [1900, 2100]": ("year", 1900, 2100),
    "negative hbA1c_level values": ("hbA1c_level", 0, None),
    "negative blood_glucose_level values": ("blood_glucose_level", 0, None),
}

"""Values that fix the meaning of results. Change them per call, not here."""

# --- Fixed values: cohort definition ---------------------------------------
CODE_PREFIXES = ("430", "431", "433", "434", "436", "437")
KEYWORDS = ("stroke", "cva", "ich", "sah")

# --- Fixed values: observation window and sparse-column rule ----------------
WINDOW_HOURS = 72
MINUTES_PER_HOUR = 60
MISSING_THRESHOLD = 0.7

# --- Fixed values: plausible ranges (low, high), both ends allowed ----------
RANGES_CONFIGURED = {
    "heartrate": (20, 220),
    "map": (30, 160),
    "spo2": (50, 100),
    "temperature": (32, 42),
}
RANGES_DEFAULT = {
    "heartrate": (20, 220),
    "temperature": (32, 42),
    "respiration": (4, 60),
    "systemicsystolic": (40, 250),
    "systemicdiastolic": (20, 180),
    "systemicmean": (30, 200),
    "sao2": (50, 100),
}

# --- Fixed values: column names ---------------------------------------------
STAY = "patientunitstayid"
LABEL = "mortality"
STATUS = "hospitaldischargestatus"
DEATH_WORD = "expired"
LEAKAGE_COLUMNS = (
    "hospitaldischargestatus",
    "unitdischargestatus",
    "hospitaldischargelocation",
    "unitdischargelocation",
)
STATIC_COLUMNS = (
    "age",
    "gender",
    "ethnicity",
    "admissionheight",
    "admissionweight",
    "site_id",
    "mortality",
)
CATEGORICAL_COLUMNS = ("age", "gender", "ethnicity", "site_id")
NON_FEATURE_COLUMNS = ("patient_id", "patientunitstayid", "admission_time", "mortality")
ID_COLUMN_NAMES = (
    "patientunitstayid",
    "patient_unit_stay_id",
    "subject_id",
    "hadm_id",
    "icustay_id",
    "patient_id",
    "id",
    "ID",
    "stay_id",
)
TIME_WORDS = ("time", "offset", "hour", "minute", "datetime", "timestamp", "date")
SUSPICIOUS_WORDS = (
    "death", "dead", "died", "expire", "expired", "expiration",
    "mortality", "mortal", "deceased",
    "discharge", "discharged", "disposition",
    "outcome", "result", "final",
    "diagnosis", "diagnose", "icd",
    "future", "post", "after",
    "label", "target", "ground_truth",
)

# --- Fixed values: encodings, splits and report thresholds -------------------
UNKNOWN_LEVEL = "Unknown"
MISSING_TEXT = "nan"
PROTOCOLS = {
    "patient_level": "patient_stratified",
    "temporal": "temporal",
    "site": "site_holdout",
}
SPLITS = ("train", "val", "test")
DEFAULT_SEED = 42
MAX_CATEGORICAL_LEVELS = 10
HIGH_CARDINALITY = 10_000
STATIC_ROWS_PER_ENTITY = 1.1
HIGH_CORRELATION = 0.9
IMBALANCE_RATIO = 0.2
THRESHOLD_GRID = 100
DEVIATION_EPSILON = 1e-8

# --- Fixed values: spellings read as missing from text files -----------------
MISSING_SPELLINGS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)

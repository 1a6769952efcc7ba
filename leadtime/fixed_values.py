"""Fixed values that decide results: names, weights, bounds and limits.

Everything here is data. Operators take these as parameters; nothing in the
operators is bound to one table or to one column name.
"""

# --- Fixed values: entity-year and claim columns --------------------------
ENTITY_KEY = "DESYNPUF_ID"
YEAR_COLUMN = "ANNEE"
TARGET_COLUMN = "HOSPITALIZED_IN_6M"
BIRTH_COLUMN = "BENE_BIRTH_DT"
DATE_MARK = "DT"
FLAG_PREFIX = "SP_"
COST_MARKS = ["MEDREIMB", "BENRES", "PPPYMT"]
ENTITY_FIXED_COLUMNS = [
    "DESYNPUF_ID", "ANNEE", "BENE_BIRTH_DT", "BENE_SEX_IDENT_CD",
    "BENE_RACE_CD", "BENE_ESRD_IND", "AGE", "HOSPITALIZED_IN_6M",
]
ADMISSION_FALLBACK = ["admission", "CLM_ADMSN_DT", "CLM_FROM_DT"]
ADMISSION_TYPE_COLUMN = "CLM_IP_ADMSN_TYPE_CD"
URGENT_ADMISSION_TYPES = [1, 2]
YEAR_SPLITS = {2008: "train", 2009: "val", 2010: "test"}

# --- Fixed values: chronic-condition flags and their weights --------------
CHRONIC_WEIGHTS = {
    "SP_ALZHDMTA": 1,
    "SP_CHF": 1,
    "SP_CHRNKIDN": 2,
    "SP_CNCR": 2,
    "SP_COPD": 1,
    "SP_DEPRESSN": 1,
    "SP_DIABETES": 1,
    "SP_ISCHMCHT": 1,
    "SP_OSTEOPRS": 0,
    "SP_RA_OA": 1,
    "SP_STRKETIA": 2,
}
CHRONIC_FLAGS = list(CHRONIC_WEIGHTS)

# --- Fixed values: age handling -------------------------------------------
AGE_EDGES = [0, 65, 75, 85, 120]
AGE_LABELS = ["<65", "65-74", "75-84", "85+"]
AGE_RANGE = (0, 120)
AGE_DEFAULT = 70
DAYS_PER_YEAR = 365.25
MANY_CODES = 5

# --- Fixed values: model-facing feature list ------------------------------
SCALED_FEATURES = [
    "AGE", "COUT_TOTAL", "CHARLSON_INDEX", "NB_COMORBIDITES",
    "NB_HOSP_PASSEES", "NB_OP_3M", "NB_OP_6M", "NB_OP_12M", "NB_CAR_6M",
    "NB_PRESCRIPTIONS", "NB_MOLECULES_UNIQUES",
]
MODEL_FEATURES = CHRONIC_FLAGS + [
    "AGE", "SEXE_ENC", "RACE_ENC", "BENE_ESRD_IND", "GROUPE_AGE_ENC",
    "NB_COMORBIDITES", "CHARLSON_INDEX", "COUT_TOTAL", "IS_NEW_PATIENT",
    "NB_HOSP_PASSEES", "NB_OP_3M", "NB_OP_6M", "NB_OP_12M", "NB_CAR_6M",
    "NB_PRESCRIPTIONS", "NB_MOLECULES_UNIQUES", "POLYPHARMACIE",
]

# --- Fixed values: data-quality rules -------------------------------------
QUALITY_RULES = {
    "sp_features": {"cols": CHRONIC_FLAGS, "dtype": "int", "min": 0, "max": 1},
    "numerical_features": {"cols": SCALED_FEATURES, "dtype": "float", "min": 0},
    "categorical_features": {
        "cols": ["SEXE_ENC", "RACE_ENC", "BENE_ESRD_IND", "GROUPE_AGE_ENC",
                 "IS_NEW_PATIENT", "POLYPHARMACIE"],
        "dtype": "int", "min": 0,
    },
}
NULL_SHARE_ERROR = 0.5
NULL_SHARE_WARNING = 0.1
ERROR_PENALTY = 15
WARNING_PENALTY = 5
TARGET_RATE_RANGE = (0.01, 0.99)
SEX_CODES = [1, 2]

# --- Fixed values: drift and retraining -----------------------------------
PSI_LIMIT = 0.20
PSI_BINS = 10
PSI_SHARE_FLOOR = 0.0001
TARGET_DRIFT_LIMIT = 0.02
DRIFT_CRITICAL_PCT = 30
DRIFT_HIGH_PCT = 15
RETRAIN_SEVERITIES = ["HIGH", "CRITICAL"]
RETRAIN_RECALL_MIN = 0.85

# --- Fixed values: evaluation, promotion and scoring ----------------------
SWEEP_THRESHOLDS = [
    0.01, 0.02, 0.03, 0.04, 0.05, 0.1, 0.15, 0.2, 0.25, 0.3, 0.35, 0.4,
    0.45, 0.5, 0.55, 0.6, 0.65, 0.7, 0.75, 0.8, 0.85, 0.9, 0.95,
]
RECALL_TARGET = 0.95
CANDIDATE_MIN_AUC = 0.88
PRECISION_TARGETS = [0.80, 0.85, 0.89, 0.90, 0.93]
PRECISION_MIN_POSITIVES = 50
PROMOTION_MIN_AUC = 0.85
ROLLBACK_MIN_RECALL = 0.75
ROLLBACK_AUC_MARGIN = 0.05
KEEP_VERSIONS = 10
SCORE_THRESHOLD = 0.25
RISK_LABELS = ("ÉLEVÉ", "MODÉRÉ", "FAIBLE")
CHALLENGER_SHARE = 10
PSEUDO_LABEL_CONFIDENCE = 0.95
MISSING_MODEL_SCORE = 0.5

# --- Fixed values: request-latency bucket bounds, seconds -----------------
LATENCY_BOUNDS = [
    0.005, 0.01, 0.025, 0.05, 0.075, 0.1, 0.25, 0.5, 0.75, 1.0, 2.5, 5.0,
    10.0,
]

# --- Fixed values: scoring-request fields: (name, type, default, min, max);
# --- default None means the field is required -----------------------------
REQUEST_FIELDS = [
    ("AGE", "double", None, 0, 120),
    ("SEXE_ENC", "int", None, 0, 1),
    ("RACE_ENC", "int", None, 0, 5),
    ("BENE_ESRD_IND", "int", 0, 0, 1),
    ("GROUPE_AGE_ENC", "int", None, 0, 3),
    ("SP_ALZHDMTA", "int", 0, 0, 1),
    ("SP_CHF", "int", 0, 0, 1),
    ("SP_CHRNKIDN", "int", 0, 0, 1),
    ("SP_CNCR", "int", 0, 0, 1),
    ("SP_COPD", "int", 0, 0, 1),
    ("SP_DEPRESSN", "int", 0, 0, 1),
    ("SP_DIABETES", "int", 0, 0, 1),
    ("SP_ISCHMCHT", "int", 0, 0, 1),
    ("SP_OSTEOPRS", "int", 0, 0, 1),
    ("SP_RA_OA", "int", 0, 0, 1),
    ("SP_STRKETIA", "int", 0, 0, 1),
    ("SP_STATE_CODE", "int", 0, 0, None),
    ("NB_COMORBIDITES", "double", 0, 0, None),
    ("CHARLSON_INDEX", "double", 0, 0, None),
    ("COUT_TOTAL", "double", 0, 0, None),
    ("IS_NEW_PATIENT", "int", 0, 0, 1),
    ("NB_HOSP_PASSEES", "double", 0, 0, None),
    ("NB_OP_3M", "double", 0, 0, None),
    ("NB_OP_6M", "double", 0, 0, None),
    ("NB_OP_12M", "double", 0, 0, None),
    ("NB_CAR_6M", "double", 0, 0, None),
    ("NB_PRESCRIPTIONS", "double", 0, 0, None),
    ("NB_MOLECULES_UNIQUES", "double", 0, 0, None),
    ("POLYPHARMACIE", "int", 0, 0, 1),
]

# --- Fixed values: parameter search ----------------------------------------
SEARCH_TRIALS = 50
SEARCH_RANGES = {
    "rounds": ("int", 50, 300),
    "depth": ("int", 3, 8),
    "step": ("log", 0.001, 0.1),
    "rows": ("float", 0.5, 1.0),
    "columns": ("float", 0.5, 1.0),
}

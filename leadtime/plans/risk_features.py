"""The two feature builds, splitting and scaling, with the fixed column names of claims data."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import DataFrame, functions as F

from leadtime import fixed_values as fv
from leadtime.functions.dates import year_start
from leadtime.functions.flags import code_flag
from leadtime.functions.numeric import as_target, clip, column_or, right_closed_bin, right_closed_ordinal, safe_columns, safe_numeric
from leadtime.operators import cleaning, composites, point_in_time as pit
from leadtime.operators.prefix import exact_quantile
from leadtime.operators.scaling import prepare_training
from leadtime.session import cut_lineage

FULL_FEATURES = [
    pit.count_before("inpatient", "NB_HOSP_PASSEES"),
    pit.days_since_last("inpatient", "DAYS_SINCE_LAST_HOSP"),
    *[pit.count_trailing("inpatient", m, f"NB_HOSP_{m}M") for m in (3, 6, 12)],
    *[pit.count_trailing("outpatient", m, f"NB_OP_{m}M") for m in (3, 6, 12)],
    *[pit.count_trailing("carrier", m, f"NB_CAR_{m}M") for m in (3, 6, 12)],
    *[pit.count_trailing("prescription", m, f"NB_RX_{m}M") for m in (3, 6, 12)],
    pit.count_before("outpatient", "NB_OP_TOTAL_PASSE"),
    pit.count_before("carrier", "NB_CAR_TOTAL_PASSE"),
    pit.count_before("prescription", "NB_PRESCRIPTIONS"),
    pit.days_since_last("outpatient", "DAYS_SINCE_LAST_OP"),
    pit.days_since_last("carrier", "DAYS_SINCE_LAST_CAR"),
    pit.days_since_last("prescription", "DAYS_SINCE_LAST_RX"),
    pit.distinct_before("prescription", "NB_MOLECULES_UNIQUES"),
    pit.sum_before("inpatient", "COUT_HOSP_PASSE"),
    pit.sum_before("outpatient", "COUT_OP_PASSE"),
    pit.sum_before("carrier", "COUT_CAR_PASSE"),
]
REDUCED_FEATURES = [f for f in FULL_FEATURES if f.name in (
    "NB_HOSP_PASSEES", "NB_OP_3M", "NB_OP_6M", "NB_OP_12M", "NB_CAR_6M", "NB_PRESCRIPTIONS", "NB_MOLECULES_UNIQUES")]

TOTALS = {f"UTILISATION_{m}M": [f"NB_{s}_{m}M" for s in ("HOSP", "OP", "CAR", "RX")] for m in (3, 6, 12)}


def claim_sources(claims: Mapping[str, DataFrame]) -> list[pit.Source]:
    """The four claim tables as event sources; the admission date is the first date column that exists."""
    inpatient = cleaning.event_date(claims["inpatient"], fv.ADMISSION_FALLBACK, "admission")

    def amount(df):
        return "CLM_PMT_AMT" if "CLM_PMT_AMT" in df.columns else None

    def priced(df):
        return df if amount(df) else df.withColumn("CLM_PMT_AMT", F.lit(0.0))

    rx = claims["prescription"]
    return [
        pit.Source("inpatient", priced(inpatient), fv.ENTITY_KEY, "admission", "CLM_PMT_AMT"),
        pit.Source("outpatient", priced(claims["outpatient"]), fv.ENTITY_KEY, "CLM_FROM_DT", "CLM_PMT_AMT"),
        pit.Source("carrier", priced(claims["carrier"]), fv.ENTITY_KEY, "CLM_FROM_DT", "CLM_PMT_AMT"),
        pit.Source("prescription", rx if "PROD_SRVC_ID" in rx.columns else
                   rx.withColumn("PROD_SRVC_ID", F.lit(None).cast("string")), fv.ENTITY_KEY, "SRVC_DT",
                   code="PROD_SRVC_ID"),
    ]


def observation_dates(years: Sequence[int]) -> list[date]:
    return [date(y, 1, 1) for y in sorted(years)]


def _dynamic(entities: DataFrame, sources: Sequence[pit.Source], features: Sequence[pit.Feature],
             years: Sequence[int], key: str, year: str) -> DataFrame:
    cohort = entities.withColumn("obs_date", year_start(F.col(year)))
    return pit.point_in_time(cohort, sources, features, observation_dates(years), key)


def full_features(entities: DataFrame, sources: Sequence[pit.Source], years: Sequence[int],
                  key: str = fv.ENTITY_KEY, year: str = fv.YEAR_COLUMN, weights: Mapping[str, float] = fv.CHRONIC_WEIGHTS,
                  cost_marks: Sequence[str] = tuple(fv.COST_MARKS)) -> DataFrame:
    """24 event features, totals, ratios, burden, costs and age group for every entity-year."""
    df = _dynamic(entities, sources, FULL_FEATURES, years, key, year)
    df = composites.presence_flags(df, {"HAS_HOSP_HISTORY": ("NB_HOSP_PASSEES", 0),
                                        "POLYPHARMACIE": ("NB_MOLECULES_UNIQUES", fv.MANY_CODES)})
    df = composites.activity_totals(df, TOTALS)
    df = composites.newcomer_flag(df, ["NB_HOSP_PASSEES", "NB_OP_TOTAL_PASSE", "NB_CAR_TOTAL_PASSE",
                                       "NB_PRESCRIPTIONS"], "IS_NEW_PATIENT")
    df = composites.smoothed_ratios(df, {"RATIO_RX_OP_12M": ("NB_RX_12M", "NB_OP_12M"),
                                         "RATIO_CAR_OP_12M": ("NB_CAR_12M", "NB_OP_12M")})
    codes = safe_columns(df, list(weights))
    df = df.withColumns({c: clip(v.cast("int"), 0, 1) for c, v in codes.items()})
    df = composites.condition_burden(df, weights, "NB_COMORBIDITES", "CHARLSON_INDEX")
    df = composites.cost_rollup(df, cost_marks, "COUT_BENEFICIARY_ANNUEL")
    df = composites.sum_of(df, ["COUT_HOSP_PASSE", "COUT_OP_PASSE", "COUT_CAR_PASSE"], "COUT_CLAIMS_PASSE", clean=True)
    df = composites.sum_of(df, ["COUT_BENEFICIARY_ANNUEL", "COUT_CLAIMS_PASSE"], "COUT_TOTAL", clean=True)
    if "AGE" in df.columns:
        # the median of the entity table itself: the joined features do not change the ages
        age = safe_numeric("AGE", None)
        middle = exact_quantile(entities.select(safe_numeric("AGE", None).alias("AGE")), "AGE").scalar()
        filled = F.coalesce(age, middle, F.lit(float(fv.AGE_DEFAULT)))
        df = df.withColumn("AGE", clip(filled, *[float(x) for x in fv.AGE_RANGE]))
    else:
        df = df.withColumn("AGE", F.lit(float(fv.AGE_DEFAULT)))
    return df.withColumn("GROUPE_AGE", right_closed_bin(F.col("AGE"), fv.AGE_EDGES, fv.AGE_LABELS))


def prepare_entities(entities: DataFrame, target: str = fv.TARGET_COLUMN,
                     weights: Mapping[str, float] = fv.CHRONIC_WEIGHTS,
                     cost_marks: Sequence[str] = tuple(fv.COST_MARKS), sex: str = "BENE_SEX_IDENT_CD",
                     race: str = "BENE_RACE_CD") -> DataFrame:
    """Flags (code 1 only), costs, encodings and label of the model-facing build.

    A renal flag may arrive as 'Y'/'0' or as a number.
    """
    df = entities.withColumns({c: code_flag(F.col(c)) for c in weights if c in entities.columns})
    df = composites.cost_rollup(df, cost_marks, "COUT_TOTAL")
    renal = F.lit(0.0)
    if "BENE_ESRD_IND" in df.columns:
        renal = F.when(F.col("BENE_ESRD_IND").cast("string") == "Y", F.lit(1.0)).otherwise(column_or(df, "BENE_ESRD_IND"))
    v = safe_columns(df, ["AGE", sex, race])
    return df.withColumns({
        "AGE": v["AGE"], "SEXE_ENC": v[sex], "RACE_ENC": v[race], "BENE_ESRD_IND": renal,
        target: as_target(F.col(target))})


def reduced_features(entities: DataFrame, sources: Sequence[pit.Source], years: Sequence[int],
                     key: str = fv.ENTITY_KEY, year: str = fv.YEAR_COLUMN, target: str = fv.TARGET_COLUMN,
                     weights: Mapping[str, float] = fv.CHRONIC_WEIGHTS, **entity_options) -> DataFrame:
    """The 28 model-facing features beside key, year and label."""
    prepared = prepare_entities(entities, target, weights, **entity_options)
    df = _dynamic(prepared, sources, REDUCED_FEATURES, years, key, year)
    df = composites.newcomer_flag(df, ["NB_HOSP_PASSEES", "NB_OP_12M", "NB_PRESCRIPTIONS"], "IS_NEW_PATIENT")
    df = composites.condition_burden(df, weights, "NB_COMORBIDITES", "CHARLSON_INDEX")
    df = composites.presence_flags(df, {"POLYPHARMACIE": ("NB_MOLECULES_UNIQUES", fv.MANY_CODES)})
    return df.withColumn("GROUPE_AGE_ENC", right_closed_ordinal(F.col("AGE"), fv.AGE_EDGES))


def split_and_scale(df: DataFrame, key: str = fv.ENTITY_KEY, year: str = fv.YEAR_COLUMN,
                    target: str = fv.TARGET_COLUMN, splits: Mapping[int, str] = fv.YEAR_SPLITS,
                    features: Sequence[str] = tuple(fv.MODEL_FEATURES), scaled: Sequence[str] = tuple(fv.SCALED_FEATURES),
                    fit_on: str = "train") -> tuple[DataFrame, DataFrame]:
    """(key, year, split, label, features) with the scaler's one-row parameters.

    ``fit_on='train'`` keeps later years out of the scaler; ``'all'`` fits on every row.
    Fitting and applying are two passes: the features are stored in between, so
    that the events behind them are read and aggregated only once.
    """
    present = [c for c in features if c in df.columns]
    rows = cleaning.temporal_split(df, F.col(year), splits).withColumn(target, as_target(F.col(target)))
    rows = cut_lineage(rows.select(key, year, "split", target, *present), "features")
    where = None if fit_on == "all" else F.col("split") == fit_on
    return prepare_training(rows, present, [c for c in scaled if c in present], [key, year, "split", target], where)


def clean_entities(raw: DataFrame, label: DataFrame | None = None) -> DataFrame:
    """Raw entity-years to the cleaned table: projection, one row per key and year, dates, age, numbers."""
    df = cleaning.project_by_name(raw, fv.ENTITY_FIXED_COLUMNS, [fv.FLAG_PREFIX], fv.COST_MARKS)
    keys = [fv.ENTITY_KEY, fv.YEAR_COLUMN]
    df = cleaning.normalise_key(cleaning.keep_first(df, keys, df.columns), fv.ENTITY_KEY)
    df = cleaning.parse_dates(df, [fv.BIRTH_COLUMN])
    df = df.withColumn("_obs", year_start(F.col(fv.YEAR_COLUMN)))
    aged = cleaning.add_age(df, fv.BIRTH_COLUMN, "_obs", None, "AGE")
    middle = exact_quantile(aged, "AGE").scalar()
    df = aged.withColumn("AGE", F.coalesce(F.col("AGE"), middle)).drop("_obs")
    df = cleaning.coerce_prefixed(df, [fv.FLAG_PREFIX])
    df = df.withColumns({c: safe_numeric(c) for c in df.columns if any(m in c for m in fv.COST_MARKS)})
    return df if label is None else df.join(label, keys, "left").withColumn(
        fv.TARGET_COLUMN, F.coalesce(F.col(fv.TARGET_COLUMN), F.lit(0)))

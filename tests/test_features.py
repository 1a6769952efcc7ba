"""The two builds on claim-shaped tables with the fixed column names."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from leadtime import fixed_values as fv
from leadtime.plans import risk_features as rf


@pytest.fixture(scope="module")
def entities(spark):
    rows = [("A1", 2008, 1, 1, 1, 2, 100.0, 70.0, 1), ("A1", 2009, 1, 1, 2, 2, 50.0, 71.0, 0), ("B2", 2008, 2, 5, 2, 1, 10.0, None, 0),
            ("Z9", 2010, 2, 3, 2, 2, 0.0, 90.0, 0)]
    return spark.createDataFrame(rows, "DESYNPUF_ID string, ANNEE int, BENE_SEX_IDENT_CD int, BENE_RACE_CD int, SP_CHF int, "
                                       "SP_CHRNKIDN int, MEDREIMB_IP double, AGE double, HOSPITALIZED_IN_6M int")


@pytest.fixture(scope="module")
def sources(spark):
    def at(*rows):
        return [(i, datetime.fromisoformat(d), a) for i, d, a in rows]

    ip = spark.createDataFrame(at(("A1", "2007-12-15", 10.0), ("A1", "2008-07-01", 5.0), ("B2", "2008-01-01", 7.0)),
                               "DESYNPUF_ID string, CLM_ADMSN_DT timestamp, CLM_PMT_AMT double")
    op = spark.createDataFrame(at(("A1", "2007-03-01", 1.0), ("A1", "2007-11-01", 2.0)), "DESYNPUF_ID string, CLM_FROM_DT timestamp, CLM_PMT_AMT double")
    car = spark.createDataFrame(at(("B2", "2007-09-01", 4.0)), "DESYNPUF_ID string, CLM_FROM_DT timestamp, x double")
    rx = spark.createDataFrame([("A1", datetime(2007, 6, d), f"c{d % 7}") for d in range(1, 20)],
                               "DESYNPUF_ID string, SRVC_DT timestamp, PROD_SRVC_ID string")
    return rf.claim_sources({"inpatient": ip, "outpatient": op, "carrier": car, "prescription": rx})


def test_full_build(entities, sources):
    got = {(r["DESYNPUF_ID"], r["ANNEE"]): r for r in rf.full_features(entities, sources, [2008, 2009, 2010]).collect()}
    a, b, z = got["A1", 2008], got["B2", 2008], got["Z9", 2010]
    assert (a["NB_HOSP_PASSEES"], a["NB_HOSP_3M"], a["DAYS_SINCE_LAST_HOSP"], a["COUT_HOSP_PASSE"]) == (1, 1, 17, 10.0)
    assert (a["NB_OP_3M"], a["NB_OP_6M"], a["NB_OP_12M"], a["COUT_OP_PASSE"]) == (1, 1, 2, 3.0)
    assert (a["NB_PRESCRIPTIONS"], a["NB_MOLECULES_UNIQUES"], a["POLYPHARMACIE"]) == (19, 7, 1)
    assert (a["UTILISATION_12M"], a["RATIO_RX_OP_12M"]) == (22, pytest.approx(19 / 3))
    assert (a["COUT_BENEFICIARY_ANNUEL"], a["COUT_TOTAL"], a["HAS_HOSP_HISTORY"], a["IS_NEW_PATIENT"]) == (100.0, 113.0, 1, 0)
    assert got["A1", 2009]["NB_HOSP_PASSEES"] == 2 and got["A1", 2009]["NB_HOSP_6M"] == 1
    assert (b["NB_HOSP_PASSEES"], b["NB_CAR_6M"], b["COUT_CAR_PASSE"]) == (0, 1, 0.0)  # admitted on the day itself; no amount
    assert (b["AGE"], b["GROUPE_AGE"]) == (71.0, "65-74") and z["GROUPE_AGE"] == "85+"
    assert z["IS_NEW_PATIENT"] == 1 and z["NB_COMORBIDITES"] == 2  # code 2 is clipped to 1 in this build
    assert len(got) == 4


def test_reduced_build_and_split(entities, sources):
    df = rf.reduced_features(entities, sources, [2008, 2009, 2010])
    got = {(r["DESYNPUF_ID"], r["ANNEE"]): r for r in df.collect()}
    assert got["A1", 2008]["NB_COMORBIDITES"] == 1 and got["Z9", 2010]["NB_COMORBIDITES"] == 0  # only code 1 counts here
    assert got["B2", 2008]["CHARLSON_INDEX"] == 2 and got["B2", 2008]["AGE"] == 0.0
    table, params = rf.split_and_scale(df)
    rows = {(r["DESYNPUF_ID"], r["ANNEE"]): r for r in table.collect()}
    assert {k[1]: r["split"] for k, r in rows.items()} == {2008: "train", 2009: "val", 2010: "test"}
    p = params.first()["COUT_TOTAL"]
    assert (p["mean"], p["std"]) == (55.0, 45.0)  # the two training rows only
    assert rows["A1", 2008]["COUT_TOTAL"] == 1.0 and rows["A1", 2009]["COUT_TOTAL"] == pytest.approx(-5 / 45)
    everything = rf.split_and_scale(df, fit_on="all")[1].first()["COUT_TOTAL"]["mean"]
    assert everything == 40.0


def test_renal_flag_forms(spark, entities):
    base = entities.drop("AGE")
    for values, want in ((["Y", "0", None, "Y"], [1, 0, 0, 1]),):
        rows = spark.createDataFrame([(r["DESYNPUF_ID"], r["ANNEE"], v, 0) for r, v in zip(base.collect(), values)],
                                     "DESYNPUF_ID string, ANNEE int, BENE_ESRD_IND string, HOSPITALIZED_IN_6M int")
        got = rf.prepare_entities(rows).select("BENE_ESRD_IND").collect()
        assert [r[0] for r in got] == want


def test_feature_list_is_whole():
    assert len(fv.MODEL_FEATURES) == 28 and len(rf.FULL_FEATURES) == 24
    assert len(fv.REQUEST_FIELDS) == 29 and len(fv.SWEEP_THRESHOLDS) == 23


def test_fingerprint_tells_shifted_values_apart(spark):
    from leadtime.operators.profile import fingerprint

    def of(*row):
        return fingerprint(spark.createDataFrame([row], "x string, y string"), ["x", "y"]).first()["hash_sum"]

    assert len({of("a|b", "c"), of("a", "b|c"), of("~", None), of(None, "~"), of("", "")}) == 5

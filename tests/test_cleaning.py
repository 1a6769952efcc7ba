from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from leadtime.functions.dates import in_forward, in_lookback, parse_yyyymmdd, whole_days
from leadtime.functions.flags import clip_flag, code_flag, map_codes
from leadtime.functions.numeric import clip, right_closed_bin, right_closed_ordinal, safe_numeric
from leadtime.operators import cleaning as op
from leadtime.plans.risk_features import clean_entities


def values(df, column):
    return [r[column] for r in df.collect()]


@pytest.mark.parametrize("raw, day", [
    ("20100312", date(2010, 3, 12)), ("20100312.0", date(2010, 3, 12)), ("not_a_date", None), ("", None), ("nan", None),
    (None, None), ("20101399", None), ("2010", None)])
def test_text_dates(spark, raw, day):
    df = spark.createDataFrame([(raw,)], "v string")
    assert values(df.select(parse_yyyymmdd(F.col("v")).alias("d")), "d") == [day]


def test_number_dates(spark):
    df = spark.createDataFrame([(20100312.0,), (float("nan"),), (None,)], "v double")
    assert values(df.select(parse_yyyymmdd(F.col("v"), "double").alias("d")), "d") == [date(2010, 3, 12), None, None]
    df = spark.createDataFrame([(19230501,)], "v int")
    assert values(df.select(parse_yyyymmdd(F.col("v"), "int").alias("d")), "d") == [date(1923, 5, 1)]


def test_only_marked_columns_are_parsed(spark):
    df = op.parse_dates(spark.createDataFrame([("20080101", "20080101")], "A_DT string, B string"), mark="DT")
    assert dict(df.dtypes) == {"A_DT": "date", "B": "string"}


def test_keep_first_same_key_different_years(spark):
    rows = [("X1", 2008, 1), ("X1", 2009, 2), ("X1", 2010, 3), ("Y2", 2008, 4), ("Y2", 2009, 5)]
    df = spark.createDataFrame(rows, "id string, year int, v int")
    assert op.keep_first(df, ["id", "year"], ["v"]).count() == 5
    assert op.keep_first(df.union(df), ["id", "year"], ["v"]).count() == 5


def test_keep_first_takes_the_smallest(spark):
    df = spark.createDataFrame([("a", 3, "z"), ("a", 1, "y"), ("b", 2, None)], "id string, o int, v string")
    got = {r["id"]: (r["o"], r["v"]) for r in op.keep_first(df, ["id"], ["o"]).collect()}
    assert got == {"a": (1, "y"), "b": (2, None)}


def test_code_map_and_flags(spark):
    df = spark.createDataFrame([("Y",), ("0",), (None,), ("x",)], "v string")
    assert values(df.select(map_codes(F.col("v"), {"Y": 1, "0": 0}).alias("f")), "f") == [1, 0, 0, 0]
    df = spark.createDataFrame([(1,), (2,), (0,), (None,)], "v int")
    got = df.select(code_flag(F.col("v")).alias("a"), clip_flag(F.col("v")).alias("b")).collect()
    assert [(r["a"], r["b"]) for r in got] == [(1, 1), (0, 1), (0, 0), (0, 0)]


def test_windows_at_their_borders(spark):
    df = spark.createDataFrame([(d,) for d in (
        date(2007, 7, 1), date(2007, 6, 30), date(2007, 12, 31), date(2008, 1, 1), date(2008, 1, 2), date(2008, 7, 1),
        date(2008, 7, 2))] + [(None,)], "d date")
    obs = F.lit("2008-01-01").cast("date")
    got = df.select(in_lookback(F.col("d"), obs, 6).alias("back"), in_forward(F.col("d"), obs, 6).alias("ahead")).collect()
    assert [r["back"] for r in got] == [True, False, True, False, False, False, False, None]
    assert [r["ahead"] for r in got] == [False, False, False, False, True, True, False, None]


def test_whole_days_floor(spark):
    df = spark.sql("select timestamp'2007-12-31 12:00:00' a, timestamp'2007-12-30 23:59:59' b, date'2008-01-01' o")
    r = df.select(whole_days(F.col("a"), F.col("o")).alias("a"), whole_days(F.col("b"), F.col("o")).alias("b")).first()
    assert (r["a"], r["b"]) == (0, 1)


def test_safe_numeric_both_forms(spark):
    df = spark.createDataFrame([("1.5",), ("abc",), ("inf",), ("-inf",), ("nan",), (None,)], "v string")
    assert values(df.select(safe_numeric(F.col("v"), 7).alias("n")), "n") == [1.5, 7, 7, 7, 7, 7]
    assert values(df.select(safe_numeric("v", 7).alias("n")), "n") == [1.5, 7, 7, 7, 7, 7]
    assert values(df.select(safe_numeric("v", None).alias("n")), "n") == [1.5, None, None, None, None, None]


def test_right_closed_bins(spark):
    df = spark.createDataFrame([(x,) for x in (0.0, 65.0, 65.1, 75.0, 85.0, 120.0, -1.0, 121.0)] + [(None,)], "x double")
    edges, labels = [0, 65, 75, 85, 120], ["a", "b", "c", "d"]
    got = df.select(right_closed_bin(F.col("x"), edges, labels).alias("l"), right_closed_ordinal(F.col("x"), edges).alias("o")).collect()
    assert [r["l"] for r in got] == ["a", "a", "b", "b", "c", "d", None, None, None]
    assert [r["o"] for r in got] == [0, 0, 1, 1, 2, 3, 1, 1, 1]


def test_clip_keeps_null(spark):
    df = spark.createDataFrame([(-5.0,), (5.0,), (500.0,), (None,)], "x double")
    assert values(df.select(clip(F.col("x"), 0.0, 120.0).alias("c")), "c") == [0.0, 5.0, 120.0, None]


def test_sample_is_exact_and_repeatable(spark):
    df = spark.range(20000).withColumnRenamed("id", "k")
    a = set(values(op.seeded_sample(df, 700, ["k"]), "k"))
    b = set(values(op.seeded_sample(df.repartition(13), 700, ["k"]), "k"))
    assert len(a) == 700 and a == b
    assert a != set(values(op.seeded_sample(df, 700, ["k"], seed=7), "k"))
    assert op.seeded_sample(df.limit(10), 700, ["k"]).count() == 10
    assert op.seeded_sample(df.limit(0), 5, ["k"]).count() == 0


def test_required_tables_and_columns(spark):
    df = spark.createDataFrame([(1,)], "a int")
    op.require_tables({"t": df}, {"t": ["a"]})
    with pytest.raises(ValueError, match="u: missing table"):
        op.require_tables({"t": df}, {"t": ["a", "b"], "u": ["c"]})
    with pytest.raises(ValueError, match="lacks"):
        op.normalise_key(df, "id")
    with pytest.raises(ValueError, match="none of the date columns"):
        op.event_date(df, ["x", "y"], "e")


def test_pair_by_key_shows_mismatch(spark):
    x = spark.createDataFrame([(1, 0.5), (2, 0.7)], "id int, f double")
    y = spark.createDataFrame([(1, 1), (3, 0)], "id int, y int")
    assert sorted(values(op.pair_by_key(x, y, ["id"]), "matched")) == [False, False, True]


def test_clean_entities(spark):
    rows = [("A", 2008, 19400615, 1, 2, "1", 100.5, 9.0), ("A", 2008, 19400615, 1, 2, "1", 100.5, 9.0),
            ("B", 2008, None, 2, 1, "2", None, 9.0), ("C", 2009, 19500101, 2, 3, "x", 7.0, 9.0)]
    schema = ("DESYNPUF_ID string, ANNEE int, BENE_BIRTH_DT int, BENE_SEX_IDENT_CD int, BENE_RACE_CD int, SP_CHF string, "
              "MEDREIMB_IP double, OTHER double")
    got = {r["DESYNPUF_ID"]: r for r in clean_entities(spark.createDataFrame(rows, schema)).collect()}
    assert set(got) == {"A", "B", "C"} and "OTHER" not in got["A"].asDict()
    assert got["A"]["AGE"] == pytest.approx((date(2008, 1, 1) - date(1940, 6, 15)).days / 365.25)
    assert got["B"]["AGE"] == pytest.approx((got["A"]["AGE"] + got["C"]["AGE"]) / 2)
    assert got["C"]["SP_CHF"] == 0.0 and got["B"]["MEDREIMB_IP"] == 0.0

from __future__ import annotations

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from leadtime.operators import point_in_time as pit

OBS = [date(2008, 1, 1), date(2009, 1, 1)]


def months_before(d, n):
    y, m = divmod(d.year * 12 + d.month - 1 - n, 12)
    return datetime(y, m + 1, 1)


@pytest.fixture(scope="module")
def events():
    """One entity holds more than a third of all events."""
    rng = random.Random(5)
    rows = []
    for i in range(3000):
        who = "hot" if rng.random() < 0.4 else f"e{rng.randrange(40)}"
        ts = datetime(2006, 6, 1) + timedelta(minutes=rng.randrange(4 * 365 * 1440))
        rows.append((who, None if i % 97 == 0 else ts, round(rng.uniform(1, 50), 2), rng.choice(["a", "b", "c", None]), i % 3))
    return rows


@pytest.fixture(scope="module")
def frame(spark, events):
    return spark.createDataFrame(events, "id string, ts timestamp, amt double, code string, kind int")


@pytest.fixture(scope="module")
def cohort(spark, events):
    ids = sorted({r[0] for r in events}) + ["nobody"]
    return pit.cohort_on(spark.createDataFrame([(i,) for i in ids], "id string"), "id", OBS)


def brute(events, who, day):
    obs = datetime(day.year, day.month, day.day)
    mine = [r for r in events if r[0] == who and r[1] is not None]
    past = [r for r in mine if r[1] < obs]
    two = [r for r in past if r[4] != 0]
    ahead = [r for r in mine if obs < r[1] <= months_before(day, -6)]
    return dict(n=len(past), n3=sum(r[1] >= months_before(day, 3) for r in past),
                n12=sum(r[1] >= months_before(day, 12) for r in two), amt=round(sum(r[2] for r in past), 2),
                codes=len({r[3] for r in past if r[3]}), days=(obs - max(r[1] for r in past)).days if past else 0,
                y=int(bool(ahead)), ny=len(ahead))


FEATURES = [pit.count_before("all", "n"), pit.count_trailing("all", 3, "n3"), pit.count_trailing("some", 12, "n12"),
            pit.sum_before("all", "amt"), pit.distinct_before("all", "codes"), pit.days_since_last("all", "days")]


def sources(frame):
    return [pit.Source("all", frame, "id", "ts", "amt", "code"),
            pit.Source("some", frame, "id", "ts", "amt", "code", where=F.col("kind") != 0)]


def test_against_brute_force_with_a_hot_entity(frame, cohort, events):
    wanted = [*FEATURES, pit.event_ahead("all", 6, "y"), pit.count_ahead("all", 6, "ny")]
    got = pit.point_in_time(cohort, sources(frame), wanted, OBS, "id").withColumn("amt", F.round("amt", 2)).collect()
    assert len(got) == cohort.count()
    for r in got:
        assert {k: r[k] for k in ("n", "n3", "n12", "amt", "codes", "days", "y", "ny")} == brute(events, r["id"], r["obs_date"])


def test_own_date_per_entity_gives_the_same(frame, cohort):
    a = pit.point_in_time(cohort, sources(frame), FEATURES, OBS, "id").withColumn("amt", F.round("amt", 2))
    b = pit.point_in_time_any_dates(cohort, sources(frame), FEATURES, "id").withColumn("amt", F.round("amt", 2))
    assert a.exceptAll(b.select(a.columns)).count() == 0 and a.count() == b.count()


def test_later_events_change_no_feature(frame, cohort):
    early = pit.point_in_time(cohort, sources(frame), FEATURES, OBS, "id").where(F.col("obs_date") == F.lit(OBS[0]))
    cut = frame.where(F.col("ts") < F.lit(OBS[0]))
    again = pit.point_in_time(cohort, sources(cut), FEATURES, OBS, "id").where(F.col("obs_date") == F.lit(OBS[0]))
    assert early.withColumn("amt", F.round("amt", 2)).exceptAll(again.withColumn("amt", F.round("amt", 2))).count() == 0


@pytest.mark.parametrize("who, day, label", [
    ("SAME_DAY", "2008-01-01", 0), ("FUTURE", "2008-01-02", 1), ("BEFORE", "2007-12-31", 0), ("BEYOND", "2008-07-02", 0),
    ("END", "2008-07-01", 1), ("NONE", None, 0)])
def test_label_borders(spark, who, day, label):
    e = spark.createDataFrame([(who, day)], "id string, d string").withColumn("ts", F.col("d").cast("timestamp"))
    c = pit.cohort_on(e, "id", OBS[:1])
    assert pit.forward_label(c, e, "id", "ts", OBS[:1], 6).first()["label"] == label


def test_label_code_filter_and_empty_events(spark):
    e = spark.createDataFrame([("A", "2008-02-01", 1), ("B", "2008-02-01", 3)], "id string, d string, type int")
    e = e.withColumn("ts", F.col("d").cast("timestamp"))
    c = pit.cohort_on(e, "id", OBS[:1])

    def labels(events, codes):
        return {r["id"]: r["label"] for r in pit.forward_label(c, events, "id", "ts", OBS[:1], 6, codes=codes).collect()}

    assert labels(e, ("type", [1, 2])) == {"A": 1, "B": 0}
    assert labels(e.drop("type"), ("type", [1, 2])) == {"A": 1, "B": 1}
    assert labels(e.limit(0), ("type", [1, 2])) == {"A": 0, "B": 0}


def test_month_end_window(spark):
    e = spark.createDataFrame([("A", "2009-02-28"), ("B", "2009-03-01")], "id string, d string")
    e = e.withColumn("ts", F.col("d").cast("timestamp"))
    obs = [date(2008, 8, 31)]
    got = pit.forward_label(pit.cohort_on(e, "id", obs), e, "id", "ts", obs, 6).collect()
    assert {r["id"]: r["label"] for r in got} == {"A": 1, "B": 0}


def test_latest_and_history(frame, cohort, events):
    last = {(r["id"], r["obs_date"]): r["ts"] for r in pit.latest_before(frame, "id", "ts", ["amt"], OBS).collect()}
    for (who, day), ts in last.items():
        obs = datetime(day.year, day.month, day.day)
        assert ts == max(r[1] for r in events if r[0] == who and r[1] and r[1] < obs)
    new = {(r["id"], r["obs_date"]) for r in pit.without_history(cohort, frame, "id", "ts", OBS).collect()}
    assert new == {(r["id"], r["obs_date"]) for r in cohort.collect()} - set(last)


def test_rolling_counts_brute(frame, events):
    got = {(r["id"], r["ts"]): r["n"] for r in pit.rolling_counts(frame, "id", "ts", 30, "n").collect()}
    for (who, ts), n in list(got.items())[::25]:
        assert n == sum(r[0] == who and r[1] is not None and ts - timedelta(days=30) <= r[1] < ts for r in events)


def test_one_scan_for_shared_sources_and_pushed_bounds(spark, tmp_path, frame, cohort):
    path = str(tmp_path / "e")
    frame.write.parquet(path)
    stored = spark.read.parquet(path)
    wanted = [pit.count_trailing("all", 3, "n3"), pit.count_trailing("some", 12, "n12")]
    plan = pit.entity_features(sources(stored), wanted, OBS, "id")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "GreaterThanOrEqual(ts" in plan and "LessThan(ts" in plan
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "Python" not in plan


def test_unknown_source_and_missing_amount(frame):
    with pytest.raises(ValueError, match="unknown sources"):
        pit.entity_features(sources(frame), [pit.count_before("zz", "n")], OBS, "id")
    with pytest.raises(ValueError, match="amount"):
        pit.entity_features([pit.Source("s", frame, "id", "ts")], [pit.sum_before("s", "x")], OBS, "id")


def test_rolling_counts_below_a_second(spark):
    at = datetime(2020, 1, 1, 12, 0, 0)
    moments = [at, at + timedelta(milliseconds=500), at + timedelta(days=1), at + timedelta(days=1, milliseconds=500, microseconds=1)]
    df = spark.createDataFrame([("a", t) for t in moments], "id string, ts timestamp")
    got = {r["ts"]: r["n"] for r in pit.rolling_counts(df, "id", "ts", 1, "n").collect()}
    assert [got[t] for t in moments] == [0, 1, 2, 1]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_every_table_is_read_once(spark):
    from leadtime.plans import risk_features as rf
    from leadtime.plans.bindings import KEY, OBS_DATES, Tables

    t = Tables(spark, "/root/testdata/sf0.001")
    plan = plan_of(pit.entity_features(t.sources, rf.FULL_FEATURES, OBS_DATES, KEY))
    scans = [line for line in plan.split("\n") if "FileScan" in line or "Scan parquet" in line]
    assert sum("l_shipdate" in s for s in scans) == 1 and sum("o_orderdate" in s or "o_totalprice" in s for s in scans) == 1
    assert "Window" not in plan and "collect" not in plan


def test_segments_hold_for_any_dates_and_month_ends(spark, frame, events):
    dates = [date(2008, 2, 29), date(2008, 3, 31), date(2008, 8, 31), date(2007, 5, 1), date(2009, 3, 30)]
    ids = sorted({r[0] for r in events})[:9] + ["hot"]
    few = pit.cohort_on(spark.createDataFrame([(i,) for i in ids], "id string"), "id", dates)
    wanted = [pit.count_trailing("all", m, f"back{m}") for m in (1, 6)] + [pit.count_ahead("all", m, f"next{m}") for m in (1, 6)] + [pit.event_ahead("some", 1, "any")]
    lattice = pit.Lattice(dates, wanted)
    assert lattice.borders == sorted(set(lattice.borders)) and not lattice.past
    for r in pit.point_in_time(few, sources(frame), wanted, dates, "id").collect():
        obs = datetime.combine(r.obs_date, datetime.min.time())
        mine = [(ts, kind) for who, ts, _, _, kind in events if who == r.id and ts is not None]
        for m in (1, 6):
            first, last = (datetime.combine(pit._shifted(r.obs_date, k), datetime.min.time()) for k in (-m, m))
            assert (r[f"back{m}"], r[f"next{m}"]) == (sum(first <= ts < obs for ts, _ in mine), sum(obs < ts <= last for ts, _ in mine))
        assert r["any"] == int(any(obs < ts <= datetime.combine(pit._shifted(r.obs_date, 1), datetime.min.time()) and kind for ts, kind in mine))


def test_moments_on_a_border_and_codes_of_several_sources(spark):
    at = [datetime(2008, 1, 1), datetime(2008, 1, 1, 0, 0, 0, 1), datetime(2007, 12, 31, 23, 59, 59, 999999), datetime(2007, 10, 1), datetime(2007, 9, 30, 23, 59, 59),
          datetime(2008, 7, 1), datetime(2008, 7, 1, 0, 0, 0, 1), None]
    rows = [("a", t, f"c{i % 2}", i, float(i)) for i, t in enumerate(at)]
    df = spark.createDataFrame(rows, "id string, ts timestamp, code string, other int, amt double")
    two = [pit.Source("x", df, "id", "ts", "amt", "code"), pit.Source("y", df, "id", "ts", "amt", "other", where=F.col("other") > 2)]
    wanted = [pit.count_before("x", "n"), pit.count_trailing("x", 3, "n3"), pit.count_ahead("x", 6, "ahead"), pit.distinct_before("x", "codes"),
              pit.distinct_before("y", "others"), pit.sum_before("y", "amt")]
    cohort = spark.createDataFrame([("a", date(2008, 1, 1)), ("b", date(2008, 1, 1))], "id string, obs_date date")
    got = {r.id: (r.n, r.n3, r["ahead"], r.codes, r.others, r.amt) for r in pit.point_in_time(cohort, two, wanted, [date(2008, 1, 1)], "id").collect()}
    assert got == {"a": (3, 2, 2, 2, 2, 7.0), "b": (0, 0, 0, 0, 0, 0.0)}


@pytest.mark.parametrize("slice_days", [1, 30, 10_000])
def test_own_dates_with_labels_against_brute_force(spark, frame, events, slice_days):
    rng = random.Random(3)
    ids = sorted({r[0] for r in events})[:12] + ["hot", "nobody"]
    pairs = [(i, date(2006, 1, 1) + timedelta(rng.randrange(1800))) for i in ids for _ in range(5)] + [("hot", date(2008, 2, 29)), ("hot", None)]
    cohort = spark.createDataFrame(pairs, "id string, obs_date date")
    wanted = [*FEATURES, pit.event_ahead("all", 6, "y"), pit.count_ahead("all", 6, "ny"), pit.count_ahead("some", 1, "soon")]
    got = pit.point_in_time_any_dates(cohort, sources(frame), wanted, "id", slice_days=slice_days).withColumn("amt", F.round("amt", 2)).collect()
    assert len(got) == len(pairs)
    for r in got:
        if r.obs_date is None:
            assert (r.n, r.y) == (0, 0)
            continue
        back, d = {}, r.obs_date
        mine = [e for e in events if e[0] == r.id and e[1] is not None]
        obs, at = datetime(d.year, d.month, d.day), lambda m: datetime.combine(pit._shifted(d, m), datetime.min.time())
        past = [e for e in mine if e[1] < obs]
        back = dict(n=len(past), n3=sum(e[1] >= at(-3) for e in past), n12=sum(e[1] >= at(-12) and e[4] != 0 for e in past), amt=round(sum(e[2] for e in past), 2),
                    codes=len({e[3] for e in past if e[3]}), days=(obs - max(e[1] for e in past)).days if past else 0,
                    ny=sum(obs < e[1] <= at(6) for e in mine), soon=sum(obs < e[1] <= at(1) and e[4] != 0 for e in mine))
        back["y"] = int(back["ny"] > 0)
        assert {k: r[k] for k in back} == back


def test_own_dates_read_a_table_once_and_split_a_hot_entity(spark, tmp_path):
    rows = [("hot" if i % 3 else f"e{i % 50}", datetime(2000, 1, 1) + timedelta(hours=5 * i), f"c{i % 11}") for i in range(6000)]
    spark.createDataFrame(rows, "id string, ts timestamp, code string").write.parquet(str(tmp_path / "e"))
    df = spark.read.parquet(str(tmp_path / "e"))
    cohort = spark.createDataFrame([("hot", date(2001, 5, 5)), ("e1", date(2002, 5, 5))], "id string, obs_date date")
    out = pit.point_in_time_any_dates(cohort, [pit.Source("x", df, "id", "ts", code="code")],
                                      [pit.count_before("x", "n"), pit.distinct_before("x", "codes"), pit.event_ahead("x", 1, "y")], "id")
    out.collect()
    from test_evaluation import ran

    plan = ran(out)
    assert sum("FileScan" in line for line in plan.split("\n")) == 1 and "ReusedExchange" in plan
    spread = [line for line in plan.split("\n") if "Window [" in line and "_turn" in line]
    assert spread and all("_slice" in line.split("ASC")[0] for line in spread)


def test_own_dates_shuffle_events_by_code_and_slice_only(spark, frame, cohort):
    out = pit.point_in_time_any_dates(cohort, sources(frame), FEATURES, "id")
    out.collect()
    from test_evaluation import ran

    shuffles = [line for line in ran(out).split("\n") if "Exchange hashpartitioning(" in line and "Reused" not in line]
    assert sum("_slice#" in line for line in shuffles) <= 2  # events with probes, and the few slices that are asked for
    assert not [line for line in shuffles if "_segment#" in line.split("),")[0]]


@pytest.mark.parametrize("kind", ["date", "timestamp"])
def test_own_dates_find_the_last_event_of_a_source_that_is_not_counted(spark, kind):
    days = [("a", "2008-01-01", 1), ("a", "2008-03-01", 0), ("a", "2008-03-05", 1), ("b", "2008-03-04", 0), (None, "2008-03-01", 1)]
    df = spark.createDataFrame(days, "id string, d string, kind int").withColumn("day", F.col("d").cast(kind))
    cohort = spark.createDataFrame([("a", date(2008, 3, 5)), ("a", date(2008, 3, 6)), ("b", date(2008, 3, 5)), (None, date(2008, 3, 5))], "id string, obs_date date")
    some = pit.Source("x", df, "id", "day", where=F.col("kind") == 1)
    got = pit.point_in_time_any_dates(cohort, [some], [pit.days_since_last("x", "days")], "id").collect()
    assert {(r.id, r.obs_date.day): r.days for r in got} == {("a", 5): 64, ("a", 6): 1, ("b", 5): 0, (None, 5): 0}

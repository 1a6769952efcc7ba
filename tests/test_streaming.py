from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from leadtime.fixed_values import LATENCY_BOUNDS
from leadtime.streaming import monitors as mon
from leadtime.streaming.keyed import KeyedTable
from leadtime.streaming.runner import append_result, complete_result, read_stream, run_aggregate, run_closed

SCHEMA = "ts timestamp, endpoint string, status int, latency double"


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("events") / "data")
    start = datetime(2024, 1, 1)
    rows = [(start + timedelta(seconds=17 * i), "ab"[i % 2], 500 if i % 10 == 0 else 200, (i % 40) / 100) for i in range(600)]
    spark.createDataFrame(rows, SCHEMA).repartition(5).write.parquet(path)
    return path


def test_stream_equals_batch_over_several_files(spark, stored):
    batch = spark.read.parquet(stored)
    stream = read_stream(spark, stored, batch.schema, files_per_batch=1)
    for job in (lambda d: mon.request_rate(d, "ts", ["endpoint"]),
                lambda d: mon.latency_quantiles(d, "ts", "latency", length="10 minutes"),
                lambda d: mon.error_rate(d, "ts", "status", length="5 minutes", slide="1 minute")):
        a, b = job(mon.timed(batch, "ts")), complete_result(job(mon.timed(stream, "ts")))
        assert a.count() == b.count() and a.exceptAll(b.select(a.columns)).count() == 0


def test_append_mode_emits_closed_windows_only(spark, stored, tmp_path):
    batch = spark.read.parquet(stored)
    stream = mon.timed(read_stream(spark, stored, batch.schema), "ts", "30 minutes")
    run_aggregate(mon.request_rate(stream, "ts", [], "1 hour"), str(tmp_path / "o"), str(tmp_path / "c"), "append")
    assert spark.read.parquet(str(tmp_path / "o")).count() < batch.select(F.window("ts", "1 hour")).distinct().count()


def test_append_sink_keeps_every_row(spark, stored):
    batch = spark.read.parquet(stored)
    out = append_result(read_stream(spark, stored, batch.schema, 2).withColumn("double", F.col("latency") * 2))
    assert out.count() == 600


def test_bucket_quantile(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 1), x) for x in [0.003] * 50 + [0.02] * 40 + [99.0] * 10], "ts timestamp, latency double")
    r = mon.latency_quantiles(df, "ts", "latency", (0.25, 0.7, 0.99)).first()
    assert r["p25_ms"] == pytest.approx(2.5)  # half of the first bucket 0..5 ms
    assert r["p70_ms"] == pytest.approx(10 + 15 * 20 / 40)  # 20 of 40 rows into 10..25 ms
    assert r["p99_ms"] == LATENCY_BOUNDS[-1] * 1000


def test_gauge_and_totals(spark):
    t = datetime(2024, 1, 1)
    df = spark.createDataFrame([(t, "v1", 200, 0.1), (t + timedelta(1), "v1", 500, 0.4), (t, "v2", 200, 0.9)], SCHEMA)
    assert {r["endpoint"]: r["value"] for r in mon.latest_gauge(df, "ts", ["endpoint"], "latency").collect()} == {"v1": 0.4, "v2": 0.9}
    assert {r["endpoint"]: (r["n_requests"], r["n_errors"]) for r in mon.running_totals(df, ["endpoint"], "status").collect()} == {"v1": (2, 1), "v2": (1, 0)}


def arrive(spark, path, batches):
    """One file per batch, in this order."""
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(f"{path}/n{i}")
    return read_stream(spark, f"{path}/n*", spark.createDataFrame([], SCHEMA).schema, files_per_batch=1)


def test_state_of_closed_windows_stays_bounded_and_late_rows_are_dropped(spark, tmp_path):
    start = datetime(2024, 1, 1)
    batches = [[(start + timedelta(minutes=30 * b, seconds=20 * i), "ab"[i % 2], 200, 0.1) for i in range(90)] for b in range(8)]
    batches.append([(start, "late", 500, 9.9), (start + timedelta(hours=4), "a", 200, 0.1)])
    stream = mon.timed(arrive(spark, str(tmp_path / "in"), batches), "ts", "10 minutes")
    progress = run_closed(mon.request_rate(stream, "ts", ["endpoint"]), str(tmp_path / "o"), str(tmp_path / "c"))
    with_rows = [p for p in progress if p["n_input"]]
    assert len(with_rows) == 9 and sum(p["n_late"] for p in progress) == 1
    # a batch spans 30 minutes and the delay 10: two labels for at most 40 open windows, after eight batches as after one
    assert max(p["n_state"] for p in progress) <= 2 * (30 + 10 + 2) and progress[-1]["n_state"] <= 2 * 12
    out = spark.read.parquet(str(tmp_path / "o"))
    rows = [r for b in batches for r in b if r[1] != "late"]
    closed = start + timedelta(hours=4) - timedelta(minutes=10)
    want = {}
    for ts, endpoint, _, _ in rows:
        w = ts.replace(second=0)
        if w + timedelta(minutes=1) <= closed:
            want[w, endpoint] = want.get((w, endpoint), 0) + 1
    got = [((r.window_start, r.endpoint), r.n) for r in out.collect()]
    assert len(got) == len(want) and dict(got) == want


def test_a_restarted_job_goes_on_and_writes_no_window_twice(spark, tmp_path):
    start = datetime(2024, 1, 1)
    rows = lambda b: [(start + timedelta(hours=b, minutes=i), "a", 200, 0.1) for i in range(60)]
    for b in range(3):
        stream = mon.timed(arrive(spark, str(tmp_path / "in" / str(b)), [rows(b)]), "ts", "10 minutes")
        stream = mon.timed(read_stream(spark, f"{tmp_path}/in/*/n0", spark.createDataFrame([], SCHEMA).schema), "ts", "10 minutes")
        run_closed(mon.request_rate(stream, "ts", [], "10 minutes"), str(tmp_path / "o"), str(tmp_path / "c"))
    got = sorted((r.window_start, r.n) for r in spark.read.parquet(str(tmp_path / "o")).collect())
    assert got == [(start + timedelta(minutes=10 * i), 10) for i in range(16)]  # the newest event is at 2:59, so all until 2:40 is closed


def test_panes_add_up_to_sliding_windows(spark, stored):
    batch = mon.timed(spark.read.parquet(stored), "ts")
    for length, slide in (("10 minutes", "2 minutes"), ("3 minutes", "1 minute"), ("5 minutes", "5 minutes")):
        got = mon.sliding_rates(batch, "ts", ["endpoint"], "status", length, slide).select("window_start", "endpoint", "n", "n_errors")
        want = batch.groupBy(F.window("ts", length, slide), "endpoint").agg(F.count("*").alias("n"), F.count(F.when(F.col("status") >= 500, 1)).alias("e"))
        want = want.select("window.start", "endpoint", "n", "e")
        assert got.count() == want.count() and got.exceptAll(want).count() == 0
    with pytest.raises(ValueError):
        mon.sliding_rates(batch, "ts", length="5 minutes", slide="2 minutes")


def test_sliding_windows_of_a_stream_hold_panes_not_copies(spark, stored, tmp_path):
    batch = mon.timed(spark.read.parquet(stored), "ts")
    stream = mon.timed(read_stream(spark, stored, spark.read.parquet(stored).schema), "ts", "10 minutes")
    job = mon.sliding_rates(stream, "ts", [], "status", "20 minutes", "1 minute")
    progress = run_closed(job, str(tmp_path / "o"), str(tmp_path / "c"))
    panes = batch.select(F.window("ts", "1 minute")).distinct().count()
    assert max(p["n_state"] for p in progress if p["n_input"]) == panes  # a copy of each event would be twenty times as many keys
    want = mon.closed_windows(mon.sliding_rates(batch, "ts", [], "status", "20 minutes", "1 minute"), batch, "ts", "20 minutes", "10 minutes")
    got = spark.read.parquet(str(tmp_path / "o"))
    assert got.count() == want.count() > 100 and got.exceptAll(want).count() == 0


def keyed(spark, folder, buckets=3):
    return KeyedTable(spark, folder, ["endpoint"], lambda d: mon.running_totals(d, ["endpoint"], "status"), lambda d: mon.fold_totals(d, ["endpoint"]), buckets)


def test_keyed_table_counts_every_batch_once(spark, tmp_path, monkeypatch):
    t = datetime(2024, 1, 1)
    batches = [spark.createDataFrame([(t, f"e{i % k}", 500 if i % 3 == 0 else 200, 0.1) for i in range(40)], SCHEMA) for k in (2, 5, 9)]
    table, rows = keyed(spark, str(tmp_path / "k")), lambda: {r.endpoint: (r.n_requests, r.n_errors) for r in table.read().collect()}
    with pytest.raises(ValueError):
        table.read()
    assert table.apply(batches[0], 0) and not table.apply(batches[0], 0)
    first = rows()
    from leadtime.sources import commits

    with monkeypatch.context() as m:  # the job dies after its files, before the commit: readers see the table as before
        m.setattr(commits, "publish", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            table.apply(batches[1], 1)
    assert rows() == first
    table = keyed(spark, str(tmp_path / "k"))  # restarted
    assert table.apply(batches[1], 1) and table.apply(batches[2], 2) and not table.apply(batches[1], 1)
    assert table.apply(batches[0].limit(0), 3)
    want = {}
    for b in batches:
        for r in b.collect():
            n, e = want.get(r.endpoint, (0, 0))
            want[r.endpoint] = (n + 1, e + (r.status >= 500))
    assert rows() == want
    assert table.clean_up(1) == [0] or set(table.clean_up(1)) <= {0, 1}
    assert rows() == want


def test_keyed_gauge_keeps_the_latest_in_any_order(spark, tmp_path):
    t = datetime(2024, 1, 1)
    table = KeyedTable(spark, str(tmp_path / "g"), ["endpoint"], lambda d: mon.latest_gauge(d, "ts", ["endpoint"], "latency"), lambda d: mon.fold_gauge(d, ["endpoint"]))
    for n, rows in enumerate([[(t + timedelta(2), "a", 200, 0.2)], [(t, "a", 200, 0.9), (t, "b", 200, None)], [(t + timedelta(1), "a", 200, 0.8), (t + timedelta(1), None, 200, 0.5)]]):
        table.apply(spark.createDataFrame(rows, SCHEMA), n)
    assert {r.endpoint: r.value for r in table.read().collect()} == {"a": 0.2, "b": None, None: 0.5}


def test_one_of_many_writers_creates_a_record(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    from leadtime.sources import commits

    with ThreadPoolExecutor(8) as pool:
        made = list(pool.map(lambda i: commits.publish(spark, f"{tmp_path}/c/7", f"text {i}"), range(24)))
    assert sum(made) == 1 and commits.text_of(spark, f"{tmp_path}/c/7") == f"text {made.index(True)}"
    assert list(commits.records(spark, f"{tmp_path}/c")) == [7] and commits.records(spark, f"{tmp_path}/none") == {}

"""Monitoring of prediction events, as batch queries and as streaming jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from leadtime import fixed_values as fv
from leadtime.functions.numeric import uniform_hash
from leadtime.operators import scoring
from leadtime.plans.bindings import Tables
from leadtime.plans.catalog import query
from leadtime.plans.catalog import sql as q
from leadtime.plans.catalog.evaluation import _ROUTE, band_sql
from leadtime.streaming import monitors as mon
from leadtime.session import scratch_path
from leadtime.streaming.keyed import KeyedTable
from leadtime.streaming.runner import append_result, closed_result, complete_result, read_stream, run_keyed


def stamp(df, *names):
    return df.withColumns({n: F.date_format(n, "yyyy-MM-dd HH:mm:ss") for n in names or ("window_start",)})


def rounded(df, *names):
    return df.withColumns({c: F.round(c, 6) for c in names})


def bucket(minutes: int) -> str:
    return f"strftime(time_bucket(INTERVAL {minutes} MINUTE, ts, TIMESTAMP '2000-01-01'), '%Y-%m-%d %H:%M:%S') AS window_start"


def event_stream(t: Tables):
    """The event table as a file stream, with the columns of a scoring request."""
    stream = read_stream(t.spark, t.path("event[s]"), t.events.schema)
    live = Tables(t.spark, t.dir)
    live.__dict__["events"] = stream
    return mon.timed(live.requests, "ts")


_T1 = f"WITH {q.REQ} SELECT {bucket(1)}, endpoint, status::INTEGER AS status, count(*) AS n, round(count(*) / 60.0, 6)::DOUBLE AS per_second FROM req GROUP BY 1, 2, 3"


def t1_of(events):
    return rounded(stamp(mon.request_rate(events, "ts", ["endpoint", "status"])), "per_second")


@query("t1_request_rate", _T1)
def t1(t: Tables):
    return t1_of(mon.timed(t.requests, "ts"))


@query("t1_request_rate_stream", _T1)
def t1_stream(t: Tables):
    return complete_result(t1_of(event_stream(t)))


_LE = ", ".join(f"count(*) FILTER (WHERE latency_s <= {b}) AS c{i}" for i, b in enumerate(fv.LATENCY_BOUNDS))


def _quantile_sql(p: float) -> str:
    cases = []
    for i, upper in enumerate(fv.LATENCY_BOUNDS):
        lower, before = (fv.LATENCY_BOUNDS[i - 1], f"c{i - 1}") if i else (0.0, "0")
        cases.append(f"WHEN c{i} >= {p} * n THEN {lower} + ({upper} - {lower}) * coalesce(({p} * n - {before}) / nullif(c{i} - {before}, 0), 0)")
    return f"round(1000 * CASE {' '.join(cases)} ELSE {fv.LATENCY_BOUNDS[-1]} END, 6)::DOUBLE"


_T2 = (f"WITH {q.REQ}, h AS (SELECT {bucket(60)}, count(latency_s) AS n, {_LE} FROM req GROUP BY 1) SELECT window_start, n, "
       + ", ".join(f"{_quantile_sql(p)} AS p{int(p * 100)}_ms" for p in (0.5, 0.95, 0.99)) + " FROM h")


def t2_of(events):
    df = mon.latency_quantiles(events, "ts", "latency_s", length="1 hour")
    return rounded(stamp(df), "p50_ms", "p95_ms", "p99_ms")


@query("t2_latency_quantiles", _T2)
def t2(t: Tables):
    return t2_of(mon.timed(t.requests, "ts"))


@query("t2_latency_quantiles_stream", _T2)
def t2_stream(t: Tables):
    return complete_result(t2_of(event_stream(t)))


_T3 = (f"WITH {q.REQ} SELECT {bucket(60)}, count(*) AS n, count(*) FILTER (WHERE status >= 500) AS n_errors, "
       "round(count(*) FILTER (WHERE status >= 500) / 3600.0, 6)::DOUBLE AS errors_per_second, "
       "round(count(*) FILTER (WHERE status >= 500) / count(*), 6)::DOUBLE AS error_share FROM req GROUP BY 1")


def t3_of(events):
    return rounded(stamp(mon.error_rate(events, "ts", "status", length="1 hour")), "errors_per_second", "error_share")


@query("t3_error_rate", _T3)
def t3(t: Tables):
    return t3_of(mon.timed(t.requests, "ts"))


@query("t3_error_rate_stream", _T3)
def t3_stream(t: Tables):
    return complete_result(t3_of(event_stream(t)))


def t4_of(events):
    banded = events.withColumns({"risk": scoring.risk_band(F.col("score")), "version": F.lit("v1")})
    return rounded(stamp(mon.label_counts(banded, "ts", ["risk", "version"], "1 hour")), "per_second")


_T4 = (f"WITH {q.REQ} SELECT {bucket(60)}, {band_sql('score', 0.25)} AS risk, 'v1' AS version, count(*) AS n, "
       "round(count(*) / 3600.0, 6)::DOUBLE AS per_second FROM req GROUP BY 1, 2")


@query("t4_risk_band_rate", _T4)
def t4(t: Tables):
    return t4_of(mon.timed(t.requests, "ts"))


@query("t4_risk_band_rate_stream", _T4)
def t4_stream(t: Tables):
    return complete_result(t4_of(event_stream(t)))


_T5 = (f"WITH {q.REQ} SELECT {bucket(60)}, {_ROUTE} AS role, count(*) AS n, "
       "round(count(*) / 3600.0, 6)::DOUBLE AS per_second FROM req GROUP BY 1, 2")


def t5_of(events):
    routed = events.withColumn("role", scoring.route(["user_id"]))
    return rounded(stamp(mon.label_counts(routed, "ts", ["role"], "1 hour")), "per_second")


@query("t5_assignment_rate", _T5)
def t5(t: Tables):
    return t5_of(mon.timed(t.requests, "ts"))


@query("t5_assignment_rate_stream", _T5)
def t5_stream(t: Tables):
    return complete_result(t5_of(event_stream(t)))


_T6 = (f"WITH {q.REQ} SELECT {bucket(5)}, count(*) AS n, round(avg(latency_s) * 1000, 6)::DOUBLE AS mean_ms "
       "FROM req GROUP BY 1")


def t6_of(events):
    return rounded(stamp(mon.mean_latency(events, "ts", "latency_s")), "mean_ms")


@query("t6_mean_latency", _T6)
def t6(t: Tables):
    return t6_of(mon.timed(t.requests, "ts"))


@query("t6_mean_latency_stream", _T6)
def t6_stream(t: Tables):
    return complete_result(t6_of(event_stream(t)))


_T7 = (f"WITH {q.REQ}, r AS (SELECT *, row_number() OVER (PARTITION BY endpoint ORDER BY ts DESC, score DESC) AS rn FROM req) "
       "SELECT endpoint, round(score, 6)::DOUBLE AS value, strftime(ts, '%Y-%m-%d %H:%M:%S') AS at FROM r WHERE rn = 1")


def t7_of(events):
    return rounded(stamp(mon.latest_gauge(events, "ts", ["endpoint"], "score"), "at"), "value")


@query("t7_latest_gauge", _T7)
def t7(t: Tables):
    return t7_of(mon.timed(t.requests, "ts"))


@query("t7_latest_gauge_stream", _T7)
def t7_stream(t: Tables):
    return complete_result(t7_of(event_stream(t)))


_T8 = f"WITH {q.REQ} SELECT endpoint, count(*) AS n_requests, count(*) FILTER (WHERE status >= 500) AS n_errors FROM req GROUP BY 1"


@query("t8_running_totals", _T8)
def t8(t: Tables):
    return mon.running_totals(mon.timed(t.requests, "ts"), ["endpoint"], "status")


@query("t8_running_totals_stream", _T8)
def t8_stream(t: Tables):
    return complete_result(mon.running_totals(event_stream(t), ["endpoint"], "status"))


_T9 = (f"WITH {q.REQ}, s AS (SELECT event_id, 1.0 / (1.0 + exp(-(4.0 * score + {q.unit_hash('user_id || ' + chr(39) + '|u' + chr(39))} - 1.0))) AS p "
       f"FROM req) SELECT event_id, round(p, 4)::DOUBLE AS probability, {band_sql('p', 0.6)} AS risk FROM s")


def t9_of(events):
    rows = events.withColumn("u", uniform_hash(F.col("user_id"), seed="u"))
    return scoring.score_rows(rows, scoring.logistic({"score": 4.0, "u": 1.0}, -1.0), "1", 0.6).select("event_id", "probability", "risk")


@query("t9_score_requests", _T9)
def t9(t: Tables):
    return t9_of(mon.timed(t.requests, "ts"))


@query("t9_score_requests_stream", _T9)
def t9_stream(t: Tables):
    return append_result(t9_of(event_stream(t)))


# --- append mode: windows that the watermark, an hour behind the newest event, has closed

def closed_sql(sql: str, minutes: int) -> str:
    """Of a query's windows, those that end no later than the watermark after all events."""
    return (f"SELECT * FROM ({sql}) WHERE strptime(window_start, '%Y-%m-%d %H:%M:%S') + INTERVAL {minutes} MINUTE "
            "<= (SELECT max(ts) - INTERVAL 1 HOUR FROM events)")


_CLOSED = {"t1_request_rate": (t1_of, _T1, 1), "t2_latency_quantiles": (t2_of, _T2, 60), "t3_error_rate": (t3_of, _T3, 60),
           "t4_risk_band_rate": (t4_of, _T4, 60), "t5_assignment_rate": (t5_of, _T5, 60), "t6_mean_latency": (t6_of, _T6, 5)}
for _name, (_of, _sql, _minutes) in _CLOSED.items():
    query(f"{_name}_closed_stream", closed_sql(_sql, _minutes))(lambda t, of=_of: closed_result(of(event_stream(t))))


def sliding_of(events):
    df = mon.sliding_rates(events, "ts", ["endpoint"], "status", "1 hour", "10 minutes")
    return rounded(stamp(df), "per_second", "error_share")


_SLIDING = f"""WITH {q.REQ}, w AS (SELECT time_bucket(INTERVAL 10 MINUTE, ts, TIMESTAMP '2000-01-01') - i * INTERVAL 10 MINUTE AS start,
  endpoint, status FROM req, range(6) AS r(i))
SELECT strftime(start, '%Y-%m-%d %H:%M:%S') AS window_start, endpoint, count(*) AS n, count(*) FILTER (WHERE status >= 500) AS n_errors,
  round(count(*) / 3600.0, 6)::DOUBLE AS per_second, round(count(*) FILTER (WHERE status >= 500) / count(*), 6)::DOUBLE AS error_share
FROM w GROUP BY 1, 2"""


@query("t1_sliding_rate", _SLIDING)
def t1_sliding(t: Tables):
    return sliding_of(mon.timed(t.requests, "ts"))


@query("t1_sliding_rate_stream", closed_sql(_SLIDING, 60))
def t1_sliding_stream(t: Tables):
    return closed_result(sliding_of(event_stream(t)))


@query("t3_closed_error_rate", closed_sql(_T3, 60))
def t3_closed(t: Tables):
    events = mon.timed(t.requests, "ts")
    df = mon.closed_windows(mon.error_rate(events, "ts", "status", length="1 hour"), events, "ts", "1 hour")
    return rounded(stamp(df), "errors_per_second", "error_share")


# --- keyed tables after three batches, the second of which comes twice

def keyed_result(t: Tables, keys, reduce, fold):
    arrived, folder = scratch_path(t.spark, "arrived"), scratch_path(t.spark, "keyed")
    t.requests.repartitionByRange(3, "event_id").sortWithinPartitions("event_id").write.parquet(arrived)
    stream = read_stream(t.spark, arrived, t.requests.schema, files_per_batch=1)
    table = KeyedTable(t.spark, folder, keys, reduce, fold, buckets=4)
    once = table.apply

    def twice(rows, n):
        return once(rows, n) if n != 1 else (once(rows, n), once(rows, n))

    table.apply = twice
    run_keyed(stream, table, scratch_path(t.spark, "stream-state"))
    return table.read()


@query("t7_latest_gauge_keyed_stream", _T7)
def t7_keyed(t: Tables):
    df = keyed_result(t, ["endpoint"], lambda d: mon.latest_gauge(d, "ts", ["endpoint"], "score"), lambda d: mon.fold_gauge(d, ["endpoint"]))
    return rounded(stamp(df, "at"), "value").select("endpoint", "value", "at")


@query("t8_running_totals_keyed_stream", _T8)
def t8_keyed(t: Tables):
    df = keyed_result(t, ["endpoint"], lambda d: mon.running_totals(d, ["endpoint"], "status"), lambda d: mon.fold_totals(d, ["endpoint"]))
    return df.select("endpoint", "n_requests", "n_errors")

"""Scans, projections, predicates, cleaning, set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from leadtime.functions.dates import in_forward, in_lookback, parse_yyyymmdd, year_start
from leadtime.functions.flags import map_codes
from leadtime.functions.numeric import as_target, column_or, safe_numeric
from leadtime.operators import cleaning as op
from leadtime.operators.prefix import exact_quantile
from leadtime.plans.bindings import KEY, OBS_YEARS, URGENT, Tables
from leadtime.plans.catalog import query
from leadtime.plans.catalog import sql as q
from leadtime.plans.cleaning_job import clean_events, cleaning_profile
from leadtime.session import scratch_path
from leadtime.sources.tables import read_split, read_tables, write_table


@query("s3_table_scan", """
SELECT 'customer' AS table_name, count(*) AS n_rows FROM customer UNION ALL
SELECT 'orders', count(*) FROM orders UNION ALL SELECT 'lineitem', count(*) FROM lineitem UNION ALL
SELECT 'events', count(*) FROM events""")
def s3(t: Tables):
    found = read_tables(t.spark, {n: t.path(n) for n in ("customer", "orders", "lineitem", "events")})
    return op.union_all([df.agg(F.count("*").alias("n_rows")).select(F.lit(n).alias("table_name"), "n_rows")
                         for n, df in found.items()])


@query("s4_split_scan", f"WITH {q.COHORT}, {q.LABEL} SELECT c.entity, "
       "CASE WHEN l.entity IS NULL THEN 0 ELSE 1 END AS label FROM cohort c LEFT JOIN label l "
       "ON c.entity = l.entity AND c.obs_date = l.obs_date WHERE c.obs_date = DATE '1997-01-01'")
def s4(t: Tables):
    path = scratch_path(t.spark, "splits")
    rows = op.temporal_split(t.entities, F.col("year"), OBS_YEARS).select(KEY, "split", "label")
    write_table(rows, path, ["split"])
    return read_split(t.spark, path, "train").select(KEY, "label")


@query("s5_projected_scan", "SELECT o_orderkey, o_totalprice, 0.0::DOUBLE AS not_there FROM orders")
def s5(t: Tables):
    return op.read_columns(t.orders, ["o_orderkey", "o_totalprice", "not_there"])


@query("p1_project_by_name", "SELECT l_orderkey, l_linenumber, l_shipdate::DATE::VARCHAR AS l_shipdate, "
       "l_extendedprice FROM lineitem")
def p1(t: Tables):
    df = op.project_by_name(t.lineitem, ["l_orderkey", "l_linenumber"], ["l_ship"], ["price"])
    return df.withColumn("l_shipdate", F.to_date("l_shipdate").cast("string"))


@query("p2_cohort_rows", f"SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem "
       f"WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE {q.URGENT})")
def p2(t: Tables):
    cohort = t.urgent.select(F.col("o_orderkey").alias("l_orderkey"))
    return op.restrict_to(t.lineitem, cohort, "l_orderkey").select("l_orderkey", "l_linenumber", "l_quantity")


@query("p3_seeded_sample", "SELECT o_orderkey, o_custkey FROM orders "
       "ORDER BY md5(o_orderkey || '|42'), o_orderkey LIMIT 500")
def p3(t: Tables):
    return op.seeded_sample(t.orders.select("o_orderkey", "o_custkey"), 500, ["o_orderkey"])


_RAW_DATE = """CASE o_orderstatus WHEN 'F' THEN strftime(o_orderdate, '%Y%m%d')
  WHEN 'O' THEN strftime(o_orderdate, '%Y%m%d') || '.0'
  ELSE CASE o_orderpriority WHEN '1-URGENT' THEN 'not_a_date' WHEN '2-HIGH' THEN '' WHEN '3-MEDIUM' THEN 'nan'
    WHEN '4-NOT SPECIFIED' THEN NULL ELSE '20101399' END END"""


@query("p4_parse_dates", f"""
WITH raw AS (SELECT o_orderkey, {_RAW_DATE} AS t, strftime(o_orderdate, '%Y%m%d')::DOUBLE AS n FROM orders)
SELECT o_orderkey, try_strptime(regexp_replace(t, '\\.0$', ''), '%Y%m%d')::DATE::VARCHAR AS from_text,
  try_strptime(n::BIGINT::VARCHAR, '%Y%m%d')::DATE::VARCHAR AS from_number FROM raw""")
def p4(t: Tables):
    day = F.date_format("o_orderdate", "yyyyMMdd")
    junk = (F.when(F.col("o_orderpriority") == "1-URGENT", "not_a_date").when(F.col("o_orderpriority") == "2-HIGH", "")
            .when(F.col("o_orderpriority") == "3-MEDIUM", "nan")
            .when(F.col("o_orderpriority") == "4-NOT SPECIFIED", F.lit(None)).otherwise("20101399"))
    text = (F.when(F.col("o_orderstatus") == "F", day).when(F.col("o_orderstatus") == "O", F.concat(day, F.lit(".0")))
            .otherwise(junk))
    return t.orders.select("o_orderkey", parse_yyyymmdd(text).cast("string").alias("from_text"),
                           parse_yyyymmdd(day.cast("double"), "double").cast("string").alias("from_number"))


@query("p5_parse_marked_columns", """
SELECT o_orderkey, o_orderdate::DATE::VARCHAR AS "A_DT", o_orderdate::DATE::VARCHAR AS "B_DT" FROM orders""")
def p5(t: Tables):
    day = F.date_format("o_orderdate", "yyyyMMdd")
    raw = t.orders.select("o_orderkey", day.alias("A_DT"), day.cast("double").alias("B_DT"))
    return op.to_text(op.parse_dates(raw, mark="DT"), ["A_DT", "B_DT"])


@query("p6_coerce_timestamps", """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN NULL ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS at
FROM orders""")
def p6(t: Tables):
    text = F.when(F.col("o_orderstatus") == "F", "broken").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))
    df = op.coerce_timestamps(t.orders.select("o_orderkey", text.alias("at")), ["at", "not_there"])
    return df.withColumn("at", F.date_format("at", "yyyy-MM-dd HH:mm:ss"))


@query("p7_event_date", f"""
WITH {q.LINES} SELECT l.l_orderkey, l.l_linenumber, coalesce(CASE WHEN l_returnflag = 'R' THEN l_shipdate END,
  o_orderdate)::DATE::VARCHAR AS event_date FROM lineitem l JOIN orders ON l.l_orderkey = o_orderkey""")
def p7(t: Tables):
    both = t.lineitem.join(t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate"), "l_orderkey")
    both = both.withColumn("returned", F.when(F.col("l_returnflag") == "R", F.col("l_shipdate")))
    df = op.event_date(both, ["not_there", "returned", "o_orderdate"], "event_date", per_row=True)
    return df.select("l_orderkey", "l_linenumber", F.to_date("event_date").cast("string").alias("event_date"))


_RAW_NUMBER = """CASE event_type WHEN 'error' THEN 'nan' WHEN 'view' THEN 'abc' WHEN 'click' THEN 'inf'
  WHEN 'signup' THEN NULL ELSE floor(value)::BIGINT::VARCHAR END"""


@query("p8_safe_numeric", f"""
WITH raw AS (SELECT event_id, try_cast({_RAW_NUMBER} AS DOUBLE) AS x FROM events)
SELECT event_id, CASE WHEN x IS NULL OR isnan(x) OR isinf(x) THEN 7.0 ELSE x END AS number FROM raw""")
def p8(t: Tables):
    kind = F.col("event_type")
    raw = (F.when(kind == "error", "nan").when(kind == "view", "abc").when(kind == "click", "inf")
           .when(kind == "signup", F.lit(None)).otherwise(F.floor("value").cast("string")))
    return t.events.select("event_id", safe_numeric(raw, 7).alias("number"))


@query("p9_column_or_default", "SELECT o_orderkey, o_totalprice AS price, 5.0::DOUBLE AS absent FROM orders")
def p9(t: Tables):
    return t.orders.select("o_orderkey", column_or(t.orders, "o_totalprice").alias("price"),
                           column_or(t.orders, "not_there", 5).alias("absent"))


@query("p10_normalise_key", "SELECT c_custkey::VARCHAR AS c_custkey, c_acctbal FROM customer")
def p10(t: Tables):
    return op.normalise_key(t.customer.select("c_custkey", "c_acctbal"), "c_custkey")


@query("p11_to_text", "SELECT c_custkey::VARCHAR AS c_custkey, c_nationkey::VARCHAR AS c_nationkey, c_mktsegment FROM customer")
def p11(t: Tables):
    return op.to_text(t.customer.select("c_custkey", "c_nationkey", "c_mktsegment"), ["c_custkey", "c_nationkey"])


@query("p12_keep_first", """
SELECT user_id, day, event_id, event_type FROM (
  SELECT user_id, ts::DATE::VARCHAR AS day, event_id, event_type,
    row_number() OVER (PARTITION BY user_id, ts::DATE ORDER BY ts, event_id) AS rn FROM events) WHERE rn = 1""")
def p12(t: Tables):
    df = t.events.select("user_id", F.to_date("ts").cast("string").alias("day"), "event_id", "event_type", "ts")
    return op.keep_first(df, ["user_id", "day"], ["ts", "event_id"]).drop("ts")


@query("p14_lookback", "SELECT o_orderkey FROM orders WHERE o_orderdate >= DATE '1998-02-28' - INTERVAL 6 MONTH "
       "AND o_orderdate < DATE '1998-02-28'")
def p14(t: Tables):
    return t.orders.where(in_lookback(F.col("o_orderdate"), F.lit("1998-02-28").cast("date"), 6)).select("o_orderkey")


@query("p15_forward", "SELECT o_orderkey FROM orders WHERE o_orderdate > DATE '1998-08-31' "
       "AND o_orderdate <= DATE '1998-08-31' + INTERVAL 6 MONTH")
def p15(t: Tables):
    return t.orders.where(in_forward(F.col("o_orderdate"), F.lit("1998-08-31").cast("date"), 6)).select("o_orderkey")


@query("p16_code_filter", f"SELECT o_orderkey, o_orderpriority FROM orders WHERE {q.URGENT}")
def p16(t: Tables):
    df = t.orders.select("o_orderkey", "o_orderpriority")
    return df.where(F.col("o_orderpriority").isin(URGENT)) if "o_orderpriority" in df.columns else df


@query("p17_sanitize", """
SELECT l_orderkey, l_linenumber, l_quantity, l_tax, l_suppkey::DOUBLE AS l_suppkey, 0.0::DOUBLE AS l_returnflag,
  0.0::DOUBLE AS not_there FROM lineitem""")
def p17(t: Tables):
    return op.sanitize(t.lineitem, ["l_quantity", "l_tax", "l_suppkey", "l_returnflag", "not_there"],
                       ["l_orderkey", "l_linenumber"])


@query("p18_target", """
SELECT doc_id, CASE WHEN toxic = 1 THEN 0 ELSE quality END::INTEGER AS label FROM labels""")
def p18(t: Tables):
    raw = F.when(F.col("toxic") == 1, "unknown").otherwise(F.col("quality").cast("string"))
    return t.labels.select("doc_id", as_target(raw).alias("label"))


@query("p19_code_map", """
SELECT o_orderkey, (CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'P' THEN 0 ELSE 9 END)::INTEGER AS code FROM orders""")
def p19(t: Tables):
    return t.orders.select("o_orderkey", map_codes(F.col("o_orderstatus"), {"F": 1, "P": 0}, 9).alias("code"))


@query("p20_coerce_prefixed", "SELECT event_id, 0.0::DOUBLE AS event_type, user_id FROM events")
def p20(t: Tables):
    return op.coerce_prefixed(t.events.select("event_id", "event_type", "user_id"), ["event_t"])


@query("p21_required_tables", "SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1")
def p21(t: Tables):
    op.require_tables({"orders": t.orders, "customer": t.customer},
                      {"orders": ["o_orderkey", "o_custkey", "o_orderdate"], "customer": ["c_custkey"]})
    return op.require_columns(t.orders, ["o_orderstatus"], "orders").groupBy("o_orderstatus").agg(F.count("*").alias("n"))


@query("p22_age", """
WITH first_seen AS (SELECT o_custkey AS entity, min(o_orderdate)::DATE AS born FROM orders GROUP BY 1),
aged AS (SELECT c_custkey AS entity, CASE WHEN born < DATE '1996-01-01'
  THEN date_diff('day', born, DATE '1998-01-01') / 365.25 END AS age FROM customer LEFT JOIN first_seen ON c_custkey = entity)
SELECT entity, round(coalesce(age, (SELECT median(age) FROM aged)), 6) AS age FROM aged""")
def p22(t: Tables):
    born = F.to_date(F.min("o_orderdate"))
    seen = t.orders.groupBy(F.col("o_custkey").alias(KEY)).agg(born.alias("_first"))
    people = (t.customer.select(F.col("c_custkey").alias(KEY)).join(seen, KEY, "left")
              .withColumns({"born": F.when(F.col("_first") < F.lit("1996-01-01").cast("date"), F.col("_first")),
                            "obs": F.lit("1998-01-01").cast("date")}))
    aged = op.add_age(people, "born", "obs", None)
    whole = op.add_age(people, "born", "obs", exact_quantile(aged, "age").scalar())
    return whole.select(KEY, F.round("age", 6).alias("age"))


@query("p23_temporal_split", """
SELECT o_orderkey, CASE year(o_orderdate) WHEN 1997 THEN 'train' WHEN 1998 THEN 'val' WHEN 1999 THEN 'test' END AS split
FROM orders""")
def p23(t: Tables):
    return op.temporal_split(t.orders, F.year("o_orderdate"), OBS_YEARS).select("o_orderkey", "split")


@query("p24_align_for_scoring", "SELECT o_orderkey AS id, o_custkey::DOUBLE AS o_custkey, o_totalprice, "
       "0.0::DOUBLE AS not_there FROM orders")
def p24(t: Tables):
    df = t.orders.withColumn("id", F.col("o_orderkey"))
    return op.align_for_scoring(df, ["o_custkey", "o_totalprice", "not_there"], ["id"])


@query("fn_year_start", "SELECT o_orderkey, (date_trunc('year', o_orderdate))::DATE::VARCHAR AS obs FROM orders")
def fn_year_start(t: Tables):
    return t.orders.select("o_orderkey", year_start(F.year("o_orderdate")).cast("string").alias("obs"))


@query("fn_json_field", "SELECT event_id, json_extract(props, '$.k')::BIGINT AS k FROM events")
def fn_json(t: Tables):
    return t.events.select("event_id", F.from_json("props", "k bigint")["k"].alias("k"))


@query("u1_union_shards", "SELECT l_orderkey, l_linenumber, l_returnflag, "
       "CASE WHEN l_returnflag = 'A' THEN l_tax END AS l_tax FROM lineitem")
def u1(t: Tables):
    base = ["l_orderkey", "l_linenumber", "l_returnflag"]
    a = t.lineitem.where(F.col("l_returnflag") == "A").select(*base, "l_tax")
    rest = [t.lineitem.where(F.col("l_returnflag") == flag).select(*base) for flag in ("N", "R")]
    return op.union_all([a, *rest])


@query("u2_union_years", "SELECT year(o_orderdate)::INTEGER AS year, count(*) AS n_orders FROM orders GROUP BY 1")
def u2(t: Tables):
    def of(y):
        day = F.col("o_orderdate")
        return t.orders.where((day >= F.lit(f"{y}-01-01").cast("date")) & (day < F.lit(f"{y + 1}-01-01").cast("date"))) \
            .select(F.lit(y).alias("year"))
    years = [r[0] for r in t.orders.select(F.year("o_orderdate")).distinct().collect()]
    return op.union_all([of(y) for y in sorted(years)]).groupBy("year").agg(F.count("*").alias("n_orders"))


@query("u4_absent_keys", f"SELECT c_custkey FROM customer WHERE c_custkey NOT IN "
       f"(SELECT o_custkey FROM orders WHERE {q.URGENT} AND o_orderdate < DATE '1997-01-01')")
def u4(t: Tables):
    early = t.urgent.where(F.col("o_orderdate") < F.lit("1997-01-01").cast("date"))
    return op.absent_keys(t.customer, early.select(F.col("o_custkey").alias("c_custkey")), ["c_custkey"])


@query("j7_pair_by_key", """
SELECT matched, count(*) AS n FROM (
  SELECT (l.doc_id IS NOT NULL AND d.doc_id IS NOT NULL) AS matched FROM labels l FULL JOIN documents d
  ON l.doc_id = d.doc_id) GROUP BY 1""")
def j7(t: Tables):
    paired = op.pair_by_key(t.documents.select("doc_id", "n_chars"), t.labels.select("doc_id", "quality"), ["doc_id"])
    return paired.groupBy("matched").agg(F.count("*").alias("n"))


# --- the cleaning job over raw files with junk dates and broken lines, all flags

_JUNK = """CASE l_linenumber % 7 WHEN 0 THEN 'nan' WHEN 1 THEN strftime(l_shipdate, '%Y%m%d') || '.0' WHEN 2 THEN '' WHEN 3 THEN '20101399'
  ELSE strftime(l_shipdate, '%Y%m%d') END"""


@query("clean_pipeline", f"""
WITH raw AS (SELECT l_returnflag AS "table", l_partkey % 50 = 0 AS broken, l_extendedprice AS amt,
  coalesce(try_strptime(regexp_replace({_JUNK}, '\\.0$', ''), '%Y%m%d'),
    CASE WHEN l_linenumber % 2 = 0 THEN l_shipdate END)::DATE AS d, o_orderstatus <> 'P' AS mine
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
SELECT "table", count(*) FILTER (WHERE NOT broken AND mine) AS n_rows, count(d) FILTER (WHERE NOT broken AND mine) AS n_valid,
  min(d) FILTER (WHERE NOT broken AND mine)::VARCHAR AS first_time, max(d) FILTER (WHERE NOT broken AND mine)::VARCHAR AS last_time,
  round(sum(amt) FILTER (WHERE NOT broken AND mine), 2) AS amount, count(*) FILTER (WHERE broken) AS n_rejected FROM raw GROUP BY 1""")
def clean_job(t: Tables):
    root, out = scratch_path(t.spark, "raw"), scratch_path(t.spark, "clean")
    day = F.date_format("l_shipdate", "yyyyMMdd")
    kind = F.col("l_linenumber") % 7
    text = F.when(kind == 0, "nan").when(kind == 1, F.concat(day, F.lit(".0"))).when(kind == 2, "").when(kind == 3, "20101399").otherwise(day)
    price = F.when(F.col("l_partkey") % 50 == 0, "n/a").otherwise(F.col("l_extendedprice").cast("string"))
    fallback = F.when(F.col("l_linenumber") % 2 == 0, day).otherwise("")
    line = F.concat_ws(",", F.col("l_orderkey").cast("string"), text, fallback, price).alias("value")
    # one directory of raw lines for each flag, as yearly or split deliveries come
    t.lineitem.select(line, F.col("l_returnflag").alias("shard")).write.partitionBy("shard").text(root)
    cohort = t.orders.where(F.col("o_orderstatus") != "P").select(F.col("o_orderkey").cast("string").alias("key"))
    flags = ("A", "N", "R")
    clean_events(t.spark, {f: [f"{root}/shard={f}"] for f in flags}, "key string, from_dt string, thru_dt string, amt double", out, "key",
                 ["from_dt", "thru_dt"], cohort)
    df = cleaning_profile(t.spark, flags, out, "amt")
    return df.select("table", "n_rows", "n_valid", F.col("first_time").cast("string").alias("first_time"),
                     F.col("last_time").cast("string").alias("last_time"), F.round("amount", 2).alias("amount"), "n_rejected")

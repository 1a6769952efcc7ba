"""Point-in-time joins and aggregates, composites, scaling."""

from __future__ import annotations

from pyspark.sql import functions as F

from leadtime import fixed_values as fv
from leadtime.functions.flags import clip_flag, code_flag
from leadtime.functions.numeric import clip, flag, right_closed_bin, right_closed_ordinal
from leadtime.operators import composites as comp
from leadtime.operators import point_in_time as pit
from leadtime.operators import profile, scaling
from leadtime.operators.prefix import exact_quantile
from leadtime.plans import risk_features as rf
from leadtime.plans.bindings import COST_MARKS, FLAG_CODES, FLAG_WEIGHTS, KEY, OBS_DATES, OBS_YEARS, URGENT, Tables
from leadtime.plans.catalog import query
from leadtime.plans.catalog import sql as q

IDS = [KEY, "obs_date"]


def text_dates(df):
    return df.withColumn("obs_date", F.col("obs_date").cast("string")) if "obs_date" in df.columns else df


def with_features(t: Tables, features):
    return text_dates(pit.point_in_time(t.cohort, t.sources, features, OBS_DATES, KEY))


def all_features(t: Tables):
    return with_features(t, rf.FULL_FEATURES)


def feats_sql(columns: str, where: str = "") -> str:
    return f"WITH {q.FEATS} SELECT entity, obs_date::VARCHAR AS obs_date, {columns} FROM feats{where}"


def cents(df, *names):
    return df.withColumns({n: F.round(n, 2) for n in names})


# --- the flagship: features of one source, and the label, for every customer and date

FLAGSHIP = [pit.count_before("inpatient", "n_before"), pit.count_trailing("inpatient", 3, "n_3m"),
            pit.count_trailing("inpatient", 12, "n_12m"), pit.sum_before("inpatient", "spent"),
            pit.distinct_before("inpatient", "n_codes"), pit.days_since_last("inpatient", "days_since")]


@query("flagship_point_in_time", f"""
WITH {q.COHORT}, {q.LABEL}, f AS (SELECT o_custkey AS entity, obs_date, count(*) AS n_before,
  count(*) FILTER (WHERE o_orderdate >= obs_date - INTERVAL 3 MONTH) AS n_3m,
  count(*) FILTER (WHERE o_orderdate >= obs_date - INTERVAL 12 MONTH) AS n_12m, sum(o_totalprice) AS spent,
  count(DISTINCT o_orderpriority) AS n_codes, date_diff('day', max(o_orderdate)::DATE, obs_date) AS days_since
  FROM orders JOIN dates ON o_orderdate < obs_date GROUP BY 1, 2)
SELECT c.entity, c.obs_date::VARCHAR AS obs_date, coalesce(n_before, 0) AS n_before, coalesce(n_3m, 0) AS n_3m,
  coalesce(n_12m, 0) AS n_12m, round(coalesce(spent, 0.0), 2) AS spent, coalesce(n_codes, 0) AS n_codes,
  coalesce(days_since, 0) AS days_since, CASE WHEN l.entity IS NULL THEN 0 ELSE 1 END AS label
FROM cohort c LEFT JOIN f ON c.entity = f.entity AND c.obs_date = f.obs_date
LEFT JOIN label l ON c.entity = l.entity AND c.obs_date = l.obs_date""")
def flagship(t: Tables):
    urgent = pit.Source("urgent", t.orders, "o_custkey", "o_orderdate", where=F.col("o_orderpriority").isin(URGENT))
    df = pit.point_in_time(t.cohort, [*t.sources[:1], urgent], [*FLAGSHIP, pit.event_ahead("urgent", 6, "label")],
                           OBS_DATES, KEY)
    return cents(text_dates(df), "spent")


# --- joins

@query("j1_feature_join", feats_sql("NB_HOSP_PASSEES, NB_OP_12M, NB_CAR_12M, NB_RX_12M"))
def j1(t: Tables):
    wanted = ("NB_HOSP_PASSEES", "NB_OP_12M", "NB_CAR_12M", "NB_RX_12M")
    return with_features(t, [f for f in rf.FULL_FEATURES if f.name in wanted])


@query("j2_cohort_events", f"WITH {q.LINES} SELECT entity, count(*) AS n FROM lines WHERE entity IN "
       "(SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING') GROUP BY 1")
def j2(t: Tables):
    from leadtime.operators.cleaning import restrict_to
    building = t.customer.where(F.col("c_mktsegment") == "BUILDING").select(F.col("c_custkey").alias(KEY))
    return restrict_to(t.lines, building, KEY).groupBy(KEY).agg(F.count("*").alias("n"))


@query("j3_forward_label", f"WITH {q.COHORT}, {q.LABEL} SELECT c.entity, c.obs_date::VARCHAR AS obs_date, "
       "CASE WHEN l.entity IS NULL THEN 0 ELSE 1 END AS label FROM cohort c LEFT JOIN label l "
       "ON c.entity = l.entity AND c.obs_date = l.obs_date")
def j3(t: Tables):
    return text_dates(pit.forward_label(t.cohort, t.orders, KEY, "o_orderdate", OBS_DATES, 6, "label",
                                        codes=("o_orderpriority", URGENT), event_key="o_custkey"))


@query("j4_attach_dates", f"WITH {q.DATES} SELECT o_orderkey, obs_date::VARCHAR AS obs_date FROM orders "
       "JOIN dates ON o_orderdate < obs_date")
def j4(t: Tables):
    rows = t.orders.select("o_orderkey", "o_orderdate").where(F.col("o_orderdate") < F.lit(max(OBS_DATES)))
    return text_dates(pit.attach_dates(rows, "o_orderdate", OBS_DATES).select("o_orderkey", "obs_date"))


@query("j5_latest_before", f"""
WITH {q.DATES}, r AS (SELECT o_custkey, obs_date, o_orderkey, o_orderpriority, o_orderdate, row_number() OVER (
  PARTITION BY o_custkey, obs_date ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
  FROM orders JOIN dates ON o_orderdate < obs_date)
SELECT o_custkey, obs_date::VARCHAR AS obs_date, o_orderdate::DATE::VARCHAR AS o_orderdate, o_orderkey, o_orderpriority
FROM r WHERE rn = 1""")
def j5(t: Tables):
    df = pit.latest_before(t.orders, "o_custkey", "o_orderdate", ["o_orderkey", "o_orderpriority"], OBS_DATES)
    return text_dates(df).withColumn("o_orderdate", F.to_date("o_orderdate").cast("string"))


@query("j6_without_history", f"""
WITH {q.COHORT} SELECT entity, obs_date::VARCHAR AS obs_date FROM cohort c WHERE NOT EXISTS (
  SELECT 1 FROM orders WHERE o_custkey = c.entity AND o_orderdate < c.obs_date)""")
def j6(t: Tables):
    events = t.orders.withColumnRenamed("o_custkey", KEY)
    return text_dates(pit.without_history(t.cohort, events, KEY, "o_orderdate", OBS_DATES))


@query("j4_any_dates", f"""
WITH {q.LINES}, people AS (SELECT o_custkey AS entity, max(o_orderdate)::DATE AS obs_date FROM orders GROUP BY 1),
f AS (SELECT p.entity, p.obs_date, count(*) AS n_before,
  count(*) FILTER (WHERE l_shipdate >= p.obs_date - INTERVAL 6 MONTH) AS n_6m, sum(l_extendedprice) AS spent,
  count(DISTINCT l_partkey) AS n_parts, date_diff('day', max(l_shipdate)::DATE, p.obs_date) AS days_since
  FROM people p JOIN lines l ON l.entity = p.entity AND l_shipdate < p.obs_date GROUP BY 1, 2)
SELECT entity, p.obs_date::VARCHAR AS obs_date, coalesce(n_before, 0) AS n_before, coalesce(n_6m, 0) AS n_6m,
  round(coalesce(spent, 0.0), 2) AS spent, coalesce(n_parts, 0) AS n_parts, coalesce(days_since, 0) AS days_since
FROM people p LEFT JOIN f USING (entity)""")
def j4_any(t: Tables):
    people = t.orders.groupBy(F.col("o_custkey").alias(KEY)).agg(F.to_date(F.max("o_orderdate")).alias("obs_date"))
    wanted = [pit.count_before("prescription", "n_before"), pit.count_trailing("prescription", 6, "n_6m"),
              pit.sum_before("prescription", "spent"), pit.distinct_before("prescription", "n_parts"),
              pit.days_since_last("prescription", "days_since")]
    return cents(text_dates(pit.point_in_time_any_dates(people, t.sources, wanted, KEY)), "spent")


@query("j4_any_dates_label", f"""
WITH {q.LINES}, people AS (SELECT o_custkey AS entity, median(epoch(o_orderdate)) AS m FROM orders GROUP BY 1),
own AS (SELECT entity, (TIMESTAMP '1970-01-01' + to_seconds(m::BIGINT))::DATE AS obs_date FROM people),
f AS (SELECT p.entity, p.obs_date, count(*) FILTER (WHERE l_shipdate < p.obs_date) AS n_before,
  count(*) FILTER (WHERE l_shipdate < p.obs_date AND l_shipdate >= p.obs_date - INTERVAL 12 MONTH) AS n_12m,
  count(*) FILTER (WHERE l_shipdate > p.obs_date AND l_shipdate <= p.obs_date + INTERVAL 6 MONTH) AS n_next,
  max(CASE WHEN l_returnflag = 'R' AND l_shipdate > p.obs_date AND l_shipdate <= p.obs_date + INTERVAL 6 MONTH THEN 1 ELSE 0 END) AS label
  FROM own p JOIN lines l ON l.entity = p.entity GROUP BY 1, 2)
SELECT p.entity, p.obs_date::VARCHAR AS obs_date, coalesce(n_before, 0) AS n_before, coalesce(n_12m, 0) AS n_12m,
  coalesce(n_next, 0) AS n_next, coalesce(label, 0) AS label FROM own p LEFT JOIN f USING (entity)""")
def j4_any_label(t: Tables):
    middle = F.percentile(F.unix_seconds(F.col("o_orderdate").cast("timestamp")), 0.5)
    people = t.orders.groupBy(F.col("o_custkey").alias(KEY)).agg(F.to_date(F.timestamp_seconds(F.round(middle))).alias("obs_date"))
    wanted = [pit.count_before("prescription", "n_before"), pit.count_trailing("prescription", 12, "n_12m"),
              pit.count_ahead("prescription", 6, "n_next"), pit.event_ahead("outpatient", 6, "label")]
    return text_dates(pit.point_in_time_any_dates(people, t.sources, wanted, KEY))


# --- aggregates

@query("a1_count_before", feats_sql("NB_HOSP_PASSEES"))
def a1(t: Tables):
    return with_features(t, [pit.count_before("inpatient", "NB_HOSP_PASSEES")])


@query("a2_trailing_counts", feats_sql("NB_OP_3M, NB_OP_6M, NB_OP_12M"))
def a2(t: Tables):
    return with_features(t, [pit.count_trailing("outpatient", m, f"NB_OP_{m}M") for m in (3, 6, 12)])


@query("a2_rolling_counts", """
SELECT o_custkey, o_orderdate::DATE::VARCHAR AS day, count(*) AS n_at, (
  SELECT count(*) FROM orders b WHERE b.o_custkey = a.o_custkey AND b.o_orderdate < a.o_orderdate
  AND b.o_orderdate >= a.o_orderdate - INTERVAL 90 DAY) AS n_90d FROM orders a GROUP BY o_custkey, o_orderdate""")
def a2_rolling(t: Tables):
    df = pit.rolling_counts(t.orders, "o_custkey", "o_orderdate", 90, "n_90d")
    return df.select("o_custkey", F.to_date("o_orderdate").cast("string").alias("day"), "n_at", "n_90d")


@query("a3_sum_before", feats_sql("round(COUT_HOSP_PASSE, 2) AS COUT_HOSP_PASSE"))
def a3(t: Tables):
    return cents(with_features(t, [pit.sum_before("inpatient", "COUT_HOSP_PASSE")]), "COUT_HOSP_PASSE")


@query("a4_distinct_before", feats_sql("NB_MOLECULES_UNIQUES"))
def a4(t: Tables):
    return with_features(t, [pit.distinct_before("prescription", "NB_MOLECULES_UNIQUES")])


@query("a5_days_since_last", feats_sql("DAYS_SINCE_LAST_RX"))
def a5(t: Tables):
    return with_features(t, [pit.days_since_last("prescription", "DAYS_SINCE_LAST_RX")])


@query("a6_median", "SELECT round(median(l_extendedprice), 6) AS median_price FROM lineitem")
def a6(t: Tables):
    return exact_quantile(t.lineitem, "l_extendedprice", 0.5, "median_price").select(
        F.round("median_price", 6).alias("median_price"))


@query("a7_label_rates", f"WITH {q.COHORT}, {q.ENTITIES} SELECT CASE year WHEN 1997 THEN 'train' WHEN 1998 THEN 'val' "
       "ELSE 'test' END AS split, count(*) AS n_rows, round(avg(label), 6) AS rate FROM entities GROUP BY 1")
def a7(t: Tables):
    from leadtime.operators.cleaning import temporal_split
    rows = temporal_split(t.entities, F.col("year"), OBS_YEARS)
    return profile.label_rates(rows, "label", ["split"]).withColumn("rate", F.round("rate", 6))


@query("a8_time_profile", """
WITH r AS (SELECT o_orderpriority, CASE WHEN o_orderstatus = 'F' THEN NULL ELSE o_orderdate END AS seen_at FROM orders)
SELECT o_orderpriority, count(*) AS n_rows, count(seen_at) AS n_valid, round(100.0 * count(seen_at) / count(*), 6)::DOUBLE AS pct_valid,
  min(seen_at)::DATE::VARCHAR AS first_time, max(seen_at)::DATE::VARCHAR AS last_time, count(*) - count(seen_at) AS n_missing
FROM r GROUP BY 1""")
def a8(t: Tables):
    raw = t.orders.withColumn("at", F.when(F.col("o_orderstatus") != "F", F.col("o_orderdate")))
    df = profile.time_profile(raw, "at", ["o_orderpriority"])
    return df.withColumns({"pct_valid": F.round("pct_valid", 6), "first_time": F.to_date("first_time").cast("string"),
                           "last_time": F.to_date("last_time").cast("string")})


@query("a9_label_audit", f"WITH {q.DATES} SELECT obs_date::VARCHAR AS obs_date, count(*) AS n_events, "
       f"count(DISTINCT o_custkey) AS n_entities FROM orders JOIN dates ON o_orderdate > obs_date "
       f"AND o_orderdate <= obs_date + INTERVAL 6 MONTH WHERE {q.URGENT} GROUP BY 1")
def a9(t: Tables):
    return text_dates(pit.label_audit(t.urgent, "o_custkey", "o_orderdate", OBS_DATES, 6))


@query("a10_distinct_years", "SELECT DISTINCT year(o_orderdate)::INTEGER AS year FROM orders")
def a10(t: Tables):
    return profile.distinct_sorted(t.orders, F.year("o_orderdate"), "year")


@query("a11_imbalance_weight", "SELECT count(*) FILTER (WHERE quality = 1) AS n_pos, count(*) FILTER (WHERE quality = 0) "
       "AS n_neg, round(count(*) FILTER (WHERE quality = 0) / greatest(count(*) FILTER (WHERE quality = 1), 1), 6)::DOUBLE "
       "AS weight FROM labels")
def a11(t: Tables):
    return profile.imbalance_weight(t.labels, "quality").withColumn("weight", F.round("weight", 6))


@query("a12_fingerprint", "SELECT count(*) AS n_rows, sum(CAST('0x' || substr(md5(concat_ws('|', " + ", ".join(
    f"coalesce(length({c}::VARCHAR) || ':' || {c}, '~')" for c in ("l_orderkey", "l_linenumber", "l_returnflag", "l_partkey"))
       + ")), 1, 15) AS BIGINT))::VARCHAR AS hash_sum FROM lineitem")
def a12(t: Tables):
    return profile.fingerprint(t.lineitem, ["l_orderkey", "l_linenumber", "l_returnflag", "l_partkey"])


@query("a13_leaderboard", """
SELECT user_id, round(arg_max(value, ts) FILTER (WHERE event_type = 'click'), 6) AS click,
  round(arg_max(value, ts) FILTER (WHERE event_type = 'purchase'), 6) AS purchase,
  round(arg_max(value, ts) FILTER (WHERE event_type = 'view'), 6) AS "view" FROM events GROUP BY 1""")
def a13(t: Tables):
    df = profile.leaderboard(t.events, "user_id", "event_type", "value", "ts", ["click", "purchase", "view"])
    return df.withColumns({c: F.round(c, 6) for c in ("click", "purchase", "view")})


@query("a14_means", "SELECT round(avg(l_quantity), 6) AS mean_l_quantity, round(avg(l_tax), 6) AS mean_l_tax FROM lineitem")
def a14(t: Tables):
    df = profile.means(t.lineitem, ["l_quantity", "l_tax"])
    return df.select(*[F.round(c, 6).alias(c) for c in df.columns])


@query("a15_column_profile", """
WITH s AS (SELECT CASE WHEN o_orderdate < DATE '1998-01-01' THEN 'ref' ELSE 'cur' END AS side, o_totalprice, o_custkey FROM orders),
long AS (SELECT side, 'o_totalprice' AS feature, o_totalprice AS value FROM s
  UNION ALL SELECT side, 'o_custkey', o_custkey::DOUBLE FROM s)
SELECT side, feature, count(*) AS n_rows, 0.0::DOUBLE AS null_share, round(avg(value), 6) AS mean,
  round(stddev_pop(value), 4) AS std, min(value) AS min, max(value) AS max, quantile_disc(value, 0.25) AS q25,
  quantile_disc(value, 0.5) AS q50, quantile_disc(value, 0.75) AS q75, count(DISTINCT value) AS n_distinct
FROM long GROUP BY 1, 2""")
def a15(t: Tables):
    side = F.when(F.col("o_orderdate") < F.lit("1998-01-01").cast("date"), "ref").otherwise("cur")
    df = profile.column_profile(t.orders.withColumn("side", side), ["o_totalprice", "o_custkey"], "side")
    return df.withColumns({"mean": F.round("mean", 6), "std": F.round("std", 4)})


# --- composites

@query("f1_history_flag", feats_sql("CASE WHEN NB_HOSP_PASSEES > 0 THEN 1 ELSE 0 END AS HAS_HOSP_HISTORY"))
def f1(t: Tables):
    return comp.presence_flags(all_features(t), {"HAS_HOSP_HISTORY": ("NB_HOSP_PASSEES", 0)}).select(*IDS, "HAS_HOSP_HISTORY")


@query("f2_many_codes_flag", feats_sql("CASE WHEN NB_MOLECULES_UNIQUES > 5 THEN 1 ELSE 0 END AS POLYPHARMACIE"))
def f2(t: Tables):
    df = comp.presence_flags(all_features(t), {"POLYPHARMACIE": ("NB_MOLECULES_UNIQUES", fv.MANY_CODES)})
    return df.select(*IDS, "POLYPHARMACIE")


@query("f3_activity_totals", feats_sql(", ".join(
    f"(NB_HOSP_{m}M + NB_OP_{m}M + NB_CAR_{m}M + NB_RX_{m}M)::DOUBLE AS UTILISATION_{m}M" for m in (3, 6, 12))))
def f3(t: Tables):
    return comp.activity_totals(all_features(t), rf.TOTALS).select(*IDS, *rf.TOTALS)


@query("f4_smoothed_ratios", feats_sql("round(NB_RX_12M / (NB_OP_12M + 1), 6)::DOUBLE AS RATIO_RX_OP_12M, "
                                       "round(NB_CAR_12M / (NB_OP_12M + 1), 6)::DOUBLE AS RATIO_CAR_OP_12M"))
def f4(t: Tables):
    ratios = {"RATIO_RX_OP_12M": ("NB_RX_12M", "NB_OP_12M"), "RATIO_CAR_OP_12M": ("NB_CAR_12M", "NB_OP_12M")}
    df = comp.smoothed_ratios(all_features(t), ratios)
    return df.select(*IDS, *[F.round(c, 6).alias(c) for c in ratios])


@query("f5_flag_variants", f"WITH {q.COHORT}, {q.ENTITIES} SELECT entity, year::INTEGER AS year, "
       "CASE WHEN flag_low = 1 THEN 1 ELSE 0 END AS by_code, least(greatest(flag_low, 0), 1)::INTEGER AS clipped FROM entities")
def f5(t: Tables):
    return t.entities.select(KEY, "year", code_flag(F.col("flag_low")).alias("by_code"),
                             clip_flag(F.col("flag_low")).alias("clipped"))


@query("f6_newcomer_variants", feats_sql(
    "CASE WHEN NB_HOSP_PASSEES = 0 AND NB_OP_TOTAL_PASSE = 0 AND NB_CAR_TOTAL_PASSE = 0 AND NB_PRESCRIPTIONS = 0 "
    "THEN 1 ELSE 0 END AS by_totals, CASE WHEN NB_HOSP_PASSEES = 0 AND NB_OP_12M = 0 AND NB_PRESCRIPTIONS = 0 "
    "THEN 1 ELSE 0 END AS by_year"))
def f6(t: Tables):
    df = comp.newcomer_flag(all_features(t), ["NB_HOSP_PASSEES", "NB_OP_TOTAL_PASSE", "NB_CAR_TOTAL_PASSE",
                                              "NB_PRESCRIPTIONS"], "by_totals")
    return comp.newcomer_flag(df, ["NB_HOSP_PASSEES", "NB_OP_12M", "NB_PRESCRIPTIONS"], "by_year").select(
        *IDS, "by_totals", "by_year")


_FLAG1 = {c: f"CASE WHEN {c} = 1 THEN 1 ELSE 0 END" for c in FLAG_CODES}


@query("f7_flag_count", f"WITH {q.COHORT}, {q.ENTITIES} SELECT entity, year::INTEGER AS year, "
       f"{' + '.join(_FLAG1.values())} AS n_conditions FROM entities")
def f7(t: Tables):
    df = t.entities.withColumns({c: code_flag(F.col(c)) for c in FLAG_CODES})
    df = comp.condition_burden(df, FLAG_WEIGHTS, "n_conditions", "index")
    return df.select(KEY, "year", "n_conditions")


@query("f8_weighted_index", f"WITH {q.COHORT}, {q.ENTITIES} SELECT entity, year::INTEGER AS year, "
       + " + ".join(f"{w} * {_FLAG1[c]}" for c, w in FLAG_WEIGHTS.items()) + " AS index FROM entities")
def f8(t: Tables):
    df = t.entities.withColumns({c: code_flag(F.col(c)) for c in FLAG_CODES})
    return comp.condition_burden(df, FLAG_WEIGHTS, "n_conditions", "index").select(KEY, "year", "index")


@query("f9_cost_rollup", f"WITH {q.COHORT}, {q.ENTITIES} SELECT entity, year::INTEGER AS year, "
       "round(cost_balance + cost_nation, 2) AS cost FROM entities")
def f9(t: Tables):
    return cents(comp.cost_rollup(t.entities, COST_MARKS, "cost").select(KEY, "year", "cost"), "cost")


@query("f10_past_amounts", feats_sql("round(COUT_HOSP_PASSE + COUT_OP_PASSE + COUT_CAR_PASSE, 2) AS COUT_CLAIMS_PASSE"))
def f10(t: Tables):
    df = comp.sum_of(all_features(t), q.SUMMED, "COUT_CLAIMS_PASSE")
    return cents(df.select(*IDS, "COUT_CLAIMS_PASSE"), "COUT_CLAIMS_PASSE")


@query("f11_clip", "SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 0.0 WHEN c_acctbal > 120 THEN 120.0 ELSE c_acctbal END "
       "AS clipped FROM customer")
def f11(t: Tables):
    return t.customer.select("c_custkey", clip(F.col("c_acctbal"), 0.0, 120.0).alias("clipped"))


@query("f12_total_cost_variants", f"""
WITH {q.FEATS}, {q.ENTITIES} SELECT e.entity, e.obs_date::VARCHAR AS obs_date, round(cost_balance + cost_nation, 2) AS annual,
  round(cost_balance + cost_nation + COUT_HOSP_PASSE + COUT_OP_PASSE + COUT_CAR_PASSE, 2) AS with_past
FROM entities e JOIN feats f ON e.entity = f.entity AND e.obs_date = f.obs_date""")
def f12(t: Tables):
    cohort = comp.cost_rollup(t.entities.withColumn("obs_date", F.make_date("year", F.lit(1), F.lit(1))), COST_MARKS, "annual")
    wanted = [f for f in rf.FULL_FEATURES if f.kind == "sum"]
    df = pit.point_in_time(cohort, t.sources, wanted, OBS_DATES, KEY)
    df = comp.sum_of(df, ["annual", *q.SUMMED], "with_past")
    return cents(text_dates(df.select(*IDS, "annual", "with_past")), "annual", "with_past")


_BIN = "CASE WHEN x < 0 THEN NULL WHEN x <= 65 THEN {0} WHEN x <= 75 THEN {1} WHEN x <= 85 THEN {2} WHEN x <= 120 THEN {3} END"


@query("f13_right_closed_bins", "WITH s AS (SELECT c_custkey, floor(c_acctbal / 60.0) AS x FROM customer) "
       f"SELECT c_custkey, {_BIN.format(*[repr(x) for x in fv.AGE_LABELS])} AS age_group FROM s")
def f13(t: Tables):
    x = F.floor(F.col("c_acctbal") / 60.0)
    return t.customer.select("c_custkey", right_closed_bin(x, fv.AGE_EDGES, fv.AGE_LABELS).alias("age_group"))


@query("f14_ordinal_bins", "WITH s AS (SELECT c_custkey, floor(c_acctbal / 60.0) AS x FROM customer) "
       f"SELECT c_custkey, coalesce({_BIN.format(0.0, 1.0, 2.0, 3.0)}, 1.0)::DOUBLE AS age_code FROM s")
def f14(t: Tables):
    x = F.floor(F.col("c_acctbal") / 60.0)
    return t.customer.select("c_custkey", right_closed_ordinal(x, fv.AGE_EDGES).alias("age_code"))


@query("f15_encodings", f"WITH {q.COHORT}, {q.ENTITIES} SELECT entity, year::INTEGER AS year, sex_code::DOUBLE AS SEXE_ENC, "
       "race_code::DOUBLE AS RACE_ENC, 0.0::DOUBLE AS BENE_ESRD_IND FROM entities")
def f15(t: Tables):
    df = rf.prepare_entities(t.entities, "label", FLAG_WEIGHTS, COST_MARKS, "sex_code", "race_code")
    return df.select(KEY, "year", "SEXE_ENC", "RACE_ENC", "BENE_ESRD_IND")


_CLIP = {c: f"least(greatest({c}, 0), 1)" for c in FLAG_CODES}
_FULL_COLUMNS = (
    ", ".join(f"f.{c}" for c in q.COUNTED) + ", " + ", ".join(f"round(f.{c}, 2) AS {c}" for c in q.SUMMED)
    + ", CASE WHEN NB_HOSP_PASSEES > 0 THEN 1 ELSE 0 END AS HAS_HOSP_HISTORY"
    + ", CASE WHEN NB_MOLECULES_UNIQUES > 5 THEN 1 ELSE 0 END AS POLYPHARMACIE, "
    + ", ".join(f"(NB_HOSP_{m}M + NB_OP_{m}M + NB_CAR_{m}M + NB_RX_{m}M)::DOUBLE AS UTILISATION_{m}M" for m in (3, 6, 12))
    + ", CASE WHEN NB_HOSP_PASSEES + NB_OP_TOTAL_PASSE + NB_CAR_TOTAL_PASSE + NB_PRESCRIPTIONS = 0 THEN 1 ELSE 0 END AS IS_NEW_PATIENT"
    + ", round(NB_RX_12M / (NB_OP_12M + 1), 6)::DOUBLE AS RATIO_RX_OP_12M"
    + ", round(NB_CAR_12M / (NB_OP_12M + 1), 6)::DOUBLE AS RATIO_CAR_OP_12M, "
    + " + ".join(_CLIP.values()) + " AS NB_COMORBIDITES, "
    + " + ".join(f"{w} * {_CLIP[c]}" for c, w in FLAG_WEIGHTS.items()) + " AS CHARLSON_INDEX"
    + ", round(cost_balance + cost_nation, 2) AS COUT_BENEFICIARY_ANNUEL"
    + ", round(COUT_HOSP_PASSE + COUT_OP_PASSE + COUT_CAR_PASSE, 2) AS COUT_CLAIMS_PASSE"
    + ", round(cost_balance + cost_nation + COUT_HOSP_PASSE + COUT_OP_PASSE + COUT_CAR_PASSE, 2) AS COUT_TOTAL")


@query("f16_full_features", f"""
WITH {q.FEATS}, {q.ENTITIES}, aged AS (SELECT e.*, least(greatest(coalesce(AGE, (SELECT median(AGE) FROM entities), 70.0),
  0.0), 120.0) AS x FROM entities e)
SELECT e.entity, e.year::INTEGER AS year, e.label, {_FULL_COLUMNS}, round(x, 6) AS AGE,
  {_BIN.format(*[repr(x) for x in fv.AGE_LABELS])} AS GROUPE_AGE
FROM aged e JOIN feats f ON e.entity = f.entity AND e.obs_date = f.obs_date""")
def f16(t: Tables):
    df = rf.full_features(t.stored_entities, t.sources, list(OBS_YEARS), KEY, "year", FLAG_WEIGHTS, COST_MARKS)
    money = [*q.SUMMED, "COUT_BENEFICIARY_ANNUEL", "COUT_CLAIMS_PASSE", "COUT_TOTAL"]
    ratios = ["RATIO_RX_OP_12M", "RATIO_CAR_OP_12M", "AGE"]
    df = df.withColumns({**{c: F.round(c, 2) for c in money}, **{c: F.round(c, 6) for c in ratios}})
    return df.select(KEY, "year", "label", *q.COUNTED, *money, *ratios, "HAS_HOSP_HISTORY", "POLYPHARMACIE",
                     *rf.TOTALS, "IS_NEW_PATIENT", "NB_COMORBIDITES", "CHARLSON_INDEX", "GROUPE_AGE")


REDUCED = [f.name for f in rf.REDUCED_FEATURES]
_REDUCED_SQL = f"""{q.FEATS}, {q.ENTITIES}, made AS (SELECT e.entity, e.year::INTEGER AS year, e.label,
  {", ".join(f"f.{c}" for c in REDUCED)}, {", ".join(f"{x} AS {c}" for c, x in _FLAG1.items())},
  {" + ".join(_FLAG1.values())} AS NB_COMORBIDITES,
  {" + ".join(f"{w} * {_FLAG1[c]}" for c, w in FLAG_WEIGHTS.items())} AS CHARLSON_INDEX,
  cost_balance + cost_nation AS COUT_TOTAL, coalesce(AGE, 0.0) AS AGE, sex_code::DOUBLE AS SEXE_ENC,
  race_code::DOUBLE AS RACE_ENC, 0.0::DOUBLE AS BENE_ESRD_IND,
  CASE WHEN NB_HOSP_PASSEES = 0 AND NB_OP_12M = 0 AND NB_PRESCRIPTIONS = 0 THEN 1 ELSE 0 END AS IS_NEW_PATIENT,
  CASE WHEN NB_MOLECULES_UNIQUES > 5 THEN 1 ELSE 0 END AS POLYPHARMACIE,
  coalesce({_BIN.format(0.0, 1.0, 2.0, 3.0).replace("x ", "coalesce(AGE, 0.0) ")}, 1.0)::DOUBLE AS GROUPE_AGE_ENC
  FROM entities e JOIN feats f ON e.entity = f.entity AND e.obs_date = f.obs_date)"""
MODEL_COLUMNS = [*FLAG_CODES, "AGE", "SEXE_ENC", "RACE_ENC", "BENE_ESRD_IND", "GROUPE_AGE_ENC", "NB_COMORBIDITES",
                 "CHARLSON_INDEX", "COUT_TOTAL", "IS_NEW_PATIENT", *REDUCED, "POLYPHARMACIE"]


def model_table(t: Tables):
    return rf.reduced_features(t.stored_entities, t.sources, list(OBS_YEARS), KEY, "year", "label", FLAG_WEIGHTS,
                               cost_marks=COST_MARKS, sex="sex_code", race="race_code")


@query("f17_reduced_features", f"WITH {_REDUCED_SQL} SELECT entity, year, label, "
       + ", ".join(f"round({c}, 6)::DOUBLE AS {c}" for c in MODEL_COLUMNS) + " FROM made")
def f17(t: Tables):
    return model_table(t).select(KEY, "year", "label", *[F.round(F.col(c).cast("double"), 6).alias(c) for c in MODEL_COLUMNS])


# --- scaling

SCALED = [c for c in fv.SCALED_FEATURES if c in MODEL_COLUMNS]


def _moments(where: str) -> str:
    return "p AS (SELECT " + ", ".join(
        f"avg({c}) AS m_{c}, coalesce(nullif(stddev_pop({c}), 0), 1.0) AS s_{c}" for c in SCALED) + f" FROM made {where})"


def _scaled(c: str) -> str:
    return f"round(({c} - m_{c}) / s_{c}, 4)::DOUBLE + 0.0 AS {c}" if c in SCALED else f"round({c}, 4)::DOUBLE + 0.0 AS {c}"


def plain(name: str, digits: int):
    """Rounded, with a negative zero turned into zero."""
    return (F.round(name, digits) + F.lit(0.0)).alias(name)


@query("k1_standardise", """
WITH p AS (SELECT avg(o_totalprice) AS m, coalesce(nullif(stddev_pop(o_totalprice), 0), 1.0) AS s,
  avg(o_custkey) AS m2, coalesce(nullif(stddev_pop(o_custkey), 0), 1.0) AS s2 FROM orders)
SELECT o_orderkey, round((o_totalprice - m) / s, 6) + 0.0 AS o_totalprice, round((o_custkey - m2) / s2, 6) + 0.0 AS o_custkey,
  0.0::DOUBLE AS flat FROM orders, p""")
def k1(t: Tables):
    df = t.orders.select("o_orderkey", "o_totalprice", "o_custkey", F.lit(3.0).alias("flat"))
    out = scaling.apply_scaler(df, scaling.fit_scaler(df, ["o_totalprice", "o_custkey", "flat"]))
    return out.select("o_orderkey", *[plain(c, 6) for c in ("o_totalprice", "o_custkey", "flat")])


@query("k2_apply_stored_scaler", """
WITH p AS (SELECT avg(o_totalprice) AS m, stddev_pop(o_totalprice) AS s FROM orders WHERE o_orderdate < DATE '1998-01-01')
SELECT o_orderkey, round((o_totalprice - m) / s, 6) + 0.0 AS o_totalprice FROM orders, p WHERE o_orderdate >= DATE '1998-01-01'""")
def k2(t: Tables):
    day = F.lit("1998-01-01").cast("date")
    params = scaling.fit_scaler(t.orders.where(F.col("o_orderdate") < day), ["o_totalprice"])
    new = t.orders.where(F.col("o_orderdate") >= day).select("o_orderkey", "o_totalprice")
    return scaling.apply_scaler(new, params).withColumn("o_totalprice", plain("o_totalprice", 6))


@query("k3_split_and_scale", f"WITH {_REDUCED_SQL}, {_moments('WHERE year = 1997')} SELECT entity, year, label, "
       "CASE year WHEN 1997 THEN 'train' WHEN 1998 THEN 'val' ELSE 'test' END AS split, "
       + ", ".join(_scaled(c) for c in MODEL_COLUMNS) + " FROM made, p")
def k3(t: Tables):
    df, _ = rf.split_and_scale(model_table(t), KEY, "year", "label", OBS_YEARS, MODEL_COLUMNS)
    return df.select(KEY, "year", "label", "split", *[plain(c, 4) for c in MODEL_COLUMNS])


@query("k3_split_rates", f"WITH {q.COHORT}, {q.ENTITIES} SELECT CASE year WHEN 1997 THEN 'train' WHEN 1998 THEN 'val' ELSE "
       f"'test' END AS split, count(*) AS n_rows, round(avg(label), 6) AS rate, {len(MODEL_COLUMNS)}::INTEGER AS n_features "
       "FROM entities GROUP BY 1")
def k3_rates(t: Tables):
    df, _ = rf.split_and_scale(model_table(t), KEY, "year", "label", OBS_YEARS, MODEL_COLUMNS)
    return profile.label_rates(df, "label", ["split"]).select(
        "split", "n_rows", F.round("rate", 6).alias("rate"), F.lit(len(MODEL_COLUMNS)).alias("n_features"))


@query("k6_prepare_training", """
WITH p AS (SELECT avg(value) AS m, stddev_pop(value) AS s FROM events)
SELECT event_id, CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS label, round((value - m) / s, 6) + 0.0 AS value,
  user_id::DOUBLE AS user_id, 0.0::DOUBLE AS not_there FROM events, p""")
def k6(t: Tables):
    raw = t.events.withColumn("label", flag(F.col("event_type") == "error"))
    df, _ = scaling.prepare_training(raw, ["value", "user_id", "not_there"], ["value"], ["event_id", "label"])
    return df.withColumn("value", plain("value", 6))


@query("k7_prepare_inference", """
WITH p AS (SELECT avg(value) AS m, stddev_pop(value) AS s FROM events WHERE event_type <> 'error')
SELECT event_id, round((value - m) / s, 6) + 0.0 AS value, 0.0::DOUBLE AS not_there FROM events, p WHERE event_type = 'error'""")
def k7(t: Tables):
    params = scaling.fit_scaler(t.events.where(F.col("event_type") != "error"), ["value"])
    new = t.events.where(F.col("event_type") == "error")
    df = scaling.prepare_inference(new, ["value", "not_there"], params, ["event_id"])
    return df.withColumn("value", plain("value", 6))

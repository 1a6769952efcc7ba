"""Common table expressions shared by the SQL twins."""

from __future__ import annotations

DATES = "dates(obs_date) AS (VALUES (DATE '1997-01-01'), (DATE '1998-01-01'), (DATE '1999-01-01'))"
COHORT = DATES + ", cohort AS (SELECT c_custkey AS entity, obs_date FROM customer CROSS JOIN dates)"
LINES = "lines AS (SELECT l.*, o_custkey AS entity FROM lineitem l JOIN orders ON l_orderkey = o_orderkey)"
URGENT = "o_orderpriority IN ('1-URGENT', '2-HIGH')"


def unit_hash(text: str) -> str:
    """md5 of the text as a number in [0, 1)."""
    return f"(CAST('0x' || substr(md5({text}), 1, 8) AS BIGINT) / 4294967296.0)"


EVENTS = LINES + """,
ip AS (SELECT o_custkey AS entity, o_orderdate AS ts, o_totalprice AS amt, o_orderpriority AS code FROM orders),
op AS (SELECT entity, l_shipdate AS ts, l_extendedprice AS amt FROM lines WHERE l_returnflag = 'R'),
car AS (SELECT entity, l_shipdate AS ts, l_extendedprice AS amt FROM lines WHERE l_returnflag IN ('A', 'N')),
rx AS (SELECT entity, l_shipdate AS ts, l_partkey AS code FROM lines)"""


def _per_source(name: str, source: str, mark: str, count: str, last: str, cost: str | None, extra: str = "") -> str:
    trailing = ", ".join(
        f"count(*) FILTER (WHERE ts >= obs_date - INTERVAL {m} MONTH) AS NB_{mark}_{m}M" for m in (3, 6, 12))
    money = f", sum(amt) AS {cost}" if cost else ""
    return (f"{name} AS (SELECT entity, obs_date, count(*) AS {count}, {trailing}, "
            f"date_diff('day', max(ts)::DATE, obs_date) AS {last}{money}{extra} "
            f"FROM {source} JOIN dates ON ts < obs_date GROUP BY entity, obs_date)")


COUNTED = [
    "NB_HOSP_PASSEES", "DAYS_SINCE_LAST_HOSP", "NB_HOSP_3M", "NB_HOSP_6M", "NB_HOSP_12M", "NB_OP_3M", "NB_OP_6M",
    "NB_OP_12M", "NB_CAR_3M", "NB_CAR_6M", "NB_CAR_12M", "NB_RX_3M", "NB_RX_6M", "NB_RX_12M", "NB_OP_TOTAL_PASSE",
    "NB_CAR_TOTAL_PASSE", "NB_PRESCRIPTIONS", "DAYS_SINCE_LAST_OP", "DAYS_SINCE_LAST_CAR", "DAYS_SINCE_LAST_RX",
    "NB_MOLECULES_UNIQUES",
]
SUMMED = ["COUT_HOSP_PASSE", "COUT_OP_PASSE", "COUT_CAR_PASSE"]

# every event feature of the cohort
FEATS = ",\n".join([
    COHORT, EVENTS,
    _per_source("f_ip", "ip", "HOSP", "NB_HOSP_PASSEES", "DAYS_SINCE_LAST_HOSP", "COUT_HOSP_PASSE"),
    _per_source("f_op", "op", "OP", "NB_OP_TOTAL_PASSE", "DAYS_SINCE_LAST_OP", "COUT_OP_PASSE"),
    _per_source("f_car", "car", "CAR", "NB_CAR_TOTAL_PASSE", "DAYS_SINCE_LAST_CAR", "COUT_CAR_PASSE"),
    _per_source("f_rx", "rx", "RX", "NB_PRESCRIPTIONS", "DAYS_SINCE_LAST_RX", None,
                ", count(DISTINCT code) AS NB_MOLECULES_UNIQUES"),
    "feats AS (SELECT entity, obs_date, "
    + ", ".join(f"coalesce({c}, 0) AS {c}" for c in COUNTED + SUMMED)
    + " FROM cohort LEFT JOIN f_ip USING (entity, obs_date) LEFT JOIN f_op USING (entity, obs_date)"
      " LEFT JOIN f_car USING (entity, obs_date) LEFT JOIN f_rx USING (entity, obs_date))",
])

LABEL = (f"label AS (SELECT DISTINCT o_custkey AS entity, obs_date FROM orders JOIN dates "
         f"ON o_orderdate > obs_date AND o_orderdate <= obs_date + INTERVAL 6 MONTH WHERE {URGENT})")

FLAGS = {"flag_urgent": "1-URGENT", "flag_high": "2-HIGH", "flag_medium": "3-MEDIUM", "flag_open": "4-NOT SPECIFIED",
         "flag_low": "5-LOW"}
# customer-years with raw codes, needs COHORT
ENTITIES = LABEL + """,
seen AS (SELECT o_custkey AS entity, """ + ", ".join(
    f"max(CASE WHEN o_orderpriority = '{p}' THEN 1 ELSE 0 END) AS {c}" for c, p in FLAGS.items()) + """
  FROM orders WHERE o_orderdate < DATE '1997-01-01' GROUP BY 1),
entities AS (SELECT c.entity, c.obs_date, year(c.obs_date) AS year,
  CASE WHEN c_nationkey < 12 THEN 1 ELSE 2 END AS sex_code, c_nationkey AS race_code, c_acctbal AS cost_balance,
  c_nationkey::DOUBLE AS cost_nation, CASE WHEN c_acctbal >= 0 THEN 60.0 + c_acctbal / 150.0 END AS AGE, """ + ", ".join(
    f"CASE WHEN {c} = 1 THEN 1 ELSE 2 END AS {c}" for c in FLAGS) + """,
  CASE WHEN label.entity IS NULL THEN 0 ELSE 1 END AS label
  FROM cohort c JOIN customer ON c.entity = c_custkey LEFT JOIN seen ON seen.entity = c.entity
  LEFT JOIN label ON label.entity = c.entity AND label.obs_date = c.obs_date)"""

PRED = f"""pred AS (SELECT doc_id, lang, source, quality AS label, toxic,
  CASE WHEN {unit_hash("doc_id || '|split'")} < 0.66 THEN 'validation' ELSE 'test' END AS split,
  round(n_chars / (n_chars + 2000.0), 4)::DOUBLE AS p_len, round({unit_hash("doc_id || '|s'")}, 6)::DOUBLE AS p_hash,
  round(0.5 * round(n_chars / (n_chars + 2000.0), 4) + 0.5 * {unit_hash("source || '|s'")}, 4)::DOUBLE AS p_src
  FROM labels JOIN documents USING (doc_id))"""

REQ = """req AS (SELECT ts, event_type AS endpoint, user_id, event_id,
  CASE WHEN event_type = 'error' THEN 500 ELSE 200 END AS status, value / 1000.0 AS latency_s, value / 500.0 AS score,
  props FROM events)"""


def counts(by: str = "", score: str = "p_len", threshold: float | str = 0.5, table: str = "pred") -> str:
    """Confusion counts of a score column."""
    keys = f"{by}, " if by else ""
    group = f" GROUP BY {by}" if by else ""
    return (f"SELECT {keys}count(*) FILTER (WHERE {score} >= {threshold} AND label = 1) AS tp, "
            f"count(*) FILTER (WHERE {score} >= {threshold} AND label = 0) AS fp, "
            f"count(*) FILTER (WHERE {score} < {threshold} AND label = 0) AS tn, "
            f"count(*) FILTER (WHERE {score} < {threshold} AND label = 1) AS fn FROM {table}{group}")


RATES = ("tp + fp AS predicted_positive, round(coalesce(tp / nullif(tp + fp, 0), 0), 6)::DOUBLE AS precision, "
         "round(coalesce(tp / nullif(tp + fn, 0), 0), 6)::DOUBLE AS recall, "
         "round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 6)::DOUBLE AS f1, "
         "round(coalesce((tp + tn) / nullif(tp + fp + tn + fn, 0), 0), 6)::DOUBLE AS accuracy")


def auc(by: str = "", score: str = "p_len", table: str = "pred") -> str:
    """AUC by comparing every positive with every negative: the definition, not the running-total form."""
    keys = f"a.{by} AS {by}, " if by else ""
    same = f" AND a.{by} IS NOT DISTINCT FROM b.{by}" if by else ""
    group = f" GROUP BY a.{by}" if by else ""
    return (f"SELECT {keys}sum(CASE WHEN a.{score} > b.{score} THEN 1.0 WHEN a.{score} = b.{score} THEN 0.5 ELSE 0.0 END)"
            f" / count(*) AS auc_roc FROM {table} a JOIN {table} b ON a.label = 1 AND b.label = 0{same}{group}")


# one row per distinct score as threshold, needs PRED
CURVE = """steps AS (SELECT p_len AS threshold, count(*) FILTER (WHERE label = 1) AS pos,
  count(*) FILTER (WHERE label = 0) AS neg FROM pred GROUP BY 1),
runs AS (SELECT threshold, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, sum(pos) OVER () AS P, sum(neg) OVER () AS N
  FROM steps WINDOW w AS (ORDER BY threshold DESC)),
curve AS (SELECT threshold, tp, fp, N - fp AS tn, P - tp AS fn, tp + fp AS predicted_positive,
  tp / (tp + fp) AS precision, coalesce(tp / nullif(P, 0), 0) AS recall FROM runs)"""

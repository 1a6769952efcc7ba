"""Evaluation, ensembles, scoring."""

from __future__ import annotations

from pyspark.sql import functions as F

from leadtime import fixed_values as fv
from leadtime.operators import ensembles as en
from leadtime.operators import evaluation as ev
from leadtime.operators import profile, scoring
from leadtime.plans.bindings import Tables
from leadtime.plans.catalog import query
from leadtime.plans.catalog import sql as q

SCORES = ["p_len", "p_hash", "p_src"]
RATES = ["precision", "recall", "f1", "accuracy"]


def rounded(df, *names, digits=6):
    return df.withColumns({c: F.round(c, digits) for c in names})


@query("e1_predict_at", f"WITH {q.PRED} SELECT doc_id, (p_len >= 0.25)::INTEGER AS predicted FROM pred")
def e1(t: Tables):
    return t.predictions.select("doc_id", ev.predict_at(F.col("p_len"), 0.25).alias("predicted"))


@query("e2_confusion", f"WITH {q.PRED} {q.counts('split')}")
def e2(t: Tables):
    return ev.confusion(t.predictions, "label", "p_len", 0.5, ["split"])


@query("e3_rates", f"WITH {q.PRED}, c AS ({q.counts('split')}) SELECT split, tp, fp, tn, fn, {q.RATES} FROM c")
def e3(t: Tables):
    return rounded(ev.with_rates(ev.confusion(t.predictions, "label", "p_len", 0.5, ["split"])), *RATES)


@query("e4_roc_auc", f"WITH {q.PRED}, a AS ({q.auc('split')}) SELECT split, round(auc_roc, 6)::DOUBLE AS auc_roc FROM a")
def e4(t: Tables):
    return ev.roc_auc(t.predictions, "label", "p_len", ["split"]).select("split", F.round("auc_roc", 6).alias("auc_roc"))


@query("e4_roc_auc_orders", """
WITH s AS (SELECT o_totalprice AS score, CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 1 ELSE 0 END AS y FROM orders),
g AS (SELECT score, sum(y) AS pos, sum(1 - y) AS neg FROM s GROUP BY 1),
r AS (SELECT pos, neg, coalesce(sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM g)
SELECT sum(pos)::BIGINT AS n_pos, sum(neg)::BIGINT AS n_neg,
  round(sum(pos * (below + neg / 2.0)) / (sum(pos) * sum(neg)::DOUBLE), 6)::DOUBLE AS auc_roc FROM r""")
def e4_orders(t: Tables):
    rows = t.orders.select("o_totalprice", F.col("o_orderpriority").isin("1-URGENT", "2-HIGH").cast("int").alias("y"))
    return rounded(ev.roc_auc(rows, "y", "o_totalprice"), "auc_roc")


@query("e5_threshold_sweep", f"WITH {q.PRED}, th(threshold) AS (VALUES "
       + ", ".join(f"({x}::DOUBLE)" for x in fv.SWEEP_THRESHOLDS) + "), j AS (SELECT * FROM pred, th), "
       f"c AS ({q.counts('split, threshold', threshold='threshold', table='j')}) "
       f"SELECT split, threshold, tp, fp, tn, fn, {q.RATES} FROM c")
def e5(t: Tables):
    return rounded(ev.threshold_sweep(t.predictions, "label", "p_len", by=["split"]), *RATES)


@query("e6_pr_curve", f"WITH {q.PRED}, {q.CURVE} SELECT threshold, tp::BIGINT AS tp, fp::BIGINT AS fp, "
       "round(precision, 6)::DOUBLE AS precision, round(recall, 6)::DOUBLE AS recall FROM curve")
def e6(t: Tables):
    curve = ev.pr_curve(t.predictions, "label", "p_len")
    return rounded(curve.select("threshold", "tp", "fp", "precision", "recall"), "precision", "recall")


@query("e7_threshold_for_recall", f"WITH {q.PRED}, {q.CURVE} SELECT max(threshold) AS threshold FROM curve WHERE recall >= 0.95")
def e7(t: Tables):
    return ev.threshold_for_recall(ev.pr_curve(t.predictions, "label", "p_len"))


@query("e8_thresholds_for_precision", f"""
WITH {q.PRED}, {q.CURVE}, want(target) AS (VALUES {", ".join(f"({x}::DOUBLE)" for x in fv.PRECISION_TARGETS)}),
r AS (SELECT target, c.*, row_number() OVER (PARTITION BY target ORDER BY recall DESC, threshold DESC) AS rn
  FROM want JOIN curve c ON precision >= target AND predicted_positive >= 50)
SELECT want.target, rn IS NOT NULL AS achievable, threshold, round(precision, 6)::DOUBLE AS precision,
  round(recall, 6)::DOUBLE AS recall, coalesce(predicted_positive, 0)::BIGINT AS predicted_positive
FROM want LEFT JOIN r ON want.target = r.target AND rn = 1""")
def e8(t: Tables):
    curve = ev.pr_curve(t.predictions, "label", "p_len")
    found = ev.thresholds_for_precision(curve, fv.PRECISION_TARGETS).fillna(0, ["predicted_positive"])
    return rounded(found, "precision", "recall")


@query("e9_best_f_beta", f"""
WITH {q.PRED}, {q.CURVE}, f AS (SELECT threshold, coalesce(5 * precision * recall / nullif(4 * precision + recall, 0), 0) AS fbeta
  FROM curve) SELECT threshold, round(fbeta, 6)::DOUBLE AS fbeta FROM f ORDER BY fbeta DESC, threshold DESC LIMIT 1""")
def e9(t: Tables):
    return rounded(ev.best_f_beta(ev.pr_curve(t.predictions, "label", "p_len"), 2.0), "fbeta")


_MODELS = f"""long AS (SELECT 'p_len' AS model, label, p_len AS p, split FROM pred UNION ALL SELECT 'p_hash', label, p_hash, split
  FROM pred UNION ALL SELECT 'p_src', label, p_src, split FROM pred),
a AS ({q.auc('model', 'p', 'long')}), c AS ({q.counts('model', 'p', 0.25, 'long')}),
m AS (SELECT model, auc_roc, coalesce(tp / nullif(tp + fn, 0), 0) AS recall FROM a JOIN c USING (model))"""


def long_scores(t: Tables):
    """One row per document and model."""
    pairs = F.array(*[F.struct(F.lit(c).alias("model"), F.col(c).alias("p")) for c in SCORES])
    return t.predictions.select("doc_id", "label", "split", F.explode(pairs).alias("x")).select(
        "doc_id", "label", "split", "x.model", "x.p")


@query("e10_select_candidate", f"WITH {q.PRED}, {_MODELS} SELECT model, round(recall, 6)::DOUBLE AS recall, "
       "round(auc_roc, 6)::DOUBLE AS auc_roc FROM m WHERE auc_roc >= 0.4 AND recall >= 0.5 "
       "ORDER BY recall DESC, auc_roc DESC, model DESC LIMIT 1")
def e10(t: Tables):
    metrics = ev.metrics_at(long_scores(t), "label", "p", 0.25, ["model"])
    return rounded(ev.select_candidate(metrics, "model", 0.4, 0.5), "recall", "auc_roc")


@query("e11_class_report", f"""
WITH {q.PRED}, c AS ({q.counts()}), r AS (
  SELECT '0' AS "class", coalesce(tn / nullif(tn + fn, 0), 0) AS precision, coalesce(tn / nullif(tn + fp, 0), 0) AS recall,
    coalesce(2 * tn / nullif(2 * tn + fn + fp, 0), 0) AS f1, tn + fp AS support FROM c
  UNION ALL SELECT '1', coalesce(tp / nullif(tp + fp, 0), 0), coalesce(tp / nullif(tp + fn, 0), 0),
    coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), tp + fn FROM c),
w AS (SELECT * FROM r UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), sum(support) FROM r
  UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
    sum(f1 * support) / sum(support), sum(support) FROM r)
SELECT "class", round(precision, 6)::DOUBLE AS precision, round(recall, 6)::DOUBLE AS recall, round(f1, 6)::DOUBLE AS f1,
  support::BIGINT AS support FROM w""")
def e11(t: Tables):
    return rounded(ev.class_report(t.predictions, "label", "p_len"), "precision", "recall", "f1")


@query("e12_performance_check", f"""
WITH {q.PRED}, c AS ({q.counts(threshold=0.25)}), a AS ({q.auc()}) SELECT true AS model_available,
  round(tp / (tp + fn), 4)::DOUBLE AS recall, round(auc_roc, 4)::DOUBLE AS auc_roc, 0.25::DOUBLE AS threshold,
  tp + fp + tn + fn AS n_samples FROM c, a""")
def e12(t: Tables):
    return ev.performance_check(t.predictions, "label", "p_len", 0.25)


@query("e13_validation_metrics", f"""
WITH {q.PRED}, c AS ({q.counts('split')}), a AS ({q.auc('split')}) SELECT split, round(auc_roc, 6)::DOUBLE AS auc_roc,
  round(coalesce(tp / nullif(tp + fn, 0), 0), 6)::DOUBLE AS recall, tp + fp + tn + fn AS n_samples FROM c JOIN a USING (split)""")
def e13(t: Tables):
    return rounded(ev.validation_metrics(t.predictions, "label", "p_len", ["split"]), "auc_roc", "recall")


@query("e14_trial_scores", f"WITH {q.PRED}, {_MODELS}, c5 AS ({q.counts('model', 'p', 0.5, 'long')}) SELECT model, "
       "round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 6)::DOUBLE AS trial_score FROM c5")
def e14(t: Tables):
    return rounded(ev.trial_score(long_scores(t), "label", "p", 0.5, "f1", ["model"]), "trial_score")


_COEF = {"l_quantity": 0.02, "l_discount": -3.0, "l_tax": 1.5, "l_linenumber": 0.1}
_CONTRIB = "m AS (SELECT " + ", ".join(f"avg({c}) AS m_{c}" for c in _COEF) + " FROM lineitem)"


def contributions(t: Tables):
    return ev.linear_contributions(t.lineitem, _COEF, ["l_orderkey"])


@query("e15_contribution_ranking", f"WITH {_CONTRIB} " + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, round(avg(abs({w} * ({c} - m_{c}))), 6)::DOUBLE AS mean_abs FROM lineitem, m" for c, w in _COEF.items()))
def e15(t: Tables):
    return rounded(ev.contribution_ranking(contributions(t), list(_COEF)), "mean_abs")


_COEF_ORDER = {"p_len": 2.0, "p_hash": -1.0, "p_src": 1.0}


@query("e16_highest_risk_contributions", f"""
WITH {q.PRED}, m AS (SELECT avg(p_len) AS a, avg(p_hash) AS b, avg(p_src) AS c FROM pred),
top AS (SELECT doc_id, 2.0 * (p_len - a) AS p_len, -1.0 * (p_hash - b) AS p_hash, 1.0 * (p_src - c) AS p_src,
  round(2.0 * (p_len - a) - (p_hash - b) + (p_src - c), 9) AS score FROM pred, m ORDER BY score DESC, doc_id LIMIT 10),
long AS (SELECT doc_id, 'p_len' AS feature, p_len AS contribution FROM top UNION ALL SELECT doc_id, 'p_hash', p_hash FROM top
  UNION ALL SELECT doc_id, 'p_src', p_src FROM top),
r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY abs(contribution) DESC, feature DESC) AS rank FROM long)
SELECT doc_id, rank::INTEGER AS rank, feature, round(contribution, 6)::DOUBLE AS contribution FROM r WHERE rank <= 2""")
def e16(t: Tables):
    c = ev.linear_contributions(t.predictions, _COEF_ORDER, ["doc_id"])
    scored = c.withColumn("score", F.round(F.col("p_len") + F.col("p_hash") + F.col("p_src"), 9))
    top = ev.highest_risk_contributions(scored, list(_COEF_ORDER), "score", ["doc_id"], 10, 2)
    return rounded(top.drop("score"), "contribution")


@query("w2_top_k_per_group", """
SELECT o_custkey, o_orderkey, o_totalprice, rank::INTEGER AS rank FROM (SELECT *, row_number() OVER (
  PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rank FROM orders) WHERE rank <= 3""")
def w2(t: Tables):
    rows = t.orders.select("o_custkey", "o_orderkey", "o_totalprice")
    return ev.top_k_per_group(rows, ["o_custkey"], "o_totalprice", 3, ["o_orderkey"])


@query("w6_running_counts", """
WITH g AS (SELECT o_totalprice AS score, count(*) AS n FROM orders GROUP BY 1)
SELECT score, n, (sum(n) OVER (ORDER BY score) - n)::BIGINT AS before FROM g""")
def w6(t: Tables):
    from leadtime.operators.prefix import add_before, bounds_of, with_bucket
    g = t.orders.groupBy(F.col("o_totalprice").alias("score")).agg(F.count("*").alias("n"))
    g = with_bucket(g, "score", bounds_of(g, "score"))
    return add_before(g, {"before": "n"}, ["score"]).select("score", "n", "before")


@query("w7_sorted_importance", f"WITH {_CONTRIB}, r AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, avg(abs({w} * ({c} - m_{c}))) AS v FROM lineitem, m" for c, w in _COEF.items())
    + ") SELECT feature, row_number() OVER (ORDER BY v DESC, feature)::INTEGER AS place FROM r")
def w7(t: Tables):
    ranked = ev.contribution_ranking(contributions(t), list(_COEF))
    # one row per feature: the whole ranking is one short array
    names = F.transform(F.sort_array(F.collect_list(F.struct((-F.col("mean_abs")).alias("v"), "feature"))), lambda x: x["feature"])
    return ranked.agg(names.alias("f")).select(F.posexplode("f").alias("place", "feature")).withColumn("place", F.col("place") + 1)


# --- ensembles

@query("m5_soft_vote", f"WITH {q.PRED}, v AS (SELECT doc_id, (0.3 * p_len + 0.7 * p_src) / 1.0 AS p FROM pred) "
       "SELECT doc_id, round(p, 6)::DOUBLE AS p_vote, (p > 0.5)::INTEGER AS predicted FROM v")
def m5(t: Tables):
    df = en.soft_vote(t.predictions, ["p_len", "p_src"], [0.3, 0.7]).select("doc_id", "p_vote", "predicted")
    return rounded(df, "p_vote")


GRID = en.simplex_grid(3, 10)


@query("m6_blend_objectives", f"WITH {q.PRED}, g(weight_id, a, b, c) AS (VALUES "
       + ", ".join(f"({i}, {a}, {b}, {c})" for i, (a, b, c) in enumerate(GRID))
       + "), j AS (SELECT weight_id, label, round(a * p_len + b * p_hash + c * p_src, 12) AS p FROM pred, g), "
       f"k AS ({q.counts('weight_id', 'p', 0.5, 'j')}) SELECT weight_id::INTEGER AS weight_id, "
       "round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 6)::DOUBLE AS objective FROM k")
def m6_all(t: Tables):
    return rounded(en.blend_objectives(t.predictions, "label", SCORES, GRID), "objective")


@query("m6_search_weights", f"WITH {q.PRED}, g(weight_id, a, b, c) AS (VALUES "
       + ", ".join(f"({i}, {a}, {b}, {c})" for i, (a, b, c) in enumerate(GRID))
       + "), j AS (SELECT weight_id, label, round(a * p_len + b * p_hash + c * p_src, 12) AS p FROM pred, g), "
       f"k AS ({q.counts('weight_id', 'p', 0.5, 'j')}), f AS (SELECT weight_id, coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0) "
       "AS o FROM k) SELECT weight_id::INTEGER AS weight_id, round(o, 6)::DOUBLE AS objective, a::DOUBLE AS w_p_len, "
       "b::DOUBLE AS w_p_hash, c::DOUBLE AS w_p_src FROM f JOIN g USING (weight_id) ORDER BY o DESC, weight_id LIMIT 1")
def m6(t: Tables):
    return rounded(en.search_weights(t.predictions, "label", SCORES, GRID), "objective")


@query("m6_search_weights_auc", f"WITH {q.PRED}, g(weight_id, a, b) AS (VALUES "
       + ", ".join(f"({i}, {a}, {b})" for i, (a, b) in enumerate(en.simplex_grid(2, 4)))
       + "), j AS (SELECT weight_id, label, round(a * p_len + b * p_hash, 12) AS p FROM pred, g), "
       f"k AS ({q.auc('weight_id', 'p', 'j')}) SELECT weight_id::INTEGER AS weight_id, round(auc_roc, 6)::DOUBLE AS objective FROM k")
def m6_auc(t: Tables):
    return rounded(en.blend_objectives(t.predictions, "label", ["p_len", "p_hash"], en.simplex_grid(2, 4), "auc"), "objective")


@query("m7_apply_weights", f"WITH {q.PRED} SELECT doc_id, round((0.5 * p_len + 0.25 * p_hash + 0.25 * p_src) / 1.0, 9)::DOUBLE "
       "AS p_blend FROM pred")
def m7(t: Tables):
    df = en.apply_weights(t.predictions, SCORES, [0.5, 0.25, -0.25]).select("doc_id", "p_blend")
    return rounded(df, "p_blend", digits=9)


@query("m8_pseudo_labels", f"WITH {q.PRED} SELECT doc_id, greatest(p_hash, 1.0 - p_hash)::DOUBLE AS confidence, "
       "(p_hash > 0.5)::INTEGER AS pseudo_label FROM pred WHERE greatest(p_hash, 1.0 - p_hash) >= 0.95")
def m8(t: Tables):
    return en.pseudo_labels(t.predictions, "p_hash").select("doc_id", "confidence", "pseudo_label")


@query("m8_pseudo_label_summary", f"""
WITH {q.PRED}, k AS (SELECT *, greatest(p_hash, 1.0 - p_hash) >= 0.95 AS kept FROM pred)
SELECT count(*) AS n_rows, count(*) FILTER (WHERE kept) AS n_kept,
  round(100.0 * count(*) FILTER (WHERE kept) / count(*), 6)::DOUBLE AS coverage_pct,
  count(*) FILTER (WHERE kept AND p_hash <= 0.5) AS n_class_0, count(*) FILTER (WHERE kept AND p_hash > 0.5) AS n_class_1 FROM k""")
def m8_summary(t: Tables):
    return rounded(en.pseudo_label_summary(t.predictions, "p_hash"), "coverage_pct")


@query("m9_cross_features", f"""
WITH {q.PRED}, m AS (SELECT *, (p_len + p_hash + p_src) / 3.0 AS mu FROM pred) SELECT doc_id, """
       + ", ".join(f"{c} AS {c}_pred" for c in SCORES) + ", "
       + ", ".join(f"round({a} * {b}, 11)::DOUBLE AS {a}_x_{b}_prod, round(({a} + {b}) / 2, 9)::DOUBLE AS {a}_x_{b}_mean, "
                   f"greatest({a}, {b}) AS {a}_x_{b}_max, round(abs({a} - {b}), 9)::DOUBLE AS {a}_x_{b}_diff"
                   for a, b in (("p_len", "p_hash"), ("p_len", "p_src"), ("p_hash", "p_src")))
       + """, round(mu, 9)::DOUBLE AS pred_mean, round(sqrt(((p_len - mu) * (p_len - mu) + (p_hash - mu) * (p_hash - mu)
  + (p_src - mu) * (p_src - mu)) / 3.0), 9)::DOUBLE AS pred_std, greatest(p_len, p_hash, p_src) AS pred_max,
  least(p_len, p_hash, p_src) AS pred_min FROM m""")
def m9(t: Tables):
    df = en.cross_features(t.predictions, SCORES, ["doc_id"])
    df = rounded(df, *[c for c in df.columns if c.endswith("_prod")], digits=11)
    return rounded(df, *[c for c in df.columns if c.endswith(("_mean", "_diff", "_std"))], digits=9)


@query("m3_stratified_folds", """
WITH r AS (SELECT doc_id, quality, row_number() OVER (PARTITION BY quality ORDER BY md5(doc_id || '|42'), doc_id) - 1 AS k FROM labels)
SELECT doc_id, quality, (k % 5)::INTEGER AS fold FROM r""")
def m3_folds(t: Tables):
    return en.assign_folds(t.labels.select("doc_id", "quality"), "quality", ["doc_id"])


@query("m12_class_weights", """
WITH n AS (SELECT count(*) AS n, count(*) FILTER (WHERE quality = 1) AS p FROM labels)
SELECT doc_id, round(n / (2.0 * CASE WHEN quality = 1 THEN p ELSE n - p END), 6)::DOUBLE AS balanced,
  round(CASE WHEN quality = 1 THEN (n - p) / p ELSE 1.0 END, 6)::DOUBLE AS positive FROM labels, n""")
def m12(t: Tables):
    df = profile.positive_weights(profile.balanced_weights(t.labels, "quality", "balanced"), "quality", "positive")
    return rounded(df.select("doc_id", "balanced", "positive"), "balanced", "positive")


# --- scoring

_SCORE = {"p_len": 3.0, "p_hash": -2.0}
_Z = "1.0 / (1.0 + exp(-(3.0 * p_len - 2.0 * p_hash - 0.5)))"


def band_sql(p: str, threshold: float) -> str:
    high, moderate, low = fv.RISK_LABELS
    return f"CASE WHEN {p} >= {threshold} THEN '{high}' WHEN {p} >= {threshold / 2} THEN '{moderate}' ELSE '{low}' END"


@query("r1_batch_scores", f"WITH {q.PRED}, s AS (SELECT doc_id, {_Z} AS p FROM pred) SELECT doc_id, round(p, 4)::DOUBLE AS "
       f"probability, {band_sql('p', 0.25)} AS risk, 0.25::DOUBLE AS threshold_used, 'v3' AS model_version FROM s")
def r1(t: Tables):
    df = scoring.score_rows(t.predictions.select("doc_id", *SCORES), scoring.logistic(_SCORE, -0.5), "3")
    return df.drop(*SCORES)


@query("r2_risk_bands", f"WITH {q.PRED} SELECT {band_sql('p_len', 0.6)} AS risk, count(*) AS n FROM pred GROUP BY 1")
def r2(t: Tables):
    return t.predictions.groupBy(scoring.risk_band(F.col("p_len"), 0.6).alias("risk")).agg(F.count("*").alias("n"))


_ROUTE = "CASE WHEN CAST('0x' || substr(md5(user_id::VARCHAR), 1, 8) AS BIGINT) % 100 < 10 THEN 'challenger' ELSE 'champion' END"


@query("r3_routing", f"SELECT event_id, {_ROUTE} AS role FROM events")
def r3(t: Tables):
    return t.events.select("event_id", scoring.route(["user_id"]).alias("role"))


@query("r3_scores_by_role", f"""
WITH {q.REQ}, s AS (SELECT event_id, {_ROUTE} AS role, CASE WHEN {_ROUTE} = 'challenger' THEN least(score * 2, 1.0) ELSE score END AS p
  FROM req) SELECT event_id, role, round(p, 4)::DOUBLE AS probability, {band_sql('p', 0.25)} AS risk,
  CASE role WHEN 'challenger' THEN 'v8' ELSE 'v7' END AS model_version FROM s""")
def r3_scores(t: Tables):
    df = scoring.score_with_roles(t.requests, F.col("score"), F.col("score") * 2, "7", "8", ["user_id"])
    return df.select("event_id", "role", "probability", "risk", "model_version")

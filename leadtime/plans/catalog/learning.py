"""Fitted models. Their numbers have no SQL twin; what SQL can say about them (rows, counts) is checked."""

from __future__ import annotations

from pyspark.sql import functions as F

from leadtime import fixed_values as fv
from leadtime.functions.numeric import add_all
from leadtime.operators import evaluation as ev
from leadtime.operators import learners as ml
from leadtime.operators import point_in_time as pit
from leadtime.operators.cleaning import temporal_split
from leadtime.plans.bindings import KEY, OBS_DATES, OBS_YEARS, URGENT, Tables
from leadtime.plans.catalog import query
from leadtime.plans.catalog import sql as q
from leadtime.session import cut_lineage

FEATURES = ["n_before", "n_6m", "n_12m", "spent", "days_since"]
IDS = ["row_id", KEY, "split", "label"]


def labelled(t: Tables):
    """Order features and the urgent-order label of every customer and date; cut so that fits do not redo it."""
    urgent = pit.Source("urgent", t.orders, "o_custkey", "o_orderdate", where=F.col("o_orderpriority").isin(URGENT))
    wanted = [pit.count_before("inpatient", "n_before"), pit.count_trailing("inpatient", 6, "n_6m"),
              pit.count_trailing("inpatient", 12, "n_12m"), pit.sum_before("inpatient", "spent"),
              pit.days_since_last("inpatient", "days_since"), pit.event_ahead("urgent", 6, "label")]
    df = pit.point_in_time(t.cohort, [*t.sources[:1], urgent], wanted, OBS_DATES, KEY)
    df = temporal_split(df, F.year("obs_date"), OBS_YEARS)
    thousands = F.col("spent") / 100000.0
    return cut_lineage(df.withColumns({"row_id": F.concat_ws("@", KEY, "obs_date"), "spent": thousands})
                       .select(*IDS, *FEATURES))


def scored(df, name):
    return df.select("row_id", "split", "label", F.round(name, 6).alias(name))


@query("m1_boosted_trees")
def m1(t: Tables):
    df = labelled(t)
    fit_rows = df.where(F.col("split") != "test").withColumn("is_val", F.col("split") == "val")
    model = ml.fit_boosted_trees(fit_rows, FEATURES, "label", "is_val")
    return scored(ml.add_score(model, ml.assemble(df, FEATURES), "p_trees"), "p_trees")


@query("m1_loss_curve", "SELECT true AS chosen_is_smallest, true AS stopped_early, true AS falls, 1 AS n_chosen")
def m1_curve(t: Tables):
    """300 rounds offered: the chosen round has the smallest validation loss, and there are fewer rounds than offered."""
    df = labelled(t)
    fit_rows = df.where(F.col("split") != "test").withColumn("is_val", F.col("split") == "val")
    model = ml.fit_boosted_trees(fit_rows, FEATURES, "label", "is_val", rounds=300, depth=3, step=0.3)
    curve = ml.loss_curve(model, df.where(F.col("split") == "val"), FEATURES, "label")
    chosen, first = F.max(F.when(F.col("chosen"), F.col("loss"))), F.min(F.when(F.col("round") == 1, F.col("loss")))
    return curve.agg((chosen <= F.min("loss") + 1e-12).alias("chosen_is_smallest"), (F.max("round") < 300).alias("stopped_early"),
                     (chosen <= first).alias("falls"), F.count(F.when(F.col("chosen"), 1)).cast("int").alias("n_chosen"))


@query("m2_balanced_logistic")
def m2(t: Tables):
    df = labelled(t)
    model = ml.fit_balanced_logistic(df.where(F.col("split") == "train"), FEATURES, "label", penalty=0.001)
    return scored(ml.add_score(model, ml.assemble(df, FEATURES), "p_logit"), "p_logit")


def base_models():
    return {"p_logit": ml.logistic_regression("label", 0.001, rounds=50),
            "p_trees": ml.boosted_trees("label", rounds=3, depth=3)}


@query("m3_out_of_fold")
def m3(t: Tables):
    train = labelled(t).where(F.col("split") == "train")
    df = ml.out_of_fold(train, base_models(), FEATURES, "label", ["row_id"], folds=3)
    return df.select("row_id", "label", "fold", F.round("p_logit", 6).alias("p_logit"), F.round("p_trees", 6).alias("p_trees"))


@query("m4_stacking")
def m4(t: Tables):
    df = labelled(t)
    stack = ml.Stacking(base_models(), FEATURES, "label", ["row_id"], folds=2).fit(df.where(F.col("split") == "train"))
    return scored(stack.transform(df.where(F.col("split") != "train")), "p_stack")


def searched(t: Tables, n: int):
    """Trials over the published ranges. Fitting stops early on the validation rows, which also score a trial."""
    df = labelled(t).withColumn("is_val", F.col("split") == "val")

    def build(**options):
        return ml.boosted_trees("label", validation="is_val", **options)

    return ml.search_parameters(df.where(F.col("split") != "test"), df.where(F.col("split") == "val"), FEATURES, "label", build,
                                ml.draw_candidates(fv.SEARCH_RANGES, n), threshold=0.4, parallelism=4)


@query("m10_parameter_search")
def m10(t: Tables):
    trials = searched(t, fv.SEARCH_TRIALS)
    return trials.select("trial", F.map_keys("params").alias("names"), F.round("trial_score", 6).alias("trial_score"))


@query("m10_best_trial", f"SELECT true AS best_of_all, true AS in_ranges, {len(fv.SEARCH_RANGES)} AS n_params")
def m10_best(t: Tables):
    """The chosen trial has the largest score of all, and its parameters lie in their ranges."""
    trials = cut_lineage(searched(t, 8))
    best, most = ml.best_trial(trials), trials.agg(F.max("trial_score")).scalar()
    inside = F.lit(True)
    for name, (_, low, high) in fv.SEARCH_RANGES.items():
        inside = inside & F.col("params")[name].cast("double").between(low, high)
    return best.select((F.col("trial_score") >= most).alias("best_of_all"), inside.alias("in_ranges"), F.size("params").alias("n_params"))


@query("m11_oversample_counts", f"""
WITH {q.COHORT}, {q.LABEL}, n AS (SELECT count(*) AS n, count(l.entity) AS p FROM cohort c LEFT JOIN label l
  ON c.entity = l.entity AND c.obs_date = l.obs_date)
SELECT 0 AS label, false AS synthetic, n - p AS n_rows FROM n UNION ALL SELECT 1, false, p FROM n
UNION ALL SELECT 1, true, n - p - p FROM n WHERE n - p > p""")
def m11(t: Tables):
    df = ml.oversample(labelled(t), "label", FEATURES, "row_id")
    return df.groupBy("label", "synthetic").agg(F.count("*").alias("n_rows"))


@query("m2_scores_auc")
def m2_auc(t: Tables):
    """AUC of the fitted scores per split."""
    df = labelled(t)
    model = ml.fit_balanced_logistic(df.where(F.col("split") == "train"), FEATURES, "label", penalty=0.001)
    rows = ml.add_score(model, ml.assemble(df, FEATURES), "p")
    return ev.validation_metrics(rows, "label", "p", ["split"]).select(
        "split", F.round("auc_roc", 6).alias("auc_roc"), F.round("recall", 6).alias("recall"), "n_samples")


@query("m11_oversample_positions", f"""
WITH {q.COHORT}, {q.LABEL}, n AS (SELECT count(*) AS n, count(l.entity) AS p FROM cohort c LEFT JOIN label l
  ON c.entity = l.entity AND c.obs_date = l.obs_date)
SELECT CASE WHEN n > 2 * p THEN n - 2 * p ELSE 0 END AS n_new, 0 AS n_outside, 0 AS n_copies FROM n""")
def m11_positions(t: Tables):
    """New rows; those outside the box around the positive rows; those equal to a real row although that row stands alone."""
    rows = cut_lineage(ml.oversample(labelled(t), "label", FEATURES, "row_id"))
    real, new = rows.where("NOT synthetic AND label = 1"), rows.where("synthetic")
    box = real.agg(F.struct(*[F.struct(F.min(c).alias("low"), F.max(c).alias("high")).alias(c) for c in FEATURES]).alias("b")).scalar()
    outside = add_all([(~F.col(c).between(F.col(f"_b.{c}.low") - 1e-6, F.col(f"_b.{c}.high") + 1e-6)).cast("int") for c in FEATURES])
    alone = real.groupBy(*FEATURES).agg(F.count("*").alias("_same")).where("_same = 1").withColumn("_copy", F.lit(1))
    return (new.withColumn("_b", box).join(alone, FEATURES, "left")
            .agg(F.count("*").alias("n_new"), F.count(F.when(outside > 0, 1)).cast("int").alias("n_outside"), F.count("_copy").cast("int").alias("n_copies")))

"""Model versions as tables: current versions, promotion, rollback, clean-up.

The tables hold one row per version of a model; windows are per model.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window

from leadtime.fixed_values import KEEP_VERSIONS, PROMOTION_MIN_AUC, ROLLBACK_AUC_MARGIN, ROLLBACK_MIN_RECALL

PRODUCTION, STAGING, ARCHIVED = "Production", "Staging", "Archived"


def latest_by_stage(versions: DataFrame, model: str = "model", stages: Sequence[str] = (PRODUCTION, STAGING)) -> DataFrame:
    """The newest version of each stage: champion (Production) and challenger (Staging)."""
    rest = [c for c in versions.columns if c not in (model, "stage", "version")]
    newest = F.max(F.struct("version", *rest)) if not any(t.startswith("map") for _, t in versions.dtypes) else \
        F.max_by(F.struct("version", *rest), "version")
    return (versions.where(F.col("stage").isin(list(stages))).groupBy(model, "stage").agg(newest.alias("_v"))
            .select(model, "stage", "_v.*"))


def promotion_decision(metrics: DataFrame, champions: DataFrame, model: str = "model",
                       min_auc: float = PROMOTION_MIN_AUC) -> DataFrame:
    """Each candidate against the champion of its model.

    ``metrics``: (model, version, auc_roc, recall); ``champions``: (model,
    version, auc_roc, recall) with at most one row per model. A candidate below
    the AUC floor is refused; then better or equal recall OR AUC is enough.
    """
    old = champions.select(model, F.col("version").alias("champion_version"), F.col("auc_roc").alias("champion_auc"),
                           F.col("recall").alias("champion_recall"))
    both = metrics.join(old, model, "left")
    floor = F.coalesce(F.col("auc_roc") < min_auc, F.lit(True))
    first = F.col("champion_version").isNull()
    better = F.coalesce((F.col("recall") >= F.col("champion_recall")) | (F.col("auc_roc") >= F.col("champion_auc")),
                        F.lit(False))
    return both.withColumns({
        "promoted": ~floor & (first | better),
        "reason": F.when(floor, "auc_below_floor").when(first, "first_champion")
        .when(better, "better_performance").otherwise("champion_better")})


def rollback_check(metrics: DataFrame, champions: DataFrame, model: str = "model",
                   min_recall: float = ROLLBACK_MIN_RECALL, margin: float = ROLLBACK_AUC_MARGIN) -> DataFrame:
    """Roll a version back on low recall, or on an AUC clearly below another champion's; unscored counts as broken."""
    old = champions.select(model, F.col("version").alias("champion_version"), F.col("auc_roc").alias("champion_auc"))
    both = metrics.join(old, model, "left")
    broken = F.col("recall").isNull()
    weak = F.col("recall") < min_recall
    behind = F.coalesce((F.col("champion_version") != F.col("version"))
                        & (F.col("auc_roc") < F.col("champion_auc") - F.lit(margin)), F.lit(False))
    return both.withColumns({
        "rollback": broken | weak | behind,
        "reason": F.when(broken, "no_metrics").when(weak, "low_recall").when(behind, "auc_below_champion")
        .otherwise("ok")})


def promote(versions: DataFrame, decisions: DataFrame, model: str = "model") -> DataFrame:
    """Versions after promotion: the promoted one becomes champion, the former champion is archived.

    ``decisions``: (model, new_version), one row per model that changes.
    """
    change = decisions.select(model, F.col("new_version").alias("_new"))
    both = versions.join(change, model, "left")
    now = F.col("version") == F.col("_new")
    was = F.col("_new").isNotNull() & (F.col("stage") == PRODUCTION) & ~now
    return both.withColumns({
        "stage": F.when(now, PRODUCTION).when(was, ARCHIVED).otherwise(F.col("stage")),
        "role": F.when(now, "champion").when(was, "archived").otherwise(F.col("role"))}).drop("_new")


def stage_challenger(versions: DataFrame, candidates: DataFrame, model: str = "model") -> DataFrame:
    """Versions with the candidates (model, new_version) moved to Staging as challengers."""
    change = candidates.select(model, F.col("new_version").alias("_new"))
    both = versions.join(change, model, "left")
    now = F.col("version") == F.col("_new")
    return both.withColumns({"stage": F.when(now, STAGING).otherwise(F.col("stage")),
                             "role": F.when(now, "challenger").otherwise(F.col("role"))}).drop("_new")


def beyond_last(versions: DataFrame, keep: int = KEEP_VERSIONS, model: str = "model") -> DataFrame:
    """All versions with ``age_rank``, 1 being the newest, and whether they lie beyond the kept ones."""
    w = Window.partitionBy(model).orderBy(F.col("version").desc())
    return versions.withColumn("age_rank", F.row_number().over(w)).withColumn("beyond", F.col("age_rank") > keep)


def clean_up(versions: DataFrame, keep: int = KEEP_VERSIONS, model: str = "model") -> DataFrame:
    """Archive versions beyond the newest ``keep``, never a Production or Staging one."""
    stale = F.col("beyond") & ~F.coalesce(F.col("stage").isin(PRODUCTION, STAGING), F.lit(False))
    return (beyond_last(versions, keep, model)
            .withColumn("stage", F.when(stale, ARCHIVED).otherwise(F.col("stage"))).drop("beyond", "age_rank"))


def with_previous_version(versions: DataFrame, model: str = "model") -> DataFrame:
    w = Window.partitionBy(model).orderBy("version")
    return versions.withColumn("previous_version", F.lag("version").over(w))


def run_rows(metrics: DataFrame, run: str, values: Mapping[str, str], split: str = "split") -> DataFrame:
    """Wide metrics per split to long run-log rows (run, kind, name, value), names as ``val_recall``."""
    pairs = F.array(*[F.struct(F.concat_ws("_", F.col(split), F.lit(n)).alias("name"),
                               F.col(c).cast("string").alias("value")) for n, c in values.items()])
    return (metrics.select(F.lit(run).alias("run_id"), F.lit("metrics").alias("kind"), F.explode(pairs).alias("p"))
            .select("run_id", "kind", "p.name", "p.value"))

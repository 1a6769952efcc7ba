"""Fitting binary classifiers with spark.ml: boosted trees, weighted logistic
regression, out-of-fold scores, stacking, parameter search, oversampling."""

from __future__ import annotations

import random
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.ml import Estimator, Model
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window

from leadtime.fixed_values import MISSING_MODEL_SCORE
from leadtime.functions.numeric import add_all, clip, uniform_hash
from leadtime.operators.ensembles import assign_folds
from leadtime.operators.evaluation import trial_score
from leadtime.operators.prefix import add_before, bounds_of, with_bucket
from leadtime.operators.profile import balanced_weights
from leadtime.operators.scaling import apply_scaler, fit_scaler
from leadtime.session import cut_lineage

VECTOR = "_features"
#: Rows of a slice in which near rows are looked for.
SLICE = 4096


def assemble(df: DataFrame, features: Sequence[str]) -> DataFrame:
    return VectorAssembler(inputCols=list(features), outputCol=VECTOR, handleInvalid="error").transform(df)


def add_score(model: Model, df: DataFrame, name: str) -> DataFrame:
    """The probability of class 1 as a DOUBLE column; spark.ml's own columns are dropped."""
    scored = model.transform(df)
    return (scored.withColumn(name, vector_to_array("probability").getItem(1))
            .drop("probability", "rawPrediction", "prediction"))


def boosted_trees(label: str, rounds: int = 300, step: float = 0.05, depth: int = 5, rows: float = 0.8,
                  columns: float = 0.8, validation: str | None = None, weight: str | None = None,
                  seed: int = 42) -> GBTClassifier:
    """Gradient-boosted trees; ``validation`` names a BOOLEAN column, on which fitting stops early."""
    gbt = GBTClassifier(featuresCol=VECTOR, labelCol=label, maxIter=rounds, stepSize=step, maxDepth=depth,
                        subsamplingRate=rows, featureSubsetStrategy=str(columns), seed=seed, validationTol=0.001)
    if validation:
        gbt = gbt.setValidationIndicatorCol(validation)
    return gbt.setWeightCol(weight) if weight else gbt


def fit_boosted_trees(df: DataFrame, features: Sequence[str], label: str, is_validation: str, **options) -> Model:
    return boosted_trees(label, validation=is_validation, **options).fit(assemble(df, features))


def loss_curve(model: Model, df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """(round, loss, chosen) of boosted trees on given rows: the loss after every kept round, and which round scoring stops at.

    Early stopping keeps the rounds up to the smallest validation loss, so the last kept round is the chosen one. Losses are computed on the
    cluster; the driver holds one number a round.
    """
    losses = model.evaluateEachIteration(assemble(df, features).withColumn(label, F.col(label).cast("double")))
    rows = [(i + 1, float(loss), i + 1 == len(losses)) for i, loss in enumerate(losses)]
    return df.sparkSession.createDataFrame(rows, "round int, loss double, chosen boolean")


def logistic_regression(label: str, penalty: float = 0.0, weight: str | None = None,
                        rounds: int = 3000) -> LogisticRegression:
    lr = LogisticRegression(featuresCol=VECTOR, labelCol=label, maxIter=rounds, regParam=penalty,
                            standardization=False)
    return lr.setWeightCol(weight) if weight else lr


def fit_balanced_logistic(df: DataFrame, features: Sequence[str], label: str, penalty: float = 0.0) -> Model:
    """Both classes weigh the same in total."""
    weighted = balanced_weights(df, label, "_weight")
    return logistic_regression(label, penalty, "_weight").fit(assemble(weighted, features))


def out_of_fold(df: DataFrame, models: Mapping[str, Estimator], features: Sequence[str], label: str,
                keys: Sequence[str], folds: int = 5, seed: int = 42) -> DataFrame:
    """A score per model for every row, each from a fit that did not see the row's fold."""
    rows = cut_lineage(assemble(assign_folds(df, label, keys, folds, seed), features))
    parts = []
    for fold in range(folds):
        seen, unseen = rows.where(F.col("fold") != fold), rows.where(F.col("fold") == fold)
        for name, estimator in models.items():
            unseen = add_score(estimator.fit(seen), unseen, name)
        parts.append(unseen)
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole.drop(VECTOR)


class Stacking:
    """Base models, then a meta model on their standardised out-of-fold scores."""

    def __init__(self, models: Mapping[str, Estimator], features: Sequence[str], label: str, keys: Sequence[str],
                 meta: str = "logistic", folds: int = 5, seed: int = 42, ridge_alpha: float = 1.0):
        if meta not in ("logistic", "ridge"):
            raise ValueError("meta must be 'logistic' or 'ridge'")
        self.models, self.features, self.label, self.keys = dict(models), list(features), label, list(keys)
        self.meta, self.folds, self.seed, self.ridge_alpha = meta, folds, seed, ridge_alpha
        self.fitted: dict[str, Model] = {}
        self.failed: dict[str, Exception] = {}

    def fit(self, df: DataFrame) -> "Stacking":
        names = list(self.models)
        oof = cut_lineage(out_of_fold(df, self.models, self.features, self.label, self.keys, self.folds, self.seed))
        self.scaler = cut_lineage(fit_scaler(oof, names))
        level = apply_scaler(oof, self.scaler, names)
        if self.meta == "logistic":
            self.meta_model = fit_balanced_logistic(level, names, self.label)
        else:
            # alpha of a summed loss is alpha / n of a mean one
            ridge = LinearRegression(featuresCol=VECTOR, labelCol=self.label, elasticNetParam=0.0,
                                     regParam=self.ridge_alpha / max(oof.count(), 1), standardization=False)
            self.meta_model = ridge.fit(assemble(level, names))
        whole = assemble(df, self.features)
        self.fitted, self.failed = {}, {}
        for name, estimator in self.models.items():
            try:
                self.fitted[name] = estimator.fit(whole)
            except Exception as e:  # the other models go on; transform() scores this one as undecided
                self.failed[name] = e
        if not self.fitted:
            raise next(iter(self.failed.values()))
        return self

    def transform(self, df: DataFrame, name: str = "p_stack") -> DataFrame:
        """Adds the base scores and the stacked one; a model that could not be refitted scores 0.5."""
        rows = assemble(df, self.features)
        for model in self.models:
            rows = (add_score(self.fitted[model], rows, model) if model in self.fitted
                    else rows.withColumn(model, F.lit(MISSING_MODEL_SCORE)))
        rows = rows.drop(VECTOR)
        names = list(self.models)
        kept = rows.withColumns({f"_b_{n}": F.col(n) for n in names})
        level = assemble(apply_scaler(kept, self.scaler, names), names)
        if self.meta == "logistic":
            out = add_score(self.meta_model, level, name)
        else:
            out = self.meta_model.transform(level).withColumn(name, clip(F.col("prediction"), 0.0, 1.0)).drop("prediction")
        return out.withColumns({n: F.col(f"_b_{n}") for n in names}).drop(VECTOR, *[f"_b_{n}" for n in names])


def draw_candidates(ranges: Mapping[str, tuple], n: int, seed: int = 42) -> list[dict]:
    """Seeded draws from ranges: ('int', low, high), ('float', low, high) or ('log', low, high)."""
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        one = {}
        for name, (kind, low, high) in ranges.items():
            if kind == "int":
                one[name] = rng.randint(low, high)
            elif kind == "log":
                one[name] = low * (high / low) ** rng.random()
            else:
                one[name] = rng.uniform(low, high)
        out.append(one)
    return out


def search_parameters(train: DataFrame, valid: DataFrame, features: Sequence[str], label: str, build,
                      candidates: Sequence[Mapping], threshold: float = 0.5, metric: str = "f1",
                      parallelism: int = 2) -> DataFrame:
    """One row per candidate: its parameters and its score on the validation rows.

    ``build(**candidate)`` returns an estimator. The driver holds the candidate
    list and one number per candidate; every fit and score runs on the cluster.
    """
    a, b = cut_lineage(assemble(train, features)), cut_lineage(assemble(valid, features))

    def attempt(i):
        scored = add_score(build(**candidates[i]).fit(a), b, "_score")
        return i, float(trial_score(scored, label, "_score", threshold, metric).first()["trial_score"])

    with ThreadPoolExecutor(max_workers=parallelism) as pool:
        results = list(pool.map(attempt, range(len(candidates))))
    rows = [(i, {k: str(v) for k, v in candidates[i].items()}, s) for i, s in results]
    return train.sparkSession.createDataFrame(rows, "trial int, params map<string,string>, trial_score double")


def best_trial(trials: DataFrame) -> DataFrame:
    """The trial with the largest score; the earlier one among equals."""
    best = trials.agg(F.max_by(F.struct("trial", "params", "trial_score"),
                               F.struct("trial_score", -F.col("trial"))).alias("b"))
    return best.select("b.*")


def oversample(df: DataFrame, label: str, features: Sequence[str], key: str, neighbours: int = 5, reach: int = 12,
               seed: int = 42) -> DataFrame:
    """Balance the classes with points between a positive row and one of its near positives.

    Near rows are searched among the ``reach`` rows on both sides along one
    projection of the standardised features, by true distance: linear work, no
    pairs within a group. Rows are numbered along the line; a slice of numbers also gets
    copies of the ``reach`` rows beyond its ends, so every row sees the same neighbours however the
    work is cut. A tiny hash offset separates equal projections. The number of new rows is exact: negatives - positives.
    """
    scaler = fit_scaler(df, features)
    z = apply_scaler(df.withColumns({f"_x_{c}": F.col(c).cast("double") for c in features}), scaler, features)
    rng = random.Random(seed)
    line = add_all([F.lit(rng.gauss(0.0, 1.0)) * F.col(c) for c in features])
    jitter = (uniform_hash(F.col(key), seed=seed) - 0.5) * 1e-6
    minority = (z.where(F.col(label) == 1)
                .select(F.col(key), F.array(*[F.col(c) for c in features]).alias("_z"),
                        F.array(*[F.col(f"_x_{c}") for c in features]).alias("_x"), (line + jitter).alias("_line")))
    numbered = add_before(with_bucket(minority.withColumn("_one", F.lit(1).cast("bigint")), "_line", bounds_of(minority, "_line")),
                          {"_place": "_one"}, ["_line", key]).drop("_bucket", "_one")
    slice_of = lambda place: F.floor(place / max(SLICE, 2 * reach + 1))
    copies = numbered.withColumn("_slice", F.explode(F.sequence(slice_of(F.greatest(F.col("_place") - reach, F.lit(0))), slice_of(F.col("_place") + reach))))
    w = Window.partitionBy("_slice").orderBy("_place").rowsBetween(-reach, reach)
    around = copies.withColumn("_near", F.collect_list(F.struct(F.col(key).alias("k"), F.col("_z").alias("z"), F.col("_x").alias("x"))).over(w))
    around = around.where(F.col("_slice") == slice_of(F.col("_place")))
    ranked = F.sort_array(F.transform(F.filter("_near", lambda n: n["k"] != F.col(key)), lambda n: F.struct(
        F.aggregate(F.zip_with(n["z"], F.col("_z"), lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, v: s + v)
        .alias("d"), n["k"].alias("k"), n["x"].alias("x"))))
    rows = around.select(key, "_x", F.slice(ranked, 1, neighbours).alias("_near"))

    sizes = df.agg(F.struct(F.count(F.when(F.col(label) == 1, 1)).alias("p"),
                            F.count(F.when(F.col(label) == 0, 1)).alias("n")).alias("s")).scalar()
    digest = F.md5(F.concat_ws("|", F.col(key).cast("string"), F.lit(str(seed))))
    rows = rows.withColumns({"_digest": digest, "_one": F.lit(1).cast("bigint")}).withColumn(
        "_bucket", F.substring("_digest", 1, 4))
    rows = add_before(rows, {"_rank": "_one"}, ["_digest"]).withColumn("_s", sizes)
    need = F.greatest(F.col("_s")["n"] - F.col("_s")["p"], F.lit(0))
    share = F.floor(need / F.col("_s")["p"]) + (F.col("_rank") < need % F.col("_s")["p"]).cast("int")
    copies = rows.where(share > 0).withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), share)))
    pick = F.floor(uniform_hash(F.col(key), F.col("_copy"), seed=f"{seed}n") * F.size("_near")).cast("int")
    made = copies.withColumns({"_gap": uniform_hash(F.col(key), F.col("_copy"), seed=f"{seed}g"),
                               "_other": F.coalesce(F.get(F.col("_near"), pick)["x"], F.col("_x"))})
    new = made.select(
        F.concat_ws("#", F.col(key).cast("string"), F.col("_copy").cast("string")).alias(key),
        F.lit(1).alias(label), F.lit(True).alias("synthetic"),
        *[(F.get("_x", F.lit(i)) + F.col("_gap") * (F.get("_other", F.lit(i)) - F.get("_x", F.lit(i)))).alias(c)
          for i, c in enumerate(features)])
    kept = df.select(F.col(key).cast("string").alias(key), F.col(label).cast("int").alias(label),
                     F.lit(False).alias("synthetic"), *[F.col(c).cast("double").alias(c) for c in features])
    return kept.unionByName(new)

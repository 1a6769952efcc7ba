"""Data-quality checks. One aggregate gathers the facts of all columns; the rest is row logic."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from leadtime.fixed_values import (ERROR_PENALTY, NULL_SHARE_ERROR, NULL_SHARE_WARNING, TARGET_RATE_RANGE,
                                   WARNING_PENALTY)
from leadtime.functions.names import missing

ISSUE_TYPE = "array<struct<check:string,column:string,severity:string,message:string>>"
_INTEGERS = ("tinyint", "smallint", "int", "bigint")


def _present(name: str, dtype: str) -> Column:
    """The value, with NaN counted as missing."""
    value = F.col(name)
    return F.when(~F.isnan(value), value) if dtype in ("double", "float") else value


def column_facts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Per column: rows, missing values, min and max as numbers, fractional values, constant or not."""
    types = dict(df.dtypes)
    chosen = list(columns or df.columns)
    wide = [F.count("*").alias("_n")]
    for c in chosen:
        v, t = _present(c, types[c]), types[c]
        numeric = t in _INTEGERS or t in ("double", "float") or t.startswith("decimal")
        wide.append(F.struct(
            F.lit(c).alias("column"), F.lit(t).alias("dtype"), F.count(v).alias("n_present"),
            (F.min(v).cast("double") + 0.0 if numeric else F.lit(None).cast("double")).alias("min"),
            (F.max(v).cast("double") + 0.0 if numeric else F.lit(None).cast("double")).alias("max"),
            (F.count(F.when(v % 1 != 0, 1)) if t in ("double", "float") else F.lit(0).cast("bigint"))
            .alias("n_fractional"),
            F.coalesce(F.min(v) == F.max(v), F.lit(False)).alias("constant")).alias(f"_c{len(wide)}"))
    facts = df.agg(*wide)
    each = F.explode(F.array(*[F.col(f"_c{i + 1}") for i in range(len(chosen))]))
    return (facts.select("_n", each.alias("_f"))
            .select("_f.column", "_f.dtype", F.col("_n").alias("n_rows"),
                    (F.col("_n") - F.col("_f.n_present")).alias("n_missing"),
                    F.coalesce(F.try_divide(F.col("_n") - F.col("_f.n_present"), F.col("_n")), F.lit(0.0))
                    .alias("null_share"),
                    "_f.min", "_f.max", "_f.n_fractional", "_f.constant"))


def _issue(when: Column, check: str, severity: str, message: Column) -> Column:
    return F.when(when, F.struct(F.lit(check).alias("check"), F.col("column"), F.lit(severity).alias("severity"),
                                 message.alias("message")))


def _rule_issues(rules: Mapping[str, Mapping], name: Column, lowest: Column, highest: Column) -> list[Column]:
    out = []
    for group, rule in rules.items():
        mine = name.isin(list(rule["cols"]))
        if rule.get("dtype") == "int":
            whole = F.col("dtype").isin(*_INTEGERS)
            floating = F.col("dtype").isin("double", "float")
            out.append(_issue(mine & floating & (F.col("n_fractional") > 0), "dtype", "warning",
                              F.format_string("%s has fractional values but whole numbers are expected", name)))
            out.append(_issue(mine & ~floating & ~whole, "dtype", "warning",
                              F.format_string("%s should be a whole number but is %s", name, F.col("dtype"))))
        if rule.get("min") is not None:
            out.append(_issue(mine & (lowest < rule["min"]), "range", "error",
                              F.format_string(f"%s is below {rule['min']} ({group})", name)))
        if rule.get("max") is not None:
            out.append(_issue(mine & (highest > rule["max"]), "range", "error",
                              F.format_string(f"%s is above {rule['max']} ({group})", name)))
    return out


def find_issues(df: DataFrame, rules: Mapping[str, Mapping]) -> DataFrame:
    """One row (check, column, severity, message) per fault: missing columns, types, ranges, nulls, constants."""
    name = F.col("column")
    tests = _rule_issues(rules, name, F.col("min"), F.col("max"))
    tests.append(_issue(F.col("null_share") > NULL_SHARE_ERROR, "missing_values", "error",
                        F.format_string("%s is missing in more than half of the rows", name)))
    tests.append(_issue((F.col("null_share") > NULL_SHARE_WARNING) & (F.col("null_share") <= NULL_SHARE_ERROR),
                        "missing_values", "warning",
                        F.format_string("%s is missing in more than a tenth of the rows", name)))
    tests.append(_issue(F.col("constant"), "constant", "warning", F.format_string("%s has one value only", name)))
    found = column_facts(df).select(F.explode(F.array_compact(F.array(*tests))).alias("_i")).select("_i.*")
    return found.unionByName(missing_columns(df, rules))


def missing_columns(df: DataFrame, rules: Mapping[str, Mapping]) -> DataFrame:
    """Rule columns the table lacks. This reads the schema only."""
    rows = [("missing_column", c, "error", f"{c} is required ({group})")
            for group, rule in rules.items() for c in missing(df.columns, rule["cols"])]
    return df.sparkSession.createDataFrame(rows, "check string, column string, severity string, message string")


def missing_fields(df: DataFrame, by: str, document: str, required: Sequence[str]) -> DataFrame:
    """(by, field, n_rows, n_missing, severity) of required fields of a JSON column that rows of a kind lack.

    An error where no row of the kind has the field, a warning where some rows lack it. One aggregate, combined map-side.
    """
    held = F.from_json(document, "map<string,string>")
    has = {f: F.coalesce(F.map_contains_key(held, F.lit(f)), F.lit(False)) for f in required}
    counts = df.groupBy(by).agg(F.count("*").alias("n_rows"), *[F.count(F.when(~h, 1)).alias(f"_m_{i}") for i, h in enumerate(has.values())])
    table = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f"_m_{i}").alias("n_missing")) for i, f in enumerate(required)])
    rows = counts.select(by, "n_rows", F.explode(table).alias("_f")).select(by, "_f.field", "n_rows", "_f.n_missing").where("n_missing > 0")
    return rows.withColumn("severity", F.when(F.col("n_missing") == F.col("n_rows"), "error").otherwise("warning"))


def quality_score(issues: DataFrame) -> DataFrame:
    errors = F.count(F.when(F.col("severity") == "error", 1))
    warnings = F.count(F.when(F.col("severity") == "warning", 1))
    score = F.greatest(F.lit(0), 100 - ERROR_PENALTY * errors - WARNING_PENALTY * warnings)
    return issues.agg(errors.alias("n_errors"), warnings.alias("n_warnings"),
                      (errors == 0).alias("passed"), score.alias("quality_score"))


def quality_report(df: DataFrame, rules: Mapping[str, Mapping], dataset: str) -> DataFrame:
    """One row: the score, the verdict and the faults themselves (at most a few per column)."""
    issues = find_issues(df, rules)
    kept = F.sort_array(F.collect_list(F.struct("severity", "column", "check", "message")))
    counted = issues.agg(kept.alias("issues"), F.count(F.when(F.col("severity") == "error", 1)).alias("n_errors"),
                         F.count(F.when(F.col("severity") == "warning", 1)).alias("n_warnings"))
    score = F.greatest(F.lit(0), 100 - ERROR_PENALTY * F.col("n_errors") - WARNING_PENALTY * F.col("n_warnings"))
    return counted.select(F.lit(dataset).alias("dataset"), F.lit(len(df.columns)).alias("n_columns"),
                          "n_errors", "n_warnings", (F.col("n_errors") == 0).alias("passed"),
                          score.alias("quality_score"), "issues")


def gate(report: DataFrame) -> DataFrame:
    """Stop the job when a one-row report says the data has errors."""
    failed = [r for r in report.where(~F.col("passed")).collect()]
    if failed:
        raise ValueError("data quality gate: " + "; ".join(i["message"] for r in failed for i in r["issues"]
                                                             if i["severity"] == "error"))
    return report


def check_target(df: DataFrame, label: str) -> DataFrame:
    """Nulls (NaN among them), values other than 0 and 1, and whether the positive rate is extreme."""
    y = F.nanvl(F.col(label).try_cast("double"), F.lit(None).cast("double"))
    rate = F.avg(y)
    low, high = TARGET_RATE_RANGE
    n_null, n_outside = F.count(F.when(y.isNull(), 1)), F.count(F.when(~y.isin(0.0, 1.0), 1))
    return df.agg(F.count("*").alias("n_samples"), n_null.alias("n_null"), n_outside.alias("n_outside"),
                  rate.alias("positive_rate"), ((n_null == 0) & (n_outside == 0)).alias("passed"),
                  F.coalesce((rate < low) | (rate > high), F.lit(False)).alias("unbalanced"))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n_rows")).where(F.col("n_rows") > 1)


def check_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: rows whose key occurs more than once, and the verdict."""
    sizes = df.groupBy(*keys).agg(F.count("*").alias("n"))
    bad = F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0))
    return sizes.agg(F.lit("unique").alias("expectation"), F.lit(",".join(keys)).alias("column"),
                     bad.alias("n_unexpected"), (bad == 0).alias("success"))


def check_value_set(df: DataFrame, column: str, allowed: Sequence) -> DataFrame:
    """One row: non-null values outside the set, and the verdict."""
    bad = F.count(F.when(~F.col(column).isin(list(allowed)), 1))
    return df.agg(F.lit("in_set").alias("expectation"), F.lit(column).alias("column"), bad.alias("n_unexpected"),
                  (bad == 0).alias("success"))


def suite_statistics(results: Sequence[DataFrame]) -> DataFrame:
    """Evaluated, successful and failed expectations and the share of successes."""
    whole = results[0]
    for r in results[1:]:
        whole = whole.unionByName(r)
    good = F.count(F.when(F.col("success"), 1))
    return whole.agg(F.count("*").alias("n_evaluated"), good.alias("n_successful"),
                     (F.count("*") - good).alias("n_failed"), (100.0 * good / F.count("*")).alias("pct_successful"))

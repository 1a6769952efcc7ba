"""Cleaning: projections, key and date handling, deduplication, sampling, splits."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from leadtime.functions.dates import age_years, parse_yyyymmdd
from leadtime.functions.names import missing, with_mark, with_prefix
from leadtime.functions.numeric import safe_columns, safe_numeric


def project_by_name(df: DataFrame, fixed: Sequence[str] = (), prefixes: Sequence[str] = (),
                    marks: Sequence[str] = ()) -> DataFrame:
    """Keep the fixed columns, those with a prefix and those whose name contains a mark."""
    wanted = [c for c in fixed if c in df.columns]
    wanted += [c for c in with_prefix(df.columns, prefixes) if prefixes and c not in wanted]
    wanted += [c for c in with_mark(df.columns, marks) if marks and c not in wanted]
    return df.select(*wanted)


def restrict_to(df: DataFrame, cohort: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """Rows whose key is in the cohort. Spark broadcasts the cohort only when its size allows."""
    on = [keys] if isinstance(keys, str) else list(keys)
    return df.join(cohort.select(*on), on, "left_semi")


def seeded_sample(df: DataFrame, n: int, keys: Sequence[str], seed: int = 42) -> DataFrame:
    """Exactly ``min(n, rows)`` rows with the smallest md5 of key and seed.

    The first four hex digits of the hash are counted first, so that only the
    rows up to the digit group that holds the n-th row are ranked; ranking
    every row of every partition would bring n rows per task to one place.
    """
    digest = F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in keys], F.lit(str(seed))))
    hashed = df.withColumn("_digest", digest)
    counts = (df.select(F.substring(digest, 1, 4).alias("_head"))
              .groupBy("_head").agg(F.count("*").alias("_n")))
    # at most 65,536 rows, whatever the table size
    tallest = (counts.agg(F.sort_array(F.collect_list(F.struct("_head", "_n"))).alias("_all"))
               .select(F.aggregate(
                   "_all", F.struct(F.lit(0).cast("bigint").alias("seen"), F.lit("").alias("head")),
                   lambda acc, x: F.when(acc["seen"] >= F.lit(n), acc).otherwise(
                       F.struct((acc["seen"] + x["_n"]).alias("seen"), x["_head"].alias("head"))),
                   lambda acc: acc["head"]).alias("_head")))
    near = hashed.where(F.substring("_digest", 1, 4) <= tallest.scalar())
    return near.orderBy("_digest", *keys).limit(n).drop("_digest")


def parse_dates(df: DataFrame, columns: Sequence[str] | None = None, mark: str = "DT") -> DataFrame:
    """Tolerant date parse of the listed columns, or of all whose name contains ``mark``."""
    types = dict(df.dtypes)
    chosen = with_mark(df.columns, mark) if columns is None else list(columns)
    chosen = [c for c in chosen if types[c] not in ("date", "timestamp", "timestamp_ntz")]
    return df.withColumns({c: parse_yyyymmdd(F.col(c), types[c]) for c in chosen})


def coerce_timestamps(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Timestamp or NULL for each listed column that exists."""
    return df.withColumns({c: F.col(c).try_cast("timestamp") for c in columns if c in df.columns})


def event_date(df: DataFrame, candidates: Sequence[str], name: str, per_row: bool = False) -> DataFrame:
    """Event date from the first candidate column that exists, or row by row with ``per_row``."""
    present = [c for c in candidates if c in df.columns]
    if not present:
        raise ValueError(f"none of the date columns {list(candidates)} exists")
    return df.withColumn(name, F.coalesce(*[F.col(c) for c in present]) if per_row else F.col(present[0]))


def normalise_key(df: DataFrame, key: str) -> DataFrame:
    require_columns(df, [key])
    return df.withColumn(key, F.col(key).cast("string"))


def to_text(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("string") for c in columns})


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the one with the smallest ``order`` values.

    An aggregate, not a window: copies of one key collapse before the shuffle.
    """
    chosen = F.min_by(F.struct(*df.columns), F.struct(*order))
    return df.groupBy(*keys).agg(chosen.alias("_row")).select("_row.*")


def sanitize(df: DataFrame, features: Sequence[str], keep: Sequence[str] = (), fill: float = 0.0) -> DataFrame:
    """Exactly the listed features as finite doubles (absent ones are filled), beside ``keep``."""
    return df.select(*keep, *[v.alias(c) for c, v in safe_columns(df, features, fill).items()])


def read_columns(df: DataFrame, columns: Sequence[str], default: float = 0.0) -> DataFrame:
    """Projection that invents absent columns with a default."""
    return df.select(*[F.col(c) if c in df.columns else F.lit(default).alias(c) for c in columns])


def align_for_scoring(df: DataFrame, features: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Reindex to the feature list and cast to double; absent columns are 0."""
    have = set(df.columns)
    return df.select(*keep, *[(F.col(c) if c in have else F.lit(0.0)).cast("double").alias(c) for c in features])


def coerce_prefixed(df: DataFrame, prefixes: Sequence[str], fill: float = 0.0) -> DataFrame:
    return df.withColumns({c: safe_numeric(c, fill) for c in with_prefix(df.columns, prefixes)})


def require_columns(df: DataFrame, columns: Sequence[str], table: str = "table") -> DataFrame:
    absent = missing(df.columns, columns)
    if absent:
        raise ValueError(f"{table} lacks the columns {absent}")
    return df


def require_tables(tables: Mapping[str, DataFrame | None], columns: Mapping[str, Sequence[str]]) -> None:
    """Every named table must be there with its required columns; all faults are listed at once."""
    faults = []
    for table, needed in columns.items():
        found = tables.get(table)
        if found is None:
            faults.append(f"{table}: missing table")
            continue
        absent = missing(found.columns, needed)
        if absent:
            faults.append(f"{table}: missing columns {absent}")
    if faults:
        raise ValueError("; ".join(faults))


def add_age(df: DataFrame, birth: str, obs: str, median_age: Column | float | None, name: str = "age") -> DataFrame:
    """Age in years at the observation date; missing ages take the given median."""
    age = age_years(F.col(birth), F.col(obs))
    if median_age is not None:
        age = F.coalesce(age, median_age if isinstance(median_age, Column) else F.lit(float(median_age)))
    return df.withColumn(name, age)


def temporal_split(df: DataFrame, year: Column, splits: Mapping[int, str], name: str = "split") -> DataFrame:
    """Name the split of each year; other years stay NULL."""
    chosen = None
    for value, split in splits.items():
        test = year == F.lit(value)
        chosen = F.when(test, F.lit(split)) if chosen is None else chosen.when(test, F.lit(split))
    return df.withColumn(name, chosen)


def union_all(shards: Sequence[DataFrame]) -> DataFrame:
    """All rows of all shards by column name; columns missing in a shard become NULL."""
    whole = shards[0]
    for shard in shards[1:]:
        whole = whole.unionByName(shard, allowMissingColumns=True)
    return whole


def absent_keys(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct keys of ``left`` that ``right`` does not have."""
    return left.select(*keys).join(right.select(*keys), list(keys), "left_anti").distinct()


def pair_by_key(features: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Put features and label on one row. Keys of one side only stay visible as
    ``matched = false``, so that a mismatch cannot pass unnoticed."""
    left = features.withColumn("_f", F.lit(True))
    right = target.withColumn("_t", F.lit(True))
    return (left.join(right, list(keys), "full_outer")
            .withColumn("matched", F.col("_f").isNotNull() & F.col("_t").isNotNull())
            .drop("_f", "_t"))

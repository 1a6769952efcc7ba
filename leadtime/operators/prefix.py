"""Running totals and ranks over a global order without a single-task window and without a job while building.

Running totals: rows are put into order-preserving buckets. A window runs inside each bucket only; the totals of the
buckets before it come from a table with one row per bucket. Bucket bounds are a subquery of the same query, so no
bucket gets much more than its share however the values are spread.

Ranks: values become 64-bit numbers in the same order, of which some twenty bits at a time are counted; only the counts
are shuffled.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

#: Bits of a value's number that the histograms look at one after another. A group's cells are ordered in one task, 4 million at most.
DIGITS = (20, 22, 22)


def _buckets(df: DataFrame, buckets: int | None) -> int:
    return max(2, buckets or 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def bounds_of(df: DataFrame, column: str, buckets: int | None = None) -> Column:
    """Increasing bounds that cut the column into about equally filled buckets, found when the query runs.

    At most ``buckets`` numbers from a quantile sketch. They only steer the distribution of work: results are the same for any bounds.
    """
    n = _buckets(df, buckets)
    sketch = F.percentile_approx(F.col(column).cast("double"), [i / n for i in range(1, n)], 10 * n)
    return df.agg(F.array_sort(F.array_distinct(F.coalesce(sketch, F.array().cast("array<double>")))).alias("b")).scalar()


def with_bucket(df: DataFrame, column: str, bounds: Column | Sequence[float], name: str = "_bucket") -> DataFrame:
    """How many bounds the value has reached, by binary search; -1 for NULL."""
    if not isinstance(bounds, Column):
        bounds = F.array(*[F.lit(float(b)) for b in sorted(bounds)]).cast("array<double>")
    value, steps = F.col(column).cast("double"), [F.lit(1 << i) for i in reversed(range(max(2, _buckets(df, None)).bit_length() + 2))]
    found = F.aggregate(F.array(*steps), F.lit(0), lambda low, step: F.when(F.get("_bounds", low + step - 1) <= value, low + step).otherwise(low))
    # never NULL: otherwise Spark adds a not-null filter to one reader only, and the rows would be computed twice
    return df.withColumn("_bounds", bounds).withColumn(name, F.coalesce(F.when(value.isNotNull(), found), F.lit(-1))).drop("_bounds")


def add_before(df: DataFrame, sums: dict[str, str], order: Sequence[str], bucket: str = "_bucket",
               groups: Sequence[str] = (), descending: bool = False, totals: dict[str, str] | None = None) -> DataFrame:
    """For each ``{new: value}``: the sum of ``value`` over all earlier rows of the group.

    ``bucket`` must rise with ``order`` and must depend on the row's own values.
    ``totals`` adds ``{new: value}`` sums over the whole group, from the same
    bucket table. Rows are shuffled once: window and join share the key (group,
    bucket), so a heavy group stays spread over its buckets. The group is one
    struct, in which a NULL equals a NULL, so no group is lost in the join.
    """
    def direction(c):
        return F.col(c).desc() if descending else F.col(c).asc()

    totals = totals or {}
    keyed = df.withColumn("_g", F.struct(*groups)) if groups else df
    by = ["_g"] if groups else []
    sizes = keyed.groupBy(*by, bucket).agg(*[F.sum(v).alias(f"_t_{v}") for v in {*sums.values(), *totals.values()}])
    over = Window.partitionBy(*by).orderBy(direction(bucket)).rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        *by, bucket, *[F.coalesce(F.sum(f"_t_{v}").over(over), F.lit(0)).alias(f"_s_{n}") for n, v in sums.items()],
        *[F.sum(f"_t_{v}").over(Window.partitionBy(*by)).alias(n) for n, v in totals.items()])
    inside = (Window.partitionBy(*by, bucket).orderBy(*[direction(c) for c in order])
              .rowsBetween(Window.unboundedPreceding, -1))
    ran = keyed.withColumns({n: F.coalesce(F.sum(v).over(inside), F.lit(0)) for n, v in sums.items()})
    joined = ran.join(starts, [*by, bucket])
    return joined.withColumns({n: F.col(n) + F.col(f"_s_{n}") for n in sums}).drop("_g", *[f"_s_{n}" for n in sums])


def with_order_key(df: DataFrame, column: str, name: str) -> DataFrame:
    """A DOUBLE as a BIGINT that rises with it, one number for each value: sign, binary exponent and 52 bits of mantissa.

    Both zeros are 0. NULL and NaN have no number. Each step is a projection of its own, so that none is computed twice.
    """
    least, most, value = 2.0 ** -1022, 1.7976931348623157e308, F.col(column)
    steps = df.withColumn("_size", F.abs(value))
    steps = steps.withColumn("_e", F.least(F.floor(F.log2(F.when(F.col("_size").between(least, most), F.col("_size")).otherwise(F.lit(1.0)))), F.lit(1023)))
    steps = steps.withColumn("_m", F.col("_size") / F.pow(F.lit(2.0), F.col("_e")))  # may be just outside [1, 2) beside a power of two
    high, low = F.col("_m") >= 2.0, F.col("_m") < 1.0
    normal = ((F.col("_e") + F.when(high, 1024).when(low, 1022).otherwise(1023)) * (1 << 52)
              + ((F.when(high, F.col("_m") / 2).when(low, F.col("_m") * 2).otherwise(F.col("_m")) - 1.0) * float(1 << 52)).cast("bigint"))
    number = (F.when(F.col("_size").between(least, most), normal).when(F.col("_size") > most, F.lit(2047 << 52))
              .otherwise((F.col("_size") / F.lit(2.0 ** -1074)).cast("bigint")))
    steps = steps.withColumn("_b", F.when(~F.isnan("_size"), number))
    return steps.withColumn(name, F.when(value < 0, -F.col("_b")).otherwise(F.col("_b"))).drop("_size", "_e", "_m", "_b")


def rank_values(df: DataFrame, column: str, wanted: Mapping[str, str], by: Sequence[str] = (), weight: str | None = None) -> DataFrame:
    """(by..., n, one column per wanted rank): the values at exact ranks of a column, for all groups and ranks at once.

    ``wanted`` maps names to SQL for a 0-based rank from the group's number of values ``_n``; ``weight`` counts a row
    several times. NULL and NaN are left out; a group without values has no row, but without ``by`` there is one row in any case.
    ``by`` must have few distinct values: groups times ranks rows are broadcast.

    A histogram of the highest bits finds each rank's cell, a histogram of the next bits the cell within that one, and so on: the
    rows are read three times, the later times only between the cells' least and largest values. No value is shuffled, and
    nothing is approximate or depends on partitions.
    """
    value = F.col(column).cast("double")
    group = F.struct(*by) if by else F.lit(0)
    rows = (df.select(group.alias("_g"), value.alias("_v"), (F.col(weight) if weight else F.lit(1)).cast("bigint").alias("_w"))
            .where(F.col("_v").isNotNull() & ~F.isnan("_v")))
    ranks = "array(" + ", ".join(f"named_struct('name', '{n}', 'rank', CAST({e} AS BIGINT))" for n, e in wanted.items()) + ")"
    found, shift = None, 64
    for bits in DIGITS:
        cells, keys, shift = rows, ["_g"], shift - bits
        if found is not None:
            keys = ["_g", "_prefix", "_ranks"]
            targets = found.groupBy(F.col("_g").alias("_of"), "_prefix", "_low", "_high").agg(F.array_sort(F.collect_list("_rank")).alias("_ranks"))
            cells = cells.join(F.broadcast(targets), (F.col("_g") == F.col("_of")) & F.col("_v").between(F.col("_low"), F.col("_high")))
        digit = F.shiftright("_k", shift)
        cells = with_order_key(cells, "_v", "_k").withColumn("_digit", digit if found is None else digit.bitwiseAND(F.lit((1 << bits) - 1)))
        counts = cells.groupBy(*keys, "_digit").agg(F.sum("_w").alias("_here"), F.min("_v").alias("_low"), F.max("_v").alias("_high"))
        inside = Window.partitionBy(*keys).orderBy("_digit")
        run = counts.withColumn("_before", F.coalesce(F.sum("_here").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        if found is None:
            run = run.withColumn("_n", F.sum("_here").over(Window.partitionBy(*keys))).withColumn("_ranks", F.expr(
                f"transform({ranks}, r -> named_struct('name', r.name, 'rank', r.rank, 'n', _n))"))
        hit = run.withColumn("_at", F.explode("_ranks")).where((F.col("_at.rank") >= F.col("_before")) & (F.col("_at.rank") < F.col("_before") + F.col("_here")))
        prefix = F.col("_digit") if found is None else F.shiftleft("_prefix", bits).bitwiseOR(F.col("_digit"))
        rank = F.struct(F.col("_at.name").alias("name"), (F.col("_at.rank") - F.col("_before")).alias("rank"), F.col("_at.n").alias("n"))
        found = hit.select("_g", prefix.alias("_prefix"), rank.alias("_rank"), "_low", "_high")
    picked = [F.max(F.when(F.col("_rank.name") == n, F.col("_low"))).alias(n) for n in wanted]
    whole = found.groupBy("_g") if by else found
    out = whole.agg(F.max("_rank.n").alias("n"), *picked)
    return out.select(*[F.col(f"_g.{c}").alias(c) for c in by], F.coalesce("n", F.lit(0)).alias("n"), *wanted)


def exact_quantile(df: DataFrame, column: str, q: float = 0.5, name: str = "value", by: Sequence[str] = ()) -> DataFrame:
    """The interpolated quantile as a one-row table (or one row per group), exact at any size; NULL where there are no values."""
    spot = f"(_n - 1) * {float(q)!r}D"
    near = rank_values(df, column, {"_low": f"floor({spot})", "_high": f"ceil({spot})"}, by)
    at = (F.col("n") - 1) * F.lit(float(q))
    return near.select(*by, (F.col("_low") + (F.col("_high") - F.col("_low")) * (at - F.floor(at))).alias(name))

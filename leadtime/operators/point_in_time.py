"""Point-in-time features and labels.

For every (entity, observation date) the features see only events strictly
before the date, and the label sees only events after it.

Shape of the plan. The borders of all windows of all listed dates cut time into
segments. Each table is read once, and each event gets its segment's number; an
aggregate leaves one row per (entity, segment), whatever the number of dates,
windows and features. A code counts from the first segment that has it, so
distinct codes need no per-group set: the same aggregate also reduces every (entity, code) to
that segment. Only then are segments expanded to dates, as ranges of numbers. All
steps combine map-side, so an entity with a third of all events costs
one partial row per task and segment. One left join brings the features to the cohort.
"""

from __future__ import annotations

from calendar import monthrange
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from leadtime.functions.dates import in_forward, whole_days
from leadtime.functions.numeric import safe_numeric


@dataclass(frozen=True)
class Source:
    """One kind of event: whose, when, and optionally how much, which code and which rows.

    Sources that name the same ``events`` table, key and time are read in one scan.
    """

    name: str
    events: DataFrame
    key: str
    time: str
    amount: str | None = None
    code: str | None = None
    where: Column | None = None


@dataclass(frozen=True)
class Feature:
    """One output column. Kinds: count, trailing, sum, distinct, recency, ahead, ahead_count."""

    name: str
    kind: str
    source: str
    months: int | None = None


def count_before(source: str, name: str) -> Feature:
    return Feature(name, "count", source)


def count_trailing(source: str, months: int, name: str) -> Feature:
    return Feature(name, "trailing", source, months)


def sum_before(source: str, name: str) -> Feature:
    return Feature(name, "sum", source)


def distinct_before(source: str, name: str) -> Feature:
    return Feature(name, "distinct", source)


def days_since_last(source: str, name: str) -> Feature:
    return Feature(name, "recency", source)


def event_ahead(source: str, months: int, name: str) -> Feature:
    """1 when an event falls into ``(obs, obs + months]``."""
    return Feature(name, "ahead", source, months)


def count_ahead(source: str, months: int, name: str) -> Feature:
    return Feature(name, "ahead_count", source, months)


def cohort_on(entities: DataFrame, key: str, obs_dates: Sequence[date], obs: str = "obs_date") -> DataFrame:
    """Every entity at every observation date; the dates are a short literal list."""
    dates = F.array(*[F.lit(d) for d in obs_dates])
    return entities.select(key).distinct().withColumn(obs, F.explode(dates))


def _months_back(features: Sequence[Feature]) -> list[int]:
    return sorted({f.months for f in features if f.kind == "trailing"})


def _months_ahead(features: Sequence[Feature]) -> list[int]:
    return sorted({f.months for f in features if f.kind in ("ahead", "ahead_count")})


def _needs_past(features: Sequence[Feature]) -> bool:
    return any(f.kind in ("count", "sum", "distinct", "recency") for f in features)


def _scan_bounds(df: DataFrame, time: str, obs_dates: Sequence[date], features: Sequence[Feature]) -> DataFrame:
    """Constant time bounds on the raw column, so that they reach the file scan."""
    ts, ahead, back = F.col(time), _months_ahead(features), _months_back(features)
    last = F.lit(max(obs_dates))
    df = df.where(ts <= F.add_months(last, ahead[-1]) if ahead else ts < last)
    if not _needs_past(features):
        first = F.lit(min(obs_dates))
        df = df.where(ts >= F.add_months(first, -back[-1]) if back else ts > first)
    return df


def _shifted(d: date, months: int) -> date:
    """The day ``months`` later, or the last day of that month where it has none such."""
    y, m = divmod(d.year * 12 + d.month - 1 + months, 12)
    return date(y, m + 1, min(d.day, monthrange(y, m + 1)[1]))


class Lattice:
    """Time cut into numbered segments by the window borders of all observation dates.

    A border is (day, False), passed from the day's first moment on, or (day, True), passed after that moment. An event's
    segment is the number of borders it has passed, so every window is a range of segment numbers.
    """

    def __init__(self, obs_dates: Sequence[date], features: Sequence[Feature]):
        self.obs_dates, self.back, self.ahead = sorted(set(obs_dates)), _months_back(features), _months_ahead(features)
        borders = set()
        for d in self.obs_dates:
            borders |= {(d, False)} | {(_shifted(d, -m), False) for m in self.back}
            borders |= {(_shifted(d, m), True) for m in (0, *self.ahead) if self.ahead}
        self.borders = sorted(borders)
        self.past = _needs_past(features)

    def segment(self, time: str, kind: str) -> str:
        """SQL for an event's segment: a binary search over the borders, which are constants of the time's own type."""
        def search(low: int, high: int) -> str:
            if low == high:
                return str(low)
            middle = (low + high) // 2
            day, after = self.borders[middle]
            return f"IF({time} {'>' if after else '>='} CAST(DATE'{day}' AS {kind}), {search(middle + 1, high)}, {search(low, middle)})"

        return search(0, len(self.borders))

    def date_table(self) -> str:
        """SQL for the dates with their windows as segment numbers: ``at`` the last one before the date, ``back_m`` and ``from``
        the first, ``ahead_m`` the last of a window, ``low`` and ``high`` what any window of the date needs."""
        place, rows = {b: i for i, b in enumerate(self.borders)}, []
        for d in self.obs_dates:
            at, back = place[d, False], {m: place[_shifted(d, -m), False] + 1 for m in self.back}
            ahead = {m: place[_shifted(d, m), True] for m in self.ahead}
            low = 0 if self.past else min(back.values(), default=place[d, True] + 1 if ahead else at + 1)
            cells = {"at": at, **{f"back_{m}": i for m, i in back.items()}, "from": place[d, True] + 1 if ahead else at,
                     **{f"ahead_{m}": i for m, i in ahead.items()}, "low": low, "high": max(ahead.values(), default=at)}
            rows.append(f"named_struct('obs', DATE'{d}', " + ", ".join(f"'{k}', {v}" for k, v in cells.items()) + ")")
        return "array(" + ", ".join(rows) + ")"


def attach_dates(df: DataFrame, time: str, obs_dates: Sequence[date], obs: str = "obs_date",
                 relevant=None) -> DataFrame:
    """Each event once per observation date it precedes (or that ``relevant(ts, obs)`` accepts).

    A generator over a short literal list and a filter replace the range join.
    """
    test = relevant or (lambda ts, d: ts < d)
    dates = F.array(*[F.lit(d) for d in obs_dates])
    return df.withColumn(obs, F.explode(dates)).where(test(F.col(time), F.col(obs)))


#: Per source, what the rows of a segment add up to: events, amounts, the last time, codes met for the first time.
_MEASURES = {"count": "n", "trailing": "n", "ahead": "n", "ahead_count": "n", "sum": "amt", "recency": "last", "distinct": "codes"}


def _measures(features: Sequence[Feature]) -> list[tuple[str, str]]:
    unknown = {f.kind for f in features} - set(_MEASURES)
    if unknown:
        raise ValueError(f"unknown feature kind {sorted(unknown)}")
    return sorted({(_MEASURES[f.kind], f.source) for f in features})


def _segment_rows(group: Sequence[Source], features: Sequence[Feature], lattice: Lattice | None, key: str, moment: str) -> DataFrame:
    """Rows (key, _segment, one column per measure) of sources that share a table, from one scan of it.

    A source with codes adds a row for each (entity, code), in the code's first segment. Without a lattice each moment is a
    segment, numbered by its microseconds.
    """
    by = {s.name: s for s in group}
    mine = [f for f in features if f.source in by]
    measures = _measures(mine)
    coded = [name for kind, name in measures if kind == "codes"]
    for name in coded:
        if by[name].code is None:
            raise ValueError(f"source {name} has no code column to count")
    for kind, name in measures:
        if kind == "amt" and by[name].amount is None:
            raise ValueError(f"source {name} has no amount column to sum")
    time, kind = group[0].time, dict(group[0].events.dtypes)[group[0].time]
    if lattice is None:
        events, segment = group[0].events.where(F.col(time).isNotNull()), f"unix_micros(CAST(`{time}` AS timestamp))"
    else:
        events, segment = _scan_bounds(group[0].events, time, lattice.obs_dates, mine), lattice.segment(f"`{time}`", kind)
    if all(s.where is not None for s in group):
        events = events.where(reduce(lambda a, b: a | b, [s.where for s in group]))

    def within(s: Source, value: Column) -> Column:
        return value if s.where is None else F.when(s.where, value)

    def value(kind: str, s: Source) -> Column:
        if kind == "n":
            # a condition even where all rows count: Spark would move a constant into some readers of a shared shuffle only
            return F.when(F.col(s.time).isNotNull() if s.where is None else s.where, 1).otherwise(0).cast("long")
        if kind == "amt":
            return within(s, safe_numeric(s.amount))
        return within(s, F.col(s.time).cast(moment))

    plain = [(kind, name) for kind, name in measures if kind != "codes"]
    rows = events.select(F.col(group[0].key).alias(key), F.expr(segment).alias("_segment"),
                         *[value(m, by[name]).alias(f"_{m}_{name}") for m, name in plain],
                         *[within(by[name], F.col(by[name].code)).alias(f"_code_{name}") for name in coded])
    if not coded:
        return rows
    # an event takes part in the row of its (entity, segment) and in one for each (entity, code), all in one aggregate; rows of
    # the one kind have a cell, of the other a code, and what a kind does not use is NULL, which shuffles small
    kinds = dict(rows.dtypes)
    codes = [f"_code_{name}" for name in coded]
    none = {c: F.lit(None).cast(kinds[c]) for c in codes}
    nowhere = F.lit(None).cast(kinds["_segment"])
    parts = [F.struct(F.col("_segment").alias("_cell"), nowhere.alias("_first"), *[none[c].alias(c) for c in codes])] if plain else []
    parts += [F.struct(nowhere.alias("_cell"), F.col("_segment").alias("_first"), *[(F.col(c) if c == own else none[c]).alias(c) for c in codes])
              for own in codes]
    spread = rows.select(key, *[f"_{m}_{name}" for m, name in plain], F.inline(F.array(*parts)))
    kept = reduce(lambda a, b: a | b, [F.col(c).isNotNull() for c in codes], F.col("_cell").isNotNull())
    found = spread.where(kept).groupBy(key, "_cell", *codes).agg(
        F.min("_first").alias("_first"),
        *[(F.max if m == "last" else F.sum)(F.when(F.col("_cell").isNotNull(), F.col(f"_{m}_{name}"))).alias(f"_{m}_{name}") for m, name in plain])
    met = [F.col(c).isNotNull().cast("long").alias(f"_codes_{name}") for c, name in zip(codes, coded)]
    return found.select(key, F.coalesce("_cell", "_first").alias("_segment"), *[f"_{m}_{name}" for m, name in plain], *met)


def _aggregate(f: Feature) -> Column:
    """A feature as the conditional aggregate over the segments of its window, as SQL text: the builds have dozens of them."""
    inside = {"trailing": f"_segment BETWEEN _d.back_{f.months} AND _d.at",
              "ahead": f"_segment BETWEEN _d.from AND _d.ahead_{f.months}",
              "ahead_count": f"_segment BETWEEN _d.from AND _d.ahead_{f.months}"}.get(f.kind, "_segment <= _d.at")
    value = f"`_{_MEASURES[f.kind]}_{f.source}`"
    shape = {"recency": "max(CASE WHEN {0} THEN {1} END)", "ahead": "max(CASE WHEN {0} AND {1} > 0 THEN 1 ELSE 0 END)",
             "sum": "sum(CASE WHEN {0} THEN coalesce({1}, 0.0D) ELSE 0.0D END)"}
    return F.expr(shape.get(f.kind, "sum(CASE WHEN {0} THEN coalesce({1}, 0L) ELSE 0L END)").format(inside, value)).alias(f.name)


def _combined(rows: DataFrame, key: str) -> DataFrame:
    """One row per entity and segment."""
    names = [c for c in rows.columns if c not in (key, "_segment")]
    return rows.groupBy(key, "_segment").agg(*[(F.max if n.startswith("_last_") else F.sum)(n).alias(n) for n in names])


def _parts(sources: Sequence[Source], features: Sequence[Feature], lattice: Lattice | None, key: str) -> tuple[list[tuple[DataFrame, bool]], str]:
    """The rows of each table that sources name, and whether they have codes; the type of the last moments."""
    used = [s for s in sources if any(f.source == s.name for f in features)]
    unknown = {f.source for f in features} - {s.name for s in used}
    if unknown:
        raise ValueError(f"features refer to unknown sources {sorted(unknown)}")
    groups: dict[tuple, list[Source]] = {}
    for s in used:
        groups.setdefault((id(s.events), s.key, s.time), []).append(s)
    # the last moments of a day are told apart only where a source has them
    moment = "date" if all(dict(s.events.dtypes)[s.time] == "date" for s in used) else "timestamp"
    coded = {f.source for f in features if f.kind == "distinct"}
    return [(_segment_rows(group, features, lattice, key, moment), any(s.name in coded for s in group)) for group in groups.values()], moment


def _cells(sources: Sequence[Source], features: Sequence[Feature], lattice: Lattice, key: str) -> DataFrame:
    """One row per entity and segment with the measures of all sources."""
    parts, _ = _parts(sources, features, lattice, key)
    return _combined(reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [rows for rows, _ in parts]), key)


def entity_features(sources: Sequence[Source], features: Sequence[Feature], obs_dates: Sequence[date],
                    key: str, obs: str = "obs_date") -> DataFrame:
    """All features of the (entity, date) pairs that have at least one relevant event."""
    lattice = Lattice(obs_dates, features)
    cells = _cells(sources, features, lattice, key)
    dated = cells.withColumn("_d", F.expr(f"explode({lattice.date_table()})")).where("_segment BETWEEN _d.low AND _d.high")
    out = dated.groupBy(key, F.col("_d.obs").alias(obs)).agg(*[_aggregate(f) for f in features])
    days = {f.name: whole_days(F.col(f.name), F.col(obs)) for f in features if f.kind == "recency"}
    return out.withColumns(days) if days else out


def point_in_time(cohort: DataFrame, sources: Sequence[Source], features: Sequence[Feature],
                  obs_dates: Sequence[date], key: str, obs: str = "obs_date") -> DataFrame:
    """The cohort with every feature; pairs without events get 0."""
    found = entity_features(sources, features, obs_dates, key, obs)
    return cohort.join(found, [key, obs], "left").fillna(0, [f.name for f in features])


def point_in_time_any_dates(cohort: DataFrame, sources: Sequence[Source], features: Sequence[Feature],
                            key: str, obs: str = "obs_date", slice_days: int = 30) -> DataFrame:
    """The same features and labels where every cohort row has its own date and the dates cannot be listed.

    Each (entity, date) puts a few probes among the entity's moments: at the date and at its windows' borders. A
    feature is the difference of running totals at two probes, so nothing is copied into windows. An entity's time is
    cut into slices of ``slice_days``; totals run inside a slice, and what the slices before it
    add up to comes from a table with one row per entity and slice. So no task holds a whole entity.
    """
    names = [f"_{m}_{name}" for m, name in _measures(features)]
    # a source's last moment is the last segment with an event of it, so its number of events is all that is shuffled
    counted = [Feature(f.name, "count", f.source) if f.kind == "recency" else f for f in features]
    parts, moment = _parts(sources, counted, None, key)
    # rows with codes come from an aggregate already
    cells = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [rows if coded else _combined(rows, key) for rows, coded in parts])
    back, ahead, day = _months_back(features), _months_ahead(features), f"CAST(`{obs}` AS date)"
    # (name, day, whether the moment itself still counts)
    borders = [("at", day, False)] + [(f"back_{m}", f"add_months({day}, {-m})", False) for m in back]
    borders += [("from", day, True)] * bool(ahead) + [(f"ahead_{m}", f"add_months({day}, {m})", True) for m in ahead]
    each = ", ".join(f"named_struct('name', '{n}', 'at', unix_micros(CAST({d} AS timestamp)), 'after', {2 if after else 0})" for n, d, after in borders)
    probes = (cohort.select(key, obs).where(F.col(obs).isNotNull()).distinct().withColumn("_p", F.expr(f"explode(array({each}))"))
              .select(key, F.col(obs).alias("_obs"), F.col("_p.name").alias("_probe"), F.col("_p.at").alias("_segment"), F.col("_p.after").alias("_turn")))
    # of one moment: probes that leave it out, its events, probes that take it in; an entity without a key meets no row of the cohort
    line = (cells.withColumn("_turn", F.lit(1)).unionByName(probes, allowMissingColumns=True).where(F.col(key).isNotNull())
            .withColumn("_slice", F.coalesce(F.floor(F.col("_segment") / F.lit(slice_days * 86_400_000_000)), F.lit(0))))  # never NULL, see prefix

    def total(name: str, column: str) -> Column:
        return (F.max if name.startswith("_last_") else F.sum)(column)

    def own(name: str) -> Column:
        return F.when(F.col(name.replace("_last_", "_n_", 1)) > 0, F.col("_segment")) if name.startswith("_last_") else F.col(name)

    def together(name: str, a: Column, b: Column) -> Column:
        if name.startswith("_last_"):
            return F.timestamp_micros(F.greatest(a, b)).cast(moment)
        zero = F.lit(0.0 if name.startswith("_amt_") else 0)
        return F.coalesce(a, zero) + F.coalesce(b, zero)

    line = line.repartition(key, "_slice")  # what windows compute of a row's values comes after the shuffle
    order = Window.partitionBy(key, "_slice").orderBy("_segment", "_turn")
    inside = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ran = line.withColumns({**{f"_in{n}": total(n, own(n)).over(inside) for n in names},
                            "_asked": F.max(F.when(F.col("_probe").isNotNull(), F.col("_obs"))).over(inside), "_end": F.lead("_turn").over(order).isNull()})
    # the last row of a slice has the slice's totals; both readers need the same columns, so that one shuffle serves them. What came
    # before is kept for slices with probes only
    earlier = Window.partitionBy(key).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = (ran.where("_end").select(key, "_slice", "_asked", *[total(n, f"_in{n}").over(earlier).alias(f"_to{n}") for n in names])
               .where(F.col("_asked").isNotNull()))
    met = ran.where(F.col("_probe").isNotNull()).join(carried.drop("_asked"), [key, "_slice"]).select(
        key, "_obs", "_probe", *[together(n, F.col(f"_in{n}"), F.col(f"_to{n}")).alias(n) for n in names])
    needed = {f"{probe}{n}": F.max(F.when(F.col("_probe") == probe, F.col(n))).alias(f"{probe}{n}") for probe, _, _ in borders for n in names}
    wide = met.groupBy(key, F.col("_obs").alias(obs)).agg(*needed.values())

    def value(f: Feature) -> Column:
        n = f"_{_MEASURES[f.kind]}_{f.source}"
        if f.kind == "trailing":
            return F.col(f"at{n}") - F.col(f"back_{f.months}{n}")
        if f.kind in ("ahead", "ahead_count"):
            later = F.col(f"ahead_{f.months}{n}") - F.col(f"from{n}")
            return later if f.kind == "ahead_count" else (later > 0).cast("int")
        return whole_days(F.col(f"at{n}"), F.col(obs)) if f.kind == "recency" else F.col(f"at{n}")

    found = wide.select(key, obs, *[value(f).alias(f.name) for f in features])
    return (cohort.join(found, [key, obs], "left")
            .withColumns({f.name: F.coalesce(F.col(f.name), F.lit(0)) for f in features}))


def forward_label(cohort: DataFrame, events: DataFrame, key: str, time: str, obs_dates: Sequence[date],
                  months: int = 6, name: str = "label", obs: str = "obs_date",
                  codes: tuple[str, Sequence] | None = None, event_key: str | None = None) -> DataFrame:
    """1 for cohort rows with a matching event in ``(obs, obs + months]``, else 0.

    ``codes`` restricts the events to listed values of a column, if the table has it.
    """
    if codes and codes[0] in events.columns:
        events = events.where(F.col(codes[0]).isin(list(codes[1])))
    found = entity_features([Source("e", events, event_key or key, time)], [event_ahead("e", months, name)], obs_dates, key, obs)
    return (cohort.join(found.select(key, obs, name), [key, obs], "left")
            .withColumn(name, F.coalesce(F.col(name), F.lit(0))))


def label_audit(events: DataFrame, key: str, time: str, obs_dates: Sequence[date], months: int,
                obs: str = "obs_date") -> DataFrame:
    """Per observation date: events inside the label window and the entities they belong to."""
    window = [event_ahead("e", months, "_")]
    rows = _scan_bounds(events.select(key, time), time, obs_dates, window)
    rows = attach_dates(rows, time, obs_dates, obs, lambda ts, d: in_forward(ts, d, months))
    per_entity = rows.groupBy(obs, key).agg(F.count("*").alias("_n"))
    return per_entity.groupBy(obs).agg(F.sum("_n").alias("n_events"), F.count("*").alias("n_entities"))


def latest_before(events: DataFrame, key: str, time: str, payload: Sequence[str], obs_dates: Sequence[date],
                  obs: str = "obs_date") -> DataFrame:
    """The last event strictly before each date, with its payload; ties go to the largest payload."""
    rows = events.select(key, time, *payload).where(F.col(time) < F.lit(max(obs_dates)))
    rows = attach_dates(rows, time, obs_dates, obs)
    best = F.max(F.struct(F.col(time), *[F.col(p) for p in payload]))
    return rows.groupBy(key, obs).agg(best.alias("_last")).select(key, obs, "_last.*")


def without_history(cohort: DataFrame, events: DataFrame, key: str, time: str, obs_dates: Sequence[date],
                    obs: str = "obs_date") -> DataFrame:
    """Cohort rows with no event before their date."""
    rows = events.select(key, time).where(F.col(time) < F.lit(max(obs_dates)))
    seen = rows.groupBy(key).agg(F.min(time).alias("_first"))
    late = cohort.join(seen, key, "left")
    return late.where(F.col("_first").isNull() | (F.col("_first") >= F.col(obs))).drop("_first")


def rolling_counts(events: DataFrame, key: str, time: str, days: int, name: str) -> DataFrame:
    """Per entity and moment: events of the entity in the ``days`` before it, that moment excluded.

    Events of the same moment (to the microsecond) collapse first. A heavy entity is then split into
    time slices as long as the window; a slice also sees a copy of the slice
    before it, so no task has to hold a whole entity.
    """
    span = days * 86400 * 1_000_000
    moments = (events.where(F.col(time).isNotNull())
               .groupBy(key, F.unix_micros(F.col(time).cast("timestamp")).alias("_at"))
               .agg(F.count("*").alias("n_at")))
    copies = (moments.withColumn("_copy", F.explode(F.array(F.lit(0), F.lit(1))))
              .withColumn("_slice", F.floor(F.col("_at") / span) + F.col("_copy")))
    w = Window.partitionBy(key, "_slice").orderBy("_at").rangeBetween(-span, -1)
    return (copies.withColumn(name, F.coalesce(F.sum("n_at").over(w), F.lit(0))).where(F.col("_copy") == 0)
            .select(key, F.timestamp_micros("_at").alias(time), "n_at", name))

"""The star model: related tables and the evaluation of measures over any grouping.

A measure is arithmetic over base aggregates. For a query the aggregates are collected, grouped
into frames that can be computed together, reduced, stacked, and combined:

* A frame makes one pass over its fact, however many calendar periods it serves.
* It first reduces the fact to the foreign keys and columns the query needs, with partial
  aggregation in the map tasks. Dimensions and parent facts are joined to these reduced rows, so a
  hot patient or admission crosses the network as one row per map task.
* Bills are also stored with the keys of their admission. A query that these columns cover groups this companion by the keys of the
  star and joins no admission; others go by the relationship.
* No join carries a broadcast hint. Spark broadcasts sides whose measured size is below its
  threshold and otherwise sorts and splits skewed keys at run time.
* A filter inside a measure replaces the context on its own column. When the query groups by that
  column, or by one that does not reach the fact, the aggregate is computed without it and joined
  back on the other grouping columns.
"""

from __future__ import annotations

from collections import ChainMap
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, replace
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oreline.plans import timeintel
from oreline.plans.gold import month_of as gold_month
from oreline.plans.gold import patient_bits
from oreline.sources.raw import stored

DATE = "dim_date"
DEPARTMENT_NAME = "dim_department.department_name"

# Many-to-one relationships: (table, column) -> (table, key).
RELATIONSHIPS = {
    ("fact_admissions", "patient_id"): ("dim_patient", "patient_key"),
    ("fact_admissions", "department_key"): ("dim_department", "department_key"),
    ("fact_admissions", "doctor_key"): ("dim_doctor", "doctor_key"),
    ("fact_admissions", "admission_date_key"): (DATE, "date_key"),
    ("fact_billing", "admission_id"): ("fact_admissions", "admission_id"),
    ("fact_billing", "patient_id"): ("dim_patient", "patient_key"),
    ("fact_bed_occupancy", "department_key"): ("dim_department", "department_key"),
    ("fact_bed_occupancy", "snapshot_date_key"): (DATE, "date_key"),
}
TABLE_NAMES = [
    "dim_date", "dim_patient", "dim_department", "dim_doctor",
    "fact_admissions", "fact_billing", "fact_bed_occupancy",
]
# A fact that is stored with columns of its parent, named parent__column, and whether it has found it.
COMPANIONS = {("fact_billing", "fact_admissions"): "fact_billing_keyed"}
FOUND = "found"
# Numbers of the patients and, by month and department, bitmaps over them.
PATIENT_BITS = ("patient_numbers", "patient_months")
# The column a fact is stored by, equal to the year of its date.
YEAR_PARTITION = {"fact_admissions": "admission_year", "fact_bed_occupancy": "snapshot_year"}


@dataclass(frozen=True)
class Agg:
    """One base aggregate.

    ``kind``: ``rows``, ``values`` (non-NULL values), ``sum``, ``distinct`` (a NULL counts as one
    value), ``daily_mean`` (mean over days of the mean per day) or ``rank`` (dense rank among all
    departments by row count). ``only`` is a filter that replaces the context on its column.
    ``period`` is a calendar function. ``exact`` is a decimal type to sum a double in.
    """

    table: str
    kind: str
    column: str | None = None
    only: tuple[str, Any] | None = None
    period: str | None = None
    exact: str | None = None


@dataclass(frozen=True)
class Measure:
    """``expr`` maps a lookup from aggregate to column to the value of the measure.

    ``fills`` says that the measure has a value even where all its aggregates are blank.
    """

    expr: Callable[[Callable[[Agg], Column]], Column]
    fills: bool = False


def condition(column: Column, wanted: Any) -> Column:
    """A filter value: one value, several, None for NULL, or a function of the column."""
    if callable(wanted):
        return wanted(column)
    if wanted is None:
        return column.isNull()
    if isinstance(wanted, (list, tuple, set, frozenset)):
        return column.isin(list(wanted))
    return column == F.lit(wanted)


def _flat(qualified: str) -> str:
    return qualified.replace(".", "__")


def _table(qualified: str) -> str:
    return qualified.split(".", 1)[0]


def _column(qualified: str) -> str:
    return qualified.split(".", 1)[1]


def _reached_from(table: str) -> set[str]:
    found = {table}
    for (source, _), (target, _) in RELATIONSHIPS.items():
        if source == table:
            found |= _reached_from(target)
    return found


def _first_hop(table: str, target: str) -> tuple[str, str, str]:
    """(foreign key, next table, its key) on the way to ``target``; a direct relationship first."""
    hops = [(fk, nxt, key) for (source, fk), (nxt, key) in RELATIONSHIPS.items() if source == table]
    hops.sort(key=lambda hop: hop[1] != target)
    return next(hop for hop in hops if target in _reached_from(hop[1]))


def _date_fact(table: str) -> str:
    """The table on the way from ``table`` to the calendar that holds the date key."""
    while True:
        _, nxt, _ = _first_hop(table, DATE)
        if nxt == DATE:
            return table
        table = nxt


def _date_column(table: str) -> str:
    """The qualified date key that ``table`` is counted by."""
    fact = _date_fact(table)
    return f"{fact}.{_first_hop(fact, DATE)[0]}"


@dataclass(frozen=True)
class _FrameKey:
    """What aggregates must share to be computed in one pass over their table."""

    table: str
    group: tuple[str, ...]
    where: tuple[tuple[str, Any], ...]
    alone: Agg | None


class Star:
    """Tables of a star model, by name, and queries over them."""

    def __init__(self, tables: Mapping[str, DataFrame], last_date: str = "data"):
        if last_date not in ("data", "calendar"):
            raise ValueError("last_date must be 'data' or 'calendar'")
        self.tables = tables
        self.last_date = last_date

    @classmethod
    def read(cls, spark: SparkSession, folder: str, last_date: str = "data") -> Star:
        tables = {n: spark.read.parquet(f"{folder}/{n}") for n in TABLE_NAMES}
        tables |= {n: spark.read.parquet(f"{folder}/{n}") for n in COMPANIONS.values() if stored(spark, f"{folder}/{n}")}
        return cls(tables, last_date)

    def with_tables(self, tables: Mapping[str, DataFrame]) -> Star:
        """The star with some tables replaced. A companion of a replaced table no longer holds, unless it is replaced too."""
        stale = {name: None for pair, name in COMPANIONS.items() if any(t in tables for t in pair)}
        if "fact_admissions" in tables:
            stale |= dict.fromkeys(PATIENT_BITS)
        return Star(ChainMap(stale | dict(tables), self.tables), self.last_date)

    def companion(self, table: str, parent: str) -> DataFrame | None:
        """The stored form of a fact that carries columns of its parent, if there is one."""
        name = COMPANIONS.get((table, parent))
        try:
            return self.tables[name] if name else None
        except KeyError:
            return None

    # ---- queries ---------------------------------------------------------------------------

    def query(
        self,
        measures: Mapping[str, Measure],
        by: Sequence[str] = (),
        where: Mapping[str, Any] | None = None,
        keep_empty: bool = False,
    ) -> DataFrame:
        """One row per group with the measures as columns.

        ``by`` and the keys of ``where`` are qualified, as in ``dim_date.year``. Rows in which all
        measures are blank are dropped unless ``keep_empty``.
        """
        by, where = list(by), dict(where or {})
        names = [_column(c) for c in by]
        if len({*names, *measures}) != len(names) + len(measures):
            raise ValueError(f"duplicate output columns in {names} and {list(measures)}")

        aggs: dict[Agg, str] = {}

        def collect(agg: Agg) -> Column:
            aggs.setdefault(agg, f"_a{len(aggs)}")
            return F.lit(None)

        for measure in measures.values():
            measure.expr(collect)

        needs_domain = keep_empty or any(m.fills for m in measures.values())
        combined = self._combine(aggs, by, where, needs_domain)

        def value(agg: Agg) -> Column:
            column = F.col(aggs[agg])
            return column.cast("double") if self._is_decimal(agg) else column

        result = combined.select(
            *[F.col(_flat(c)).alias(n) for c, n in zip(by, names)],
            *[m.expr(value).alias(name) for name, m in measures.items()],
        )
        if by and not keep_empty:
            result = result.dropna(how="all", subset=list(measures))
        return result

    def rollup(
        self, measures: Mapping[str, Measure], by: Sequence[str], where: Mapping[str, Any] | None = None
    ) -> DataFrame:
        """The query at every prefix of ``by`` down to the grand total.

        Every level is evaluated in its own context, never summed from the finer one. ``level``
        is the number of grouping columns in use. Where the measures allow it, all levels come from one pass over each fact.
        """
        by, where = list(by), dict(where or {})
        aggs: dict[Agg, str] = {}
        for measure in measures.values():
            measure.expr(lambda agg: (aggs.setdefault(agg, f"_a{len(aggs)}"), F.lit(None))[1])
        if by and not any(m.fills for m in measures.values()) and all(self._expandable(a, by, where) for a in aggs):
            return self._expanded(measures, aggs, by, where)
        levels = []
        for depth in range(len(by), -1, -1):
            part = self.query(measures, by[:depth], where)
            levels.append(part.withColumn("level", F.lit(depth)))
        full = levels[0]
        order = full.columns
        types = {f.name: f.dataType for f in full.schema.fields}

        def widen(part: DataFrame) -> DataFrame:
            return part.select(
                *[F.col(c) if c in part.columns else F.lit(None).cast(types[c]).alias(c) for c in order]
            )

        return reduce(DataFrame.unionByName, [widen(p) for p in levels])

    def _expandable(self, agg: Agg, by: Sequence[str], where: Mapping[str, Any]) -> bool:
        """Whether the finest groups hold all that the levels above need: sums and counts, and the values of a distinct count."""
        plain = agg.kind in ("rows", "values", "sum", "distinct") and agg.period is None
        return plain and len(self._frame_key(agg, by, where).group) == len(by)

    def _expanded(self, measures: Mapping[str, Measure], aggs: Mapping[Agg, str], by: list[str], where: dict[str, Any]) -> DataFrame:
        """All levels at once: a fact is reduced to the finest groups, which Spark expands to the levels; distinct values travel with their group."""
        flat = [_flat(c) for c in by]
        members: dict[_FrameKey, dict[Agg, str]] = {}
        for agg, name in aggs.items():
            members.setdefault(self._frame_key(agg, by, where), {})[agg] = name
        level = (F.lit(len(by)) - F.bit_count(F.grouping_id())).cast("int").alias("_level")
        stack = []
        for key, group in members.items():
            distinct = key.alone is not None and key.alone.kind == "distinct"
            finest = self._reduce(key.table, group, by, dict(key.where), count=not distinct)
            if distinct:
                blank = F.coalesce(F.max(F.col("_value").isNull().cast("int")), F.lit(0))
                values = [F.nullif(F.count_distinct("_value") + blank, F.lit(0)).alias(group[key.alone])]
            else:
                values = [F.sum(n).alias(n) for n in group.values()]
            stack.append(finest.rollup(*flat).agg(level, *values))
        # The grand total is a row also where there is nothing to count.
        total = self.tables[DATE].sparkSession.range(1).select(F.lit(0).alias("_level"))
        together = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [*stack, total])
        combined = together.groupBy(*flat, "_level").agg(*[F.max(n).alias(n) for n in aggs.values()])

        def value(agg: Agg) -> Column:
            column = F.col(aggs[agg])
            return column.cast("double") if self._is_decimal(agg) else column

        result = combined.select(
            *[F.col(f).alias(_column(c)) for c, f in zip(by, flat)], *[m.expr(value).alias(n) for n, m in measures.items()],
            F.col("_level").alias("level"),
        )
        some = reduce(lambda a, b: a | b, [F.col(n).isNotNull() for n in measures])
        return result.filter(some | (F.col("level") == 0))

    # ---- evaluation ------------------------------------------------------------------------

    def _is_decimal(self, agg: Agg) -> bool:
        if agg.kind != "sum":
            return False
        return agg.exact is not None or isinstance(
            self.tables[agg.table].schema[agg.column].dataType, T.DecimalType
        )

    def _frame_key(self, agg: Agg, by: Sequence[str], where: Mapping[str, Any]) -> _FrameKey:
        reached = _reached_from(agg.table)
        replaced = {agg.only[0]} if agg.only else set()
        if agg.kind == "all_rows":
            where = {c: w for c, w in where.items() if c != DEPARTMENT_NAME}
        group = tuple(c for c in by if _table(c) in reached and c not in replaced)
        kept = {c: w for c, w in where.items() if _table(c) in reached and c not in replaced}
        own_filter = agg.only is not None and _table(agg.only[0]) == agg.table
        alone = agg.kind in ("distinct", "daily_mean", "all_rows") or (agg.only is not None and not own_filter)
        if alone and agg.only is not None:
            kept[agg.only[0]] = agg.only[1]
        frozen = tuple((c, tuple(w) if isinstance(w, (list, set)) else w) for c, w in kept.items())
        return _FrameKey(agg.table, group, frozen, agg if alone else None)

    def _combine(
        self, aggs: Mapping[Agg, str], by: Sequence[str], where: Mapping[str, Any], needs_domain: bool
    ) -> DataFrame:
        ranks = {a: n for a, n in aggs.items() if a.kind == "rank"}
        counted = {a: n for a, n in aggs.items() if a.kind != "rank"}
        if DEPARTMENT_NAME in by:
            for agg in ranks:
                counted.setdefault(self._ranked_count(agg, where), f"_n{len(counted)}")
        members: dict[_FrameKey, dict[Agg, str]] = {}
        for agg, name in counted.items():
            members.setdefault(self._frame_key(agg, by, where), {})[agg] = name

        whole, partial = [], []
        for key, group in members.items():
            frame = self._frame(key, group)
            (whole if len(key.group) == len(by) else partial).append((key, frame, list(group.values())))

        flat = [_flat(c) for c in by]
        stack = [frame for _, frame, _ in whole]
        # A value joined back exists for every member, also for those without rows.
        if partial and len({_table(c) for c in by}) == 1 and _table(by[0]).startswith("dim_"):
            needs_domain = True
        if by and (needs_domain or not whole):
            domain = self._domain(by, where)
            if domain is not None:
                stack.append(domain)
        if not stack:
            stack = [self.tables[DATE].sparkSession.range(1).select()]
        if len(stack) == 1:
            combined = stack[0]
        else:
            together = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), stack)
            values = [c for c in together.columns if c not in flat]
            combined = together.groupBy(*flat).agg(*[F.max(c).alias(c) for c in values]) if values else together
        for key, frame, names in partial:
            combined = self._join_back(combined, frame, [_flat(c) for c in key.group], names)
        for agg, name in ranks.items():
            combined = self._rank(combined, counted.get(self._ranked_count(agg, where)), name, by, where)
        return combined

    @staticmethod
    def _ranked_count(rank: Agg, where: Mapping[str, Any]) -> Agg:
        """The row count to rank by; it ignores a filter on the department."""
        return replace(rank, kind="all_rows" if DEPARTMENT_NAME in where else "rows")

    @staticmethod
    def _rank(
        combined: DataFrame, count: str | None, name: str, by: Sequence[str], where: Mapping[str, Any]
    ) -> DataFrame:
        """Dense rank, blanks as 0, over all departments with the other grouping columns fixed.

        Without the department in the grouping the current value is the sum over all departments
        and nothing is above it. The window sees one row per department and group.
        """
        if DEPARTMENT_NAME not in by:
            return combined.withColumn(name, F.lit(1))
        others = [_flat(c) for c in by if c != DEPARTMENT_NAME]
        window = Window.partitionBy(*others).orderBy(F.coalesce(F.col(count), F.lit(0)).desc())
        ranked = combined.withColumn(name, F.dense_rank().over(window))
        if DEPARTMENT_NAME in where:
            ranked = ranked.filter(condition(F.col(_flat(DEPARTMENT_NAME)), where[DEPARTMENT_NAME]))
        return ranked

    @staticmethod
    def _join_back(left: DataFrame, frame: DataFrame, keys: list[str], names: list[str]) -> DataFrame:
        if not keys:
            # A total is one row: read it as a scalar.
            total = frame.select(F.struct(*names)).scalar()
            return left.withColumn("_total", total).select(*left.columns, "_total.*")
        right = frame.select(*[F.col(k).alias(f"_r{k}") for k in keys], *names)
        match = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_r{k}")) for k in keys])
        return left.join(right, match, "left").select(*left.columns, *names)

    def _domain(self, by: Sequence[str], where: Mapping[str, Any]) -> DataFrame | None:
        """Groups to show although no aggregate has rows for them.

        For columns of one table all their combinations there; for columns of several tables the
        combinations that occur in a fact that reaches them all.
        """
        tables = {_table(c) for c in by}
        if len(tables) == 1:
            (table,) = tables
        else:
            facts = [t for t in TABLE_NAMES if t.startswith("fact_") and tables <= _reached_from(t)]
            if not facts:
                return None
            table = facts[0]
        reached = _reached_from(table)
        return self._reduce(table, {}, by, {c: w for c, w in where.items() if _table(c) in reached})

    def _frame(self, key: _FrameKey, aggs: Mapping[Agg, str]) -> DataFrame:
        if key.alone is not None and key.alone.kind == "daily_mean":
            return self._mean_of_days(key, aggs[key.alone])
        if any(a.period for a in aggs):
            return self._over_periods(key, aggs)
        return self._reduce(key.table, aggs, key.group, dict(key.where))

    def _over_periods(self, key: _FrameKey, aggs: Mapping[Agg, str]) -> DataFrame:
        """Aggregates over calendar periods, and over the plain context, in one pass.

        The table is reduced to one row per day and other grouping columns. These rows are joined
        to the union of the bridges of all periods, which spreads each day to the groups it counts
        for.
        """
        others, daily_where, day = self._daily_context(key)
        merged = self._merged_patients(key, aggs, others, daily_where)
        if merged is not None:
            return merged
        base: dict[Agg, str] = {}
        for agg in aggs:
            base.setdefault(replace(agg, period=None), f"_b{len(base)}")
        distinct = key.alone is not None and key.alone.kind == "distinct"
        daily = self._reduce(key.table, base, [*others, day], daily_where, count=not distinct)
        daily = daily.withColumnRenamed(_flat(day), "date_key")

        periods = sorted({agg.period or "" for agg in aggs})
        bridges = [self._bridge(key, period).withColumn("_period", F.lit(period)) for period in periods]
        bridge = reduce(DataFrame.unionByName, bridges)
        # Rows without a date in the calendar belong to the plain context only.
        undated = "" in periods and not any(_table(c) == DATE for c, _ in key.where)
        spread = daily.join(bridge, "date_key", "left" if undated else "inner")
        period = F.coalesce(F.col("_period"), F.lit(""))
        flat = [_flat(c) for c in key.group]
        if distinct:
            return self._count_distinct(spread, flat, aggs[key.alone])
        sums = [
            F.sum(F.when(period == (agg.period or ""), F.col(base[replace(agg, period=None)]))).alias(name)
            for agg, name in aggs.items()
        ]
        return spread.groupBy(*flat).agg(*sums)

    def _merged_patients(
        self, key: _FrameKey, aggs: Mapping[Agg, str], others: Sequence[str], where: Mapping[str, Any]
    ) -> DataFrame | None:
        """Distinct patients over a calendar period by merging bitmaps, exact; None where the stored ones do not have the columns.

        Whole months of a period come from the stored bitmaps of the months. Only its other days are read from the fact and made into
        bits. A patient of many days or months is one bit of each bitmap, and is spread to no day.
        """
        agg = key.alone
        if agg is None or (agg.table, agg.kind, agg.column, agg.only) != ("fact_admissions", "distinct", "patient_id", None):
            return None
        if any(_table(c) != "dim_department" for c in [*others, *where]):
            return None
        try:
            numbers, months = (self.tables[n] for n in PATIENT_BITS)
        except KeyError:
            return None
        if numbers is None or months is None:
            return None
        month = gold_month(F.col("date_key"))
        dated = [_flat(c) for c in key.group if _table(c) == DATE]
        flat, apart = [_flat(c) for c in key.group], [_flat(c) for c in others]
        bridge = self._bridge(key, agg.period or "").withColumn("month", month)
        sizes = self.tables[DATE].groupBy(month.alias("month")).agg(F.count(F.lit(1)).alias("_days"))
        whole = bridge.groupBy(*dated, "month").agg(F.count(F.lit(1)).alias("_n")).join(sizes, "month").where("_n = _days").select(*dated, "month")
        named = [F.col(c).alias(f"_w{c}") for c in [*dated, "month"]]
        covered = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_w{c}")) for c in [*dated, "month"]])
        edges = bridge.join(whole.select(*named), covered, "left_anti").drop("month")

        (fk, dim, dim_key) = _first_hop("fact_admissions", "dim_department")
        needed = list(dict.fromkeys([*others, *where]))
        by_month = months.withColumnRenamed(fk, f"_fk_{fk}")
        if needed:
            by_month = self._join_dim(by_month, dim, dim_key, fk, needed, where)
        by_month = by_month.groupBy(*apart, "month", "bucket").agg(F.bitmap_or_agg("patients").alias("patients"))
        parts = [by_month.join(whole, "month").select(*flat, "bucket", "patients")]

        date_fk = _first_hop("fact_admissions", DATE)[0]
        days = edges.select(F.col("date_key").alias(date_fk)).distinct()
        some = self.with_tables({"fact_admissions": self.tables["fact_admissions"].join(days, date_fk, "left_semi")})
        day = _date_column("fact_admissions")
        daily = some._reduce("fact_admissions", {replace(agg, period=None): "_b0"}, [*others, day], where, count=False)
        spread = daily.withColumnRenamed(_flat(day), "date_key").join(edges, "date_key").select(*flat, F.col("_value").alias("patient_id")).distinct()
        parts.append(patient_bits(spread, numbers, flat))
        bits = parts[0].unionByName(parts[1]).groupBy(*flat, "bucket").agg(F.bitmap_or_agg("patients").alias("patients"))
        return bits.groupBy(*flat).agg(F.nullif(F.sum(F.bitmap_count("patients")), F.lit(0)).alias(aggs[agg]))

    def _daily_context(self, key: _FrameKey) -> tuple[list[str], dict[str, Any], str]:
        """The grouping columns and filters that are not dates, and the date key to group by."""
        others = [c for c in key.group if _table(c) != DATE]
        where = {c: w for c, w in key.where if _table(c) != DATE}
        return others, where, _date_column(key.table)

    def _bridge(self, key: _FrameKey, period: str) -> DataFrame:
        """Calendar columns of the grouping and the date keys that ``period`` maps them to."""
        groups = [c for c in key.group if _table(c) == DATE]
        flat = [_flat(c) for c in groups]
        calendar = self.tables[DATE].withColumn(timeintel.DAY, F.col("full_date"))
        dates = calendar
        for column, wanted in key.where:
            if _table(column) == DATE:
                dates = dates.filter(condition(F.col(_column(column)), wanted))
        columns = [F.col(_column(c)).alias(f) for c, f in zip(groups, flat)]
        if period == "":
            return dates.select(*columns, "date_key")
        if self.last_date == "data" and (period == "last" or period.startswith("rolling_")):
            # The calendar up to the last date the fact has rows for.
            fact = _date_fact(key.table)
            kept = {c: w for c, w in key.where if _table(c) != DATE and _table(c) in _reached_from(fact)}
            used = self._reduce(fact, {}, [_date_column(fact)], kept)
            dates = dates.join(used.withColumnRenamed(_flat(_date_column(fact)), "date_key"), "date_key", "left_semi")
        return timeintel.bridge(dates.select(*columns, timeintel.DAY), calendar, flat, period)

    def _mean_of_days(self, key: _FrameKey, name: str) -> DataFrame:
        agg = key.alone
        others, where, day = self._daily_context(key)
        parts = {replace(agg, kind="sum", period=None): "_sum", replace(agg, kind="values", period=None): "_n"}
        daily = self._reduce(agg.table, parts, [*others, day], where).filter("_n > 0")
        # A fixed number of digits, so that the sum does not depend on the order of the days.
        mean = (F.col("_sum").cast("double") / F.col("_n")).cast("decimal(20,10)")
        daily = daily.select(*[_flat(c) for c in others], F.col(_flat(day)).alias("date_key"), mean.alias("_mean"))
        spread = daily.join(self._bridge(key, agg.period or ""), "date_key")
        total = F.sum("_mean").cast("double") / F.count("_mean")
        return spread.groupBy(*[_flat(c) for c in key.group]).agg(total.alias(name))

    # ---- reduction of one table ------------------------------------------------------------

    def _reduce(
        self,
        table: str,
        aggs: Mapping[Agg, str],
        by: Sequence[str],
        where: Mapping[str, Any],
        count: bool = True,
    ) -> DataFrame:
        """Aggregate ``table`` to ``by`` (flat names) through its relationships.

        Without aggregates the result is the distinct groups. A distinct count with ``count=False``
        stops at the distinct values, in ``_value``.
        """
        distinct = next((a for a in aggs if a.kind == "distinct"), None)
        names = ["_value"] if distinct is not None else list(aggs.values())
        flat_by = [_flat(c) for c in by]
        hops = self._hops(table, [*by, *where])
        covered = self._covered(table, aggs, by, where, hops)
        if covered is not None:
            df, hops = covered
        else:
            df = self._first_reduction(table, aggs, by, where, hops, distinct)
        for (fk, nxt, key), needed in hops:
            if not nxt.startswith("fact_"):
                df = self._join_dim(df, nxt, key, fk, needed, where)
                continue
            df, deeper = self._join_parent(df, nxt, key, fk, needed, where)
            df = self._regroup(df, [c for c in df.columns if c not in names], names, distinct)
            for (deep_fk, dim, dim_key), dim_needed in deeper:
                df = self._join_dim(df, dim, dim_key, deep_fk, dim_needed, where)
        if distinct is not None:
            return self._count_distinct(df, flat_by, aggs[distinct]) if count else df.select(*flat_by, *names).distinct()
        return self._regroup(df, flat_by, names, None) if hops else df

    def _covered(
        self, table: str, aggs: Mapping[Agg, str], by: Sequence[str], where: Mapping[str, Any],
        hops: Sequence[tuple[tuple[str, str, str], list[str]]],
    ) -> tuple[DataFrame, list[tuple[tuple[str, str, str], list[str]]]] | None:
        """The first reduction over the companion and the hops that are left, if it has all columns that the query needs."""
        parents = [(hop, needed) for hop, needed in hops if hop[1].startswith("fact_")]
        if len(parents) != 1:
            return None
        (_, parent, _), needed = parents[0]
        keyed = self.companion(table, parent)
        if keyed is None:
            return None
        deeper = self._hops(parent, needed)
        others = [(hop, columns) for hop, columns in hops if hop[1] != parent]
        # Through its parent the companion reaches a dimension by the parent's key.
        keys = {f"_fk_{fk}": fk for (fk, _, _), _ in others} | {f"_fk_{fk}": _flat(f"{parent}.{fk}") for (fk, _, _), _ in deeper}
        stored = lambda c: _column(c) if _table(c) == table else _flat(c)
        own = {c: stored(c) for c in dict.fromkeys([*by, *where]) if _table(c) in (table, parent)}
        read = [a.column for a in aggs if a.column] + [_column(a.only[0]) for a in aggs if a.only and _table(a.only[0]) == table]
        if len(keys) != len(others) + len(deeper) or not {*keys.values(), *own.values(), *read} <= set(keyed.columns):
            return None
        for column, wanted in where.items():
            if column in own:
                keyed = keyed.filter(condition(F.col(own[column]), wanted))
        on_dates = {c: where[c] for c in needed if c in where and _table(c) == DATE}
        if on_dates or any(_table(c) == parent for c in where):
            # A filter on the parent shows only rows that have one.
            keyed = keyed.filter(F.col(_flat(f"{parent}.{FOUND}")))
        keyed = self._limit_dates(keyed, parent, on_dates, lambda c: _flat(f"{parent}.{c}"))
        distinct = next((a for a in aggs if a.kind == "distinct"), None)
        groups = [F.col(own[c]).alias(_flat(c)) for c in by if c in own] + [F.col(c).alias(k) for k, c in keys.items()]
        return self._grouped(keyed, groups, aggs, distinct), [*others, *deeper]

    @staticmethod
    def _hops(table: str, columns: Sequence[str]) -> list[tuple[tuple[str, str, str], list[str]]]:
        """First hops from ``table`` to the tables of the columns, with the columns behind each."""
        needed: dict[tuple[str, str, str], list[str]] = {}
        for column in dict.fromkeys(columns):
            if _table(column) != table:
                needed.setdefault(_first_hop(table, _table(column)), []).append(column)
        return list(needed.items())

    def _first_reduction(
        self, table: str, aggs: Mapping[Agg, str], by: Sequence[str], where: Mapping[str, Any],
        hops: Sequence[tuple[tuple[str, str, str], list[str]]], distinct: Agg | None,
    ) -> DataFrame:
        """Filter on the table's own columns and group by its foreign keys and grouping columns."""
        df = self.tables[table]
        for column, wanted in where.items():
            if _table(column) == table:
                df = df.filter(condition(F.col(_column(column)), wanted))
        df = self._limit_dates(df, table, where)
        own = [F.col(_column(c)).alias(_flat(c)) for c in by if _table(c) == table]
        foreign = [F.col(fk).alias(f"_fk_{fk}") for (fk, _, _), _ in hops]
        return self._grouped(df, [*own, *foreign], aggs, distinct)

    def _grouped(self, df: DataFrame, groups: list[Column], aggs: Mapping[Agg, str], distinct: Agg | None) -> DataFrame:
        if distinct is not None:
            return df.select(*groups, F.col(distinct.column).alias("_value")).distinct()
        if not aggs:
            return df.select(*groups).distinct()
        return df.groupBy(*groups).agg(*[self._base(a).alias(n) for a, n in aggs.items()])

    def _limit_dates(
        self, df: DataFrame, table: str, where: Mapping[str, Any], stored: Callable[[str], str] = str
    ) -> DataFrame:
        """Apply date filters before the reduction: by stored year where possible, then by date key. ``stored`` names the table's columns in ``df``."""
        on_dates = {c: w for c, w in where.items() if _table(c) == DATE}
        if not on_dates or DATE not in _reached_from(table) or _date_fact(table) != table:
            return df
        year = YEAR_PARTITION.get(table)
        if f"{DATE}.year" in on_dates and year is not None:
            df = df.filter(condition(F.col(stored(year)), on_dates[f"{DATE}.year"]))
        dates = self.tables[DATE]
        for column, wanted in on_dates.items():
            dates = dates.filter(condition(F.col(_column(column)), wanted))
        fk, _, key = _first_hop(table, DATE)
        return df.join(dates.select(F.col(key).alias(stored(fk))), stored(fk), "left_semi")

    @staticmethod
    def _base(agg: Agg) -> Column:
        value = F.lit(1) if agg.column is None else F.col(agg.column)
        if agg.exact is not None and agg.kind == "sum":
            value = value.cast(agg.exact)
        if agg.only is not None and _table(agg.only[0]) == agg.table:
            value = F.when(condition(F.col(_column(agg.only[0])), agg.only[1]), value)
        if agg.kind in ("rows", "all_rows", "values"):
            return F.nullif(F.count(value), F.lit(0))
        if agg.kind == "sum":
            return F.sum(value)
        raise ValueError(f"unknown aggregate kind {agg.kind!r}")

    @staticmethod
    def _regroup(df: DataFrame, keys: list[str], names: list[str], distinct: Agg | None) -> DataFrame:
        if distinct is not None:
            return df.select(*keys, *names).distinct()
        if not names:
            return df.select(*keys).distinct()
        return df.groupBy(*keys).agg(*[F.sum(n).alias(n) for n in names])

    @staticmethod
    def _count_distinct(df: DataFrame, by: list[str], name: str) -> DataFrame:
        blank = F.coalesce(F.max(F.col("_value").isNull().cast("int")), F.lit(0))
        count = F.nullif(F.count_distinct("_value") + blank, F.lit(0))
        return df.groupBy(*by).agg(count.alias(name))

    def _join_parent(
        self, df: DataFrame, parent: str, key: str, fk: str, needed: Sequence[str], where: Mapping[str, Any]
    ) -> tuple[DataFrame, list[tuple[tuple[str, str, str], list[str]]]]:
        """Join reduced rows to their parent fact for its columns and its own foreign keys."""
        table, filtered = self._filtered(parent, needed, where)
        on_dates = {c: where[c] for c in needed if c in where and _table(c) == DATE}
        table = self._limit_dates(table, parent, on_dates)
        deeper = self._hops(parent, needed)
        own = [F.col(_column(c)).alias(_flat(c)) for c in needed if _table(c) == parent]
        onward = [F.col(f).alias(f"_fk_{f}") for (f, _, _), _ in deeper]
        side = table.select(F.col(key).alias(f"_fk_{fk}"), *own, *onward)
        how = "inner" if filtered or on_dates else "left"
        return df.join(side, f"_fk_{fk}", how).drop(f"_fk_{fk}"), deeper

    def _join_dim(
        self, df: DataFrame, dim: str, key: str, fk: str, needed: Sequence[str], where: Mapping[str, Any]
    ) -> DataFrame:
        table, filtered = self._filtered(dim, needed, where)
        side = table.select(F.col(key).alias(f"_fk_{fk}"), *[F.col(_column(c)).alias(_flat(c)) for c in needed])
        return df.join(side, f"_fk_{fk}", "inner" if filtered else "left").drop(f"_fk_{fk}")

    def _filtered(self, name: str, needed: Sequence[str], where: Mapping[str, Any]) -> tuple[DataFrame, bool]:
        table, filtered = self.tables[name], False
        for column in needed:
            if column in where and _table(column) == name:
                table = table.filter(condition(F.col(_column(column)), where[column]))
                filtered = True
        return table, filtered

"""The data tests of all tables.

Tests of the large tables are answered from findings: a few rows for each month that add up over months, so a run
looks at the rows of its own months only and takes the findings of all others as they are stored. Tests on single
rows of one table are counted in one pass. Uniqueness and references are counted per key, which Spark combines
before it shuffles.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import date
from functools import partial, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterline.config import AllowedValues, CleaningRules, DeliveryLimits
from meterline.functions.expressions import PAYMENT_TYPES
from meterline.operators import checks
from meterline.operators.checks import CheckResult, is_missing, not_accepted, out_of_range
from meterline.operators.enrich import derive_measures
from meterline.operators.staging import stage_trips
from meterline.session import side_by_side
from meterline.sources.tables import MONTH


@dataclass(frozen=True)
class TableTests:
    """Tests of one table. A reference is (column, parent table, parent column)."""

    rows: dict[str, Column] = field(default_factory=dict)
    at_least_one_row: bool = False
    unique: tuple[str, ...] = ()
    references: tuple[tuple[str, str, str], ...] = ()

    def __len__(self) -> int:
        return len(self.rows) + self.at_least_one_row + len(self.unique) + len(self.references)


def _missing(*columns: str) -> dict[str, Column]:
    return {f"not_null[{c}]": is_missing(c) for c in columns}


def _range(column: str, low=None, high=None) -> dict[str, Column]:
    return {f"range[{column}]": out_of_range(column, low, high)}


def _accepted(column: str, values: tuple) -> dict[str, Column]:
    return {f"accepted_values[{column}]": not_accepted(column, values)}


def table_tests(
    allowed: AllowedValues = AllowedValues(), rules: CleaningRules = CleaningRules()
) -> dict[str, TableTests]:
    """Tests by table; the two that compare the fact with marts are in ``run_data_tests``."""
    ends = ("pickup_location_id", "dropoff_location_id")
    return {
        "raw_trips": TableTests(at_least_one_row=True),
        "stg_trips": TableTests(
            rows=_missing("trip_id", "pickup_ts", "dropoff_ts", *ends)
            | _accepted("vendor_id", allowed.vendors)
            | _accepted("payment_type_id", allowed.payment_types)
            | _range("fare_amount", 0, rules.max_fare_usd)
            | _range("total_amount", 0, rules.max_fare_usd),
            references=tuple((c, "stg_zones", "location_id") for c in ends),
        ),
        "stg_zones": TableTests(rows=_missing("location_id", "borough", "zone"), unique=("location_id",)),
        "int_trips": TableTests(
            rows=_missing("trip_id")
            | _range("duration_minutes", 0, checks.DAY_MINUTES)
            | _range("avg_speed_mph", 0, 100)
            | _range("tip_pct", 0)
        ),
        "fct_trips": TableTests(
            rows=_missing("trip_id", "pickup_ts", "dropoff_ts", "pickup_date", "pickup_hour", *ends)
            | _range("pickup_hour", 0, 23)
            | _accepted("pickup_day_of_week", (1, 2, 3, 4, 5, 6, 7))
            | _accepted("payment_type_name", tuple(PAYMENT_TYPES.values()))
            | {
                "no_negative_fares": checks.has_negative_amount(),
                "dropoff_not_before_pickup": checks.ends_before_start(),
                "trip_duration_under_24h": checks.has_bad_duration(),
            },
            at_least_one_row=True,
            unique=("trip_id",),
            references=tuple((c, "dim_zones", "location_id") for c in ends),
        ),
        "dim_zones": TableTests(
            rows=_missing("location_id") | _accepted("borough", allowed.boroughs), unique=("location_id",)
        ),
        "mart_daily_revenue": TableTests(
            rows=_missing("pickup_date") | _range("trip_count", 1), unique=("pickup_date",)
        ),
        "mart_zone_performance": TableTests(
            rows=_missing("location_id") | _range("pct_of_all_trips", 0, 100),
            unique=("location_id",),
            references=(("location_id", "dim_zones", "location_id"),),
        ),
        "mart_hourly_demand": TableTests(
            rows=_missing("pickup_hour") | _range("pickup_hour", 0, 23), unique=("pickup_hour",)
        ),
    }


def _offenders(name: str, count: int, what: str = "rows") -> CheckResult:
    return CheckResult(name, count == 0, f"{count:,} offending {what}")


def _count_rows(table: DataFrame, conditions: dict[str, Column]) -> list[CheckResult]:
    return [_offenders(name, count) for name, count in checks.count_offenders(table, conditions).items()]


def _none_of(name: str, offending: DataFrame, what: str) -> list[CheckResult]:
    return [_offenders(name, offending.count(), what)]


def _not_empty(name: str, rows: int) -> list[CheckResult]:
    return [CheckResult(name, rows > 0, "at least 1 row expected")]


# What the tests of the large tables need to know of a month, as rows: kind, key, value, n, amount, source_month.
#   offenders  key: table.test             n: rows that meet the condition
#   repeated   key: table.column           n: values that occur more than once; equal trip ids share a month
#   rows       key: table                  n: rows; fct_in_month: those picked up in the month they are filed under
#   nulls      key: column of raw_trips    n: rows without a value
#   ids        key: table.column           value: a zone id, n: rows that refer to it
#   days       key: fct_trips              value: a day, n: trips, amount: revenue
FINDINGS = "kind string, key string, value string, n bigint, amount decimal(38,2), source_month date"
_MONTHLY = ("raw_trips", "stg_trips", "int_trips", "fct_trips")


def _finding(kind: str, key: Column, n: Column, value: Column | None = None, amount: Column | None = None) -> list[Column]:
    return [
        F.lit(kind).alias("kind"),
        key.alias("key"),
        (F.lit(None) if value is None else value).cast("string").alias("value"),
        n.cast("bigint").alias("n"),
        (F.lit(None) if amount is None else amount).cast("decimal(38,2)").alias("amount"),
        F.col(MONTH),
    ]


def _counts(table: DataFrame, counters: dict[tuple[str, str], Column], ids: dict[str, str] | None = None) -> DataFrame:
    """Findings (kind, key) of a table, and the rows of each value of the columns ``ids`` (key -> column).

    A month is one row of counts. Ids are counted column by column: combinations of them are nearly as many as rows.
    """
    ids, names = ids or {}, {f"c{i}": name for i, name in enumerate(counters)}
    wide = table.groupBy(MONTH).agg(*(counters[name].alias(c) for c, name in names.items()))
    rows = [
        F.struct(F.lit(kind).alias("kind"), F.lit(key).alias("key"), F.col(c).alias("n"))
        for c, (kind, key) in names.items()
    ]
    counts = wide.select(MONTH, F.inline(F.array(*rows)))
    found = counts.select("kind", *_finding("", F.col("key"), F.col("n"))[1:])
    if not ids:
        return found
    each = F.array(*(F.struct(F.lit(key).alias("key"), F.col(c).cast("string").alias("value")) for key, c in ids.items()))
    values = table.select(MONTH, F.inline(each)).where("value IS NOT NULL").groupBy(MONTH, "key", "value")
    return found.unionByName(values.agg(F.count(F.lit(1)).alias("n")).select(*_finding("ids", F.col("key"), F.col("n"), F.col("value"))))


def month_findings(
    raw: DataFrame, fact: DataFrame, allowed: AllowedValues = AllowedValues(), rules: CleaningRules = CleaningRules()
) -> DataFrame:
    """What the tests of raw, staged, enriched and fact trips and the delivery gate need to know, month by month."""
    suite, staged = table_tests(allowed, rules), stage_trips(raw, rules)
    every = F.count(F.lit(1))

    def offenders(*tables: str) -> dict:
        return {("offenders", f"{t}.{n}"): F.count_if(c) for t in tables for n, c in suite[t].rows.items()}

    in_month = F.count_if(F.trunc("pickup_date", "month") == F.col(MONTH))
    watched = {("nulls", c): F.count_if(F.col(c).isNull()) for c in checks.CRITICAL_COLUMNS + checks.INFO_COLUMNS}
    repeated = checks.duplicate_keys(fact, "trip_id", MONTH).groupBy(MONTH).count()
    daily = fact.groupBy(MONTH, "pickup_date").agg(every.alias("n"), F.sum("total_amount").alias("revenue"))

    def ids(table: str) -> dict[str, str]:
        return {f"{table}.{column}": column for column, *_ in suite[table].references}

    parts = [
        _counts(raw, {("rows", "raw_trips"): every} | watched),
        # The enriched trips hold all staged columns, so one pass serves both tables.
        _counts(derive_measures(staged), offenders("stg_trips", "int_trips"), ids("stg_trips")),
        _counts(
            fact,
            {("rows", "fct_trips"): every, ("rows", "fct_in_month"): in_month} | offenders("fct_trips"),
            ids("fct_trips"),
        ),
        repeated.select(*_finding("repeated", F.lit("fct_trips.trip_id"), F.col("count"))),
        daily.select(*_finding("days", F.lit("fct_trips"), F.col("n"), F.col("pickup_date"), F.col("revenue"))),
    ]
    return reduce(DataFrame.unionByName, parts)


def _orphans(findings: DataFrame, parents: dict[str, DataFrame], suite: dict[str, TableTests], *by: str) -> dict[tuple, int]:
    """(*by, reference) -> distinct values that the parent lacks."""
    names = {f"{t}.{column}": (t, column) for t in _MONTHLY for column, *_ in suite[t].references}
    known = reduce(
        DataFrame.union,
        [
            parents[parent].select(F.lit(f"{t}.{column}").alias("key"), F.col(own).cast("string").alias("value"))
            for t in _MONTHLY
            for column, parent, own in suite[t].references
        ],
    )
    values = findings.where("kind = 'ids'").select(*by, "key", "value").distinct()
    lost = values.join(known.distinct().withColumn("_known", F.lit(True)), ["key", "value"], "left").where("_known IS NULL")
    return {(*r[:-2], names[r.key]): r["count"] for r in lost.groupBy(*by, "key").count().collect()}


def _monthly_results(counts: dict[tuple[str, str], int], orphans: dict[tuple[str, str], int], suite: dict[str, TableTests]) -> dict:
    """Results by table of the tests that findings answer."""
    out: dict[str, list[CheckResult]] = {}
    for table in _MONTHLY:
        tests = suite[table]
        results = [_offenders(f"{table}.{name}", counts.get(("offenders", f"{table}.{name}"), 0)) for name in tests.rows]
        if tests.at_least_one_row:
            results += _not_empty(f"{table}.row_count", counts.get(("rows", table), 0))
        results += [
            _offenders(f"{table}.unique[{c}]", counts.get(("repeated", f"{table}.{c}"), 0), "keys") for c in tests.unique
        ]
        results += [
            _offenders(f"{table}.relationships[{c}]", orphans.get((table, c), 0), "keys") for c, *_ in tests.references
        ]
        out[table] = results
    return out


def results_by_month(
    findings: DataFrame,
    parents: dict[str, DataFrame],
    months: list[date],
    allowed: AllowedValues = AllowedValues(),
    rules: CleaningRules = CleaningRules(),
    limits: DeliveryLimits = DeliveryLimits(),
) -> tuple[dict[date, list[CheckResult]], dict[date, list[CheckResult]]]:
    """Of each month, the tests of its own rows and the checks of its delivery."""
    suite = table_tests(allowed, rules)
    sums = findings.where(F.col("kind").isin("offenders", "repeated", "rows", "nulls")).groupBy(MONTH, "kind", "key").agg(F.sum("n"))
    counts: dict[date, dict] = {m: {} for m in months}
    for month, kind, key, n in sums.collect():
        counts[month][kind, key] = n
    orphans: dict[date, dict] = {m: {} for m in months}
    for (month, name), n in _orphans(findings, parents, suite, MONTH).items():
        orphans[month][name] = n
    tests, deliveries = {}, {}
    for m in months:
        own = _monthly_results(counts[m], orphans[m], suite)
        # An empty month is for the delivery checks to judge.
        tests[m] = [r for results in own.values() for r in results if not r.name.endswith(".row_count")]
        metrics = {f"nulls_{key}": n for (kind, key), n in counts[m].items() if kind == "nulls"}
        metrics["raw_rows"] = counts[m].get(("rows", "raw_trips"), 0)
        metrics["fct_rows"] = counts[m].get(("rows", "fct_in_month"), 0)
        deliveries[m] = checks.month_results(metrics, limits)
    return tests, deliveries


def run_data_tests(
    findings: DataFrame,
    tables: dict[str, DataFrame],
    allowed: AllowedValues = AllowedValues(),
    rules: CleaningRules = CleaningRules(),
) -> list[CheckResult]:
    """Every test: those of the large tables from the findings of all months, the others over the given tables."""
    suite = table_tests(allowed, rules)
    sums = findings.where(F.col("kind").isin("offenders", "repeated", "rows")).groupBy("kind", "key").agg(F.sum("n").alias("n"))

    def monthly() -> list[CheckResult]:
        counts = {(kind, key): n for kind, key, n in sums.collect()}
        orphans = {name: n for (name,), n in _orphans(findings, tables, suite).items()}
        return [r for results in _monthly_results(counts, orphans, suite).values() for r in results]

    jobs: list[Callable[[], list[CheckResult]]] = [monthly]
    for name, tests in suite.items():
        if name in _MONTHLY:
            continue
        if tests.rows:
            jobs.append(partial(_count_rows, tables[name], {f"{name}.{test}": c for test, c in tests.rows.items()}))
        for column in tests.unique:
            duplicates = checks.duplicate_keys(tables[name], column)
            jobs.append(partial(_none_of, f"{name}.unique[{column}]", duplicates, "keys"))
        for column, parent, parent_column in tests.references:
            orphans = checks.orphan_keys(tables[name], column, tables[parent], parent_column)
            jobs.append(partial(_none_of, f"{name}.relationships[{column}]", orphans, "keys"))
    by_day = findings.where("kind = 'days'").groupBy(F.col("value").cast("date").alias("pickup_date"))
    daily = by_day.agg(F.sum("n").alias("fct_trips"), F.sum("amount").cast("decimal(38,2)").alias("fct_revenue"))
    days = checks.differing_days(daily, tables["mart_daily_revenue"])
    jobs.append(partial(_none_of, "daily_revenue_reconciles_to_fct", days, "days"))
    total = findings.where("kind = 'rows' AND key = 'fct_trips'").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"))
    gap = checks.differing_total(total, tables["mart_zone_performance"])
    jobs.append(partial(_none_of, "zone_trips_sum_to_fct", gap, "totals"))
    return [result for results in side_by_side(jobs) for result in results]

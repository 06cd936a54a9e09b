"""Monthly runs: load, fact, marts, history, data tests, delivery gate.

A run writes, audits, publishes. Every step writes versions that nobody sees. Then the tests of each month's own rows
and its delivery checks are looked at in the order the months were given. The first month that fails ends the
catch-up: it and the months after it fall back to the rows they had, and marts are built from what is left. Only when
their tests pass too does one version of the whole warehouse become visible, all tables at once.
"""

from __future__ import annotations

import hashlib
import logging
from collections.abc import Iterator
from dataclasses import dataclass, field, replace
from datetime import date, datetime, timezone
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.config import RunConfig
from meterline.operators import checks, marts
from meterline.operators.dims import dim_zones
from meterline.operators.fact import stage_fact
from meterline.operators.snapshot import VALID_TO, apply_snapshot
from meterline.operators.staging import stage_zones
from meterline.plans import data_tests
from meterline.session import shuffles_sized_for, side_by_side
from meterline.sources import files, tables
from meterline.sources.months import month_name, month_path, month_starts, validate_month
from meterline.sources.tables import State
from meterline.sources.trips import stage_load

log = logging.getLogger(__name__)

MARTS = ("mart_daily_revenue", "mart_hourly_demand", "mart_zone_performance")
States = dict[str, State]


@dataclass(frozen=True)
class Warehouse:
    """Table paths below one root, and the versions that tie the tables together."""

    root: str

    @property
    def raw(self) -> str:
        return f"{self.root}/raw/yellow_trips"

    @property
    def fact(self) -> str:
        return f"{self.root}/marts/fct_trips"

    @property
    def cells(self) -> str:
        return f"{self.root}/intermediate/trip_cells"

    @property
    def findings(self) -> str:
        return f"{self.root}/intermediate/test_findings"

    @property
    def history(self) -> str:
        return f"{self.root}/snapshots/snap_taxi_zones"

    def mart(self, name: str) -> str:
        return f"{self.root}/marts/{name}"

    @property
    def paths(self) -> dict[str, str]:
        named = {n: getattr(self, n) for n in ("raw", "fact", "cells", "findings", "history")}
        return named | {name: self.mart(name) for name in ("dim_zones", *MARTS)}

    def snapshot(self, spark: SparkSession) -> States:
        """All tables as of one moment: what is read of these states fits together, whatever is published later."""
        known = tables.versions(spark, self.root)
        published = tables.read_version(spark, self.root, known[-1]) if known else {}
        return {name: State.from_json(self.paths[name], entry["state"]) for name, entry in published.items()}

    def opened(self, spark: SparkSession) -> States:
        """The newest state of each table, for a writer.

        Publishing becomes true with the warehouse's version; if the driver died before the tables' own versions were
        written, they are written now.
        """
        known = tables.versions(spark, self.root)
        published = tables.read_version(spark, self.root, known[-1]) if known else {}
        for name, entry in published.items():
            own = tables.versions(spark, self.paths[name])
            if not own or own[-1] < entry["version"]:
                tables.commit(spark, State.from_json(self.paths[name], entry["state"]), entry["version"])
        states = {name: tables.current(spark, path) for name, path in self.paths.items()}
        return {name: state for name, state in states.items() if state}

    def publish(self, spark: SparkSession, before: States, after: States) -> None:
        """Make the states visible together, by one rename."""
        content = {}
        for name, state in after.items():
            own = tables.versions(spark, state.path)
            version = (own[-1] if own else 0) + (state is not before.get(name))
            content[name] = {"version": version, "state": state.to_json()}
        known = tables.versions(spark, self.root)
        tables.write_version(spark, self.root, known[-1] + 1 if known else 1, content)
        for name, state in after.items():
            if state is not before.get(name):
                tables.commit(spark, state, content[name]["version"])
        tables.forget(spark, self.root)


@dataclass
class RunReport:
    """Rows loaded per month and the outcome of all checks."""

    loaded: dict[str, int] = field(default_factory=dict)
    tests: list[checks.CheckResult] = field(default_factory=list)
    deliveries: dict[str, list[checks.CheckResult]] = field(default_factory=dict)

    @property
    def failures(self) -> list[checks.CheckResult]:
        every = [*self.tests, *(r for results in self.deliveries.values() for r in results)]
        return [r for r in every if not r.passed]


def _batches(sizes: dict[str, int], most: int) -> Iterator[list[str]]:
    """Months in the given order, as many together as stay below ``most`` bytes."""
    batch, size = [], 0
    for month, month_size in sizes.items():
        if batch and size + month_size > most:
            yield batch
            batch, size = [], 0
        batch.append(month)
        size += month_size
    if batch:
        yield batch


# Steps. Each returns states that are not published yet.


def stage_cells(spark: SparkSession, warehouse: Warehouse, states: States, months: list[date]) -> State:
    """The mart cells of the given months anew, from those months of the fact."""
    fact = tables.read_state(spark, states["fact"].of(months))
    return tables.stage_months(marts.trip_cells(fact), warehouse.cells, months, states.get("cells"))


def _basis(states: States, month: date, config: RunConfig) -> str:
    """What the findings of a month rest on: its folders in raw and fact, and the settings of the tests."""
    folders = sorted(p.folder for name in ("raw", "fact") for p in states[name].of([month]).parts)
    return hashlib.sha256(repr((folders, config.allowed, config.rules)).encode()).hexdigest()


def stage_findings(spark: SparkSession, warehouse: Warehouse, states: States, config: RunConfig) -> State:
    """What the data tests know of each month; months whose rows or settings have not changed are taken as stored."""
    known = states.get("findings")
    basis = {m: _basis(states, m, config) for m in sorted({*states["raw"].months, *states["fact"].months})}
    noted = {p.month: p.note for p in known.parts} if known else {}
    stale = [m for m in {*basis, *noted} if noted.get(m) != basis.get(m)]
    if known and not stale:
        return known
    raw, fact = (tables.read_state(spark, states[name].of(stale)) for name in ("raw", "fact"))
    found = data_tests.month_findings(raw, fact, config.allowed, config.rules)
    staged = tables.stage_months(found, warehouse.findings, stale, known)
    return staged.noted(set(stale) & basis.keys(), basis)


def stage_marts(spark: SparkSession, warehouse: Warehouse, states: States, zones: DataFrame) -> States:
    """The zone dimension and the three marts anew."""
    dim = tables.stage_rebuild(dim_zones(zones), warehouse.mart("dim_zones"))
    cells = tables.read_state(spark, states["cells"])
    built = {
        "mart_daily_revenue": marts.mart_daily_revenue(cells),
        "mart_hourly_demand": marts.mart_hourly_demand(cells),
        "mart_zone_performance": marts.mart_zone_performance(cells, tables.read_state(spark, dim)),
    }
    staged = side_by_side(partial(tables.stage_rebuild, df, warehouse.mart(name)) for name, df in built.items())
    return {"dim_zones": dim, **dict(zip(built, staged, strict=True))}


def stage_history(spark: SparkSession, warehouse: Warehouse, states: States, zones: DataFrame, at: datetime) -> State:
    """The zone history carried forward: closed rows stay in the files they are in, open ones are written anew."""
    known, history = states.get("history"), None
    if known:
        history = tables.read_state(spark, replace(known, parts=tuple(p for p in known.parts if p.note != "closed")))
    spell = F.when(F.col(VALID_TO).isNull(), "open").otherwise("closed")
    rows = apply_snapshot(history, zones, at).withColumn("spell", spell)
    return tables.stage_split(rows, warehouse.history, "spell", known, "closed")


def run_tests(spark: SparkSession, states: States, zones: DataFrame, config: RunConfig) -> list[checks.CheckResult]:
    """All data tests over whole tables; those of raw and fact trips from the findings of their months."""
    small = {name: tables.read_state(spark, states[name]) for name in ("dim_zones", *MARTS)}
    findings = tables.read_state(spark, states["findings"])
    return data_tests.run_data_tests(findings, small | {"stg_zones": zones}, config.allowed, config.rules)


def _without(states: States, before: States, months: set[date]) -> States:
    """The states with the rows that some months had before."""
    out = {}
    for name, state in states.items():
        old = before.get(name)
        kept = [p for p in state.parts if p.month not in months]
        back = [p for p in old.parts if p.month in months] if old else []
        out[name] = replace(state, parts=(*kept, *back))
    return out


def run_months(
    spark: SparkSession,
    months: list[str],
    data_dir: str,
    warehouse: Warehouse,
    zones: DataFrame,
    config: RunConfig = RunConfig(),
    *,
    paths: dict[str, str] | None = None,
    at: datetime | None = None,
) -> RunReport:
    """Bring the warehouse to the state after these months, whatever their order or repetition.

    ``zones`` is the raw zone lookup and ``paths`` overrides where a month's files lie. Small months share their
    jobs; each is audited by itself all the same. A month that fails its checks is not published and stops the
    catch-up there: months before it are published, later ones are not, and the error names its failures. With
    ``config.enforce`` off, failures are only reported and everything is published.
    """
    at = at or datetime.now(timezone.utc).replace(tzinfo=None)
    paths = {validate_month(m): (paths or {}).get(m) or month_path(m, data_dir) for m in months}
    sizes = {month: files.size_in_bytes(spark, path) for month, path in paths.items()}
    starts = month_starts(paths)
    report, zones = RunReport(), stage_zones(zones)
    before = warehouse.opened(spark)
    states = dict(before)
    for batch in _batches(sizes, config.batch_bytes):
        with shuffles_sized_for(spark, sum(sizes[m] for m in batch)):
            deliveries = {m: paths[m] for m in batch}
            states["raw"], loaded = stage_load(spark, deliveries, warehouse.raw, states.get("raw"), at)
            report.loaded |= loaded
            states["fact"], touched = stage_fact(
                spark, states["raw"], states.get("fact"), warehouse.fact,
                months=month_starts(batch), rules=config.rules, mode=config.fact_mode,
            )
            states["cells"] = stage_cells(spark, warehouse, states, touched)
    with shuffles_sized_for(spark, sum(sizes.values())):
        states["findings"] = stage_findings(spark, warehouse, states, config)
    bad = _audited(spark, states, zones, starts, config, report)
    if bad is not None and config.enforce:
        refused = starts[starts.index(bad) :]
        failures = [r for r in report.tests + report.deliveries[month_name(bad)] if not r.passed]
        for month in refused:
            report.loaded.pop(month_name(month))
        if len(refused) < len(starts):
            _published(spark, warehouse, before, _without(states, before, set(refused)), zones, at, config, report)
        checks.enforce(month_name(bad), failures)
    _published(spark, warehouse, before, states, zones, at, config, report)
    return report


def _audited(
    spark: SparkSession, states: States, zones: DataFrame, months: list[date], config: RunConfig, report: RunReport
) -> date | None:
    """Checks of each month by itself; the first month that fails. ``report`` gets them, of tests those of that month."""
    findings = tables.read_state(spark, states["findings"].of(months))
    parents = {"stg_zones": zones, "dim_zones": dim_zones(zones)}
    tests, deliveries = data_tests.results_by_month(
        findings, parents, months, config.allowed, config.rules, config.limits
    )
    for month in months:
        report.deliveries[month_name(month)] = deliveries[month]
        if any(not r.passed for r in tests[month] + deliveries[month]):
            report.tests = tests[month]
            return month
        if config.enforce:
            checks.enforce(month_name(month), deliveries[month])
    return None


def _published(
    spark: SparkSession,
    warehouse: Warehouse,
    before: States,
    states: States,
    zones: DataFrame,
    at: datetime,
    config: RunConfig,
    report: RunReport,
) -> None:
    """Build what rests on all months, test it, publish everything."""
    states = states | stage_marts(spark, warehouse, states, zones)
    states["history"] = stage_history(spark, warehouse, states, zones, at)
    tests = run_tests(spark, states, zones, config)
    if config.enforce:
        checks.enforce(", ".join(report.loaded), tests)
    report.tests = tests
    warehouse.publish(spark, before, states)


def run_month(
    spark: SparkSession, month: str, data_dir: str, warehouse: Warehouse, zones: DataFrame, **options
) -> RunReport:
    """Run a single month."""
    return run_months(spark, [month], data_dir, warehouse, zones, **options)

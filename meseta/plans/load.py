"""Creating tables and loading Silver and Gold."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meseta import catalog
from meseta.operators import quality
from meseta.operators.clean import in_window
from meseta.operators.geo import attach_station_place
from meseta.operators.joins import new_members
from meseta.operators.upsert import PreparedMerge, StagedSource, UpsertReport, prepare, stage_source, upsert_table
from meseta.plans import gold, silver
from meseta.session import stage
from meseta.sources.bronze import Bronze
from meseta.sources.snapshots import BUCKET, SnapshotTable, is_snapshot_table
from meseta.sources.tables import create_namespace, create_table, with_partition


def _qualified(namespace: str, name: str) -> str:
    return f"{namespace}.{name}"


def create_tables(
    spark: SparkSession, frames: Mapping[str, DataFrame], namespace: str, provider: str = "parquet",
    location: str | None = None,
) -> list[str]:
    """Create every missing table from the schema of its frame; returns the new ones."""
    create_namespace(spark, namespace)
    specs = catalog.SILVER_TABLES | catalog.GOLD_TABLES
    return [
        name for name, frame in frames.items()
        if create_table(
            spark, frame, specs[name], namespace=namespace, provider=provider,
            location=f"{location}/{name}" if location else None,
        )
    ]


Checks = Mapping[str, tuple[str, Column]]


def _discard(spark: SparkSession, namespace: str, staged: Mapping[str, StagedSource | DataFrame]) -> None:
    """Remove rows that were written as partitions of their table and will not be part of it."""
    for name, source in staged.items():
        if isinstance(source, StagedSource) and source.load:
            source.discard(SnapshotTable(spark, _qualified(namespace, name)))


def _staged(
    spark: SparkSession, frames: Mapping[str, DataFrame], namespace: str, checks: Mapping[str, Checks],
    as_loads: bool = False,
) -> tuple[dict[str, StagedSource | DataFrame], list[DataFrame]]:
    """Evaluate each frame once and count its row checks in the same write where the table allows it.

    With ``as_loads`` the rows are written as partitions of their table, for callers that merge all of them.
    """
    specs = catalog.SILVER_TABLES | catalog.GOLD_TABLES
    staged, verdicts = {}, []
    try:
        for name, frame in frames.items():
            rows, rules, target = with_partition(frame, specs[name]), checks.get(name, {}), _qualified(namespace, name)
            if is_snapshot_table(spark, target):
                staged[name] = source = stage_source(
                    rows, SnapshotTable(spark, target), specs[name].keys, {rule: bad for rule, (_, bad) in rules.items()},
                    as_load=as_loads)
                found = [quality.counted(spark, name, rules, source.rows, source.bad)]
            else:
                staged[name] = rows = stage(rows, name)
                found = [quality.row_checks(rows, name, rules)]
            verdicts += found if rules else []
    except Exception:
        _discard(spark, namespace, staged)
        raise
    return staged, verdicts


def _rows(source: StagedSource | DataFrame) -> DataFrame:
    return source.frame.drop(BUCKET) if isinstance(source, StagedSource) else source


def _write(
    spark: SparkSession, namespace: str, staged: Mapping[str, StagedSource | DataFrame], newest_by: Sequence[str] = (),
) -> dict[str, UpsertReport]:
    """Merge every table, then publish them all: nothing is visible if one of them fails."""
    specs = catalog.SILVER_TABLES | catalog.GOLD_TABLES
    merges: dict[str, PreparedMerge] = {}
    try:
        for name, source in staged.items():
            if isinstance(source, StagedSource):
                merges[name] = prepare(
                    SnapshotTable(spark, _qualified(namespace, name)), source, specs[name].keys,
                    newest_by=newest_by, what=name)
    except Exception:
        for merge in merges.values():
            merge.abandon()
        _discard(spark, namespace, staged)
        raise
    reports = {}
    for name, source in staged.items():
        if name in merges:
            reports[name] = merges[name].publish()
            if source.load is None or source.load is not merges[name].load:
                source.discard(merges[name].store)
        else:  # the format merges and publishes by itself
            spec = specs[name]
            reports[name] = upsert_table(
                spark, _qualified(namespace, name), source, spec.keys, spec.partition_column, newest_by, staged=True)
    return reports


def _scope(name: str):
    """Rows a place check covers: national scopes have no province to match."""
    if name == "silver_esios_energy_hourly":
        return ~F.col("esios_geo_id").isin(catalog.SPAIN_GEO_ID, catalog.PENINSULA_GEO_ID)
    return F.lit(True)


def silver_checks(name: str) -> Checks:
    """Key and place checks of a table's rows."""
    spec = catalog.SILVER_TABLES[name]
    checks = {"null_key": quality.null_key(spec.keys)}
    if spec.place_column:
        unplaced = F.col("province_code").isNull() | F.col("province_name").isNull()
        checks["unmatched_place"] = (quality.ERROR, unplaced & _scope(name))
    return checks


def load_silver(
    spark: SparkSession, bronze: Bronze, namespace: str, *, mode: str = "all",
    tables: Iterable[str] | None = None, provider: str = "parquet",
) -> dict[str, UpsertReport]:
    """Build, check and upsert the tables of a load mode (or the named ones)."""
    if mode not in catalog.LOAD_MODES:
        raise ValueError(f"Unknown load mode {mode}; known: {sorted(catalog.LOAD_MODES)}")
    frames = silver.build_silver(bronze, catalog.LOAD_MODES[mode] if tables is None else tables)
    create_tables(spark, frames, namespace, provider)
    staged, verdicts = _staged(
        spark, frames, namespace, {name: silver_checks(name) for name in frames}, as_loads=True)
    try:
        quality.require_passed(verdicts)
    except Exception:
        _discard(spark, namespace, staged)
        raise
    return _write(spark, namespace, staged, newest_by=("ingestion_timestamp",))


def build_gold(tables: Mapping[str, DataFrame], created_at: dt.datetime) -> dict[str, DataFrame]:
    """All Gold frames from the Silver tables."""
    provinces = tables["silver_cnig_provinces"]
    communities = tables["silver_cnig_autonomous_communities"]
    hourly = gold.fact_province_hourly(
        tables["silver_aemet_current_observations"], tables["silver_aemet_stations"],
        tables["silver_open_meteo_hourly"], tables["silver_open_meteo_15min"],
        tables["silver_esios_energy_hourly"], provinces, created_at=created_at,
    )
    capacity = gold.fact_installed_capacity_monthly(
        tables["silver_esios_installed_capacity_monthly"], communities, created_at=created_at)
    quarter = gold.fact_country_15min(
        tables["silver_open_meteo_15min"], tables["silver_esios_power_5min"], created_at=created_at)
    five = gold.fact_country_5min(tables["silver_esios_power_5min"], created_at=created_at)
    return {
        "gold_fact_province_hourly": hourly,
        "gold_fact_installed_capacity_monthly": capacity,
        "gold_fact_country_15min": quarter,
        "gold_fact_country_5min": five,
    }


_GRAIN_OF_FACT = {
    "gold_fact_country_5min": "FIVE_MINUTES",
    "gold_fact_country_15min": "FIFTEEN_MINUTES",
    "gold_fact_province_hourly": "HOUR",
    "gold_fact_installed_capacity_monthly": "MONTH",
}


def fact_checks(name: str) -> Checks:
    """Checks of a fact's rows: keys, geography level, grid and energy."""
    level = F.element_at(F.split(F.col("geography_key"), r"\|"), 1)
    checks = {"null_key": quality.null_key(catalog.GOLD_TABLES[name].keys),
              "geography_level": quality.level_allowed(level, name)}
    grain = _GRAIN_OF_FACT[name]
    if grain == "MONTH":
        checks["month_label"] = quality.incoherent_month("year_month", "gold_month_timestamp")
    else:
        checks["grid"] = quality.off_grid("gold_timestamp", grain)
    if name == "gold_fact_country_5min":
        for stem in catalog.NATIONAL_SERIES.values():
            power, energy = gold.power_metric(stem), f"{stem}_energy_mwh_5min"
            checks[f"sign_{stem}"] = quality.sign_changed(F.col(power), F.col(energy))
            checks[f"energy_{stem}"] = quality.wrong_interval_energy(power, energy, 5)
    return checks


def gold_checks(facts: Mapping[str, DataFrame]) -> list[DataFrame]:
    """Structural checks of facts: their rows, and keys that repeat."""
    return [verdict for name, frame in facts.items() for verdict in (
        quality.row_checks(frame, name, fact_checks(name)),
        quality.duplicate_keys(frame, catalog.GOLD_TABLES[name].keys, name))]


_PADDING = dt.timedelta(days=1)  # more than any alignment shift plus the longest sub-monthly grain


def _silver_of_window(
    tables: Mapping[str, DataFrame], window: tuple[dt.datetime, dt.datetime],
) -> dict[str, DataFrame]:
    """The instants that a Gold window can need; the scan skips the partitions outside."""
    start, end = window[0] - _PADDING, window[1] + _PADDING
    return {
        name: in_window(frame, "observation_timestamp", start, end)
        if catalog.SILVER_TABLES[name].partition in (catalog.BY_DAY, catalog.BY_MONTH) else frame
        for name, frame in tables.items()}


def placement_checks(tables: Mapping[str, DataFrame]) -> list[DataFrame]:
    """Observations without a province or instant, which no province fact can hold: counted, not lost in silence."""
    unplaced = F.col("province_code").isNull() | F.col("observation_timestamp").isNull()
    verdicts = [
        quality.row_checks(tables[name], name, {"unplaced_observation": (quality.WARNING, unplaced & _scope(name))})
        for name in ("silver_open_meteo_hourly", "silver_open_meteo_15min", "silver_esios_energy_hourly")]
    current = attach_station_place(
        tables["silver_aemet_current_observations"].groupBy("station_id").agg(F.count("*").alias("n")),
        tables["silver_aemet_stations"], ("province_code",))
    return [*verdicts, quality.unplaced(current, "silver_aemet_current_observations")]


def load_gold(
    spark: SparkSession, namespace: str, *, created_at: dt.datetime, provider: str = "parquet",
    window: tuple[dt.datetime, dt.datetime] | None = None,
) -> dict[str, UpsertReport]:
    """Full build, or with ``window`` the backfill of Gold instants in ``[start, end)``.

    Every fact goes through a merge by natural key, so a repeated run changes
    nothing. The geography dimension is loaded when its table is new; the time
    dimension receives the members it lacks.
    """
    tables = {name: spark.table(_qualified(namespace, name)) for name in catalog.SILVER_TABLES}
    if window:
        tables = _silver_of_window(tables, window)
    facts = build_gold(tables, created_at)
    if window:
        facts = {
            name: in_window(
                frame, "source_timestamp" if _GRAIN_OF_FACT[name] == "MONTH" else "gold_timestamp",
                *window)
            for name, frame in facts.items()
        }
    create_tables(spark, facts, namespace, provider)
    staged, verdicts = _staged(spark, facts, namespace, {name: fact_checks(name) for name in facts})
    facts = {name: _rows(source) for name, source in staged.items()}

    # dimensions from the staged facts of this run; nothing is visible before every control has passed
    capacity = facts["gold_fact_installed_capacity_monthly"]
    dimensions = {
        "gold_dim_geography": gold.dim_geography(
            tables["silver_cnig_provinces"], tables["silver_cnig_autonomous_communities"], created_at=created_at,
            esios_ids=capacity.select("geography_key", "esios_geo_id").filter(F.col("esios_geo_id").isNotNull()).distinct()),
        "gold_dim_time": gold.dim_time(
            {_GRAIN_OF_FACT[name]: frame for name, frame in facts.items()}, created_at=created_at)}
    new_tables = create_tables(spark, dimensions, namespace, provider)
    dimensions, _ = _staged(spark, dimensions, namespace, {})
    geography, instants = (_rows(source) for source in dimensions.values())
    new_geography = "gold_dim_geography" in new_tables
    places = geography if new_geography else spark.table(_qualified(namespace, "gold_dim_geography"))
    repeated = [
        quality.duplicate_keys(source, catalog.GOLD_TABLES[name].keys, name)  # counted by the merge elsewhere
        for name, source in staged.items() if not isinstance(source, StagedSource)]
    quality.require_passed([
        *verdicts, *repeated, *placement_checks(tables),
        quality.dim_time_checks(instants), quality.dim_geography_checks(places),
        *[quality.dangling_references(frame, places, ["geography_key"], name) for name, frame in facts.items()],
    ])
    members = new_members(instants, spark.table(_qualified(namespace, "gold_dim_time")), "time_key")
    added, _ = _staged(spark, {"gold_dim_time": members}, namespace, {})
    first = {"gold_dim_geography": dimensions["gold_dim_geography"]} if new_geography else {}
    return _write(spark, namespace, {**first, **added, **staged})

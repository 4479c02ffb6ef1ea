"""Data-quality checks.

Every check yields rows ``(check, table, severity, n_total, n_bad)``. Row-level
checks of one table share a single pass (``row_checks``).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meseta import catalog
from meseta.functions import dms_is_valid
from meseta.functions.time import GRAIN_MINUTES
from meseta.operators.clean import any_null, union_all
from meseta.operators.gaps import step_summary
from meseta.operators.joins import dangling
from meseta.session import stage

ERROR, WARNING, INFO = "ERROR", "WARNING", "INFO"


def _verdict(df: DataFrame, check: str, table: str, severity: str, total: Column, bad: Column) -> DataFrame:
    return df.select(
        F.lit(check).alias("check"), F.lit(table).alias("table"), F.lit(severity).alias("severity"),
        F.coalesce(total, F.lit(0)).cast("bigint").alias("n_total"),
        F.coalesce(bad, F.lit(0)).cast("bigint").alias("n_bad"),
    )


# One pass over the rows of a table ------------------------------------------


def row_checks(df: DataFrame, table: str, checks: Mapping[str, tuple[str, Column]]) -> DataFrame:
    """Evaluate any number of row predicates in one aggregate.

    ``checks`` maps a name to (severity, predicate that is true for a bad row);
    a NULL predicate counts as good, so predicates state NULL handling themselves.
    """
    names = list(checks)
    counted = df.agg(
        F.count(F.lit(1)).alias("_total"),
        *[F.count_if(checks[name][1]).alias(f"_bad_{i}") for i, name in enumerate(names)],
    )
    rows = [
        F.struct(
            F.lit(name).alias("check"), F.lit(table).alias("table"),
            F.lit(checks[name][0]).alias("severity"), F.col("_total").alias("n_total"),
            F.col(f"_bad_{i}").alias("n_bad"),
        )
        for i, name in enumerate(names)
    ]
    return counted.select(F.inline(F.array(*rows)))


def counted(
    spark: SparkSession, table: str, checks: Mapping[str, tuple[str, Column]], total: int, bad: Mapping[str, int],
) -> DataFrame:
    """Verdicts of row checks that were counted while the rows were written."""
    return spark.createDataFrame(
        [(name, table, severity, total, bad[name]) for name, (severity, _) in checks.items()],
        "check string, table string, severity string, n_total bigint, n_bad bigint")


def null_key(keys: Sequence[str]) -> tuple[str, Column]:
    return ERROR, any_null(keys)


def null_fields(columns: Sequence[str], severity: str = ERROR) -> dict[str, tuple[str, Column]]:
    """One check per mandatory column."""
    return {f"null_{name}": (severity, F.col(name).isNull()) for name in columns}


def coordinate_checks(latitude: str, longitude: str) -> dict[str, tuple[str, Column]]:
    """Out of range and missing are separate counts."""
    lat, lon = F.col(latitude), F.col(longitude)
    return {
        "coordinate_out_of_range": (ERROR, ~lat.between(-90, 90) | ~lon.between(-180, 180)),
        "coordinate_missing": (WARNING, lat.isNull() | lon.isNull()),
    }


def dms_check(text: str, axis: str) -> tuple[str, Column]:
    return WARNING, F.col(text).isNotNull() & ~dms_is_valid(F.col(text), axis)


def class_purity(magnitude: str, time: str, wanted: tuple) -> tuple[str, Column]:
    same = F.col(magnitude).eqNullSafe(F.lit(wanted[0])) & F.col(time).eqNullSafe(F.lit(wanted[1]))
    return ERROR, ~same


def off_grid(ts: str, grain: str) -> tuple[str, Column]:
    """Instants that do not start an interval of ``grain``."""
    instant = F.col(ts)
    return ERROR, (F.minute(instant) % GRAIN_MINUTES[grain] != 0) | (F.second(instant) != 0)


def incoherent_month(label: str, month_start: str) -> tuple[str, Column]:
    return ERROR, ~F.col(label).eqNullSafe(F.date_format(F.col(month_start), "yyyy-MM"))


def level_allowed(level: Column, table: str) -> tuple[str, Column]:
    allowed = level.isin(*catalog.FACT_LEVELS[table])
    return ERROR, ~F.coalesce(allowed, F.lit(False))


def sign_changed(source: Column, derived: Column) -> tuple[str, Column]:
    return ERROR, F.signum(source) != F.signum(derived)


def wrong_provenance(value: str, source: str, options: Mapping[str, str]) -> tuple[str, Column]:
    """The named source is the first one with a value, and its value was taken.

    ``options`` maps a source name to its input column, in order of preference.
    """
    expected_source, expected_value = F.lit(None).cast("string"), F.lit(None)
    for name, column in reversed(list(options.items())):
        present = F.col(column).isNotNull()
        expected_source = F.when(present, F.lit(name)).otherwise(expected_source)
        expected_value = F.when(present, F.col(column)).otherwise(expected_value)
    right = F.col(source).eqNullSafe(expected_source) & F.col(value).eqNullSafe(expected_value)
    return ERROR, ~right


def wrong_interval_energy(power: str, energy: str, minutes: int, tolerance: float = 1e-6) -> tuple[str, Column]:
    """Energy differs from power times hours, or exists on one side only."""
    expected = F.col(power) * F.lit(minutes / 60.0)
    differs = F.abs(F.col(energy) - expected) > tolerance
    return ERROR, F.coalesce(differs, F.col(energy).isNotNull() | F.col(power).isNotNull())


def dim_time_checks(df: DataFrame, table: str = "gold_dim_time") -> DataFrame:
    """Grain, ranges, the absence of an hour on months, and one row per key."""
    monthly = F.col("time_grain") == "MONTH"
    rows = row_checks(df, table, {
        "null_key": null_key(["time_key", "time_grain"]),
        "unknown_grain": (ERROR, ~F.col("time_grain").isin(*catalog.TIME_GRAINS)),
        "month_range": (ERROR, ~F.col("month").between(1, 12)),
        "hour_range": (ERROR, ~F.col("hour").between(0, 23)),
        "minute_range": (ERROR, ~F.col("minute").between(0, 59)),
        "hour_on_month": (ERROR, monthly & F.col("hour").isNotNull()),
        "hour_missing": (ERROR, ~monthly & F.col("hour").isNull()),
    })
    return rows.unionByName(duplicate_keys(df, ["time_key"], table))


def dim_geography_checks(df: DataFrame, table: str = "gold_dim_geography") -> DataFrame:
    """Levels, keys, and through a self join the province -> community -> country chain.

    The country and the Peninsula are members of their own: neither takes the other's
    code, and every community belongs to the country that is a member.
    """
    level = F.col("geography_level")
    required = ["geography_key", "geography_level", "geography_code", "geography_name"]
    rows = row_checks(df, table, {
        "null_key": null_key(required),
        "unknown_level": (ERROR, ~level.isin(*catalog.GEOGRAPHY_LEVELS)),
        "lower_level_filled": (ERROR, (level != "PROVINCE") & F.col("province_code").isNotNull()),
        "country_missing": (
            ERROR, level.isin("PROVINCE", "AUTONOMOUS_COMMUNITY") & F.col("country_code").isNull()
        ),
    })
    communities = df.filter(level == "AUTONOMOUS_COMMUNITY").select("autonomous_community_code")
    provinces = df.filter(level == "PROVINCE")
    orphans = provinces.join(communities, "autonomous_community_code", "left_anti").agg(
        F.count(F.lit(1)).alias("bad")
    )
    totals = provinces.agg(F.count(F.lit(1)).alias("total"))
    hierarchy = _verdict(
        _side_by_side(totals, orphans), "broken_hierarchy", table, ERROR, F.col("total"), F.col("bad")
    )
    countries = df.filter(level == "COUNTRY").select("country_code")
    stray = df.filter(level == "AUTONOMOUS_COMMUNITY").join(countries, "country_code", "left_anti").agg(
        F.count(F.lit(1)).alias("bad"))
    communities_total = communities.agg(F.count(F.lit(1)).alias("total"))
    country_link = _verdict(
        _side_by_side(communities_total, stray), "community_without_country", table, ERROR,
        F.col("total"), F.col("bad"))
    # one code names one member across the two national scopes
    national = duplicate_keys(
        df.filter(level.isin("COUNTRY", "PENINSULA")), ["geography_code"], table).withColumn(
        "check", F.lit("scopes_share_code"))
    parts = [
        rows, hierarchy, country_link, national, duplicate_keys(df, ["geography_key"], table),
        duplicate_keys(df, ["geography_level", "geography_code"], table).withColumn(
            "check", F.lit("duplicate_level_and_code"))]
    return reduce(DataFrame.unionByName, parts)


# Checks with a shuffle of their own -------------------------------------------


def _side_by_side(*one_row_frames: DataFrame) -> DataFrame:
    """Combine one-row aggregates by union and a final aggregate, without a cross join."""
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), one_row_frames)
    return stacked.agg(*[F.max(name).alias(name) for name in stacked.columns])


def duplicate_keys(df: DataFrame, keys: Sequence[str], table: str, severity: str = ERROR) -> DataFrame:
    """Keys that occur more than once; a NULL component counts as a value."""
    groups = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    counted = groups.agg(F.sum("_n").alias("total"), F.count_if(F.col("_n") > 1).alias("bad"))
    return _verdict(counted, "duplicate_key", table, severity, F.col("total"), F.col("bad"))


def surplus_rows(df: DataFrame, keys: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Rows, distinct keys and their difference."""
    groups = df.groupBy(*dict.fromkeys([*by, *keys])).agg(F.count(F.lit(1)).alias("_n"))
    return groups.groupBy(*by).agg(
        F.sum("_n").alias("n_rows"), F.count(F.lit(1)).alias("n_keys"),
        (F.sum("_n") - F.count(F.lit(1))).alias("n_duplicates"),
    )


def irregular_steps(df: DataFrame, series: Sequence[str], ts: str, expected_minutes: float, table: str) -> DataFrame:
    """Steps of another length than expected; real gaps are a warning, not an error."""
    summary = step_summary(df, series, ts, expected_minutes)
    return _verdict(
        summary, "irregular_step", table, WARNING,
        F.col("n_steps"), F.col("n_steps") - F.col("n_matching"),
    )


def row_count_matches(df: DataFrame, expected: int, table: str) -> DataFrame:
    counted = df.agg(F.count(F.lit(1)).alias("total"))
    return _verdict(
        counted, "row_count", table, ERROR, F.col("total"), F.abs(F.col("total") - expected)
    )


def value_fidelity(source: DataFrame, gold: DataFrame, keys: Sequence[str], value: str, table: str) -> DataFrame:
    """Keys whose value differs between source and Gold, or that one side lacks."""
    left = source.select(*keys, F.struct(F.col(value).alias("v")).alias("_source"))
    right = gold.select(*keys, F.struct(F.col(value).alias("v")).alias("_gold"))
    joined = left.join(right, list(keys), "full")
    counted = joined.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(~F.col("_source").eqNullSafe(F.col("_gold"))).alias("bad"),
    )
    return _verdict(counted, "value_fidelity", table, ERROR, F.col("total"), F.col("bad"))


def rolled_energy_matches(
    power: DataFrame, stored: DataFrame, keys: Sequence[str], energy: str, table: str,
    tolerance: float = 1e-6,
) -> DataFrame:
    """Recomputed interval energy against the stored one (both keyed frames)."""
    joined = power.select(*keys, F.col(energy).alias("_expected"), F.lit(1).alias("_l")).join(
        stored.select(*keys, F.col(energy).alias("_stored"), F.lit(1).alias("_r")), list(keys), "full"
    )
    differs = F.abs(F.col("_expected") - F.col("_stored")) > tolerance
    one_sided = F.col("_expected").isNull() != F.col("_stored").isNull()
    counted = joined.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.coalesce(differs, one_sided) | F.col("_l").isNull() | F.col("_r").isNull()).alias("bad"),
    )
    return _verdict(counted, "rolled_energy", table, ERROR, F.col("total"), F.col("bad"))


def dangling_references(facts: DataFrame, dim: DataFrame, on: Sequence[str], table: str) -> DataFrame:
    """Fact keys without a dimension member."""
    missing = dangling(facts, dim, on).agg(F.count(F.lit(1)).alias("bad"))
    total = facts.select(*on).distinct().agg(F.count(F.lit(1)).alias("total"))
    return _verdict(
        _side_by_side(total, missing), "dangling_reference", table, ERROR, F.col("total"), F.col("bad")
    )


def lost_coverage(source: DataFrame, gold: DataFrame, by: Sequence[str], value: str, table: str) -> DataFrame:
    """Groups that hold a value in the source and none in Gold."""
    present = source.filter(F.col(value).isNotNull()).select(*by).distinct()
    kept = gold.filter(F.col(value).isNotNull()).select(*by).distinct()
    total = present.agg(F.count(F.lit(1)).alias("total"))
    lost = present.join(kept, list(by), "left_anti").agg(F.count(F.lit(1)).alias("bad"))
    return _verdict(
        _side_by_side(total, lost), "lost_coverage", table, ERROR, F.col("total"), F.col("bad")
    )


def unplaced(counted: DataFrame, table: str) -> DataFrame:
    """Observations, as ``n`` per station, whose station has no province: no province fact can hold them."""
    lost = F.sum(F.when(F.col("province_code").isNull(), F.col("n")))
    return counted.agg(
        F.lit("unplaced_observation").alias("check"), F.lit(table).alias("table"), F.lit(WARNING).alias("severity"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_total"), F.coalesce(lost, F.lit(0)).alias("n_bad"))


def fingerprints(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Per group of ``by`` (or overall): rows, and 128 bits that depend on the multiset of rows alone.

    Two sums of row hashes: rows may come in any order and repeat, and tasks combine
    their part before the shuffle, which carries one row per group.
    """
    digests = [F.sum(F.xxhash64(F.lit(seed), *df.columns).cast("decimal(38,0)")) for seed in (1, 2)]
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("_rows"), *[d.alias(f"_digest_{i}") for i, d in enumerate(digests)])


def changed_outside(
    before: DataFrame, after: DataFrame, outside: Column, table: str, by: Sequence[str] = (),
) -> DataFrame:
    """Rows outside a reprocessed range that appeared, vanished or changed.

    Fingerprints per group of ``by``, such as the partition columns, are compared first;
    equal groups are done. Rows of the others are counted +1 before and -1 after, so
    equal multisets sum to zero everywhere.
    """
    columns = before.columns
    old, new = before.filter(outside), after.select(*columns).filter(outside)
    a, b = fingerprints(old, by), fingerprints(new, by)
    marks = ("_rows", "_digest_0", "_digest_1")
    sided = a.withColumns({f"{mark}_b": F.lit(None).cast(dict(a.dtypes)[mark]) for mark in marks}).unionByName(
        b.select(*by, *[F.lit(None).cast(dict(b.dtypes)[mark]).alias(mark) for mark in marks],
                 *[F.col(mark).alias(f"{mark}_b") for mark in marks]))
    groups = sided.groupBy(*by).agg(*[F.max(name).alias(name) for mark in marks for name in (mark, f"{mark}_b")])
    equal = reduce(lambda x, y: x & y, [F.col(mark).eqNullSafe(F.col(f"{mark}_b")) for mark in marks])
    # an overall fingerprint of no rows has a count of 0 and no sum on either side
    groups = stage(groups.withColumn("_equal", equal), "fingerprints")
    same = groups.agg(F.coalesce(F.sum(F.when(F.col("_equal"), F.col("_rows"))), F.lit(0)).alias("same"))
    unequal = groups.filter(~F.col("_equal")).select(*by, F.lit(True).alias("_differs"))
    if unequal.isEmpty():
        return _verdict(same, "changed_outside_range", table, ERROR, F.col("same"), F.lit(0))

    def differing(rows: DataFrame) -> DataFrame:
        if not by:
            return rows
        match = reduce(lambda x, y: x & y, [rows[name].eqNullSafe(unequal[name]) for name in by])
        return rows.join(unequal, match, "left_semi")

    signed = differing(old).withColumn("_sign", F.lit(1)).unionByName(differing(new).withColumn("_sign", F.lit(-1)))
    balance = signed.groupBy(*columns).agg(
        F.sum("_sign").alias("_balance"), F.count_if(F.col("_sign") == 1).alias("_before"))
    counted = balance.agg(
        F.coalesce(F.sum("_before"), F.lit(0)).alias("total"), F.sum(F.abs(F.col("_balance"))).alias("bad"))
    return _verdict(
        counted.withColumn("same", F.lit(same.first()["same"])),
        "changed_outside_range", table, ERROR, F.col("total") + F.col("same"), F.col("bad"))


def same_rows(first: DataFrame, second: DataFrame, table: str, by: Sequence[str] = ()) -> DataFrame:
    """Two runs gave the same multiset of rows."""
    verdict = changed_outside(first, second, F.lit(True), table, by)
    return verdict.withColumn("check", F.lit("idempotent"))


def same_values(
    first: DataFrame, second: DataFrame, keys: Sequence[str], table: str, *,
    directions: Sequence[str] = (), tolerance: float = 1e-9,
) -> DataFrame:
    """Two runs gave the same rows by key; doubles may differ by summation noise.

    A sum of doubles depends on the order in which shuffled parts arrive, so two runs of
    one mean can differ in the last bits. Every other type must be equal, and a key must
    occur once on both sides. ``directions`` are degrees, where 360 meets 0.
    """
    kinds = {name: kind for name, kind in first.dtypes if name not in keys}

    def sided(df: DataFrame, side: int) -> DataFrame:
        return df.select(*keys, F.lit(side).alias("_side"), F.struct(*kinds).alias("_row"))

    def differs(name: str) -> Column:
        a, b = F.col("_a")[name], F.col("_b")[name]
        equal = a.eqNullSafe(b)
        if kinds[name] == "double":
            gap = F.abs(a - b)
            if name in directions:
                gap = F.least(gap, F.lit(360.0) - gap)
            scale = F.greatest(F.lit(1.0), F.abs(a), F.abs(b))
            equal = equal | F.coalesce(gap <= F.lit(tolerance) * scale, F.lit(False))
        return ~equal

    rows = [F.max(F.when(F.col("_side") == side, F.col("_row"))).alias(name) for side, name in enumerate(("_a", "_b"))]
    counts = [F.count_if(F.col("_side") == side).alias(f"_n_{side}") for side in (0, 1)]
    paired = sided(first, 0).unionByName(sided(second, 1)).groupBy(*keys).agg(*rows, *counts)
    bad = reduce(lambda x, y: x | y, map(differs, kinds), (F.col("_n_0") != 1) | (F.col("_n_1") != 1))
    counted = paired.agg(F.count(F.lit(1)).alias("total"), F.count_if(bad).alias("bad"))
    return _verdict(counted, "idempotent", table, ERROR, F.col("total"), F.col("bad"))


# Profiles ---------------------------------------------------------------------


def key_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per column: non-blank values, distinct values and surplus, as key candidates.

    One row per (column, value) before the shuffle, combined map-side, so that
    several exact distinct counts share one pass.
    """
    pairs = df.select(F.inline(F.array(*[
        F.struct(F.lit(name).alias("column"), F.nullif(F.trim(F.col(name).cast("string")), F.lit("")).alias("v"))
        for name in columns
    ])))
    values = pairs.groupBy("column", "v").agg(F.count(F.lit(1)).alias("_n"))
    filled = F.col("v").isNotNull()
    return values.groupBy("column").agg(
        F.sum("_n").alias("n_rows"),
        F.coalesce(F.sum(F.when(filled, F.col("_n"))), F.lit(0)).alias("n_filled"),
        F.count_if(filled).alias("n_distinct"),
    ).withColumn("n_duplicates", F.col("n_filled") - F.col("n_distinct"))


# a digest, and a row, in this many belongs to the parts that are searched for repeated values first
_PARTS = 256


def minimal_keys(df: DataFrame, columns: Sequence[str], most: int = 3) -> DataFrame:
    """Column combinations that no two rows share, and none of whose parts is unique already.

    Combinations grow level by level up to ``most`` columns; one with a part that is unique
    is left out. Values are compared as digests, and equal ones have equal digests. A value
    that repeats anywhere proves that a candidate is no key, so two small parts come first:
    one digest in 256, which finds values that repeat far apart, and one row in 256, which
    finds the repeats of few values. Candidates without any are compared over all rows:
    distinct 64-bit digests prove a key, repeated ones are looked at again with 128 bits.
    NULL is a value. Rows: columns (comma-joined), n_columns, n_rows, n_distinct.
    """
    total = df.count()
    found: list[tuple[str, ...]] = []
    # two digests of each column, made once; those of a combination are their exclusive or
    digests = df.select(*[
        F.xxhash64(F.lit(2 * i + bits), F.col(name).isNull(), F.col(name)).alias(f"_{bits}_{name}")
        for i, name in enumerate(columns) for bits in (0, 1)])
    of = lambda names, bits: reduce(Column.bitwiseXOR, [F.col(f"_{bits}_{name}") for name in names])
    digests = digests.withColumn("row", of(columns, 0))

    def repeated(candidates: Sequence[tuple[str, ...]], part: bool, wide: bool) -> set[tuple[str, ...]]:
        """Candidates with a digest that occurs twice, in the parts or anywhere; 128 bits if ``wide``."""
        if not candidates:
            return set()
        fields = ("a", "b") if wide else ("a",)
        sets = [F.struct(*[of(names, bits).alias(field) for bits, field in enumerate(fields)]) for names in candidates]
        values = digests.select("row", F.posexplode(F.array(*sets)).alias("which", "v")).select("row", "which", "v.*")
        if part:
            chosen = [F.col(name).bitwiseAND(_PARTS - 1) == 0 for name in ("a", "row")]
            values = values.filter(chosen[0] | chosen[1])
        else:  # hardly any digest repeats now, so combining them before the shuffle would only fill memory
            values = values.repartition("which", *fields)
        twice = values.groupBy("which", *fields).agg(F.count(F.lit(1)).alias("n")).groupBy("which").agg(
            F.max("n").alias("n"))
        return {candidates[row["which"]] for row in twice.collect() if row["n"] > 1}  # a row per candidate

    for size in range(1, min(most, len(columns)) + 1):
        candidates = [names for names in combinations(columns, size) if not any(set(key) <= set(names) for key in found)]
        if not candidates or not total:
            break
        no_keys = repeated(candidates, part=True, wide=True)
        candidates = [names for names in candidates if names not in no_keys]
        doubtful = sorted(repeated(candidates, part=False, wide=False))
        no_keys = repeated(doubtful, part=False, wide=True)
        found += [names for names in candidates if names not in no_keys]
    return df.sparkSession.createDataFrame(
        [(",".join(key), len(key), total, total) for key in sorted(found)],
        "columns string, n_columns int, n_rows bigint, n_distinct bigint")


def functional_dependency(df: DataFrame, code: str | Sequence[str], name: str, table: str) -> DataFrame:
    """Codes, of one or several columns, that carry more than one name."""
    codes = [code] if isinstance(code, str) else list(code)
    code = "_".join(codes)
    pairs = df.groupBy(*codes).agg(F.min(name).alias("_low"), F.max(name).alias("_high"))
    counted = pairs.agg(
        F.count(F.lit(1)).alias("total"), F.count_if(F.col("_low") != F.col("_high")).alias("bad")
    )
    return _verdict(counted, f"{code}_to_{name}", table, ERROR, F.col("total"), F.col("bad"))


# Acceptance -------------------------------------------------------------------


def failures(checks: Sequence[DataFrame]) -> DataFrame:
    return union_all(checks).filter((F.col("severity") == ERROR) & (F.col("n_bad") > 0))


def require_passed(checks: Sequence[DataFrame]) -> DataFrame:
    """Raise on any failed ERROR check; otherwise return all verdicts.

    The verdicts are a handful of rows and are evaluated once.
    """
    verdicts = union_all(checks)
    rows = verdicts.collect()
    failed = [row for row in rows if row["severity"] == ERROR and row["n_bad"] > 0]
    if failed:
        text = ", ".join(f"{row['table']}.{row['check']}={row['n_bad']}" for row in failed)
        raise ValueError(f"Load rejected: {text}")
    return verdicts.sparkSession.createDataFrame(rows, verdicts.schema)

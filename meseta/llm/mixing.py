"""Mixing sources to target weights by pivotal dependent rounding, DataFrame functions only.

Every document of a source asks for the same fractional number of copies. The whole
copies are taken; the fractions are paired, and mass (fraction times size) moves
randomly between two documents until one fraction is 0 or 1, which keeps the words
of the pair. Blocks of documents settle all but one fraction; the residuals of the
blocks form the next, smaller level, up to one residual for each source. The words
taken from a source thus differ from its target by less than one document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F

from meseta.llm.common import free_name, stage
from meseta.llm.registry import query, table

WORD = r"[^\x20\x09-\x0D]+"
BLOCK = 64
"""Documents settled by one row of a level; sets the memory of a row, not the result's reach."""


def _ranked(sources: DataFrame, order: Column, partitions: int) -> DataFrame:
    """Add ``rank`` from 0 over all rows, without bringing them to one task."""
    dealt = stage(
        sources.repartitionByRange(partitions, order).withColumn("part", F.spark_partition_id()), "ranges")
    # one row per range: as many as partitions, however many sources there are
    counts = dealt.groupBy("part").agg(F.count("*").alias("n"))
    before = counts.withColumn("before", F.coalesce(
        F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    within = F.row_number().over(Window.partitionBy("part").orderBy(order)) - 1
    return dealt.withColumn("within", within).join(before.drop("n"), "part").withColumn(
        "rank", F.col("within") + F.col("before")).drop("part", "within", "before")


def targets(sizes: DataFrame, weights: tuple[float, ...] = (5, 2, 1), limit: float = 3.0, ranges: int = 8) -> DataFrame:
    """``source``, source_size, target from ``source``, ``size`` rows.

    Sources in code-point order, null last, take ``weights`` in turn and share the
    total size. A target stops at ``limit`` times its source's size and the excess is
    shared again by weight among the others until none is above.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = _ranked(totals, F.col("source").asc_nulls_last(), ranges)
    weight = F.element_at(
        F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    rows = stage(ranked.select("source", "source_size", weight.alias("weight")), "weights")
    ceiling = F.col("source_size") * F.lit(float(limit))
    total = float(rows.agg(F.sum("source_size")).first()[0] or 0)
    share, full = 0.0, -1
    while True:
        held = F.lit(False) if full < 0 else F.col("weight") * F.lit(share) >= ceiling
        spent, free, now = rows.agg(
            F.sum(F.when(held, ceiling)), F.sum(F.when(~held, F.col("weight"))), F.sum(held.cast("long"))).first()
        if now == full or not free:
            break
        full, share = now or 0, (total - (spent or 0.0)) / free
    return rows.select(
        "source", "source_size", F.least(ceiling, F.col("weight") * F.lit(share)).alias("target"))


def _uniform(*values: Column) -> Column:
    """A number in [0, 1) that depends on the values alone."""
    return F.shiftrightunsigned(F.xxhash64(*values), 11).cast("double") / F.lit(float(1 << 53))


def _let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _settle(rows: Column, seed: int, id_type: str) -> Column:
    """Fold an array of doc, salt, size, part rows, largest first.

    ``part`` is the open fraction. The state holds the one open row and those that
    are settled; every step settles one of two rows and keeps size times part.
    """
    kind = f"struct<doc:{id_type},salt:bigint,size:bigint,part:double>"
    start = F.struct(F.lit(None).cast(kind).alias("open"), F.array().cast(f"array<{kind}>").alias("done"))

    def row(of: Column, part: Column) -> Column:
        return F.struct(
            of["doc"].alias("doc"), of["salt"].alias("salt"), of["size"].alias("size"), part.alias("part"))

    def mass(old: Column, new: Column) -> Column:
        return F.struct(
            ((1 - old["part"]) * old["size"]).alias("old_room"), (old["part"] * old["size"]).alias("old_has"),
            ((1 - new["part"]) * new["size"]).alias("new_room"), (new["part"] * new["size"]).alias("new_has"),
            _uniform(F.lit(seed), old["doc"], old["salt"], new["doc"], new["salt"]).alias("draw"))

    def move(old: Column, new: Column, m: Column) -> Column:
        up, down = F.least(m["old_room"], m["new_has"]), F.least(m["old_has"], m["new_room"])
        # the smaller bound is met exactly, so the integral side is set, not computed
        rise = F.struct(
            F.when(m["old_room"] <= m["new_has"], 1.0).otherwise(old["part"] + up / old["size"]).alias("old"),
            F.when(m["new_has"] <= m["old_room"], 0.0).otherwise(new["part"] - up / new["size"]).alias("new"))
        fall = F.struct(
            F.when(m["old_has"] <= m["new_room"], 0.0).otherwise(old["part"] - down / old["size"]).alias("old"),
            F.when(m["new_room"] <= m["old_has"], 1.0).otherwise(new["part"] + down / new["size"]).alias("new"))
        return F.when(m["draw"] * (up + down) < down, rise).otherwise(fall)

    def step(state: Column, new: Column) -> Column:
        old = state["open"]

        def settled(parts: Column) -> Column:
            integral = parts["old"].isin(0.0, 1.0)
            a, b = row(old, parts["old"]), row(new, parts["new"])
            return F.struct(
                F.when(integral, b).otherwise(a).alias("open"),
                F.concat(state["done"], F.array(F.when(integral, a).otherwise(b))).alias("done"))

        met = _let(mass(old, new), lambda m: _let(move(old, new, m), settled))
        alone = F.struct(row(new, new["part"]).alias("open"), state["done"].alias("done"))
        return F.when(old.isNull(), alone).otherwise(met)

    return F.aggregate(rows, start, step)


def mix(
    docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), limit: float = 3.0, seed: int = 20_17,
    id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", block: int = BLOCK,
) -> DataFrame:
    """One row per row of ``docs``: ``id_col``, size, source_size, target, copies, taken, salt.

    ``size`` counts the words of the text; a null text or one without words has size 0
    and is never taken. ``taken`` is copies times size; no document is taken more than
    ``limit`` times, rounded up only where the limit isn't whole. Draws depend on the
    seed, the id and a hash of the text, so reruns agree; rows equal in all three are
    interchangeable. A source of nulls is one source.
    """
    size = F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long")
    sizes = stage(docs.select(
        F.col(id_col).alias("doc"), F.col(source_col).alias("source"), size.alias("size"),
        F.xxhash64(F.col(text_col)).alias("salt")), "sizes")
    goal = stage(targets(sizes, weights, limit), "targets")
    asked = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    rows = _with_source(sizes, goal, "target", "source_size").select(
        "doc", "salt", "source", "size", (asked - F.floor(asked)).alias("part"))
    rows = stage(rows, "fractions")
    id_type = dict(rows.dtypes)["doc"]
    open_row = (F.col("size") > 0) & (F.col("part") > 0)

    # a source has as many blocks as its open rows need; ids decide who meets whom
    counts = stage(rows.where(open_row).groupBy("source").agg(F.count("*").alias("n")), "counts")
    open_rows = _with_source(rows.where(open_row), counts, "n")
    done = [rows.where(~open_row).withColumn("part", F.lit(0.0))]
    most = int(counts.agg(F.max("n")).first()[0] or 0)
    level = 0
    while most:
        blocks = F.greatest(F.ceil(F.col("n") / F.lit(block)), F.lit(1))
        number = F.pmod(F.xxhash64(F.lit(seed), F.lit(level), "doc", "salt"), blocks)
        item = F.struct((-F.col("size")).alias("order"), "doc", "salt", "size", "part")
        largest_first = F.array_sort(F.collect_list(item))
        settled = open_rows.groupBy("source", "n", number.alias("number")).agg(largest_first.alias("items")).select(
            "source", F.ceil(F.col("n") / F.lit(block)).alias("n"),
            _settle(F.col("items"), seed + level, id_type).alias("state"))
        settled = stage(settled, f"level-{level}")
        done.append(settled.select("source", F.explode("state.done").alias("row")).select("source", "row.*"))
        # a residual that came out whole needs no partner
        rest = settled.select("source", "n", F.col("state.open").alias("row")).select("source", "n", "row.*")
        whole = F.col("part").isin(0.0, 1.0)
        done.append(rest.where(whole).drop("n"))
        rest = rest.where(~whole)
        if most <= block:
            draw = _uniform(F.lit(seed), F.lit(-1), F.col("doc"), F.col("salt"))
            done.append(rest.drop("n").withColumn("part", F.when(draw < F.col("part"), 1.0).otherwise(0.0)))
            break
        open_rows, most, level = rest, -(-most // block), level + 1
    rounded = done[0]
    for more in done[1:]:
        rounded = rounded.unionByName(more)
    copies = (F.floor(asked) + F.col("part")).cast("long")
    return _with_source(rounded, goal, "target", "source_size").select(
        F.col("doc").alias(id_col), "size", "source_size", "target",
        F.when(F.col("size") > 0, copies).otherwise(0).cast("long").alias("copies"), "salt",
    ).withColumn("taken", F.col("copies") * F.col("size"))


def _with_source(rows: DataFrame, by_source: DataFrame, *columns: str) -> DataFrame:
    """Columns of the row's source; null is a source. Adaptive execution splits a large source."""
    other = by_source.select(F.col("source").alias("__source"), *columns)
    return rows.join(other, rows["source"].eqNullSafe(other["__source"])).drop("__source")


def repeat_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with every row as often as the mix takes it; the columns stay the same.

    Rows that repeat id and text share their copies: the mix holds one row for each,
    so together they come out as often as the mix says. Ids can have any type.
    """
    hash_, copy = free_name(docs, "__hash"), free_name(docs, "__copy")
    id_, salt, copies = (free_name(docs, name) for name in ("__id", "__salt", "__copies"))
    plan = mix(docs, id_col=id_col, text_col=text_col, **options)
    plan = plan.where("copies > 0").groupBy(F.col(id_col).alias(id_), F.col("salt").alias(salt)).agg(
        F.sum("copies").alias(copies))
    once = docs.withColumn(hash_, F.xxhash64(F.col(text_col)))
    same = F.col(id_col).eqNullSafe(F.col(id_)) & (F.col(hash_) == F.col(salt))
    plan = stage(plan, "copies")
    joined = once.join(plan, same)
    repeats = once.groupBy(id_col, hash_).agg(F.count("*").alias(copy)).where(F.col(copy) > 1)
    if not repeats.isEmpty():
        joined = joined.dropDuplicates([id_col, hash_])
    return joined.withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(copies).cast("int")))).select(
        *docs.columns)


@query("op5_mixing")
def op5_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mix(table(spark, folder, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken")

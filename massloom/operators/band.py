"""Tolerance (band) joins, tolerance existence tests, gap islands and connected components.

Spark has no band-join strategy: a join whose only predicate is ``|a - b| < tol`` becomes a nested
loop.  Here the axis is cut into bins, one side is placed in its bin, the other in every bin its
tolerance reaches, and the pair is found by an equi-join on the bins and re-checked exactly.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from massloom.session import cut_lineage

_SLACK = 1e-6  # share of a bin added to the reach, so rounding of value / width never loses a pair


@dataclass(frozen=True)
class Band:
    """``left`` and ``right`` column names within ``tol``.

    unit ``da``: ``|l - r|``; ``ppm``: ``|l - r| / base * 1e6`` with ``base`` the named side.
    ``tol`` may name a column of the right side; ``width`` is then the bin width to use.
    ``strict`` makes the comparison ``<`` instead of ``<=``.
    """

    left: str
    right: str
    tol: float | str
    unit: str = "da"
    strict: bool = False
    base: str = "right"
    width: float | None = None

    def predicate(self, left: Column, right: Column, tol: Column) -> Column:
        gap = F.abs(left - right)
        if self.unit == "ppm":
            gap = gap / F.abs(right if self.base == "right" else left) * F.lit(1e6)
        return gap < tol if self.strict else gap <= tol

    def reach(self) -> float:
        t = float(self.tol)
        return -math.log1p(-t * 1e-6) if self.unit == "ppm" else t

    def bin_width(self) -> float:
        if self.width is not None:
            return self.width
        if isinstance(self.tol, str):
            raise ValueError("a tolerance column needs an explicit bin width")
        return 2.0 * self.reach()

    def axis(self, value: Column) -> Column:
        return F.log(value) if self.unit == "ppm" else value.cast("double")


def _floor(c: Column) -> Column:
    return F.floor(c).cast("bigint")


def _hashable(df: DataFrame) -> list[Column]:
    plain = (T.NumericType, T.StringType, T.BooleanType, T.TimestampType)
    return [F.col(f.name) for f in df.schema.fields if isinstance(f.dataType, plain)]


def spread(df: DataFrame) -> DataFrame:
    """``df`` for a join that shuffles both sides.

    The planner judges a side by its compressed files and not by the rows an explode makes of them, so a table of
    rows that grow with the data may be taken for a small one and collected on the driver.
    """
    return df.hint("merge")


def band_join(left: DataFrame, right: DataFrame, bands: Sequence[Band], keys: Sequence[str] = (),
              how: str = "inner", salt: int = 1, where: str | None = None) -> DataFrame:
    """Join rows equal on ``keys`` and inside every band.

    Every left row sits in one bin, so a pair is produced once.  The right side (the narrower one)
    is copied to the one or two bins it reaches.  ``salt`` > 1 spreads each bin of the left side
    over that many partitions and copies the right side to each, for a left side that may put a
    third of its rows into one bin.  The right side is shuffled, never collected (``spread``).  Column names other than ``keys`` must not overlap.  ``where``
    is a further SQL predicate evaluated inside the join.
    """
    lcols, rcols = left.columns, right.columns
    overlap = (set(lcols) & set(rcols)) - set(keys)
    if overlap and how not in ("left_semi", "left_anti"):
        raise ValueError(f"overlapping columns: {sorted(overlap)}")
    if how in ("left_semi", "left_anti"):
        needed = set(keys) | {b.right for b in bands} | {b.tol for b in bands if isinstance(b.tol, str)}
        if where is None:
            right = right.select(*[c for c in rcols if c in needed]).distinct()
            rcols = right.columns
    not_null = reduce(lambda a, b: a & b, [F.col(b.right).isNotNull() for b in bands])
    r = right.filter(not_null)
    rename = {c: f"__r_{c}" for c in rcols if c in lcols}
    for old, new in rename.items():
        r = r.withColumnRenamed(old, new)
    rname = lambda c: rename.get(c, c)
    conds: list[Column] = [F.col(k) == F.col(rname(k)) for k in keys]
    l = left
    for i, b in enumerate(bands):
        width = b.bin_width()
        tol = F.col(rname(b.tol)) if isinstance(b.tol, str) else F.lit(float(b.tol))
        reach = tol if isinstance(b.tol, str) else F.lit(b.reach())
        axis = b.axis(F.col(rname(b.right)))
        slack = F.lit(width * _SLACK)
        r = r.withColumn(f"__rb{i}", F.explode(F.sequence(
            _floor((axis - reach - slack) / F.lit(width)), _floor((axis + reach + slack) / F.lit(width)))))
        l = l.withColumn(f"__lb{i}", _floor(b.axis(F.col(b.left)) / F.lit(width)))
        conds.append(F.col(f"__lb{i}") == F.col(f"__rb{i}"))
        conds.append(b.predicate(F.col(b.left).cast("double"), F.col(rname(b.right)).cast("double"), tol))
    if salt > 1:
        l = l.withColumn("__ls", F.pmod(F.xxhash64(*_hashable(left)), F.lit(salt)).cast("int"))
        r = r.withColumn("__rs", F.explode(F.sequence(F.lit(0), F.lit(salt - 1))))
        conds.append(F.col("__ls") == F.col("__rs"))
    if where is not None:
        conds.append(F.expr(where))
    joined = l.join(spread(r), reduce(lambda a, b: a & b, conds), how)
    if how in ("left_semi", "left_anti"):
        return joined.select(*lcols)
    return joined.select(*lcols, *[c for c in rcols if c not in keys])


def blocks_of(rows: Column, block: int, most: int | None = None, few: int = 8) -> Column:
    """How many blocks of about ``block`` rows; with ``most``, only ``few`` until they hold that many, since each copies the other side."""
    n = F.ceil(rows / block)
    return (n if most is None else F.least(n, F.greatest(F.lit(few), F.ceil(rows / most)))).cast("int")


def deal(left: DataFrame, right: DataFrame, at: Sequence[str], by: Sequence[str], by_right: Sequence[str], block: int, most: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Both sides with ``__s, __l``: the rows that share ``at`` cut into blocks of about ``block`` rows by a hash of ``by`` and
    ``by_right``, each block sent once to every block of the other side.  Grouped by ``at`` and both, the blocks meet in
    tasks of bounded size, however many rows share ``at``; there should be few of these, such as bins of an axis.
    ``most``: see ``blocks_of``.
    """
    count = lambda df, n: df.groupBy(*at).agg(blocks_of(F.count(F.lit(1)), block, most).alias(n))
    sizes = F.broadcast(count(left, "__ns").join(count(right, "__nl"), list(at)))
    part = lambda n, columns: F.pmod(F.xxhash64(*columns), F.col(n)).cast("int")
    all_of = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = left.join(sizes, list(at)).withColumn("__s", part("__ns", by)).withColumn("__l", all_of("__nl"))
    right = right.join(sizes, list(at)).withColumn("__l", part("__nl", by_right)).withColumn("__s", all_of("__ns"))
    # fresh identities: both sides may stem from one table
    return left.drop("__ns", "__nl"), right.drop("__ns", "__nl").select(*[F.col(f"`{c}`").alias(c) for c in right.columns if c not in ("__ns", "__nl")])


def apart(df: DataFrame, *keys: str) -> DataFrame:
    """``df`` dealt by ``keys`` over as many partitions as the session's shuffles have.

    Adaptive execution merges partitions by their bytes and not by the pairs they make, so rows of which each meets
    thousands may all land in one task; partitions asked for by number are left as they are.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def nearest_in_band(left: DataFrame, right: DataFrame, band: Band, keys: Sequence[str] = ()) -> DataFrame:
    """``left`` plus ``__below`` and ``__above``: the nearest right values at or under, and over it.

    The right side is first reduced to the extremes of each bin, with map-side combine, so its size
    is bounded by axis range / tolerance whatever its row count or skew; each bin is then one row,
    and the join can never fan out.  Values further than the tolerance may be reported or missing;
    values inside it are always found.
    """
    t = float(band.tol)
    width = math.log1p(t * 1e-6) if band.unit == "ppm" else max(t, 1e-9)
    bins = (right.filter(F.col(band.right).isNotNull())
            .select(*keys, F.col(band.right).cast("double").alias("__v"))
            .withColumn("__b", _floor(band.axis(F.col("__v")) / F.lit(width)))
            .groupBy(*keys, "__b").agg(F.min("__v").alias("__lo"), F.max("__v").alias("__hi")))
    shifted = bins.select(*keys, "__b", "__lo", "__hi",
                          F.explode(F.array(*[F.lit(i) for i in range(-2, 3)])).alias("__d"))
    reachable = (shifted.withColumn("__bin", F.col("__b") + F.col("__d"))
                 .groupBy(*keys, "__bin")
                 .agg(F.max(F.when(F.col("__d") > 0, F.col("__hi"))).alias("__dn"),
                      F.min(F.when(F.col("__d") < 0, F.col("__lo"))).alias("__up"),
                      F.max(F.when(F.col("__d") == 0, F.col("__lo"))).alias("__own_lo"),
                      F.max(F.when(F.col("__d") == 0, F.col("__hi"))).alias("__own_hi")))
    probe = left.withColumn("__bin", _floor(band.axis(F.col(band.left)) / F.lit(width)))
    x = F.col(band.left).cast("double")
    out = probe.join(reachable, [*keys, "__bin"], "left")
    # a value of the row's own bin is closer than the bin width, so it is inside the tolerance
    # whichever side it lies on; the extremes of the bin are enough to witness it
    below = F.greatest(F.col("__dn"), F.when(F.col("__own_lo") <= x, F.col("__own_lo")),
                       F.when(F.col("__own_hi") <= x, F.col("__own_hi")))
    above = F.least(F.col("__up"), F.when(F.col("__own_hi") >= x, F.col("__own_hi")),
                    F.when(F.col("__own_lo") >= x, F.col("__own_lo")))
    return (out.withColumn("__below", below).withColumn("__above", above)
            .select(*left.columns, "__below", "__above"))


def band_exists(left: DataFrame, right: DataFrame, band: Band, flag: str,
                keys: Sequence[str] = ()) -> DataFrame:
    """``left`` plus a boolean ``flag``: does any right row lie inside the band?"""
    near = nearest_in_band(left, right, band, keys)
    x = F.col(band.left).cast("double")
    tol = F.lit(float(band.tol))
    hit = (F.coalesce(band.predicate(x, F.col("__below"), tol), F.lit(False))
           | F.coalesce(band.predicate(x, F.col("__above"), tol), F.lit(False)))
    return near.withColumn(flag, hit).select(*left.columns, flag)


def island_bins(df: DataFrame, value: str, gap: float, unit: str = "da", keys: Sequence[str] = (),
                aggs: Sequence[Column] = ()) -> DataFrame:
    """Bins of ``value`` with their island number: ``keys, __b, __lo, __hi, __island`` and ``aggs``.

    A new island starts where the step from the previous value exceeds ``gap`` (for ppm, relative
    to the larger value).  Two values of one bin are always closer than the gap, so only the bins,
    a bounded set, are put in order; the rows themselves never meet in one task.
    """
    g = float(gap)
    width = (-math.log1p(-g * 1e-6) if unit == "ppm" else g) * (1 - 1e-9)
    axis = F.log(F.col(value)) if unit == "ppm" else F.col(value).cast("double")
    bins = (df.filter(F.col(value).isNotNull()).withColumn("__b", _floor(axis / F.lit(width)))
            .groupBy(*keys, "__b").agg(F.min(value).alias("__lo"), F.max(value).alias("__hi"), *aggs))
    order = (Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))).orderBy("__b")
    previous = F.lag("__hi").over(order)
    step = F.col("__lo") - previous
    if unit == "ppm":
        step = step / F.greatest(F.col("__lo"), F.lit(1.0)) * F.lit(1e6)
    starts = F.when(previous.isNull() | (step > F.lit(g)), 1).otherwise(0)
    return (bins.withColumn("__start", starts)
            .withColumn("__island", F.sum("__start").over(order.rowsBetween(Window.unboundedPreceding, 0)))
            .drop("__start"))


def islands(df: DataFrame, value: str, gap: float, unit: str = "da", keys: Sequence[str] = (),
            label: str = "cluster") -> DataFrame:
    """``df`` with the island number of each row (numbered upwards from 1 per key)."""
    g = float(gap)
    width = (-math.log1p(-g * 1e-6) if unit == "ppm" else g) * (1 - 1e-9)
    axis = F.log(F.col(value)) if unit == "ppm" else F.col(value).cast("double")
    bins = island_bins(df, value, gap, unit, keys).select(*keys, "__b", F.col("__island").alias(label))
    return (df.withColumn("__b", _floor(axis / F.lit(width)))
            .join(bins, [*keys, "__b"], "left").drop("__b"))


def components(pairs: DataFrame, a: str, b: str) -> DataFrame:
    """Connected components of an edge list: ``node, component`` (the smallest node id in it).

    Minimum labels travel along edges and then jump to the label of their label, so the number of
    rounds grows with the logarithm of the longest path.  Each round is cut with a checkpoint.
    """
    edges = pairs.select(F.col(a).alias("u"), F.col(b).alias("v"))
    edges = cut_lineage(edges.union(edges.select("v", "u")).distinct())
    labels = cut_lineage(edges.groupBy(F.col("u").alias("node"))
                         .agg(F.least(F.min("v"), F.col("node")).alias("component")))
    while True:
        lowest = (edges.join(labels.select(F.col("node").alias("v"), "component"), "v")
                  .groupBy(F.col("u").alias("node")).agg(F.min("component").alias("__n")))
        step = (labels.join(lowest, "node", "left")
                .withColumn("__c", F.least("component", F.coalesce("__n", "component"))))
        jump = labels.select(F.col("node").alias("__c"), F.col("component").alias("__j"))
        fresh = cut_lineage(step.join(jump, "__c", "left")
                            .select("node", F.col("component").alias("__old"),
                                    F.least("__c", F.coalesce("__j", "__c")).alias("component")))
        moved = fresh.filter(F.col("__old") != F.col("component")).limit(1).count()
        labels = fresh.drop("__old")
        if not moved:
            return labels

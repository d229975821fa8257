"""Rounding, mass differences and rank helpers as Column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def half_up(x: Column, places: int = 0) -> Column:
    """Round half towards positive infinity at ``places`` decimals."""
    scale = 10.0 ** places
    return F.floor(x * F.lit(scale) + F.lit(0.5)) / F.lit(scale)


def ppm(observed: Column, reference: Column) -> Column:
    """Signed mass difference in parts per million of ``reference``."""
    return (observed - reference) / reference * F.lit(1e6)


def abs_ppm(observed: Column, reference: Column) -> Column:
    """Unsigned mass difference in parts per million; null for a zero reference."""
    return F.when(reference != 0, F.abs(observed - reference) / F.abs(reference) * F.lit(1e6))


def averaged_rank(partition: list[str], value: str) -> Column:
    """Rank of ``value`` inside the partition, ties sharing the mean of their positions."""
    order = Window.partitionBy(*partition).orderBy(value)
    ties = Window.partitionBy(*partition, value)
    return F.rank().over(order) + (F.count(F.lit(1)).over(ties) - 1) / F.lit(2.0)


def spearman(df: DataFrame, keys: list[str], x: str, y: str, out: str = "rho",
             count: str = "n_points") -> DataFrame:
    """Spearman correlation of ``x`` and ``y`` per key, with the number of points.

    Ranks are taken inside one key, so a key must be a bounded set of points (the injections of a
    study, the pools of a run).  A key with no spread on either side gets 0.
    """
    ranked = (df.withColumn("__rx", averaged_rank(keys, x)).withColumn("__ry", averaged_rank(keys, y)))
    rho = F.when((F.max("__rx") > F.min("__rx")) & (F.max("__ry") > F.min("__ry")), F.corr("__rx", "__ry"))
    return ranked.groupBy(*keys).agg(F.coalesce(rho, F.lit(0.0)).alias(out),
                                     F.count(F.lit(1)).alias(count))


def normal_tail(z: Column) -> Column:
    """Two-sided tail of the standard normal, ``erfc(|z| / sqrt 2)``.

    Complementary error function by the rational approximation of Abramowitz & Stegun 7.1.26
    (absolute error below 1.5e-7).
    """
    x = F.abs(z) / F.lit(math.sqrt(2.0))
    t = F.lit(1.0) / (F.lit(1.0) + F.lit(0.3275911) * x)
    poly = t * (F.lit(0.254829592) + t * (F.lit(-0.284496736) + t * (
        F.lit(1.421413741) + t * (F.lit(-1.453152027) + t * F.lit(1.061405429)))))
    return F.least(F.lit(1.0), poly * F.exp(-x * x))


def chi_square_tail(stat: Column, dof: Column) -> Column:
    """Upper tail of a chi-square, Wilson-Hilferty normal approximation."""
    k = dof.cast("double")
    z = (F.pow(stat / k, F.lit(1 / 3)) - (F.lit(1.0) - F.lit(2.0) / (F.lit(9.0) * k))) / F.sqrt(
        F.lit(2.0) / (F.lit(9.0) * k))
    two_sided = normal_tail(z)
    return F.when(z >= 0, two_sided / 2).otherwise(F.lit(1.0) - two_sided / 2)

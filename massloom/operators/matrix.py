"""Filters and normalisation over the long area table.

``areas``: study_id, polarity, group_id, injection, area; an absent row is a zero.
``injections``: study_id, polarity, injection, role, run_order and any metadata columns.
Injections are a few hundred rows per study, so joins to them broadcast by size; every aggregate
is keyed by group and combines on the map side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RUN = ["study_id", "polarity"]
GROUP = [*RUN, "group_id"]
INJ = [*RUN, "injection"]


def with_roles(areas: DataFrame, injections: DataFrame, *columns: str) -> DataFrame:
    """Detected cells with the role (and further columns) of their injection."""
    return areas.filter("area > 0").join(injections.select(*INJ, "role", *columns), INJ)


def role_counts(injections: DataFrame) -> DataFrame:
    """Injections per run and role, one row per run."""
    one = lambda role: F.count_if(F.col("role") == role)
    return injections.groupBy(*RUN).agg(one("sample").alias("n_sample"), one("blank").alias("n_blank"),
                                        one("qc").alias("n_qc"), F.count(F.lit(1)).alias("n_all"))


def _sum_if(cond: Column, value: str = "area") -> Column:
    return F.sum(F.when(cond, F.col(value)).otherwise(0))


def pooled_cv(areas: DataFrame, injections: DataFrame, scale: DataFrame | None = None) -> DataFrame:
    """CV in percent over the pooled QCs with signal; null below three pools or three detections.

    ``scale`` (run keys, injection, factor) divides the areas first.
    """
    pools = role_counts(injections).filter("n_qc >= 3").select(*RUN)
    cells = with_roles(areas, injections).filter("role = 'qc'").join(pools, RUN, "left_semi")
    if scale is not None:
        cells = (cells.join(scale.select(*INJ, "factor"), INJ, "left")
                 .withColumn("area", F.col("area") / F.coalesce(F.nullif("factor", F.lit(0.0)), F.lit(1.0))))
    return (cells.groupBy(*GROUP).agg(F.count(F.lit(1)).alias("n_pools"),
                                      (F.lit(100.0) * F.stddev_samp("area") / F.avg("area")).alias("pooled_cv"))
            .filter("n_pools >= 3"))


def median_factors(areas: DataFrame, injections: DataFrame, roles: tuple[str, ...] = ("sample", "qc")) -> DataFrame:
    """Per-injection factors from features complete in every included injection, scaled to mean 1.

    A run with no complete feature gets factor 1 everywhere.
    """
    inc = injections.filter(F.col("role").isin(list(roles))).select(*INJ)
    needed = inc.groupBy(*RUN).agg(F.count(F.lit(1)).alias("n_inc"))
    cells = areas.filter("area > 0").join(inc, INJ)
    complete = (cells.groupBy(*GROUP).agg(F.count(F.lit(1)).alias("n")).join(needed, RUN)
                .filter("n = n_inc").select(*GROUP))
    medians = cells.join(complete, GROUP, "left_semi").groupBy(*INJ).agg(F.median("area").alias("med"))
    mean = F.avg("med").over(Window.partitionBy(*RUN))
    scaled = medians.withColumn("factor", F.when(mean > 0, F.when(F.col("med") > 0, F.col("med") / mean)
                                                 .otherwise(1.0)).otherwise(1.0))
    return inc.join(scaled.select(*INJ, "factor"), INJ, "left").withColumn(
        "factor", F.coalesce("factor", F.lit(1.0)))


def recentre(areas: DataFrame, factors: DataFrame) -> DataFrame:
    """Fold a second scaling into ``factors`` so the medians of detected cells are equal on the
    rows given; injections without signal keep their factor."""
    med = (areas.filter("area > 0").join(factors, INJ)
           .groupBy(*INJ).agg(F.median(F.col("area") / F.col("factor")).alias("med")))
    out = factors.join(med, INJ, "left")
    centre = F.avg("med").over(Window.partitionBy(*RUN))
    return out.withColumn("factor", F.when(F.col("med") > 0, F.col("factor") * F.col("med") / centre)
                          .otherwise(F.col("factor"))).drop("med")


def apply_factors(areas: DataFrame, factors: DataFrame) -> DataFrame:
    return (areas.join(factors.select(*INJ, "factor"), INJ)
            .withColumn("area", F.col("area") / F.col("factor")).drop("factor"))


def median_normalise(areas: DataFrame) -> DataFrame:
    """Each injection divided by the median of its detected areas."""
    med = areas.filter("area > 0").groupBy(*INJ).agg(F.median("area").alias("__med"))
    return areas.join(med, INJ).withColumn("area", F.col("area") / F.col("__med")).drop("__med")


def blank_filter(groups: DataFrame, areas: DataFrame, injections: DataFrame, multiplier: float = 5.0,
                 statistic: str = "mean", min_detections: int = 2) -> DataFrame:
    """``groups`` plus ``blank_level, sample_level, detected, blank_pass``.

    Passes when detected in ``min_detections`` samples and the sample mean (zeros included) is at
    least ``multiplier`` times the blank mean or maximum.  Areas are never changed.  A run without
    blanks or without samples passes whole.
    """
    n = role_counts(injections)
    blank = F.col("role") == "blank"
    agg = (with_roles(areas, injections).groupBy(*GROUP).agg(
        F.count_if(F.col("role") == "sample").alias("detected"),
        _sum_if(F.col("role") == "sample").alias("__s"), _sum_if(blank).alias("__b"),
        F.max(F.when(blank, F.col("area"))).alias("__bmax")))
    out = groups.join(agg, GROUP, "left").join(n, RUN)
    level = F.coalesce(F.col("__bmax"), F.lit(0)) if statistic == "max" else (
        F.coalesce(F.col("__b"), F.lit(0)) / F.col("n_blank"))
    out = (out.withColumn("detected", F.coalesce("detected", F.lit(0)))
           .withColumn("blank_level", F.when(F.col("n_blank") > 0, level))
           .withColumn("sample_level", F.when(F.col("n_sample") > 0, F.coalesce("__s", F.lit(0)) / F.col("n_sample"))))
    decided = (F.col("detected") >= min_detections) & (
        (F.col("blank_level") <= 0) | (F.col("sample_level") >= F.lit(float(multiplier)) * F.col("blank_level")))
    idle = (F.col("n_blank") == 0) | (F.col("n_sample") == 0)
    return (out.withColumn("blank_pass", idle | decided)
            .select(*groups.columns, "detected", "sample_level", "blank_level", "blank_pass"))


def carryover(areas: DataFrame, injections: DataFrame) -> DataFrame:
    """Per blank: groups detected, total signal, and the share in groups whose mean sample exceeds it."""
    n = role_counts(injections).select(*RUN, "n_sample")
    cells = with_roles(areas, injections, "run_order")
    means = (cells.groupBy(*GROUP).agg(_sum_if(F.col("role") == "sample").alias("__s"),
                                       F.max(F.col("role") == "blank").alias("__any"))
             .filter("__any").join(n, RUN)
             .select(*GROUP, (F.col("__s") / F.nullif(F.col("n_sample"), F.lit(0))).alias("sample_mean")))
    blanks = cells.filter("role = 'blank'").join(means, GROUP)
    return (blanks.groupBy(*INJ, "run_order").agg(
        F.count(F.lit(1)).alias("features"), F.sum("area").alias("total"),
        (F.sum(F.when(F.col("sample_mean") > F.col("area"), F.col("area")).otherwise(0)) / F.sum("area"))
        .alias("shared")))


def blank_ratio(groups: DataFrame, areas: DataFrame, injections: DataFrame, multiplier: float = 3.0) -> DataFrame:
    """Distribution of mean sample over mean blank, per run: features, shares below, median, log10."""
    n = role_counts(injections)
    agg = (with_roles(areas, injections).groupBy(*GROUP).agg(
        _sum_if(F.col("role") == "sample").alias("__s"), _sum_if(F.col("role") == "blank").alias("__b"))
        .filter("__s > 0 and __b > 0").join(n, RUN)
        .withColumn("ratio", (F.col("__s") / F.col("n_sample")) / (F.col("__b") / F.col("n_blank"))))
    rows = agg.join(groups.select(*GROUP, (F.col("name").isNotNull() & (F.col("name") != "")).alias("named")), GROUP)
    below = (F.col("ratio") < multiplier).cast("int")
    return rows.groupBy(*RUN).agg(
        F.count(F.lit(1)).alias("features"), F.avg(below).alias("below"),
        F.avg(F.when(F.col("named"), below)).alias("below_identified"),
        F.median("ratio").alias("median_ratio"), F.median(F.log10("ratio")).alias("median_log_ratio"))


def presence_cells(injections: DataFrame, by: tuple[str, ...] = (), min_size: int = 3) -> DataFrame:
    """Injection -> cell.  Blanks and standards form no cell; an injection without a metadata value
    is placed by its role; cells below ``min_size`` take no part."""
    keyed = injections.filter(~F.col("role").isin("blank", "standard", "istd"))
    meta = F.concat_ws("/", *[F.col(c) for c in by]) if by else F.lit(None).cast("string")
    known = F.lit(False)
    for c in by:
        known = known | F.col(c).isNotNull()
    keyed = keyed.withColumn("cell", F.when(known, meta).otherwise(F.col("role")))
    size = F.count(F.lit(1)).over(Window.partitionBy(*RUN, "cell"))
    return keyed.withColumn("cell_size", size).filter(F.col("cell_size") >= min_size).select(*INJ, "cell", "cell_size")


def presence_filter(groups: DataFrame, areas: DataFrame, injections: DataFrame, min_fraction: float = 0.6,
                    by: tuple[str, ...] = (), min_size: int = 3) -> DataFrame:
    """``groups`` plus ``best_fraction, presence_pass``: detected in ``min_fraction`` of any cell.

    A run with no cell large enough is skipped (``presence_pass`` null).
    """
    cells = presence_cells(injections, by, min_size)
    per_cell = (areas.filter("area > 0").join(cells, INJ).groupBy(*GROUP, "cell")
                .agg((F.count(F.lit(1)) / F.first("cell_size")).alias("fraction"))
                .groupBy(*GROUP).agg(F.max("fraction").alias("best_fraction")))
    tested = cells.select(*RUN).distinct().withColumn("__tested", F.lit(True))
    return (groups.join(per_cell, GROUP, "left").join(tested, RUN, "left")
            .withColumn("best_fraction", F.when(F.col("__tested"), F.coalesce("best_fraction", F.lit(0.0))))
            .withColumn("presence_pass", F.when(F.col("__tested"), F.col("best_fraction") >= min_fraction - 1e-9))
            .drop("__tested"))


def gap_fill_rate(before: DataFrame, after: DataFrame, injections: DataFrame) -> DataFrame:
    """Over sample cells of the groups in ``after``: cells, gaps before, filled, left."""
    samples = injections.filter("role = 'sample'").select(*INJ)
    n = samples.groupBy(*RUN).agg(F.count(F.lit(1)).alias("n_sample"))
    seen = lambda df, name: (df.filter("area > 0").join(samples, INJ).groupBy(*RUN)
                             .agg(F.count(F.lit(1)).alias(name)))
    rows = after.select(*GROUP).distinct()
    totals = rows.groupBy(*RUN).agg(F.count(F.lit(1)).alias("rows")).join(n, RUN)
    old = seen(before.join(rows, GROUP, "left_semi"), "was")
    return (totals.join(old, RUN, "left").join(seen(after, "now"), RUN, "left").na.fill(0, ["was", "now"])
            .select(*RUN, (F.col("rows") * F.col("n_sample")).alias("cells"),
                    (F.col("rows") * F.col("n_sample") - F.col("was")).alias("gaps"),
                    (F.col("now") - F.col("was")).alias("filled"),
                    (F.col("rows") * F.col("n_sample") - F.col("now")).alias("left_open")))


def normalised_totals(areas: DataFrame, injections: DataFrame) -> DataFrame:
    """Total signal per injection over the median total of its own role, with the trend over the
    run (slope times order range) of that role."""
    totals = with_roles(areas, injections, "run_order").groupBy(*INJ, "role", "run_order").agg(
        F.sum("area").alias("total"))
    med = totals.groupBy(*RUN, "role").agg(F.median("total").alias("__med"))
    rel = totals.join(med, [*RUN, "role"]).withColumn("relative", F.col("total") / F.col("__med"))
    trend = rel.groupBy(*RUN, "role").agg(
        (F.regr_slope("relative", "run_order") * (F.max("run_order") - F.min("run_order"))).alias("trend"))
    return rel.join(trend, [*RUN, "role"]).select(*INJ, "role", "run_order", "total", "relative", "trend")


def named_only_in_pools(hits: DataFrame, injections: DataFrame) -> DataFrame:
    """Names whose every spectrum lies in pooled QCs."""
    return (hits.join(injections.select(*INJ, "role"), INJ).groupBy(*RUN, "name")
            .agg(F.bool_and(F.col("role") == "qc").alias("only"), F.count(F.lit(1)).alias("spectra"))
            .filter("only").drop("only"))


def wide_matrix(groups: DataFrame, areas: DataFrame, injections: list[str]) -> DataFrame:
    """Molecule x injection matrix for a sink: one column per listed injection, zeros filled."""
    wide = areas.groupBy(*GROUP).pivot("injection", injections).agg(F.first("area"))
    return groups.join(wide, GROUP, "left").na.fill(0, injections)

"""What the instrument did with its time: wasted precursors, contaminant series, cycle budget,
acquisition type, and the mass lists for the next run.

``scans``: study_id, polarity, injection, ms2_id, precursor_mz, rt and ``identified`` (one row per
MS2).  ``scan_table``: study_id, polarity, injection, scan_no, ms_level, rt and, for MS2,
isolation_target, isolation_lower, has_selection, injection_time, tic.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from massloom.functions import names as N
from massloom.functions.peaks import top_peaks
from massloom.operators import kernels
from massloom.operators.band import Band, apart, band_exists, band_join, deal, island_bins
from massloom.operators.matrix import INJ, RUN
from massloom.operators.order import quantiles
from massloom.operators.series import CH2, REPEATS, assign_series

CLUSTER_PPM, BLANK_TOL = 10.0, 0.01
MIN_SCANS, MIN_GRADIENT = 5, 0.5
#: Rows of one block in which next rungs are sought.
RUNGS = 2_048
DIAGNOSTIC = {"sodium formate": "formate", "sodium acetate": "acetate"}
DIA_WIDTH, DIA_REUSE, ALL_ION_WIDTH = 5.0, 20.0, 100.0


def cluster_mz(scans: DataFrame, ppm: float = CLUSTER_PPM, keys: list[str] = RUN) -> DataFrame:
    """One row per distinct precursor: ``cluster, mz, scans, rt_lo, rt_hi, any_identified``.

    Precursors chain into one while each is within ``ppm`` of the previous.  Counts and extremes
    are combined per fine bin first and per cluster after, so no precursor is hot.
    """
    bins = island_bins(scans, "precursor_mz", ppm, "ppm", keys, aggs=[
        F.count(F.lit(1)).alias("n"), F.sum("precursor_mz").alias("s"), F.min("rt").alias("lo"),
        F.max("rt").alias("hi"), F.max(F.col("identified").cast("int")).alias("idn")])
    return bins.groupBy(*keys, F.col("__island").alias("cluster")).agg(
        (F.sum("s") / F.sum("n")).alias("mz"), F.sum("n").alias("scans"), F.min("lo").alias("rt_lo"),
        F.max("hi").alias("rt_hi"), (F.max("idn") > 0).alias("any_identified"))


def find_wasted(scans: DataFrame, blank_precursors: DataFrame | None = None, min_scans: int = MIN_SCANS,
                min_fraction: float = MIN_GRADIENT, require_blank: bool = True) -> DataFrame:
    """Exclusion candidates: never identified, at least ``min_scans`` MS2, over ``min_fraction`` of
    the gradient, and also fragmented in a blank when blank precursors are given."""
    gradient = scans.groupBy(*RUN).agg((F.max("rt") - F.min("rt")).alias("gradient"))
    rows = cluster_mz(scans).join(gradient, RUN).filter("gradient > 0")
    rows = (rows.withColumn("gradient_fraction", (F.col("rt_hi") - F.col("rt_lo")) / F.col("gradient"))
            .filter((F.col("scans") >= min_scans) & ~F.col("any_identified")
                    & (F.col("gradient_fraction") >= min_fraction)))
    if blank_precursors is None:
        rows = rows.withColumn("in_blank", F.lit(False))
    else:
        rows = in_blank(rows, blank_precursors)
        if require_blank:
            has = blank_precursors.select(*RUN).distinct().withColumn("__has", F.lit(True))
            rows = rows.join(has, RUN, "left").filter(F.col("__has").isNull() | F.col("in_blank"))
    return rows.select(*RUN, "cluster", "mz", "scans", "rt_lo", "rt_hi", "gradient_fraction", "in_blank")


def in_blank(rows: DataFrame, blank_precursors: DataFrame, tol: float = BLANK_TOL) -> DataFrame:
    """``rows`` plus ``in_blank``: a blank precursor of the run lies within ``tol`` of ``mz``."""
    return band_exists(rows, blank_precursors.select(*RUN, F.col("precursor_mz").alias("blank_mz")),
                       Band("mz", "blank_mz", tol), "in_blank", keys=RUN)


def duty_cycle(wasted: DataFrame, scans: DataFrame) -> DataFrame:
    """Share of each run's MS2 spent on the candidates."""
    total = scans.groupBy(*RUN).agg(F.count(F.lit(1)).alias("total_ms2"))
    spent = wasted.groupBy(*RUN).agg(F.sum("scans").alias("wasted_ms2"), F.count(F.lit(1)).alias("precursors"))
    return (total.join(spent, RUN, "left").na.fill(0, ["wasted_ms2", "precursors"])
            .withColumn("wasted_fraction", F.col("wasted_ms2") / F.col("total_ms2")))


def series_breakdown(wasted: DataFrame, scans: DataFrame) -> DataFrame:
    total = scans.groupBy(*RUN).agg(F.count(F.lit(1)).alias("total_ms2"))
    name = F.when(F.col("series") == "", "unassigned").otherwise(F.col("series"))
    return (wasted.groupBy(*RUN, name.alias("series")).agg(F.count(F.lit(1)).alias("precursors"), F.sum("scans").alias("scans"))
            .join(total, RUN).withColumn("share", F.col("scans") / F.col("total_ms2")).drop("total_ms2"))


def survey_peaks(ms1: DataFrame, max_spectra: int | None = None, top: int | None = None) -> DataFrame:
    """Peaks of each injection's MS1 scans: all of them, unless a sample is asked for.

    ``ms1``: study_id, polarity, injection, scan_no, peaks.  ``max_spectra`` takes that many evenly
    spaced scans of an injection and ``top`` the most intense peaks of each.
    """
    peaks = F.col("peaks") if top is None else top_peaks(F.col("peaks"), top)
    if max_spectra is None:
        return ms1.select(*INJ, "scan_no", F.explode(peaks).alias("p")).select(*INJ, "scan_no", "p.*")
    position = F.row_number().over(Window.partitionBy(*INJ).orderBy("scan_no")) - 1
    count = F.count(F.lit(1)).over(Window.partitionBy(*INJ))
    slim = ms1.select(*INJ, "scan_no").withColumn("__p", position).withColumn("__n", count)
    step = F.greatest(F.lit(1), F.floor(F.col("__n") / max_spectra))
    chosen = slim.filter((F.col("__p") % step == 0) & (F.floor(F.col("__p") / step) < max_spectra)).select(*INJ, "scan_no")
    return (ms1.join(chosen, [*INJ, "scan_no"], "left_semi")
            .select(*INJ, "scan_no", F.explode(peaks).alias("p")).select(*INJ, "scan_no", "p.*"))


def detect_modifier(survey: DataFrame, min_evidence: int = 30, margin: float = 2.0) -> DataFrame:
    """Mobile-phase salt per run from the salt-cluster series of its survey peaks.

    Series are found per injection (a chain has to be real in one file) and their members counted
    over the run; the winner needs 30 members and twice the runner-up.
    """
    masses = survey.select(*INJ, F.round("mz", 4).alias("mz")).distinct()
    labelled = assign_series(masses, keys=INJ, discover=False).filter(F.col("series").isin(list(DIAGNOSTIC)))
    runs = survey.select(*RUN).distinct()
    count = lambda name: F.count_if(F.col("series") == name)
    n = labelled.groupBy(*RUN).agg(count("sodium formate").alias("formate"), count("sodium acetate").alias("acetate"))
    out = runs.join(n, RUN, "left").na.fill(0, ["formate", "acetate"])
    top, low = F.greatest("formate", "acetate"), F.least("formate", "acetate")
    call = F.when((top >= min_evidence) & ((low == 0) | (top >= margin * low)),
                  F.when(F.col("formate") >= F.col("acetate"), "formate").otherwise("acetate"))
    reason = (F.when(top == 0, "no series").when(top < min_evidence, "too thin")
              .when((low > 0) & (top < margin * low), "both present").otherwise(""))
    return out.withColumn("call", call).withColumn("reason", reason)


def acquisition_type(scan_table: DataFrame) -> DataFrame:
    """DDA / DIA / all-ion / MS1 only / unknown per injection, from its isolation windows."""
    ms2 = F.col("ms_level") > 1
    agg = scan_table.groupBy(*INJ).agg(
        F.count_if(F.col("ms_level") == 1).alias("n_ms1"), F.count_if(ms2).alias("n_ms2"),
        F.count_if(ms2 & F.coalesce(F.col("has_selection"), F.lit(False))).alias("n_selected"),
        F.count("isolation_target").alias("n_targets"),
        F.count_distinct(F.bround("isolation_target", 1)).alias("n_windows"),
        (F.max("isolation_lower") * 2).alias("width"))
    reuse = F.col("n_targets") / F.greatest(F.col("n_windows"), F.lit(1))
    call = (F.when(F.col("n_ms2") == 0, F.when(F.col("n_ms1") > 0, "MS1 only").otherwise("unknown"))
            .when((F.col("n_selected") == 0) & (F.col("n_targets") == 0), "all-ion")
            .when(F.col("width") >= ALL_ION_WIDTH, "all-ion")
            .when((F.col("width") >= DIA_WIDTH) & (reuse >= DIA_REUSE), "DIA").otherwise("DDA"))
    return agg.withColumn("reuse", reuse).withColumn("acquisition", call)


def searchable(types: DataFrame) -> DataFrame:
    """Injections worth a library search; one that cannot be classified is searched."""
    return types.withColumn("searchable", F.col("acquisition").isin("DDA", "unknown"))


def study_warnings(types: DataFrame) -> DataFrame:
    """Per run: no MS2 anywhere, MS2 without any selection, DIA windows."""
    return types.groupBy(*RUN).agg(
        ((F.sum("n_ms2") == 0) & (F.sum("n_ms1") > 0)).alias("no_ms2"),
        ((F.sum("n_ms2") > 0) & (F.sum("n_selected") + F.sum("n_targets") == 0)).alias("no_selection"),
        F.bool_or(F.col("acquisition") == "DIA").alias("any_dia"))


def cycle_budget(scan_table: DataFrame) -> DataFrame:
    """Per injection: MS1 period, MS2 per cycle, cost of one more MS2 and of the MS1 block (ms)."""
    order = Window.partitionBy(*INJ).orderBy("scan_no")
    prev = scan_table.withColumn("__l", F.lag("ms_level").over(order)).withColumn("__d", (F.col("rt") - F.lag("rt").over(order)) * 60000.0)
    step = lambda a, b: F.median(F.when((F.col("__l") == a) & (F.col("ms_level") == b), F.col("__d")))
    costs = prev.groupBy(*INJ).agg(step(2, 2).alias("ms2_cost"), step(2, 1).alias("__in"), step(1, 2).alias("__out"))
    pos = scan_table.withColumn("__p", F.row_number().over(order)).filter("ms_level = 1")
    gap = (pos.withColumn("__n", F.col("__p") - F.lag("__p").over(order) - 1)
           .withColumn("__c", (F.col("rt") - F.lag("rt").over(order)) * 60000.0)
           .groupBy(*INJ).agg(F.median("__c").alias("cycle"), F.median("__n").alias("ms2_per_cycle")))
    return (costs.join(gap, INJ).withColumn("ms1_cost", F.col("__in") + F.col("__out")).drop("__in", "__out"))


def injection_time_audit(scan_table: DataFrame, ceiling: float | None = None) -> DataFrame:
    """Per run: share of MS2 at the injection-time ceiling, and the median signal of both kinds."""
    ms2 = scan_table.filter("ms_level = 2 AND injection_time IS NOT NULL")
    if ceiling is None:
        ms2 = ms2.join(ms2.groupBy(*RUN).agg(F.max("injection_time").alias("ceiling")), RUN)
    else:
        ms2 = ms2.withColumn("ceiling", F.lit(float(ceiling)))
    at = F.col("injection_time") >= F.col("ceiling") - 1e-9
    shares = ms2.groupBy(*RUN).agg(F.count(F.lit(1)).alias("ms2"), F.avg(at.cast("int")).alias("at_ceiling"))
    middles = quantiles(ms2, RUN, {"median_time": (F.col("injection_time"), 0.5), "tic_at_ceiling": (F.when(at, F.col("tic")), 0.5),
                                   "tic_early": (F.when(~at, F.col("tic")), 0.5)})
    return shares.join(middles, RUN, "left").withColumn(
        "tic_ratio", F.col("tic_early") / F.greatest(F.col("tic_at_ceiling"), F.lit(1.0)))


def inclusion_candidates(groups: DataFrame, scans: DataFrame, library: DataFrame, ms1_tol: float = 0.01,
                         fwhm_multiple: float = 6.0) -> DataFrame:
    """Kept, unidentified groups below the median area of identified ones, never fragmented within
    ``ms1_tol`` and six mean widths, with a library entry at their mass.

    ``groups``: run keys, group_id, mz, rt, fwhm, max_area, keep, identified.
    """
    limits = groups.groupBy(*RUN).agg(
        F.median(F.when(F.col("identified") & (F.col("max_area") > 0), F.col("max_area"))).alias("ceiling"),
        (F.avg(F.when(F.col("fwhm") > 0, F.col("fwhm"))) * fwhm_multiple).alias("window"))
    low = (groups.join(limits, RUN).withColumn("window", F.coalesce("window", F.lit(0.25)))
           .filter(F.col("keep") & ~F.col("identified") & (F.col("max_area") > 0) & (F.col("max_area") < F.col("ceiling"))))
    seen = band_join(scans.select(*RUN, "precursor_mz", F.col("rt").alias("scan_rt")),
                     low.select(*RUN, "group_id", "mz", "rt", "window"),
                     [Band("precursor_mz", "mz", ms1_tol), Band("scan_rt", "rt", "window", width=1.0)], keys=RUN)
    never = low.join(seen.select(*RUN, "group_id").distinct(), [*RUN, "group_id"], "left_anti")
    entries = library.groupBy(F.col("precursor_mz").alias("lib_mz")).agg(F.count(F.lit(1)).alias("n"))
    hits = (band_join(never.select(*RUN, "group_id", "mz"), entries, [Band("mz", "lib_mz", ms1_tol, strict=True)])
            .groupBy(*RUN, "group_id").agg(F.sum("n").alias("n_matches")))
    return never.join(hits, [*RUN, "group_id"]).select(*RUN, "group_id", "mz", "rt", "max_area", "n_matches")


def safe_exclusions(wasted: DataFrame, library: DataFrame, identified: DataFrame, ppm: float = 10.0,
                    isolation: float = 0.55) -> DataFrame:
    """Exclusion entries with ``hits_library, hits_identified, co_isolated, safe``.

    ``library``: polarity, lib_mz (no decoys); ``identified``: run keys, lipid_mz.  An entry within
    ``ppm`` of either is not safe; an identified lipid in the isolation window is only reported.
    """
    rows = band_exists(wasted, library, Band("mz", "lib_mz", ppm, "ppm", base="left"), "hits_library", ["polarity"])
    rows = band_exists(rows, identified, Band("mz", "lipid_mz", ppm, "ppm", base="left"), "hits_identified", RUN)
    rows = band_exists(rows, identified, Band("mz", "lipid_mz", isolation), "co_isolated", RUN)
    return rows.withColumn("safe", ~(F.col("hits_library") | F.col("hits_identified")))


def library_masses(library: DataFrame) -> DataFrame:
    """``polarity, lib_mz`` of the non-decoy entries, polarity by the sign after the bracket."""
    return (library.filter(~F.upper("name").startswith("DECOY"))
            .select(N.adduct_sign(F.col("name")).alias("polarity"), F.col("precursor_mz").alias("lib_mz")))


def protected_fatty_acids(runs: DataFrame, grid: DataFrame) -> DataFrame:
    """Free-fatty-acid masses as identified lipids of every negative run."""
    negative = runs.filter("polarity = '-'").select(*RUN).distinct()
    masses = grid.agg(F.collect_list("fa_mz").alias("m"))  # at most a few hundred masses
    return negative.withColumn("__m", masses.scalar()).withColumn("lipid_mz", F.explode("__m")).drop("__m")


def richest_files(files: DataFrame, n: int = 3) -> DataFrame:
    """Largest non-blank files of a run by size (``n`` is the report's length)."""
    rank = F.row_number().over(Window.partitionBy(*RUN).orderBy(F.desc("size"), "injection"))
    return files.filter("role <> 'blank'").withColumn("rank", rank).filter(F.col("rank") <= n)


def next_rungs(rows: DataFrame, step: Column | float = CH2, tol: float = 0.01) -> DataFrame:
    """low_id, high_id: for each row the most abundant one of its run (the smaller id on a tie) whose mass is ``step`` more
    within ``tol`` and which elutes later.

    Rows of a mass bin meet in blocks, and a block leaves the best of each row only, so pairs are no rows.
    """
    width = 10.0 * tol  # few bins of many rows: a block costs more to hand over than to compare
    slack = F.lit(tol + width * 1e-6)
    left = rows.select(*RUN, F.col("group_id").alias("low_id"), (F.col("mz") + step).alias("target"), F.col("rt").alias("low_rt"))
    left = left.filter("target IS NOT NULL").withColumn("__bin", F.floor(F.col("target") / width))
    right = rows.filter("mz IS NOT NULL").select(*RUN, F.col("group_id").alias("high_id"), F.col("mz").alias("high_mz"), F.col("rt").alias("high_rt"), F.col("area").alias("high_area"))
    right = right.withColumn("__bin", F.explode(F.sequence(F.floor((F.col("high_mz") - slack) / width), F.floor((F.col("high_mz") + slack) / width))))
    left, right = deal(left, right, [*RUN, "__bin"], ["low_id"], ["high_id"], RUNGS)
    at = [*RUN, "__bin", "__s", "__l"]
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in [*left.select(*RUN, "low_id").schema.fields, *right.select("high_id", "high_area").schema.fields]])
    run = kernels.next_rungs(tol, [*RUN, "low_id"], to_arrow_schema(schema))
    best = apart(left, *at).groupBy(*at).cogroup(apart(right, *at).groupBy(*at)).applyInArrow(run, schema)
    return best.groupBy(*RUN, "low_id").agg(F.max_by("high_id", F.struct("high_area", -F.col("high_id"))).alias("high_id"))

"""Mass calibration, derived settings, analyser checks and spiked standards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from massloom.functions.ions import standard_mz
from massloom.functions.numeric import ppm
from massloom.functions.peaks import shift_masses
from massloom.operators.band import Band, band_join
from massloom.operators.matrix import GROUP, INJ, RUN
from massloom.operators.order import quantiles
from massloom.operators.scans import ms1_peaks

# ---- fixed values ------------------------------------------------------------------------------
BOUNDS = {"noise_threshold": (500.0, 100_000.0), "chrom_fwhm": (1.0, 120.0), "min_fwhm": (0.2, 30.0), "max_fwhm": (5.0, 300.0),
          "align_rt_max_difference": (5.0, 300.0), "mass_offset_ppm": (-25.0, 25.0), "retention_model_max_error": (0.1, 5.0)}
# parameters of this library's filters and resolvers
DECISION_RULES = {"multiplier", "min_fraction", "min_files", "min_r", "min_evidence", "min_scans", "min_base_fraction"}
DEFAULTS = {"mass_offset_ppm": 0.0, "chrom_fwhm": 5.0, "min_fwhm": 1.0, "max_fwhm": 20.0, "align_rt_max_difference": 30.0,
            "noise_threshold": 5000.0, "retention_model_max_error": 1.0}
NOISE_MULTIPLIER, PLAUSIBLE_NOISE = 5.5, (2.0, 15.0)
MS2_CALIBRANTS = {"+": [184.0733, 264.2686], "-": [255.2330, 279.2330, 281.2486, 303.2330, 327.2330]}
SEARCH_WINDOW = {"orbitrap": 0.05, "tof": 0.10, "ion trap": 0.70, "unknown": 0.70}
LADDER = [0.005, 0.01, 0.02, 0.05, 0.1, 0.2, 0.3, 0.5, 0.7]
PLAUSIBLE_WINDOW = {"orbitrap": (0.005, 0.05), "tof": (0.005, 0.10), "ion trap": (0.2, 0.7), "unknown": (0.005, 0.7)}
TARGET_CAPTURE, KEEP_CAPTURE, MIN_AXIS_PEAKS = 0.97, 0.90, 200


# ---- mass offsets -----------------------------------------------------------------------------

def apply_offset(rows: DataFrame, offset_ppm: float = 0.0, fragment_da: float = 0.0, mz: str = "precursor_mz") -> DataFrame:
    """Constant mass offset: ``mz`` corrected (the measured value kept beside it), fragments shifted."""
    out = rows.withColumn(f"{mz}_measured", F.col(mz)).withColumn(mz, F.col(mz) - F.col(mz) * F.lit(offset_ppm * 1e-6))
    if fragment_da and "peaks" in rows.columns:
        out = out.withColumn("peaks", F.transform("peaks", lambda p: p.withField("mz", p["mz"] - F.lit(fragment_da))))
    return out


def file_mass_drift(ms1: DataFrame, calibrants: DataFrame, match_ppm: float = 30.0, rt_window: float = 0.15, least: int = 20) -> DataFrame:
    """Per injection: median and spread of the mass error of its most intense peak near each calibrant.

    ``calibrants``: run keys, cal_id, cal_mz, cal_rt.  Strictly within ``match_ppm`` and
    ``rt_window``; fewer than ``least`` calibrants give no offset.
    """
    hits = band_join(ms1_peaks(ms1), calibrants.select(*RUN, "cal_id", "cal_mz", "cal_rt"),
                     [Band("mz", "cal_mz", match_ppm, "ppm", strict=True), Band("rt", "cal_rt", rt_window, strict=True)], keys=RUN, salt=4)
    best = hits.groupBy(*INJ, "cal_id", "cal_mz").agg(F.max_by("mz", F.struct("intensity", -F.col("scan_no"), -F.col("mz"))).alias("mz"))
    err = best.withColumn("err", ppm(F.col("mz"), F.col("cal_mz")))
    out = err.groupBy(*INJ).agg(F.count(F.lit(1)).alias("n"), F.median("err").alias("offset_ppm"), F.stddev_pop("err").alias("spread_ppm"))
    enough = F.col("n") >= least
    return out.withColumn("offset_ppm", F.when(enough, F.col("offset_ppm"))).withColumn("spread_ppm", F.when(enough, F.col("spread_ppm")).otherwise(0.0))


def batch_bias(relative: DataFrame, absolute: DataFrame) -> DataFrame:
    """Per run: what the theoretical masses add to the relative offsets (median difference)."""
    a = absolute.select(*INJ, F.col("offset_ppm").alias("absolute_ppm"))
    return (relative.join(a, INJ).filter("offset_ppm IS NOT NULL AND absolute_ppm IS NOT NULL").groupBy(*RUN)
            .agg(F.median(F.col("absolute_ppm") - F.col("offset_ppm")).alias("bias_ppm")))


def apply_file_calibration(spectra: DataFrame, offsets: DataFrame, least: float = 2.0) -> DataFrame:
    """Every peak and precursor of an injection shifted by its measured offset when that is at least
    ``least`` ppm.  A table already carrying ``calibrated_ppm`` is refused."""
    if "calibrated_ppm" in spectra.columns:
        raise ValueError("these spectra were calibrated before; calibrate the original ones")
    o = offsets.select(*INJ, F.col("offset_ppm").alias("__o"))
    out = spectra.join(o, INJ, "left").withColumn("calibrated_ppm", F.when(F.abs("__o") >= least, F.col("__o")).otherwise(0.0)).drop("__o")
    factor = F.lit(1.0) - F.col("calibrated_ppm") * 1e-6
    out = out.withColumn("peaks", shift_masses(F.col("peaks"), factor))
    return out.withColumn("precursor_mz", F.col("precursor_mz") * factor) if "precursor_mz" in spectra.columns else out


# ---- derived settings -------------------------------------------------------------------------

def _setting(name: str, stats: DataFrame, value: Column, measured: Column, enough: Column, why: str) -> DataFrame:
    if name in DECISION_RULES:
        raise ValueError(f"{name!r} decides what counts as a hit; it is never derived from the data")
    low, high = BOUNDS.get(name, (float("-inf"), float("inf")))
    return stats.select(*RUN, F.lit(name).alias("parameter"), F.lit(DEFAULTS.get(name)).cast("double").alias("previous"),
                        F.when(enough, measured).alias("measured"),
                        F.when(enough, F.greatest(F.lit(low), F.least(F.lit(high), value))).alias("value"),
                        (enough & ((value < low) | (value > high))).alias("clamped"), F.when(~enough, F.lit(why)).otherwise("").alias("skipped_reason"))


def derive_setting(name: str, values: DataFrame, column: str) -> DataFrame:
    """One derived parameter per run from its evidence column; asking for a decision rule raises.

    mass_offset_ppm: median of 50; chrom/min/max_fwhm: percentiles 50/1/99 of 50 positive widths;
    align_rt_max_difference: 4 x p95 of 20 absolute deviations; noise_threshold: 5.5 x the median of
    the lowest decile of 1000 intensities; retention_model_max_error: 3 x median of 3 model sds.
    """
    if name in DECISION_RULES:
        raise ValueError(f"{name!r} decides what counts as a hit; it is never derived from the data")
    x = F.col(column)
    good = values.filter(x.isNotNull() & ~F.isnan(x.cast("double")))
    n, v = F.col("n"), F.col("v")
    if name == "noise_threshold":
        s = noise_floor(good, column)
        return _setting(name, s, F.col("floor") * NOISE_MULTIPLIER, F.col("floor"), n >= 1000, "fewer than 1000 MS1 peaks")

    def stats(rows: DataFrame, value: Column, share: float) -> DataFrame:
        return rows.groupBy(*RUN).agg(F.count(x).alias("n")).join(quantiles(rows, RUN, {"v": (value, share)}), RUN)

    if name == "mass_offset_ppm":
        return _setting(name, stats(good, x, 0.5), v, v, n >= 50, "fewer than 50 matched spectra")
    if name in ("chrom_fwhm", "min_fwhm", "max_fwhm"):
        q = {"chrom_fwhm": 0.5, "min_fwhm": 0.01, "max_fwhm": 0.99}[name]
        return _setting(name, stats(good.filter(x > 0), x, q), v, v, n >= 50, "fewer than 50 detected features")
    if name == "align_rt_max_difference":
        return _setting(name, stats(good, F.abs(x), 0.95), v * 4, v * 4, n >= 20, "fewer than 20 aligned features")
    if name == "retention_model_max_error":
        return _setting(name, stats(good.filter(x > 0), x, 0.5), v * 3, v * 3, n >= 3, "fewer than 3 fitted class models")
    raise ValueError(f"unknown descriptive parameter {name!r}")


def kth_values(values: DataFrame, ranks: DataFrame) -> DataFrame:
    """Exact order statistics: ``run, tag, v`` for ``ranks`` (run keys, tag, r counted from 1 upwards).

    ``values`` (run keys, positive ``v``) are counted on a logarithmic grid, with map-side combine;
    the cells holding the wanted ranks are located from those counts, and only the values of these
    cells are put in order, as (value, count) pairs.
    """
    p = values.withColumn("g", F.floor(F.log("v") * 1000).cast("bigint"))
    hist = p.groupBy(*RUN, "g").agg(F.count(F.lit(1)).alias("n"))
    cum = F.sum("n").over(Window.partitionBy(*RUN).orderBy("g"))
    cells = (hist.withColumn("cum", cum).join(ranks, RUN).filter((F.col("cum") >= F.col("r")) & (F.col("cum") - F.col("n") < F.col("r")))
             .select(*RUN, "g", "tag", (F.col("r") - F.col("cum") + F.col("n")).alias("need")))
    counts = p.join(cells, [*RUN, "g"]).groupBy(*RUN, "tag", "need", "v").agg(F.count(F.lit(1)).alias("c"))
    at = F.sum("c").over(Window.partitionBy(*RUN, "tag").orderBy("v"))
    return counts.withColumn("at", at).filter("at >= need").groupBy(*RUN, "tag").agg(F.min("v").alias("v"))


def noise_floor(peaks: DataFrame, column: str = "intensity") -> DataFrame:
    """Median of the lowest decile of positive intensities per run: ``n, floor``."""
    pos = peaks.filter(F.col(column) > 0).select(*RUN, F.col(column).cast("double").alias("v"))
    n = pos.groupBy(*RUN).agg(F.count("v").alias("n"))
    at = F.lit(0.1) * (F.col("n") - 1)
    pair = lambda low, high: F.explode(F.array(F.struct(F.lit("a").alias("tag"), low.alias("r")), F.struct(F.lit("b").alias("tag"), high.alias("r"))))
    ends = n.select(*RUN, pair(F.floor(at) + 1, F.ceil(at) + 1).alias("e")).select(*RUN, "e.*")
    two = kth_values(pos, ends).groupBy(*RUN).pivot("tag", ["a", "b"]).agg(F.first("v")).join(n, RUN)
    p10 = two.withColumn("p10", F.col("a") + (at - F.floor(at)) * (F.col("b") - F.col("a"))).select(*RUN, "n", "p10")
    low = pos.join(p10.select(*RUN, "p10"), RUN).filter("v <= p10").select(*RUN, "v")
    m = low.groupBy(*RUN).agg(F.count("v").alias("m"))
    mids = m.select(*RUN, pair(F.floor((F.col("m") + 1) / 2), F.floor(F.col("m") / 2) + 1).alias("e")).select(*RUN, "e.*")
    floor = kth_values(low, mids).groupBy(*RUN).agg(F.avg("v").alias("floor"))
    return n.join(floor, RUN)


def noise_check(floors: DataFrame, configured: float) -> DataFrame:
    """Is the configured noise threshold plausible for the measured floor (2 to 15 times it)?"""
    ratio = F.lit(float(configured)) / F.col("floor")
    ok = F.col("floor").isNull() | (F.col("floor") <= 0) | ratio.between(*PLAUSIBLE_NOISE)
    return floors.withColumn("ratio", ratio).withColumn("derived", F.col("floor") * NOISE_MULTIPLIER).withColumn("plausible", ok)


def peak_cap(ms1: DataFrame, cap: int = 600) -> DataFrame:
    """Lowest threshold that leaves at most ``cap`` MS1 peaks per scan, null when the data is sparser."""
    pos = ms1.select(*RUN, F.explode("peaks.intensity").alias("v")).filter("v > 0")
    keep = ms1.groupBy(*RUN).agg((F.count(F.lit(1)) * cap).alias("keep"))
    size = keep.join(pos.groupBy(*RUN).agg(F.count("v").alias("total")), RUN)
    ranks = size.filter("keep < total").select(*RUN, F.lit("t").alias("tag"), (F.col("total") - F.col("keep") + 1).alias("r"))
    return keep.join(kth_values(pos, ranks).select(*RUN, F.col("v").alias("threshold")), RUN, "left").select(*RUN, "threshold")


# ---- MS2 mass axis ----------------------------------------------------------------------------

def ms2_axis_errors(ms2: DataFrame, top_n: int = 10, min_relative: float = 0.02) -> DataFrame:
    """Accepted calibrant peaks: run keys, injection, analyzer, calibrant, error_da.

    ``ms2`` carries ``analyzer``.  In each spectrum of three peaks or more the tallest peak in the
    analyser's window around each calibrant, when among the ten tallest and 2 % of the base.
    """
    pick = lambda m, k: F.create_map(*[F.lit(x) for kv in m.items() for x in kv])[k]
    cal = F.when(F.col("polarity") == "-", F.array(*[F.lit(x) for x in MS2_CALIBRANTS["-"]])).otherwise(
        F.array(*[F.lit(x) for x in MS2_CALIBRANTS["+"]]))
    rows = ms2.filter(F.size("peaks") >= 3).withColumn("w", F.coalesce(pick(SEARCH_WINDOW, F.col("analyzer")), F.lit(0.7)))
    rows = rows.withColumn("heights", F.sort_array(F.col("peaks.intensity"), asc=False)).withColumn("cal", F.explode(cal))
    inside = F.filter("peaks", lambda p: F.abs(p["mz"] - F.col("cal")) <= F.col("w"))
    best = F.array_max(F.transform(inside, lambda p: F.struct(p["intensity"].alias("i"), (-p["mz"]).alias("nmz"))))
    limit = F.when(F.size("heights") >= top_n, F.get("heights", F.lit(top_n - 1))).otherwise(F.get("heights", F.size("heights") - 1))
    out = rows.withColumn("b", best).filter(F.col("b").isNotNull() & (F.col("b.i") >= limit)
                                            & (F.col("b.i") >= min_relative * F.get("heights", F.lit(0))))
    return out.select(*INJ, "ms2_id", "analyzer", F.col("cal").alias("calibrant"), (-F.col("b.nmz") - F.col("cal")).alias("error_da"))


def ms2_axis(errors: DataFrame, configured: float = 0.01) -> DataFrame:
    """Per run: offset, share captured per ladder window after the offset, the smallest window with
    97 %, clamped to the analyser's band, and whether the configured window may stay (in band and
    capturing 90 %).  Below 200 calibrant peaks the configured window stands."""
    mid = errors.groupBy(*RUN).agg(F.count(F.lit(1)).alias("n_peaks"), F.mode("analyzer").alias("analyzer"))
    mid = mid.join(quantiles(errors, RUN, {"offset_da": (F.col("error_da"), 0.5)}), RUN, "left").select(*RUN, "n_peaks", "offset_da", "analyzer")
    dev = errors.select(*RUN, "error_da").join(mid, RUN).withColumn("dev", F.abs(F.col("error_da") - F.col("offset_da")))
    caps = F.array(*[F.avg((F.col("dev") <= w).cast("int")) for w in LADDER])
    at = F.avg((F.col("dev") <= configured).cast("int"))
    out = dev.groupBy(*RUN, "n_peaks", "offset_da", "analyzer").agg(caps.alias("capture"), at.alias("configured_capture"))
    band = lambda i: F.create_map(*[F.lit(x) for k, v in PLAUSIBLE_WINDOW.items() for x in (k, v[i])])[F.col("analyzer")]
    ladder = F.array(*[F.lit(w) for w in LADDER])
    first = F.coalesce(F.array_min(F.zip_with(ladder, "capture", lambda w, c: F.when(c >= TARGET_CAPTURE, w))), F.lit(LADDER[-1]))
    out = out.withColumn("window", F.least(F.greatest(first, band(0)), band(1)))
    stays = (F.col("n_peaks") < MIN_AXIS_PEAKS) | (F.lit(configured).between(band(0), band(1)) & (
        (F.col("configured_capture") >= KEEP_CAPTURE) if configured in LADDER else F.lit(True)))
    return out.withColumn("configured_stands", stays)


# ---- spiked standards -------------------------------------------------------------------------

def with_standard_mz(standards: DataFrame) -> DataFrame:
    return standards.withColumn("expected_mz", standard_mz(F.col("formula"), F.col("adduct")))


def _matches(groups: DataFrame, standards: DataFrame, tol: float) -> DataFrame:
    """Groups within ``tol`` ppm of each standard of their polarity, by *measured* mass."""
    g = groups.withColumn("measured", F.coalesce("mz_measured", "mz")) if "mz_measured" in groups.columns else groups.withColumn("measured", F.col("mz"))
    return band_join(g, standards.select("polarity", "standard", "expected_mz"), [Band("measured", "expected_mz", tol, "ppm")], keys=["polarity"])


def standards_performance(groups: DataFrame, areas: DataFrame, injections: DataFrame, standards: DataFrame, tol: float = 10.0) -> DataFrame:
    """Per run and standard: found, mass error, and area statistics over the standards injections.

    The group with the largest area within ``tol`` ppm stands for a standard.
    """
    runs = injections.filter("role = 'standard'").groupBy(*RUN).agg(F.count(F.lit(1)).alias("injections"))
    best = _matches(groups, standards, tol).groupBy(*RUN, "standard", "expected_mz").agg(
        F.max_by(F.struct("group_id", "measured", "rt"), F.struct("max_area", -F.col("group_id"))).alias("b"))
    best = best.select(*RUN, "standard", "expected_mz", "b.*")
    cells = areas.filter("area > 0").join(injections.filter("role = 'standard'").select(*INJ), INJ)
    stat = best.select(*GROUP, "standard").join(cells, GROUP).groupBy(*RUN, "standard").agg(
        F.count(F.lit(1)).alias("detected_in"), F.median("area").alias("median_area"),
        (100 * F.stddev_samp("area") / F.avg("area")).alias("cv_percent"))
    grid = runs.join(standards.select("polarity", "standard", F.col("expected_mz").alias("mz0")), "polarity")
    return (grid.join(best, [*RUN, "standard"], "left").join(stat, [*RUN, "standard"], "left")
            .select(*RUN, "standard", F.col("mz0").alias("expected_mz"), F.col("group_id").isNotNull().alias("found"), F.col("measured").alias("observed_mz"),
                    ppm(F.col("measured"), F.col("mz0")).alias("mass_error_ppm"), "rt", "injections", F.coalesce("detected_in", F.lit(0)).alias("detected_in"),
                    F.when(F.col("group_id").isNotNull(), F.coalesce("median_area", F.lit(0.0))).alias("median_area"), "cv_percent"))


def mix_present(groups: DataFrame, areas: DataFrame, injections: DataFrame, standards: DataFrame, tol: float = 10.0, least: int = 2,
                fraction: float = 0.5) -> DataFrame:
    """Is the mix spiked into the samples?  At least ``least`` standards, each in half the samples."""
    n = injections.groupBy(*RUN).agg(F.count_if(F.col("role") == "sample").alias("injections"))
    cells = areas.filter("area > 0").join(injections.filter("role = 'sample'").select(*INJ), INJ).groupBy(*GROUP).agg(F.count(F.lit(1)).alias("k"))
    seen = (_matches(groups, standards, tol).select(*GROUP, "standard").join(cells, GROUP, "left").groupBy(*RUN, "standard")
            .agg(F.coalesce(F.max("k"), F.lit(0)).alias("k")).join(n, RUN))
    need = F.greatest(F.lit(1), F.bround(F.col("injections") * fraction).cast("int"))
    found = seen.groupBy(*RUN).agg(F.count_if((F.col("k") >= need)).alias("standards_found"))
    return n.join(found, RUN, "left").na.fill(0, ["standards_found"]).withColumn("present", F.col("standards_found") >= least)


def standards_offset(groups: DataFrame, standards: DataFrame, tol: float = 20.0) -> DataFrame:
    """Median mass error over the standards of each run (largest group within ``tol`` ppm)."""
    best = _matches(groups, standards, tol).groupBy(*RUN, "standard", "expected_mz").agg(
        F.max_by("measured", F.struct("max_area", -F.col("group_id"))).alias("m"))
    return best.groupBy(*RUN).agg(F.median(ppm(F.col("m"), F.col("expected_mz"))).alias("standards_ppm"))


def check_offset(derived: DataFrame, from_standards: DataFrame, tolerance: float = 3.0) -> DataFrame:
    """Does the offset derived from identifications (run keys, derived_ppm) agree with the standards?"""
    rows = derived.join(from_standards, RUN, "full").withColumn("difference_ppm", F.col("standards_ppm") - F.col("derived_ppm"))
    return rows.withColumn("verdict", F.when(F.col("difference_ppm").isNull(), "not comparable")
                           .when(F.abs("difference_ppm") <= tolerance, "agree").otherwise("DISAGREE"))

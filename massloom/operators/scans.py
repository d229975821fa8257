"""Jobs over raw scans: chromatograms, peak tests, gap filling, features, alignment, linking.

``ms1``: study_id, polarity, injection, scan_no, rt, peaks<mz, intensity>.  The exploded peaks are
the largest relation of all.  They are pruned to mass and intensity, stay on one bin each, and are
reduced to one value per target and scan before anything else is shuffled; a small target list is
broadcast by its size, a large one is joined on salted bins.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from massloom.functions.peaks import bind
from massloom.operators import kernels
from massloom.operators.band import Band, apart, band_exists, band_join, islands
from massloom.operators.matrix import GROUP, INJ, RUN
from massloom.operators.qc import dense_cells
from massloom.session import cut_lineage

TARGET = [*INJ, "target_id"]
#: Minutes of an injection whose scans are searched for targets in one task.
STRETCH = 1.0


def ms1_peaks(ms1: DataFrame, min_intensity: float | None = None) -> DataFrame:
    """One row per MS1 peak: injection, scan_no, rt, mz, intensity."""
    peaks = F.col("peaks") if min_intensity is None else F.filter("peaks", lambda p: p["intensity"] >= min_intensity)
    return ms1.select(*INJ, "scan_no", "rt", F.explode(peaks).alias("p")).select(*INJ, "scan_no", "rt", "p.mz", "p.intensity")


def xic(ms1: DataFrame, targets: DataFrame, ppm: float = 10.0, how: str = "sum") -> DataFrame:
    """Signal per target and scan: ``target, scan_no, rt, signal``; a scan without the mass gives 0.

    ``targets``: injection keys, target_id, t_mz, t_lo, t_hi.  Masses in [t_mz - ppm, t_mz + ppm),
    scans in [t_lo, t_hi).  ``how`` ``max`` takes the tallest peak instead of the sum.

    The scans of one stretch of an injection meet its targets in a task, as whole scans: a peak is never a row.
    """
    bin_of = lambda c: F.floor(F.col(c) / STRETCH)
    scan = ms1.filter("rt IS NOT NULL").select(*INJ, "scan_no", F.col("rt").cast("double").alias("rt"), F.col("peaks.mz").cast("array<double>").alias("p_mz"),
                                               F.col("peaks.intensity").cast("array<double>").alias("p_int"), bin_of("rt").alias("__t"))
    t = targets.filter("t_lo < t_hi").select(*TARGET, *[F.col(c).cast("double").alias(c) for c in ("t_mz", "t_lo", "t_hi")])
    t = t.withColumn("__t", F.explode(F.sequence(bin_of("t_lo"), bin_of("t_hi"))))
    fields = [*t.select(*TARGET).schema.fields, *scan.select("scan_no", "rt").schema.fields, T.StructField("signal", T.DoubleType())]
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in fields])
    at = [*INJ, "__t"]
    return apart(scan, *at).groupBy(*at).cogroup(apart(t, *at).groupBy(*at)).applyInArrow(kernels.signals(ppm, how, TARGET, to_arrow_schema(schema)), schema)


def traces(chrom: DataFrame) -> DataFrame:
    """One row per target with its time-ordered ``trace array<struct<rt, signal>>`` (a few hundred
    scans at most: the window of one target in one injection)."""
    return chrom.groupBy(*TARGET).agg(F.array_sort(F.collect_list(F.struct("rt", "signal"))).alias("trace"))


def array_median(values: Column) -> Column:
    """Median of an array, null when empty."""
    def middle(v: Column) -> Column:
        n = F.size(v)
        upper, lower = F.get(v, F.floor(n / 2).cast("int")), F.get(v, F.floor((n - 1) / 2).cast("int"))
        return F.when(n > 0, (upper + lower) / 2)
    return bind(F.array_sort(values), middle)


def integrate(trace: Column, centre: Column, half: Column) -> Column:
    """Summed signal within ``half`` of ``centre``."""
    return F.aggregate(F.filter(trace, lambda p: F.abs(p["rt"] - centre) <= half), F.lit(0.0), lambda acc, p: acc + p["signal"])


def peak_test(trace: Column, centre: Column, half: Column, min_scans: int = 3) -> Column:
    """Struct ``apex_rt, sn`` of a peak at the expected time, or null.

    Baseline and robust sigma come from the flanks; the apex from the core; it must stand in a run
    of at least ``min_scans`` consecutive scans above baseline + sigma.
    """
    core = lambda p: F.abs(p["rt"] - centre) <= half

    def judge(t: Column) -> Column:
        flank = F.transform(F.filter(t, lambda p: ~core(p)), lambda p: p["signal"])
        inside = F.filter(F.transform(t, lambda p, i: F.struct(p["signal"].alias("s"), (-i).alias("i"), p["rt"].alias("rt"))),
                          lambda p: F.abs(p["rt"] - centre) <= half)
        return bind(F.struct(flank.alias("flank"), F.array_max(inside).alias("apex"), array_median(flank).alias("base")),
                    lambda s: with_sigma(t, s))

    def with_sigma(t: Column, s: Column) -> Column:
        mad = array_median(F.transform(s["flank"], lambda x: F.abs(x - s["base"]))) * F.lit(1.4826)
        sigma = F.when(mad > 0, mad).otherwise(F.greatest(s["base"], F.lit(1.0)) * 0.1)
        return bind(F.struct(s["apex"].alias("apex"), s["base"].alias("base"), sigma.alias("sigma"), F.size(s["flank"]).alias("n")),
                    lambda q: verdict(t, q))

    def verdict(t: Column, q: Column) -> Column:
        at, limit = -q["apex"]["i"], q["base"] + q["sigma"]
        low = F.transform(t, lambda p, i: F.when(~(p["signal"] > limit) & (i != at), i))
        left = F.coalesce(F.array_max(F.filter(low, lambda i: i < at)), F.lit(-1))
        right = F.coalesce(F.array_min(F.filter(low, lambda i: i > at)), F.size(t))
        height = q["apex"]["s"] - q["base"]
        ok = (q["n"] >= 3) & q["apex"].isNotNull() & (q["apex"]["s"] > 0) & (height > 0) & (right - left - 1 >= min_scans)
        return F.when(ok, F.struct(q["apex"]["rt"].alias("apex_rt"), (height / q["sigma"]).alias("sn")))

    return bind(trace, judge)


def area_calibration(groups: DataFrame, areas: DataFrame, ms1: DataFrame, half: float, ppm: float = 10.0, rt_window: float = 0.2,
                     min_features: int = 50, max_spread: float = 0.5) -> DataFrame:
    """Per injection: median of measured area over re-integrated signal, and whether it is usable.

    Refused below ``min_features`` usable cells or when IQR / median exceeds ``max_spread``.  All
    detected cells are used.
    """
    known = areas.filter("area > 0").join(groups.select(*GROUP, "mz", "rt"), GROUP)
    t = known.select(*INJ, F.col("group_id").alias("target_id"), F.col("mz").alias("t_mz"), (F.col("rt") - rt_window).alias("t_lo"),
                     (F.col("rt") + rt_window).alias("t_hi"), F.col("rt").alias("centre"), "area")
    tr = traces(xic(ms1, t, ppm)).join(t.select(*TARGET, "centre", "area"), TARGET)
    ratio = tr.withColumn("raw", integrate(F.col("trace"), F.col("centre"), F.lit(half))).filter("raw > 0").withColumn("ratio", F.col("area") / F.col("raw"))
    per = ratio.groupBy(*INJ).agg(F.count(F.lit(1)).alias("n"), F.median("ratio").alias("ratio"), F.sort_array(F.collect_list("ratio")).alias("r"))
    at = lambda q: F.get("r", F.floor(F.lit(q) * (F.col("n") - 1)).cast("int"))
    per = per.withColumn("spread", (at(0.75) - at(0.25)) / F.col("ratio"))
    ok = (F.col("n") >= min_features) & (F.col("ratio") > 0) & (F.col("spread") <= max_spread)
    return per.select(*INJ, "n", "ratio", "spread", ok.alias("usable"))


def fill_gaps(groups: DataFrame, areas: DataFrame, injections: DataFrame, ms1: DataFrame, run_fwhm: float, ppm: float = 10.0,
              sn: float = 1.5, rt_window: float = 0.2, min_features: int = 50, max_spread: float = 0.5) -> DataFrame:
    """Filled cells: group, injection, area, ``kind`` (``peak`` or ``area``).

    Every undetected cell of a kept group outside the blanks is re-integrated where its injection's
    calibration holds: a passing peak at its apex, weaker signal at the group's own time, nothing
    where no peak stands.
    """
    half = max(run_fwhm, 0.02)
    cal = area_calibration(groups, areas, ms1, half, ppm, rt_window, min_features, max_spread).filter("usable").select(*INJ, "ratio")
    live = injections.filter("role <> 'blank'").select(*INJ).join(cal, INJ, "left_semi")
    gaps = dense_cells(groups.select(*GROUP, "mz", "rt"), areas, live).filter("area <= 0")
    t = gaps.select(*INJ, F.col("group_id").alias("target_id"), F.col("mz").alias("t_mz"), (F.col("rt") - 3 * rt_window).alias("t_lo"),
                    (F.col("rt") + 3 * rt_window).alias("t_hi"), F.col("rt").alias("centre"))
    tr = traces(xic(ms1, t, ppm)).join(t.select(*TARGET, "centre"), TARGET).join(cal, INJ)
    found = tr.withColumn("p", peak_test(F.col("trace"), F.col("centre"), F.lit(rt_window))).filter("p IS NOT NULL")
    real = F.col("p.sn") >= sn
    at = F.when(real, F.col("p.apex_rt")).otherwise(F.col("centre"))
    area = integrate(F.col("trace"), at, F.lit(half)) * F.col("ratio")
    return (found.withColumn("area", area).filter("area > 0")
            .select(*RUN, F.col("target_id").alias("group_id"), "injection", "area", F.when(real, "peak").otherwise("area").alias("kind")))


def absences_with_signal(groups: DataFrame, before: DataFrame, after: DataFrame, cells: DataFrame) -> DataFrame:
    """Per run: group x cell combinations with no detection before filling, and how many gained one."""
    def seen(df: DataFrame, name: str) -> DataFrame:
        return df.filter("area > 0").join(cells, INJ).groupBy(*GROUP, "cell").agg(F.count(F.lit(1)).alias(name))

    total = groups.groupBy(*RUN).agg(F.count(F.lit(1)).alias("g")).join(cells.groupBy(*RUN).agg(F.count_distinct("cell").alias("c")), RUN)
    live = groups.select(*GROUP)
    b = seen(before.join(live, GROUP, "left_semi"), "nb")
    gained = seen(after.join(live, GROUP, "left_semi"), "na").join(b, [*GROUP, "cell"], "left_anti")
    return (total.join(b.groupBy(*RUN).agg(F.count(F.lit(1)).alias("nb")), RUN, "left")
            .join(gained.groupBy(*RUN).agg(F.count(F.lit(1)).alias("with_signal")), RUN, "left").na.fill(0)
            .select(*RUN, (F.col("g") * F.col("c") - F.col("nb")).alias("tested"), "with_signal"))


def gapfill_null(positions: DataFrame, ms1: DataFrame, ppm: float = 10.0, rt_window: float = 0.2, mass_shift: float = 0.3713,
                 time_shift: float = 3.0) -> DataFrame:
    """Peak-test S/N (0 when none) at each position, at a wrong mass and at a wrong time.

    ``positions``: injection keys, target_id, t_mz, centre.
    """
    kinds = F.explode(F.array(
        F.struct(F.lit("real").alias("kind"), F.lit(0.0).alias("dm"), F.lit(0.0).alias("dt")),
        F.struct(F.lit("wrong mass").alias("kind"), F.lit(mass_shift).alias("dm"), F.lit(0.0).alias("dt")),
        F.struct(F.lit("wrong time").alias("kind"), F.lit(0.0).alias("dm"), F.lit(time_shift).alias("dt"))))
    p = positions.withColumn("k", kinds).select(*INJ, F.concat_ws("#", F.col("target_id").cast("string"), "k.kind").alias("target_id"), F.col("target_id").alias("origin"),
                                                "k.kind", (F.col("t_mz") + F.col("k.dm")).alias("t_mz"), (F.col("centre") + F.col("k.dt")).alias("centre"))
    p = p.withColumn("t_lo", F.col("centre") - 3 * rt_window).withColumn("t_hi", F.col("centre") + 3 * rt_window)
    tr = traces(xic(ms1, p, ppm))
    out = p.join(tr, TARGET, "left").withColumn("t", F.when(F.col("trace").isNotNull(), peak_test(F.col("trace"), F.col("centre"), F.lit(rt_window))))
    return out.select(*INJ, F.col("origin").alias("target_id"), "kind", F.coalesce("t.sn", F.lit(0.0)).alias("sn"))


def signal_to_noise(features: DataFrame, ms1: DataFrame, floor: float = 1.0, tol_ppm: float = 12.5, near: float = 2.0, far: float = 5.0,
                    min_scans: int = 8) -> DataFrame:
    """``features`` (injection keys, target_id, mz, rt, fwhm in minutes) with ``snr``: height inside half a
    width over a robust sigma of the *leading* baseline, 2 to 5 widths ahead; null below 8 scans."""
    t = features.select(*TARGET, F.col("mz").alias("t_mz"), (F.col("rt") - far * F.col("fwhm")).alias("t_lo"),
                        (F.col("rt") + 0.5 * F.col("fwhm") + 1e-9).alias("t_hi"))
    tr = features.join(traces(xic(ms1, t, tol_ppm, how="max")), TARGET, "left")
    lead = F.transform(F.filter("trace", lambda p: (p["rt"] > F.col("rt") - far * F.col("fwhm")) & (p["rt"] < F.col("rt") - near * F.col("fwhm"))),
                       lambda p: p["signal"])
    top = F.array_max(F.transform(F.filter("trace", lambda p: F.abs(p["rt"] - F.col("rt")) <= 0.5 * F.col("fwhm")), lambda p: p["signal"]))
    sigma = bind(lead, lambda v: F.when(F.size(v) >= min_scans, array_median(F.transform(v, lambda x: F.abs(x - array_median(v)))) * 1.4826))
    out = tr.withColumn("__h", top).withColumn("__s", sigma)
    return out.withColumn("snr", F.when((F.col("__h") > 0) & F.col("__s").isNotNull(), F.col("__h") / F.greatest("__s", F.lit(floor)))).drop("trace", "__h", "__s")


# ---- features, alignment, linking -------------------------------------------------------------

def build_traces(ms1: DataFrame, noise: float = 5000.0, ppm: float = 10.0, gap: float = 0.05) -> DataFrame:
    """Elution traces: peaks above noise chained in mass (gap in ppm), then in time (gap in minutes).

    One row per trace: apex mass and time, width at half height, area, length, scans.
    """
    peaks = ms1_peaks(ms1, noise)
    lab = islands(islands(peaks, "mz", ppm, "ppm", INJ, "mz_island"), "rt", gap, "da", [*INJ, "mz_island"], "rt_island")
    key = [*INJ, "mz_island", "rt_island"]
    top = F.max("intensity").over(Window.partitionBy(*key))  # a trace is one ion of one injection
    rows = lab.withColumn("__top", top)
    tall = F.col("intensity") >= F.col("__top") / 2
    return rows.groupBy(*key).agg(
        F.max_by("mz", "intensity").alias("mz"), F.max_by("rt", "intensity").alias("rt"), F.max("intensity").alias("height"),
        F.sum("intensity").alias("area"), (F.max(F.when(tall, F.col("rt"))) - F.min(F.when(tall, F.col("rt")))).alias("fwhm"),
        (F.max("rt") - F.min("rt")).alias("length"), F.count_distinct("scan_no").alias("n_scans"))


def build_features(ms1: DataFrame, noise: float = 5000.0, ppm: float = 10.0, gap: float = 0.05, min_length: float = 0.05,
                   fwhm_range: tuple[float, float] = (1 / 60, 20 / 60), need_isotope: bool = True) -> DataFrame:
    """Features of each injection: traces long enough, of plausible width and, unless switched off,
    with a heavier isotope trace (charge 1 or 2) co-eluting within one width."""
    tr = build_traces(ms1, noise, ppm, gap).filter((F.col("length") >= min_length) & F.col("fwhm").between(*fwhm_range))
    if not need_isotope:
        return tr.withColumn("charge", F.lit(1))
    base = tr.withColumn("charge", F.explode(F.array(F.lit(1), F.lit(2)))).withColumn("iso_mz", F.col("mz") + F.lit(1.0033548) / F.col("charge"))
    partner = tr.select(*INJ, F.col("mz").alias("p_mz"), F.col("rt").alias("p_rt"), F.col("fwhm").alias("p_reach"))
    hits = band_join(base, partner, [Band("iso_mz", "p_mz", ppm, "ppm"), Band("rt", "p_rt", "p_reach", width=0.1)], keys=INJ, how="left_semi")
    one = hits.groupBy(*INJ, "mz_island", "rt_island").agg(F.min("charge").alias("charge"))
    return tr.join(one, [*INJ, "mz_island", "rt_island"])


def align_rt(features: DataFrame, ppm: float = 10.0, window: float = 0.5, least: int = 3) -> DataFrame:
    """Features with ``rt_aligned`` (measured time kept as ``rt_measured``) and ``aligned``.

    The injection with most features is the reference; each other one gets a least-squares line
    through the pairs nearest in time within ``ppm`` and ``window`` minutes.  Fewer than ``least``
    pairs leave an injection unshifted and marked.
    """
    count = features.groupBy(*INJ).agg(F.count(F.lit(1)).alias("n"))
    ref = count.groupBy(*RUN).agg(F.max_by("injection", F.struct("n", "injection")).alias("ref"))
    base = features.join(ref, RUN)
    anchor = base.filter("injection = ref").select(*RUN, F.col("mz").alias("r_mz"), F.col("rt").alias("r_rt"))
    rest = base.filter("injection <> ref").select(*INJ, "feature_id", "mz", "rt")
    pairs = band_join(rest, anchor, [Band("mz", "r_mz", ppm, "ppm"), Band("rt", "r_rt", window)], keys=RUN)
    near = pairs.groupBy(*INJ, "feature_id", "rt").agg(F.min_by("r_rt", F.abs(F.col("rt") - F.col("r_rt"))).alias("r_rt"))
    line = near.groupBy(*INJ).agg(F.count(F.lit(1)).alias("n_pairs"), F.regr_slope("r_rt", "rt").alias("slope"),
                                  F.regr_intercept("r_rt", "rt").alias("intercept"))
    out = base.join(line, INJ, "left")
    good = (F.coalesce("n_pairs", F.lit(0)) >= least) & F.col("slope").isNotNull()
    shifted = F.when(good, F.col("intercept") + F.col("slope") * F.col("rt")).otherwise(F.col("rt"))
    return (out.withColumn("rt_measured", F.col("rt")).withColumn("rt_aligned", shifted)
            .withColumn("aligned", good | (F.col("injection") == F.col("ref"))).drop("ref", "n_pairs", "slope", "intercept", "rt"))


def link_features(features: DataFrame, ppm: float = 10.0, window: float = 0.25) -> DataFrame:
    """Features with a run-wide ``link``: the injection and feature_id of the group's centre.

    A centre is an open feature larger than every other open one of its mass and time cell and of the cells around it;
    cells are as wide as the radius, so no larger feature lies within ``ppm`` and ``window``. Each open feature within
    the radius of centres goes to the nearest, and a centre keeps the nearest feature of each injection. What is left
    opens the next round. No member is further from its centre than the radius, however dense the run is. The number
    of rounds follows the number of features that one injection has within a radius. Ties go to the larger area, then
    the smaller feature_id.
    """
    reach = -math.log1p(-ppm * 1e-6)
    cell = ["__x", "__y"]
    spot = [(F.floor(F.log("mz") / F.lit(reach))).alias("__x"), F.floor(F.col("rt_aligned") / F.lit(window)).alias("__y")]
    rank = F.struct((-F.col("area")).alias("n"), "feature_id", "injection", "mz", F.col("rt_aligned").alias("rt"))
    free = cut_lineage(features.select(*RUN, *spot, "injection", "feature_id", "mz", "rt_aligned", rank.alias("__rank")))
    around = F.explode(F.expr("flatten(transform(sequence(-1, 1), x -> transform(sequence(-1, 1), y -> struct(__x + x AS x, __y + y AS y))))"))
    done = None
    while not free.isEmpty():
        top = free.groupBy(*RUN, *cell).agg(F.min("__rank").alias("c"))
        spread = top.select(*RUN, "c", F.col("__x").alias("__cx"), F.col("__y").alias("__cy"), around.alias("o")).select(*RUN, "c", "__cx", "__cy", F.col("o.x").alias("__x"), F.col("o.y").alias("__y"))
        best = spread.groupBy(*RUN, *cell).agg(F.min("c").alias("best"))
        centres = top.join(best, [*RUN, *cell]).filter("c = best").select(*RUN, *cell, "c")
        near = free.join(centres.select(*RUN, "c", around.alias("o")).select(*RUN, "c", F.col("o.x").alias("__x"), F.col("o.y").alias("__y")), [*RUN, *cell])
        off_mz, off_rt = F.abs(F.col("mz") - F.col("c.mz")) / F.col("c.mz") * 1e6 / ppm, F.abs(F.col("rt_aligned") - F.col("c.rt")) / window
        near = near.filter((off_mz <= 1) & (off_rt <= 1)).withColumn("d", off_mz * off_mz + off_rt * off_rt)
        mine = near.groupBy(*INJ, "feature_id").agg(F.min(F.struct("d", "c", "__rank")).alias("m")).select(*INJ, "feature_id", "m.*")
        kept = mine.groupBy(*INJ, "c").agg(F.min(F.struct("d", "__rank")).alias("k")).select(*INJ, F.col("k.__rank.feature_id").alias("feature_id"), F.concat_ws("/", "c.injection", F.col("c.feature_id").cast("string")).alias("link"))
        kept = cut_lineage(kept)
        done = kept if done is None else done.union(kept)
        free = cut_lineage(free.join(kept, [*INJ, "feature_id"], "left_anti"))
    if done is None:
        return features.withColumn("link", F.lit(None).cast("string"))
    return features.join(done, [*INJ, "feature_id"])


def recover_features(traces_: DataFrame, features: DataFrame, hits: DataFrame, ppm: float = 20.0, window: float = 0.25) -> DataFrame:
    """Traces that match a confidently identified spectrum and that no feature of the injection covers."""
    targets = hits.filter("dot > 500 AND reverse_dot > 700").select(*INJ, F.col("precursor_mz").alias("h_mz"), F.col("rt").alias("h_rt"))
    wanted = band_join(traces_, targets, [Band("mz", "h_mz", ppm, "ppm", strict=True, base="left"), Band("rt", "h_rt", window, strict=True)], keys=INJ, how="left_semi")
    have = features.select(*INJ, F.col("mz").alias("f_mz"), F.col("rt").alias("f_rt"))
    return band_join(wanted, have, [Band("mz", "f_mz", ppm, "ppm", strict=True, base="left"), Band("rt", "f_rt", window, strict=True)], keys=INJ, how="left_anti")


def detection_recall(hits: DataFrame, features: DataFrame, ppm: float = 20.0, window: float = 0.25) -> DataFrame:
    """Per injection: distinct confident targets (mass and time islands) and those with a feature."""
    conf = hits.filter("dot > 500 AND reverse_dot > 700").select(*INJ, F.col("precursor_mz").alias("mz"), "rt")
    lab = islands(islands(conf, "mz", ppm, "ppm", INJ, "a"), "rt", window, "da", [*INJ, "a"], "b")
    one = lab.groupBy(*INJ, "a", "b").agg(F.min(F.struct("mz", "rt")).alias("t")).select(*INJ, "t.mz", "t.rt")
    have = features.select(*INJ, F.col("mz").alias("f_mz"), F.col("rt").alias("f_rt"))
    hit = band_join(one, have, [Band("mz", "f_mz", ppm, "ppm", strict=True, base="left"), Band("rt", "f_rt", window, strict=True)], keys=INJ, how="left_semi")
    return (one.groupBy(*INJ).agg(F.count(F.lit(1)).alias("targets")).join(hit.groupBy(*INJ).agg(F.count(F.lit(1)).alias("found")), INJ, "left")
            .na.fill(0, ["found"]))


def injection_polarity(scans: DataFrame) -> DataFrame:
    """Polarity of each injection from the first scan that states one; ``+`` when none does."""
    return scans.groupBy("study_id", "injection").agg(F.coalesce(F.min_by("stated", F.when(F.col("stated").isNotNull(), F.col("scan_no"))), F.lit("+")).alias("polarity"))


def merge_frames(spectra: DataFrame, ppm: float = 60.0) -> DataFrame:
    """Peaks of repeat frames summed: a block holds the peaks within ``ppm`` of its *first* mass, at the
    intensity-weighted centroid.  The block start, not the previous peak, is the anchor."""
    start = F.struct(F.array().cast("array<struct<first double, mw double, total double>>").alias("blocks"))
    new = lambda p: F.struct(p["mz"].alias("first"), (p["mz"] * p["intensity"]).alias("mw"), p["intensity"].alias("total"))

    def step(acc: Column, p: Column) -> Column:
        b = acc["blocks"]
        last = F.get(b, F.size(b) - 1)
        joins = (F.size(b) > 0) & ((p["mz"] - last["first"]) / last["first"] * 1e6 <= ppm)
        grown = F.struct(last["first"].alias("first"), (last["mw"] + p["mz"] * p["intensity"]).alias("mw"), (last["total"] + p["intensity"]).alias("total"))
        return F.struct(F.when(joins, F.concat(F.slice(b, 1, F.greatest(F.size(b) - 1, F.lit(0))), F.array(grown)))
                        .otherwise(F.concat(b, F.array(new(p)))).alias("blocks"))

    done = lambda acc: F.transform(acc["blocks"], lambda b: F.struct(
        F.when(b["total"] > 0, b["mw"] / b["total"]).otherwise(b["first"]).alias("mz"), b["total"].alias("intensity")))
    return spectra.withColumn("peaks", F.aggregate(F.array_sort("peaks"), start, step, done))


def covered_by(rows: DataFrame, masses: DataFrame, column: str, ppm: float, flag: str, keys: list[str]) -> DataFrame:
    """Flag rows whose ``mz`` has a listed mass within ``ppm``."""
    return band_exists(rows, masses, Band("mz", column, ppm, "ppm", base="left"), flag, keys)

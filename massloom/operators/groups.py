"""From spectra and features to named groups: association, vote, purity, redundancy.

``features``: study_id, polarity, group_id, injection, mz, rt_aligned, rt_measured, fwhm, area.
``groups``: study_id, polarity, group_id, mz (quantified ion), rt, fwhm, max_area.
``hits``: one row per spectrum and rank, as ``search`` writes them.

Decisions are append-only verdict rows (``group_id, reason``); no table is mutated.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from massloom.functions import names as N
from massloom.functions.numeric import abs_ppm, half_up, ppm
from massloom.functions.peaks import peak_height_at, relative_height
from massloom.operators import kernels
from massloom.operators.band import Band, band_join, deal, spread
from massloom.operators.matrix import GROUP, INJ, RUN
from massloom.operators.qc import TRACKED, packed_cells, pair_corr
from massloom.operators.resolve import BLOCK, follow, settle_in_order
from massloom.session import next_round

ASSOCIATION_PPM, ISOBARIC_PPM, RT_MULTIPLIER, MAX_SHIFT = 20.0, 5.0, 2.0, 1.0
MIN_DOT, MIN_REVERSE, MIN_PURITY = 500.0, 700.0, 75.0
ISOTOPE_STEP, ISOTOPE_TOL = 1.003, 0.01
BUCKET = 0.1
#: Cells of the two joins of association: sixteen times the reach in mass, and minutes.  A side that is copied to the cells it reaches
#: then has a third more rows; cells as narrow as the reach copy it sevenfold.
WIDE_MASS, WIDE_RT = 16 * ASSOCIATION_PPM * 1e-6, 2.0
#: Shares of the injections that are associated one after another; only the disk that is taken at once depends on it.
PASSES = 3
#: Groups of one block whose areas are correlated.
CORRELATED = 2_048
# ---- fixed values: the ion a class is normally quantified on ----------------------------------
CANONICAL_ADDUCT = {"TG": "[M+NH4]+", "DG": "[M+NH4]+", "CE": "[M+NH4]+", "PC": "[M+H]+", "PE": "[M+H]+",
                    "PS": "[M+H]+", "PI": "[M+H]+", "SM": "[M+H]+", "Cer": "[M+H]+"}
DEFAULT_CANONICAL = ["[M+H]+", "[M-H]-"]
C13_STEP = 1.0033548


# ---- groups from features ---------------------------------------------------------------------

def build_groups(features: DataFrame, injections: DataFrame, min_files: int = 2) -> DataFrame:
    """Group rows of linked features seen in at least ``min_files`` non-blank injections."""
    roles = injections.select(*INJ, "role")
    agg = features.join(roles, INJ).groupBy(*GROUP).agg(
        F.max_by("mz", "area").alias("mz"), F.avg("rt_aligned").alias("rt"), F.avg("fwhm").alias("fwhm"),
        F.max("area").alias("max_area"), F.count(F.lit(1)).alias("n_features"),
        F.count_if(F.col("role") != "blank").alias("n_files"))
    return agg.filter(F.col("n_files") >= min_files)


def distinct_ions(features: DataFrame, keys: list[str] = GROUP, order: tuple[str, ...] = ("injection", "mz"), min_ppm: float = ASSOCIATION_PPM) -> DataFrame:
    """``keys, mz, ion_rank``: ions of a group at least ``min_ppm`` apart, taken in the ``order`` of its features.

    A feature opens an ion when none opened before it lies nearer, in ppm of that ion.  A round opens the first feature left
    of every group and drops what is near it, so there are as many rounds as the richest group has ions, and no group is
    brought together.  Null masses open none; ``order`` ends in the mass, so that equal features are one.
    """
    place = F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order)])
    left = next_round(features.filter("mz IS NOT NULL").groupBy(*keys, "mz").agg(F.min(place).alias("place")))
    ions = next_round(left.select(*keys, "mz", F.lit(0).alias("ion_rank")).limit(0))
    turn = 0
    while not left.isEmpty():
        turn += 1
        opened = left.groupBy(*keys).agg(F.min_by("mz", "place").alias("ion"))
        ions = next_round(ions.unionByName(opened.select(*keys, F.col("ion").alias("mz"), F.lit(turn).alias("ion_rank"))), ions)
        near = ions.filter(F.col("ion_rank") == turn).select(*keys, F.col("mz").alias("ion"))
        far = F.coalesce(abs_ppm(F.col("mz"), F.col("ion")) >= min_ppm, F.lit(False))
        left = next_round(left.join(near, keys).filter(far & (F.col("mz") != F.col("ion"))).select(*left.columns), left)
    return ions


def quant_ions(features: DataFrame, keys: list[str] = GROUP, sign: str = "polarity", order: tuple[str, ...] = ("injection", "mz"),
               min_ppm: float = ASSOCIATION_PPM) -> DataFrame:
    """Per group: ``quant_ion`` and ``quant_polarity`` of its largest feature (of equal areas the first), ``n_ions`` distinct ions,
    and whether it has a ``positive`` and a ``negative`` feature."""
    # the later of two places is smaller here: a maximum of (area, nearness to the start)
    first = F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order)])
    top = features.groupBy(*keys).agg(F.max("area").alias("__area"))
    best = (features.join(top, keys).filter(F.col("area") == F.col("__area")).groupBy(*keys)
            .agg(F.min_by(F.struct("mz", sign), first).alias("q")).select(*keys, F.col("q.mz").alias("quant_ion"), F.col(f"q.{sign}").alias("quant_polarity")))
    flags = features.groupBy(*keys).agg(F.bool_or(F.col(sign) == "+").alias("positive"), F.bool_or(F.col(sign) == "-").alias("negative"))
    ions = distinct_ions(features, keys, order, min_ppm).groupBy(*keys).agg(F.count(F.lit(1)).alias("n_ions"))
    return flags.join(best, keys, "left").join(ions, keys, "left").na.fill(0, ["n_ions"])


def run_fwhm(groups: DataFrame) -> DataFrame:
    return groups.groupBy(*RUN).agg(F.avg("fwhm").alias("run_fwhm"))


def isobaric_neighbours(features: DataFrame, groups: DataFrame) -> DataFrame:
    """Ordered pairs of features of one injection within 5 ppm and six mean peak widths."""
    f = features.select(*INJ, F.col("group_id").alias("id_a"), F.col("mz").alias("mz_a"), F.col("rt_aligned").alias("rt_a"))
    g = (features.join(F.broadcast(run_fwhm(groups)), RUN).select(*INJ, F.col("group_id").alias("id_b"), F.col("mz").alias("mz_b"),
                                                     F.col("rt_aligned").alias("rt_b"), (F.col("run_fwhm") * 6).alias("reach")))
    lighter = F.least("mz_a", "mz_b")
    pairs = band_join(f, g, [Band("mz_a", "mz_b", ISOBARIC_PPM * 1.00001, "ppm"), Band("rt_a", "rt_b", "reach", strict=True, width=1.0)],
                      keys=INJ, where="id_a <> id_b")
    return pairs.filter(F.abs(F.col("mz_a") - F.col("mz_b")) / lighter * 1e6 < ISOBARIC_PPM).select(*INJ, "id_a", "id_b")


# ---- association ------------------------------------------------------------------------------

def associate(hits: DataFrame, features: DataFrame, groups: DataFrame, passes: int = PASSES) -> DataFrame:
    """Hits attached to the feature they were fragmented from: hit columns plus ``group_id, weight``.

    ``hits`` carries ``corrected_rt`` (see ``rt_correction``; equal to rt when nothing was fitted).
    Score above 500 / reverse above 700; same injection and polarity; precursor strictly within
    20 ppm of the feature and of the group's ion; retention inside two feature widths; group inside
    the three-mean-width bucket window and at most one minute away; no taller isobaric neighbour at
    that time.  The earliest group wins.

    An injection's hits only meet its own features, so injections are taken in ``passes`` shares, all rows of one at once.
    """
    share = lambda rows, i: rows.filter(F.pmod(F.xxhash64(*INJ), F.lit(passes)) == i)
    return reduce(DataFrame.unionByName, [_associate(share(hits, i), share(features, i), groups) for i in range(passes)])


def _associate(hits: DataFrame, features: DataFrame, groups: DataFrame) -> DataFrame:
    keep = hits.filter((F.col("dot") > MIN_DOT) & (F.col("reverse_dot") > MIN_REVERSE)
                       & (N.name_polarity(F.col("name")) == F.col("polarity")))
    spectrum = [*INJ, "ms2_id", "rank"]
    widths = F.broadcast(run_fwhm(groups))  # one row per run
    f = (features.join(spread(groups.select(*GROUP, F.col("mz").alias("quant_mz"), F.col("rt").alias("group_rt"))), GROUP)
         .select(*INJ, "group_id", F.col("mz").alias("f_mz"), "quant_mz", "group_rt", F.col("rt_aligned").alias("f_rt"),
                 F.col("rt_measured").alias("f_measured"), F.col("fwhm").alias("f_fwhm"), F.col("area").alias("f_area"),
                 (F.col("fwhm") * RT_MULTIPLIER).alias("f_window")))
    # only masses and times of a hit go through the joins; its other columns meet the group that was found
    cand = band_join(keep.select(*spectrum, "precursor_mz", "rt", "corrected_rt"), f,
                     [Band("precursor_mz", "f_mz", ASSOCIATION_PPM, "ppm", strict=True, width=WIDE_MASS),
                      Band("rt", "f_measured", "f_window", width=WIDE_RT)], keys=INJ).join(widths, RUN)
    window = F.greatest(F.col("run_fwhm") * 3.0, F.lit(1e-6))
    bucket = lambda c: F.floor(c / BUCKET)
    cand = cand.filter(
        (abs_ppm(F.col("precursor_mz"), F.col("quant_mz")) < ASSOCIATION_PPM)
        & (F.abs(F.col("corrected_rt") - F.col("f_rt")) <= MAX_SHIFT)
        & bucket(F.col("group_rt")).between(bucket(F.col("corrected_rt") - window), bucket(F.col("corrected_rt") + window)))
    mine = peak_height_at(F.col("f_fwhm"), F.col("f_area"), F.col("f_rt"), F.col("corrected_rt"))
    weight = relative_height(F.col("f_fwhm"), F.col("f_rt"), F.col("corrected_rt"))
    cand = next_round(cand.select(*spectrum, "group_id", "group_rt", F.col("f_mz").alias("p_mz"), F.col("f_rt").alias("p_rt"), "corrected_rt",
                                  mine.alias("p_height"), weight.alias("weight")))
    probe = cand.select(*spectrum, "group_id", "p_mz", "p_rt", "corrected_rt", "p_height")
    rival = (features.join(widths, RUN).select(*INJ, F.col("group_id").alias("n_id"), F.col("mz").alias("n_mz"),
                                               F.col("rt_aligned").alias("n_rt"), F.col("fwhm").alias("n_fwhm"),
                                               F.col("area").alias("n_area"), (F.col("run_fwhm") * 6).alias("n_reach")))
    taller = band_join(probe, rival, [Band("p_mz", "n_mz", ISOBARIC_PPM, "ppm", strict=True, width=WIDE_MASS),
                                      Band("p_rt", "n_rt", "n_reach", strict=True, width=WIDE_RT)], keys=INJ, where="group_id <> n_id")
    height = peak_height_at(F.col("n_fwhm"), F.col("n_area"), F.col("n_rt"), F.col("corrected_rt"))
    taller = next_round(taller.filter(height > F.col("p_height")).select(*spectrum, "group_id").distinct())
    free = cand.join(spread(taller), [*spectrum, "group_id"], "left_anti")
    # one value, so that a null number or rank is a spectrum of its own
    one = F.struct("ms2_id", "rank").alias("__spectrum")
    best = next_round(free.groupBy(*INJ, one).agg(F.min_by(F.struct("group_id", "weight"), F.struct("group_rt", "group_id")).alias("b"))
                      .select(*INJ, "__spectrum", "b.*"), cand, taller)
    rest = [c for c in keep.columns if c not in spectrum]
    # of the written table's type, or the plan casts it and shuffles the hits again for what follows the join
    found = keep.withColumn("__spectrum", one.cast(best.schema["__spectrum"].dataType)).join(spread(best), [*INJ, "__spectrum"]).dropDuplicates([*INJ, "__spectrum"])
    return next_round(found.select(*spectrum, "group_id", "weight", *rest), best)


def links(associated: DataFrame) -> DataFrame:
    """Spectrum -> groups it ended up in."""
    return associated.select(*INJ, "ms2_id", "rank", "group_id").distinct()


def with_links(hits: DataFrame, associated: DataFrame) -> DataFrame:
    """Every spectral match with the (possibly several) group ids it supports, as text."""
    ids = links(associated).groupBy(*INJ, "ms2_id", "rank").agg(
        F.array_join(F.transform(F.array_sort(F.collect_set("group_id")), lambda g: g.cast("string")), "; ").alias("group_ids"))
    out = hits.join(ids, [*INJ, "ms2_id", "rank"], "left").withColumn("group_ids", F.coalesce("group_ids", F.lit("")))
    return out.withColumn("associated", F.when(F.col("group_ids") != "", "Associated").otherwise(""))


# ---- vote, candidates, purity -----------------------------------------------------------------

def name_columns(associated: DataFrame) -> DataFrame:
    """Adds ``lipid_name, sum_name, adduct, lipid_class`` parsed once per distinct name."""
    dim = (associated.select("name").distinct().withColumn("lipid_name", N.lipid_name(F.col("name")))
           .withColumn("sum_name", N.sum_composition(F.col("lipid_name"))).withColumn("adduct", N.adduct_of(F.col("name")))
           .withColumn("lipid_class", N.head(F.col("lipid_name"))))
    dim = next_round(dim)  # judged by its files, so that a short list of names does not move the hits
    return associated.join(dim, "name")


def vote_sum_name(named: DataFrame) -> DataFrame:
    """Majority sum composition per group; a tie goes to the one that arrived first."""
    counts = named.groupBy(*GROUP, "sum_name").agg(
        F.count(F.lit(1)).alias("votes"), F.min(F.struct("injection", "ms2_id", "rank")).alias("arrival"))
    return counts.groupBy(*GROUP).agg(F.min_by(F.struct("sum_name", "votes"), F.struct(-F.col("votes"), "arrival")).alias("w")).select(
        *GROUP, "w.sum_name", "w.votes")


def pool_candidates(named: DataFrame, vote: DataFrame) -> DataFrame:
    """Candidates of the winning sum composition: scores, count, purity and polarity of the best
    spectrum (preferred polarity, then height on the peak), and their rank."""
    rows = named.join(spread(vote.select(*GROUP, "sum_name")), [*GROUP, "sum_name"], "left_semi")
    best = F.struct(F.col("optimal_polarity").cast("int").alias("p"), F.col("weight").alias("w"))
    pooled = rows.groupBy(*GROUP, "sum_name", "lipid_name", "lipid_class").agg(
        F.max("dot").alias("max_dot"), F.max("reverse_dot").alias("max_reverse"), F.count(F.lit(1)).alias("spectra"),
        F.count_distinct("injection").alias("files"), F.max_by("purity", best).alias("purity"),
        F.max_by("optimal_polarity", best).alias("preferred"), F.min(F.struct("injection", "ms2_id", "rank")).alias("arrival"))
    order = Window.partitionBy(*GROUP).orderBy(F.desc("preferred"), F.desc("spectra"), "arrival")
    return pooled.withColumn("candidate_rank", F.row_number().over(order)).drop("arrival")


def weighted_purity(named: DataFrame, vote: DataFrame) -> DataFrame:
    """Per group: purity, its weight, the summed components (largest first) and the ether conflict.

    Only spectra in their optimal polarity; each share is weighted and rounded before it is added;
    the weight counts once per component entry.
    """
    rows = (named.join(spread(vote.select(*GROUP, "sum_name")), [*GROUP, "sum_name"], "left_semi").filter("optimal_polarity")
            .select(*GROUP, "weight", "injection", "ms2_id", "rank", F.posexplode("components").alias("at", "c")))
    per = rows.groupBy(*GROUP, F.col("c.name").alias("component")).agg(
        F.sum(half_up(F.col("c.share") * F.col("weight"))).alias("summed"), F.sum("weight").alias("w"),
        F.min(F.struct("injection", "ms2_id", "rank", "at")).alias("arrival"))
    entry = F.struct((-F.col("summed")).alias("o"), "arrival", "component", "summed")
    agg = per.groupBy(*GROUP).agg(F.array_sort(F.collect_list(entry)).alias("e"), F.sum("w").alias("purity_weight"),
                                  F.sum(F.when(F.col("component").contains("Plasmenyl"), F.col("summed")).otherwise(0)).alias("vinyl"),
                                  F.sum(F.when(F.col("component").contains("Plasmanyl"), F.col("summed")).otherwise(0)).alias("alkyl"))
    top = F.col("e")[0]
    conflict = ((top["summed"] <= MIN_PURITY) & (top["component"].contains("Plasmenyl") | top["component"].contains("Plasmanyl"))
                & (F.col("vinyl") > 0) & (F.col("vinyl") < MIN_PURITY) & (F.col("alkyl") > 0) & (F.col("alkyl") < MIN_PURITY))
    return agg.select(*GROUP, F.when(F.col("purity_weight") > 0, top["summed"] / F.col("purity_weight")).otherwise(0.0).alias("group_purity"),
                      "purity_weight", F.transform("e", lambda x: F.struct(x["component"].alias("component"), x["summed"].alias("summed"))).alias("summed"),
                      conflict.alias("ether_conflict"))


def reported_name(vote: DataFrame, candidates: DataFrame, purity: DataFrame) -> DataFrame:
    """Name and class at the resolution the evidence supports.

    Ether conflict or an unproven vinyl ether -> neutral ether form; purity of the group or of the
    top candidate under 75 -> sum composition; otherwise the top candidate's name.
    """
    top = candidates.filter("candidate_rank = 1").select(
        *GROUP, F.col("lipid_name").alias("top_name"), "lipid_class", F.col("purity").alias("top_purity"))
    rows = (vote.select(*GROUP, "sum_name", "votes").join(top, GROUP).join(purity, GROUP, "left")
            .withColumn("group_purity", F.coalesce("group_purity", F.lit(0.0)))
            .withColumn("ether_conflict", F.coalesce("ether_conflict", F.lit(False))))
    ether = F.col("ether_conflict") | ((F.col("group_purity") == 0) & F.col("sum_name").contains("Plasmenyl"))
    demote = (F.col("group_purity") < MIN_PURITY) | ((F.coalesce("top_purity", F.lit(0)) < MIN_PURITY) & (F.col("top_name") != F.col("sum_name")))
    name = F.when(ether, N.top_ether(F.col("sum_name"))).when(demote, F.col("sum_name")).otherwise(F.col("top_name"))
    return rows.withColumn("name", name).withColumn("lipid_class", F.when(ether, N.head(F.col("name"))).otherwise(F.col("lipid_class")))


def evidence_labels(reported: DataFrame) -> DataFrame:
    """``chain_evidence`` and ``purity_source`` of each reported name."""
    mine = N.chain_key(F.col("name"))
    has = F.col("summed").isNotNull() & (F.size("summed") > 0)
    named = F.exists("summed", lambda c: N.chain_key(c["component"]) == mine)
    chain = (F.when(~F.col("name").contains("_"), "").when(~has, "not eligible").when(named, "fragments").otherwise("library name"))
    top = N.bare_name(F.get("summed", F.lit(0))["component"])
    own = (top == F.col("name")) | (N.chain_key(top) == mine) | F.coalesce(N.sum_key(F.col("name")) == N.sum_key(top), F.lit(False))
    return reported.withColumn("chain_evidence", chain).withColumn(
        "purity_source", F.when(~has, "").when(own, "self").otherwise(top))


def support_scores_adduct(reported: DataFrame, named: DataFrame, groups: DataFrame) -> DataFrame:
    """Spectra, files, best scores, ordered adducts and theoretical m/z behind the name as reported.

    A sum-composition name is supported by every spectrum that voted for it, a molecular one only
    by its own.  Adducts are ordered by how near their precursor lies to the quantified ion; the
    mass error refers to the library mass nearest that ion.
    """
    scope = reported.select(*GROUP, "sum_name", "name", "top_name", "ether_conflict")
    rows = (named.select(*GROUP, "sum_name", "lipid_name", "injection", "dot", "reverse_dot", "purity", "adduct", "precursor_mz", "library_mz")
            .join(spread(scope), [*GROUP, "sum_name"]).join(spread(groups.select(*GROUP, F.col("mz").alias("quant_mz"))), GROUP))
    rows = rows.filter((F.col("name") == F.col("sum_name")) | F.col("ether_conflict") | (F.col("lipid_name") == F.col("top_name")))
    gap = F.abs(F.col("precursor_mz") - F.col("quant_mz"))
    ions = (rows.filter("adduct <> ''").groupBy(*GROUP, "adduct").agg(F.min(gap).alias("gap"), F.count(F.lit(1)).alias("n"))
            .groupBy(*GROUP).agg(F.array_join(F.transform(F.array_sort(F.collect_list(
                F.struct("gap", (-F.col("n")).alias("n"), "adduct"))), lambda a: a["adduct"]), "; ").alias("adducts")))
    agg = rows.groupBy(*GROUP).agg(
        F.count(F.lit(1)).alias("ms2_spectra"), F.count_distinct("injection").alias("ms2_files"), F.round(F.max("dot")).alias("dot"),
        F.round(F.max("reverse_dot")).alias("reverse_dot"), F.max("purity").alias("purity"), F.first("quant_mz").alias("quant_mz"),
        F.min_by("library_mz", F.abs(F.col("library_mz") - F.col("quant_mz"))).alias("theoretical_mz"))
    agg = agg.withColumn("mass_error_ppm", ppm(F.col("quant_mz"), F.col("theoretical_mz"))).drop("quant_mz")
    return agg.join(ions, GROUP, "left")


def spectral_components(reported: DataFrame) -> DataFrame:
    """Purity breakdown of groups with at least two merged components; shares sum to 100 per group."""
    rows = (reported.select(*GROUP, "name", F.explode("summed").alias("c"))
            .groupBy(*GROUP, "name", N.bare_name(F.col("c.component")).alias("component")).agg(F.sum("c.summed").alias("summed")))
    w = Window.partitionBy(*GROUP)
    rows = rows.withColumn("n", F.count(F.lit(1)).over(w)).withColumn("total", F.sum("summed").over(w)).filter("n >= 2 AND total > 0")
    same = N.parse_sum_name(F.col("name")) == N.parse_sum_name(F.col("component"))
    return rows.select(*GROUP, "name", "component", F.round(F.col("summed") / F.col("total") * 100, 2).alias("share"),
                       F.when(F.coalesce(same, F.lit(False)), "yes").otherwise("no").alias("isomer"),
                       F.row_number().over(w.orderBy(F.desc("summed"), "component")).alias("component_rank"))


# ---- names inside one table -------------------------------------------------------------------

def duplicate_names(groups: DataFrame) -> DataFrame:
    """``n of m`` in retention order for names carried by several rows."""
    w = Window.partitionBy(*RUN, "name")
    total = F.count(F.lit(1)).over(w)
    named = groups.filter(F.coalesce(F.trim("name"), F.lit("")) != "").withColumn("__m", total).filter("__m > 1")
    return named.select(*GROUP, F.concat(F.row_number().over(w.orderBy("rt", "group_id")).cast("string"), F.lit(" of "),
                                         F.col("__m").cast("string")).alias("duplicate"))


def _letters(position: Column) -> Column:
    """1 -> a, 26 -> z, 27 -> aa, ...; fourteen letters number every long."""
    def spell(state: Column, _: Column) -> Column:
        rest = state["left"] - 1
        return F.when(state["left"] > 0, F.struct(F.floor(rest / 26).alias("left"), F.concat(F.chr(F.lit(97) + rest % 26), state["text"]).alias("text"))).otherwise(state)

    start = F.struct(position.cast("long").alias("left"), F.lit("").alias("text"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(14)), start, spell, lambda state: state["text"])


def lipid_keys(groups: DataFrame) -> DataFrame:
    """Unique key per named row: repeated names take a letter, largest area first."""
    w = Window.partitionBy(*RUN, "name")
    named = groups.filter(F.coalesce(F.trim("name"), F.lit("")) != "").withColumn("__m", F.count(F.lit(1)).over(w))
    place = F.row_number().over(w.orderBy(F.desc("max_area"), "group_id"))
    return named.withColumn("__p", place).select(*GROUP, F.when(F.col("__m") == 1, F.col("name")).otherwise(
        F.concat("name", _letters(F.col("__p")))).alias("lipid_key"))


def duplicate_verdicts(groups: DataFrame) -> DataFrame:
    """``unreliable`` above 30 % pooled CV; ``class model?`` when every row of the name has a model
    score and even the smallest exceeds 3; else ``isomer?``.  Repeated names only."""
    w = Window.partitionBy(*RUN, "name")
    named = (groups.filter(F.coalesce(F.trim("name"), F.lit("")) != "").withColumn("__m", F.count(F.lit(1)).over(w))
             .withColumn("__s", F.count("rt_z").over(w)).withColumn("__z", F.min(F.abs("rt_z")).over(w)).filter("__m > 1"))
    loose = F.when(F.col("pooled_cv") > 30, F.lit("unreliable"))
    off = F.when((F.col("__s") == F.col("__m")) & (F.col("__z") > 3), F.lit("class model?"))
    text = F.concat_ws("; ", loose, off)
    return named.select(*GROUP, F.when(text == "", "isomer?").otherwise(text).alias("duplicate_verdict"))


def class_rt_filter(groups: DataFrame, multiplier: float = 2.0) -> DataFrame:
    """Rows outside class median +- ``multiplier`` * MAD / 0.6745.

    Classes with more than four identified rows (removed ones still count in the median) and a
    positive window; only kept rows are marked.  Keeps ``group_id, reason``.
    """
    named = groups.filter("lipid_class IS NOT NULL AND identified")
    mid = named.groupBy(*RUN, "lipid_class").agg(F.median("rt").alias("__m"), F.count(F.lit(1)).alias("__n")).filter("__n > 4")
    dev = named.join(mid, [*RUN, "lipid_class"]).withColumn("__d", F.abs(F.col("rt") - F.col("__m")))
    mad = dev.groupBy(*RUN, "lipid_class").agg(F.median("__d").alias("__mad"))
    rows = dev.join(mad, [*RUN, "lipid_class"]).withColumn("__w", F.lit(multiplier / 0.6745) * F.col("__mad"))
    return rows.filter((F.col("__w") > 0) & F.col("keep") & (F.col("__d") > F.col("__w"))).select(*GROUP, F.lit("RT out of class range").alias("reason"))


# ---- pair rules -------------------------------------------------------------------------------

def _sides(groups: DataFrame, columns: list[str]) -> tuple[DataFrame, DataFrame]:
    a = groups.select(*RUN, *[F.col(c).alias(f"a_{c}") for c in columns])
    widest = groups.groupBy(*RUN).agg((F.max("fwhm") / 2).alias("b_reach"))
    b = groups.join(F.broadcast(widest), RUN).select(*RUN, *[F.col(c).alias(f"b_{c}") for c in columns], "b_reach")
    return a, b


def _window(divisor: float) -> str:
    """Half width of the later of the two groups, strictly."""
    return ("abs(a_rt - b_rt) < CASE WHEN struct(a_rt, a_group_id) > struct(b_rt, b_group_id) THEN a_fwhm ELSE b_fwhm END "
            f"/ {divisor}")


BASIC = ["group_id", "mz", "rt", "fwhm"]
#: Cells of the pair rules: minutes, and sixteen times the reach in mass.  A side that is copied to the cells it reaches has up to
#: half as many rows more; cells as narrow as the reach copy it fourfold.
RULE_RT, RULE_MASS = 1.0, 16 * ASSOCIATION_PPM * 1e-6
#: What a rule leaves of a pair; retentions say which of the two is the later.
FOUND = [*RUN, "a_group_id", "b_group_id", "a_rt", "b_rt"]


def _rt_band() -> Band:
    return Band("a_rt", "b_rt", "b_reach", width=RULE_RT)


def _per_adduct(rows: DataFrame, adducts: DataFrame, prefix: str) -> DataFrame:
    """Each row once per adduct of the (ten-row) table: columns ``<prefix>rank, <prefix>shift``."""
    table = adducts.agg(F.collect_list(F.struct(F.col("adduct_rank").alias("rank"), F.col("adduct_mass").alias("shift"))).alias("t"))
    wide = rows.withColumn("__t", table.scalar()).withColumn("__a", F.explode("__t"))
    return wide.withColumn(f"{prefix}rank", F.col("__a.rank")).withColumn(f"{prefix}shift", F.col("__a.shift")).drop("__t", "__a")


def _named(found: DataFrame, a: str, b: str) -> DataFrame:
    return found.select(*RUN, F.col("a_group_id").alias(a), F.col("b_group_id").alias(b))


def _isotopes(groups: DataFrame, divisor: float = 2.0) -> DataFrame:
    a, b = _sides(groups, BASIC)
    a = a.withColumn("a_target", F.col("a_mz") + ISOTOPE_STEP)
    return band_join(a, b, [Band("a_target", "b_mz", ISOTOPE_TOL, strict=True, width=16 * ISOTOPE_TOL), _rt_band()], keys=RUN,
                     where=f"{_window(divisor)} AND a_group_id <> b_group_id").select(*FOUND)


def isotope_pairs(groups: DataFrame, divisor: float = 2.0) -> DataFrame:
    """``light, heavy`` within the sweep window whose masses differ by 1.003 +- 0.01 (strict)."""
    return _named(_isotopes(groups, divisor), "light", "heavy")


def _knowns(groups: DataFrame, adducts: DataFrame, divisor: float = 2.0) -> DataFrame:
    a, b = _sides(groups, [*BASIC, "adduct"])
    a = (a.join(adducts.select(F.col("adduct").alias("a_adduct"), "adduct_mass"), "a_adduct")
         .withColumn("a_neutral", F.col("a_mz") - F.col("adduct_mass")).drop("adduct_mass", "a_adduct"))
    b = b.drop("b_adduct")
    b = _per_adduct(b, adducts, "b_").withColumn("b_neutral", F.col("b_mz") - F.col("b_shift"))
    pairs = band_join(a, b, [Band("a_neutral", "b_neutral", ASSOCIATION_PPM, "ppm", strict=True, base="left", width=RULE_MASS), _rt_band()],
                      keys=RUN, where=f"{_window(divisor)} AND a_group_id <> b_group_id")
    return pairs.select(*FOUND).distinct()


def adduct_pairs_known(groups: DataFrame, adducts: DataFrame, divisor: float = 2.0) -> DataFrame:
    """``known, other``: the neutral mass of an identified group (its adduct is known) is that of the
    other under some adduct, strictly within 20 ppm.  ``groups`` carries ``adduct`` (null when
    unidentified)."""
    return _named(_knowns(groups, adducts, divisor), "known", "other")


def _unknowns(groups: DataFrame, adducts: DataFrame, divisor: float = 2.0) -> DataFrame:
    free = groups.filter("adduct IS NULL")
    a, b = _sides(free, BASIC)
    a, b = _per_adduct(a, adducts, "a_"), _per_adduct(b, adducts, "b_")
    a, b = a.withColumn("a_neutral", F.col("a_mz") - F.col("a_shift")), b.withColumn("b_neutral", F.col("b_mz") - F.col("b_shift"))
    pairs = band_join(a, b, [Band("a_neutral", "b_neutral", ASSOCIATION_PPM, "ppm", strict=True, base="left", width=RULE_MASS), _rt_band()], keys=RUN,
                      where=f"{_window(divisor)} AND a_rank <> b_rank AND struct(a_rt, a_group_id) > struct(b_rt, b_group_id)")
    return pairs.select(*FOUND).distinct()


def adduct_pairs_unknown(groups: DataFrame, adducts: DataFrame, divisor: float = 2.0) -> DataFrame:
    """Unordered pairs of unidentified groups that are one neutral under two different adducts."""
    return _named(_unknowns(groups, adducts, divisor), "later", "earlier")


def _sources(groups: DataFrame, divisor: float = 2.0) -> DataFrame:
    a, b = _sides(groups, [*BASIC, "fragments"])
    a, b = a.withColumn("a_fragment", F.explode("a_fragments")).drop("a_fragments"), b.drop("b_fragments")
    pairs = band_join(a, b,
                      [Band("a_fragment", "b_mz", ASSOCIATION_PPM, "ppm", strict=True, width=RULE_MASS), _rt_band()], keys=RUN,
                      where=f"{_window(divisor)} AND a_group_id <> b_group_id")
    return pairs.select(*FOUND).distinct()


def in_source_pairs(groups: DataFrame, divisor: float = 2.0) -> DataFrame:
    """``parent, fragment``: another group's ion is strictly within 20 ppm of one of this lipid's
    fragments.  ``groups`` carries ``fragments array<double>``."""
    return _named(_sources(groups, divisor), "parent", "fragment")


def _dimers(groups: DataFrame, adducts: DataFrame, divisor: float = 2.0) -> DataFrame:
    a, b = _sides(groups, BASIC)
    table = adducts.select("polarity", "adduct_rank", "adduct_mass")
    a = a.join(table, "polarity").withColumn("a_double", (F.col("a_mz") - F.col("adduct_mass")) * 2).drop("adduct_mass").withColumnRenamed("adduct_rank", "a_rank")
    b = b.join(table, "polarity").withColumn("b_neutral", F.col("b_mz") - F.col("adduct_mass")).drop("adduct_mass").withColumnRenamed("adduct_rank", "b_rank")
    # the two directions of the test measure ppm against either side; both are inside the wider bound
    pairs = band_join(a, b, [Band("a_double", "b_neutral", ASSOCIATION_PPM * 1.0001, "ppm", width=RULE_MASS), _rt_band()], keys=RUN,
                      where=f"{_window(divisor)} AND a_rank = b_rank AND a_group_id <> b_group_id")
    # relative to the neutral of the earlier-named argument: the later group comes first in the sweep
    gap = F.abs(F.col("a_double") - F.col("b_neutral"))
    base = F.when(F.expr("struct(a_rt, a_group_id) > struct(b_rt, b_group_id)"), F.col("b_neutral")).otherwise(F.col("a_double"))
    return pairs.filter(gap / F.abs(base) * 1e6 < ASSOCIATION_PPM).select(*FOUND).distinct()


def dimer_pairs(groups: DataFrame, adducts: DataFrame, divisor: float = 2.0) -> DataFrame:
    """``monomer, dimer``: twice one neutral is the other under the same adduct of the run's polarity."""
    return _named(_dimers(groups, adducts, divisor), "monomer", "dimer")


def _redundants(groups: DataFrame, divisor: float = 2.0) -> DataFrame:
    named = groups.filter("sum_name IS NOT NULL")
    a, b = _sides(named, [*BASIC, "sum_name"])
    a, b = a.withColumnRenamed("a_sum_name", "sum_name"), b.withColumnRenamed("b_sum_name", "sum_name")
    return band_join(a, b, [_rt_band()], keys=[*RUN, "sum_name"],
                     where=f"{_window(divisor)} AND struct(a_rt, a_group_id) > struct(b_rt, b_group_id)").select(*FOUND)


def redundant_pairs(groups: DataFrame, divisor: float = 2.0) -> DataFrame:
    """Unordered pairs carrying the same sum composition inside the sweep window."""
    return _named(_redundants(groups, divisor), "later", "earlier")


#: The rules of the sweep; a pair carries theirs as bits in this order, the last for an earlier group that explains the later one.
RULES = ["isotope", "known", "unknown", "source", "dimer", "redundant", "source back"]
ISOTOPE, KNOWN, UNKNOWN, SOURCE, DIMER, REDUNDANT, SOURCE_BACK = (1 << i for i in range(len(RULES)))
#: Minutes of a stretch of later groups whose pairs are correlated together, and groups it holds before its pairs are dealt to several tasks.
STRETCH, TOGETHER = 0.25, 65_536


def _in_order(found: DataFrame, rule: str) -> DataFrame:
    """``later, earlier`` with the retention of the later, ``rule`` and ``forward``: whether the explaining side is the later group."""
    forward = F.struct("a_rt", "a_group_id") > F.struct("b_rt", "b_group_id")
    either = lambda x, y: F.when(forward, F.col(x)).otherwise(F.col(y))
    return found.select(*RUN, either("a_group_id", "b_group_id").alias("later"), either("b_group_id", "a_group_id").alias("earlier"),
                        either("a_rt", "b_rt").alias("later_rt"), F.lit(RULES.index(rule)).cast("byte").alias("rule"), forward.alias("forward"))


def sweep_pairs(groups: DataFrame, adducts: DataFrame, areas: DataFrame, injections: DataFrame,
                min_points: int = 5, min_r: float = 0.5) -> DataFrame:
    """All rule-satisfying pairs of the redundancy sweep with ``tracks`` and both retentions: one row per pair and rule.

    Two groups track when r >= 0.5 over at least five shared detections, or when there are too few
    to judge.  The pairs of a stretch of retention meet the cells of its groups in a task: a pair is shuffled once, without cells,
    and a group with its cells is copied to the stretches it can be in a pair of.
    """
    found = [_in_order(_isotopes(groups), "isotope"), _in_order(_knowns(groups, adducts), "known"), _in_order(_unknowns(groups, adducts), "unknown"),
             _in_order(_sources(groups), "source"), _in_order(_dimers(groups, adducts), "dimer")]
    # one rule after another, so that the copies one makes are gone before the next; most pairs are of the last, which goes on as it is
    found = [*[next_round(p) for p in found], _in_order(_redundants(groups), "redundant")]
    pairs = reduce(DataFrame.unionByName, found).withColumn("__at", F.floor(F.col("later_rt") / STRETCH)).drop("later_rt")
    at = [*RUN, "__at"]
    # as the earlier group of a pair it may stand in later stretches
    widest = groups.groupBy(*RUN).agg((F.max("fwhm") / 2).alias("reach"))
    reach = F.explode(F.sequence(F.floor(F.col("rt") / STRETCH), F.floor((F.col("rt") + F.coalesce("reach", F.lit(0.0))) / STRETCH + 1e-6)))
    placed = groups.select(*GROUP, "rt").filter("rt IS NOT NULL").join(F.broadcast(widest), RUN)
    # one row a stretch
    tasks = F.broadcast(placed.withColumn("__at", reach).groupBy(*at).agg(F.ceil(F.count(F.lit(1)) / TOGETHER).cast("int").alias("__n")))
    pairs = pairs.join(tasks, at).withColumn("__part", F.pmod(F.xxhash64("later"), F.col("__n")).cast("int")).drop("__n")
    cells = placed.join(spread(packed_cells(areas, injections, TRACKED)), GROUP, "left").withColumn("__at", reach).drop("reach")
    cells = cells.join(tasks, at).withColumn("__part", F.explode(F.sequence(F.lit(0), F.col("__n") - 1))).drop("__n")
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in groups.select(*GROUP, "rt").schema.fields])
    kind = {f.name: f.dataType for f in schema.fields}
    schema = T.StructType([*schema.fields[:2], T.StructField("later", kind["group_id"]), T.StructField("earlier", kind["group_id"]), T.StructField("rule", T.ByteType()),
                           T.StructField("forward", T.BooleanType()), T.StructField("later_rt", kind["rt"]), T.StructField("earlier_rt", kind["rt"]), T.StructField("tracks", T.BooleanType())])
    run = kernels.tracked_pairs(min_r, min_points, to_arrow_schema(schema))
    at = [*at, "__part"]
    out = pairs.groupBy(*at).cogroup(cells.groupBy(*at)).applyInArrow(run, schema)
    return out.withColumn("rule", F.array(*[F.lit(r) for r in RULES])[F.col("rule").cast("int")])


VERDICT = {"reason": "string", "merged_into": "long"}


def _blank(rows: DataFrame, columns: dict[str, str]) -> DataFrame:
    return rows.withColumns({c: F.lit(None).cast(t) for c, t in columns.items()})


def _sweep_rules(pair: dict, later: dict, earlier: dict) -> None:
    """The rules of the sweep on one pair, in their order; each sees what the ones before it have dropped."""
    rules, tracks = pair["rules"], pair["tracks"]
    named = [g for g in (later, earlier) if g["identified"]]
    heavy, light = (later, earlier) if later["mz"] > earlier["mz"] else (earlier, later)
    weak, strong = (later, earlier) if later["max_area"] < earlier["max_area"] else (earlier, later)

    def both_kept() -> bool:
        return later["reason"] is None and earlier["reason"] is None

    if tracks and rules & ISOTOPE and heavy["reason"] is None and not heavy["identified"]:
        heavy["reason"] = "M+1 isotope"
    if tracks and rules & KNOWN and both_kept() and len(named) == 1:
        (earlier if named[0] is later else later)["reason"] = "Adduct of existing identified peak"
    if tracks and rules & UNKNOWN and both_kept() and not named:
        weak["reason"] = "Adduct of existing peak"
    if rules & SOURCE:  # the later group explains the earlier one
        earlier["reason"] = "In-source fragment"
    elif rules & SOURCE_BACK:
        later["reason"] = "In-source fragment"
    if tracks and rules & DIMER and not heavy["identified"]:
        heavy["reason"] = "Dimer"
    if rules & REDUNDANT and len(named) == 2:
        kept = [g for g in (later, earlier) if g["reason"] is None]
        # the one that is kept, else the larger; of equal areas the earlier
        winner = kept[0] if len(kept) == 1 else later if later["max_area"] > earlier["max_area"] else earlier
        loser = earlier if winner is later else later
        loser["reason"], loser["merged_into"] = "Redundant Identification", winner["group_id"]


def resolve_sweep(pairs: DataFrame, groups: DataFrame, block: int = BLOCK) -> DataFrame:
    """Verdicts of the sweep on the rows of ``sweep_pairs``: pairs in the order later group ascending, earlier group descending.

    The rules of a pair see earlier decisions, so pairs are settled in that order by ``settle_in_order``.  A group that no
    pair drops has no row; a null area counts as 0.
    """
    info = groups.select(*GROUP, "mz", "rt", F.coalesce("max_area", F.lit(0.0)).alias("max_area"), F.col("adduct").isNotNull().alias("identified"))
    rule = F.when((F.col("rule") == "source") & ~F.col("forward"), SOURCE_BACK)
    for at, name in enumerate(RULES):
        rule = rule.when(F.col("rule") == name, 1 << at)
    one = pairs.groupBy(*RUN, "later", "earlier").agg(F.bit_or(rule).alias("rules"), F.max("tracks").alias("tracks"),
                                                      F.min("later_rt").alias("later_rt"), F.min("earlier_rt").alias("earlier_rt"))
    order = [F.col("later_rt"), F.col("later"), F.col("earlier_rt").desc(), F.col("earlier").desc()]
    done = settle_in_order(one, order, ("later", "earlier"), _blank(info, VERDICT), _sweep_rules, block=block, reads=["rules", "tracks"])
    return done.filter("reason IS NOT NULL").select(*GROUP, *VERDICT)


def correlated_unidentified(groups: DataFrame, areas: DataFrame, injections: DataFrame, min_r: float = 0.95,
                            min_points: int = 5, divisor: float = 0.5) -> DataFrame:
    """Unidentified kept groups within two widths of an identified one they track at r >= 0.95.

    Nearly all pairs of a retention window are judged, so no pair is a row: groups with their cells are dealt to blocks by
    retention, and a block leaves the unidentified groups that track one.
    """
    live = groups.filter("keep")
    a = live.filter("identified").select(*RUN, F.col("group_id").alias("id_b"), F.col("rt").alias("b_rt"))
    u = live.filter("NOT identified").select(*RUN, F.col("group_id").alias("id_a"), F.col("rt").alias("a_rt"), (F.col("fwhm") / divisor).alias("a_reach"))
    packed = packed_cells(areas, injections, TRACKED)
    side = lambda rows, k: rows.join(spread(packed.withColumnRenamed("group_id", k)), [*RUN, k])
    width = 0.25
    u = side(u.filter("a_reach > 0 AND a_rt IS NOT NULL"), "id_a").withColumn("__bin", F.explode(F.sequence(
        F.floor((F.col("a_rt") - F.col("a_reach")) / width - 1e-6), F.floor((F.col("a_rt") + F.col("a_reach")) / width + 1e-6))))
    a = side(a.filter("b_rt IS NOT NULL"), "id_b").withColumn("__bin", F.floor(F.col("b_rt") / width))
    at = [*RUN, "__bin"]
    u, a = deal(u, a, at, ["id_a"], ["id_b"], CORRELATED)
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in u.select(*RUN, "id_a").schema.fields])
    run = kernels.tracked_rows(min_r, min_points, [*RUN, "id_a"], to_arrow_schema(schema))
    at = [*at, "__s", "__l"]
    found = u.groupBy(*at).cogroup(a.groupBy(*at)).applyInArrow(run, schema)
    return found.select(*RUN, F.col("id_a").alias("group_id")).distinct().withColumn("reason", F.lit("Correlated with identified peak"))


# ---- adduct pairs between identified rows -----------------------------------------------------

def adduct_pair_candidates(groups: DataFrame, adducts: DataFrame, max_ppm: float = 10.0, widths: float = 1.0) -> DataFrame:
    """Mass-consistent pairs of identified rows: ``first, second`` (retention order) with which side
    explains the other.  ``groups`` carries name, sum_name, adduct, lipid_class, dot."""
    named = groups.filter("name IS NOT NULL AND adduct IS NOT NULL")
    reach = run_fwhm(groups).withColumn("b_reach", F.col("run_fwhm") * widths).drop("run_fwhm")
    table = adducts.select("adduct", "adduct_rank", "adduct_mass", F.col("polarity").alias("adduct_polarity"))
    own = named.join(table.select("adduct", F.col("adduct_mass").alias("own_mass")), "adduct")
    a = own.select(*RUN, F.col("group_id").alias("parent"), F.col("rt").alias("a_rt"), F.col("mz").alias("a_mz"), F.col("adduct").alias("a_adduct"),
                   F.col("sum_name").alias("a_sum"), (F.col("mz") - F.col("own_mass")).alias("a_neutral"))
    b = (named.withColumnRenamed("adduct", "b_adduct").join(table, F.col("polarity") == F.col("adduct_polarity")).join(F.broadcast(reach), RUN)
         .select(*RUN, F.col("group_id").alias("ghost"), F.col("rt").alias("b_rt"), F.col("mz").alias("b_mz"), "b_adduct", F.col("sum_name").alias("b_sum"),
                 F.col("adduct").alias("as_adduct"), "adduct_rank", (F.col("mz") - F.col("adduct_mass")).alias("b_neutral"), "b_reach"))
    pairs = band_join(a, b, [Band("a_neutral", "b_neutral", max_ppm, "ppm", strict=True, base="left"), Band("a_rt", "b_rt", "b_reach", width=0.25)], keys=RUN,
                      where="parent <> ghost AND NOT (a_sum = b_sum AND a_adduct = b_adduct) "
                            f"AND abs(abs(a_mz - b_mz) - {C13_STEP}) >= 0.01")
    return pairs.groupBy(*RUN, "parent", "ghost").agg(
        F.min_by("as_adduct", "adduct_rank").alias("as_adduct"), F.first(F.col("a_sum") == F.col("b_sum")).alias("same_molecule"))


def remove_adduct_pairs(groups: DataFrame, adducts: DataFrame, areas: DataFrame, injections: DataFrame, max_ppm: float = 10.0,
                        widths: float = 1.0, min_r: float = 0.8, min_points: int = 8, block: int = BLOCK) -> DataFrame:
    """Verdicts for the weaker row of each confirmed pair.

    Direction comes from the mass evidence; when both directions hold the better-supported row wins
    (canonical adduct, then dot).  A pair whose accused row is the better supported is left alone,
    and so is one whose areas do not track (too few shared detections also rejects).
    """
    cand = adduct_pair_candidates(groups, adducts, max_ppm, widths)
    ids = cand.withColumn("id_a", F.least("parent", "ghost")).withColumn("id_b", F.greatest("parent", "ghost"))
    tracked = pair_corr(ids.select(*RUN, "id_a", "id_b").distinct(), areas, injections, min_points, method="spearman")
    good = ids.join(tracked.filter(F.col("r") >= min_r).select(*RUN, "id_a", "id_b"), [*RUN, "id_a", "id_b"])
    canonical = F.coalesce(F.create_map(*[F.lit(x) for kv in CANONICAL_ADDUCT.items() for x in kv])[F.col("lipid_class")] == F.col("adduct"),
                           F.col("adduct").isin(DEFAULT_CANONICAL))
    rank = groups.select(*GROUP, F.struct(canonical.alias("c"), F.coalesce("dot", F.lit(0)).alias("d")).alias("rank"), "rt", "name")
    side = lambda p: rank.select(*RUN, F.col("group_id").alias(p), F.col("rank").alias(f"{p}_rank"), F.col("rt").alias(f"{p}_rt"), F.col("name").alias(f"{p}_name"))
    rows = good.join(spread(side("parent")), [*RUN, "parent"]).join(spread(side("ghost")), [*RUN, "ghost"])
    # a better-supported ghost is never removed; a tie falls to the earlier row
    earlier_parent = F.struct("parent_rt", "parent") < F.struct("ghost_rt", "ghost")
    both = F.count(F.lit(1)).over(Window.partitionBy(*RUN, "id_a", "id_b")) > 1
    stands = (F.col("parent_rank") > F.col("ghost_rank")) | ((F.col("parent_rank") == F.col("ghost_rank")) & (~both | earlier_parent))
    accuse = rows.withColumn("stands", stands).filter("stands")
    reason = F.concat(F.lit("Adduct pair: "), F.when(F.col("same_molecule"), "the same molecule on its ").otherwise("the "), "as_adduct",
                      F.lit(" of "), "parent_name", F.lit(" at "), F.format_string("%.3f", "parent_rt"), F.lit(" min"))
    # in retention order of (first, second); an accusation against or by a removed row lapses
    ends = [F.struct(F.col(f"{k}_rt").alias("rt"), F.col(k).alias("group_id")) for k in ("parent", "ghost")]
    ordered_pairs = accuse.select(*RUN, "parent", "ghost", reason.alias("reason"), F.least(*ends).alias("low"), F.greatest(*ends).alias("high"))
    nodes = _blank(groups.select(*GROUP), VERDICT)
    done = settle_in_order(ordered_pairs, [F.col("low"), F.col("high")], ("parent", "ghost"), nodes, _accuse, block=block, reads=["reason"])
    return done.filter("reason IS NOT NULL").select(*GROUP, *VERDICT)


def _accuse(pair: dict, parent: dict, ghost: dict) -> None:
    if parent["reason"] is None and ghost["reason"] is None:
        ghost["reason"] = pair["reason"]


# ---- split peaks ------------------------------------------------------------------------------

def split_peak_candidates(groups: DataFrame, max_ppm: float = 10.0, widths: float = 2.0) -> DataFrame:
    """``first, second`` with the same name and adduct, within two mean widths and 10 ppm."""
    named = groups.filter("name IS NOT NULL AND keep")
    reach = run_fwhm(groups).withColumn("b_reach", F.col("run_fwhm") * widths).drop("run_fwhm")
    a = named.select(*RUN, "name", "adduct", F.col("group_id").alias("first"), F.col("rt").alias("a_rt"), F.col("mz").alias("a_mz"))
    b = named.join(F.broadcast(reach), RUN).select(*RUN, "name", "adduct", F.col("group_id").alias("second"), F.col("rt").alias("b_rt"), F.col("mz").alias("b_mz"), "b_reach")
    pairs = band_join(a, b, [Band("a_mz", "b_mz", max_ppm, "ppm"), Band("a_rt", "b_rt", "b_reach", width=0.25)],
                      keys=[*RUN, "name", "adduct"], where="struct(a_rt, first) < struct(b_rt, second)")
    return pairs.select(*RUN, "name", "first", "second")


def _cv(values: np.ndarray, least: int) -> float:
    if (values > 0).sum() < least or len(values) < 3 or values.mean() <= 0:
        return np.inf
    return 100.0 * values.std(ddof=1) / values.mean()


def _split_test(a: np.ndarray, b: np.ndarray, pool: np.ndarray, p: dict) -> str | None:
    """``precision``, ``systematic`` or None for two area vectors (larger row first)."""
    pa, pb = a[pool], b[pool]
    halves = (_cv(pa, p["min_pools"]), _cv(pb, p["min_pools"]))
    whole = _cv(pa + pb, p["min_pools"])
    if np.isfinite([*halves, whole]).all() and whole * p["improvement"] <= max(halves):
        return "precision"
    both = (a > 0) & (b > 0)
    if both.sum() < p["min_shared"]:
        return None
    ratio = a[both] / b[both]
    if 100.0 * ratio.std(ddof=1) / ratio.mean() > p["ratio_cv"]:
        return None
    x, y = a[both] - a[both].mean(), b[both] - b[both].mean()
    den = np.sqrt((x * x).sum() * (y * y).sum())
    return "systematic" if den > 0 and (x * y).sum() / den >= p["rho"] else None


def merge_split_peaks(groups: DataFrame, areas: DataFrame, injections: DataFrame, max_ppm: float = 10.0, widths: float = 2.0,
                      improvement: float = 1.5, min_pools: int = 3, rho: float = 0.8, ratio_cv: float = 25.0,
                      min_shared: int = 6, block: int = BLOCK) -> DataFrame:
    """Merges of one peak integrated as two rows: ``group_id`` (absorbed), ``merged_into``, the final
    ``survivor`` and ``kind``.

    Merged when summing improves the pooled CV of the worse half by ``improvement`` (all three CVs
    finite), else when the ratio is steady across injections and both track.  Absorbed rows take no
    further part and the survivor carries the summed areas on.  Runs with fewer than ``min_pools``
    pools are left alone.
    """
    inj = injections.filter("role IN ('sample', 'qc')")
    pools = inj.groupBy(*RUN).agg(F.count_if(F.col("role") == "qc").alias("n_pool")).filter(F.col("n_pool") >= min_pools)
    # pools come first, so a vector of areas holds them in front
    place = F.row_number().over(Window.partitionBy(*RUN).orderBy(F.col("role") == "sample", "injection")) - 1
    inj = inj.join(pools, RUN, "left_semi").withColumn("pos", place)
    cand = next_round(split_peak_candidates(groups, max_ppm, widths).join(F.broadcast(pools), RUN, "left_semi"))  # read for its groups and as pairs
    touched = cand.select(*RUN, F.col("first").alias("group_id")).union(cand.select(*RUN, F.col("second"))).distinct()
    # one row per injection, and per run; rows that grow with the data are never collected, however small their files
    cells = (areas.join(spread(touched), GROUP, "left_semi").join(F.broadcast(inj.select(*INJ, "pos")), INJ)
             .groupBy(*GROUP).agg(F.collect_list("pos").alias("pos"), F.collect_list(F.col("area").cast("double")).alias("area")))
    shape = inj.groupBy(*RUN).agg(F.count(F.lit(1)).alias("width")).join(pools, RUN)
    info = groups.select(*GROUP, "rt").join(spread(touched), GROUP, "left_semi").join(spread(cells), GROUP, "left").join(F.broadcast(shape), RUN)
    at = lambda k: groups.select(*RUN, F.col("group_id").alias(k), F.col("rt").alias(f"{k}_rt"))
    pairs = cand.join(spread(at("first")), [*RUN, "first"]).join(spread(at("second")), [*RUN, "second"])
    p = {"min_pools": min_pools, "improvement": improvement, "min_shared": min_shared, "ratio_cv": ratio_cv, "rho": rho}

    def absorb(pair: dict, first: dict, second: dict) -> None:
        if first["merged_into"] is not None or second["merged_into"] is not None:
            return
        one, other = _dense(first), _dense(second)
        win, lose = (second, first) if one.max() < other.max() else (first, second)
        larger, smaller = (other, one) if win is second else (one, other)
        kind = _split_test(larger, smaller, np.arange(win["n_pool"]), p)
        if kind:
            win["area"], win["pos"] = (larger + smaller).tolist(), list(range(win["width"]))
            lose.update(merged_into=win["group_id"], kind=kind, reason=f"Split peak, merged into {pair['name']} at {win['rt']:.3f} min")

    order = [F.col("first_rt"), F.col("first"), F.col("second_rt"), F.col("second")]
    nodes = _blank(info, {"merged_into": "long", "kind": "string", "reason": "string"})
    done = settle_in_order(pairs, order, ("first", "second"), nodes, absorb, block=block, reads=["name"])
    merges = done.filter("merged_into IS NOT NULL").select(*GROUP, "merged_into", "kind", "reason")
    ends = follow(merges, "group_id", "merged_into").withColumnRenamed("merged_into", "survivor")
    return merges.join(spread(ends), GROUP).select(*GROUP, "merged_into", "survivor", "kind", "reason")


def _dense(group: dict) -> np.ndarray:
    """Areas by position, 0 where a group was not detected."""
    out = np.zeros(group["width"])
    if group["pos"]:
        out[group["pos"]] = group["area"]
    return out


def absorb_areas(areas: DataFrame, merges: DataFrame) -> DataFrame:
    """Area table with absorbed rows added to their final survivor."""
    moved = areas.join(spread(merges.select(*GROUP, "survivor")), GROUP, "left").withColumn("group_id", F.coalesce("survivor", "group_id"))
    return moved.groupBy(*GROUP, "injection").agg(F.sum("area").alias("area"))

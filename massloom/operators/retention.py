"""Retention-time models per lipid class, alignment corrections and names drawn from retention."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from massloom.functions import names as N
from massloom.operators import kernels
from massloom.operators.band import Band, band_join
from massloom.operators.matrix import GROUP, INJ, RUN
from massloom.session import cut_lineage

CLASS = [*RUN, "lipid_class", "prefix"]
MIN_POINTS, MIN_R2, MAX_SD = 6, 0.7, 1.0
SERIES_MIN, SERIES_R2, SERIES_SD, SERIES_SIGMA, SERIES_FILES = 8, 0.85, 0.75, 3.0, 3


def class_points(groups: DataFrame) -> DataFrame:
    """Groups with a readable composition: ``lipid_class, prefix, carbons, double_bonds`` added.

    Molecular names are collapsed to their sum first; the class is the canonical one.
    """
    dim = (groups.select("name").filter("name IS NOT NULL").distinct()
           .withColumn("p", N.parse_sum_name(F.col("name"))).filter("p IS NOT NULL")
           .select("name", "p.lipid_class", "p.prefix", "p.carbons", "p.double_bonds"))
    drop = [c for c in ("lipid_class", "prefix", "carbons", "double_bonds") if c in groups.columns]
    return groups.drop(*drop).join(dim, "name")


def fit_rt_models(groups: DataFrame) -> DataFrame:
    """One plane RT ~ C + DB per run, class and chain prefix, robustly trimmed.

    Only the distinct (C, DB, RT) points of a class reach the fit; a class of a run has at most as
    many as the run has identified groups.
    """
    schema = ("study_id string, polarity string, lipid_class string, prefix string, intercept double, per_carbon double, "
              "per_db double, r2 double, residual_sd double, n_used long, n_total long")

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["carbons", "double_bonds", "rt", "group_id"])
        fit = kernels.fit_plane(pdf["carbons"].to_numpy(), pdf["double_bonds"].to_numpy(), pdf["rt"].to_numpy(), MIN_POINTS)
        head = pdf.iloc[0][["study_id", "polarity", "lipid_class", "prefix"]].to_dict()
        return pd.DataFrame([head | fit] if fit else [], columns=[c.split()[0] for c in schema.split(", ")])

    points = class_points(groups).select(*CLASS, "carbons", "double_bonds", "rt", "group_id")
    enough = points.groupBy(*CLASS).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= MIN_POINTS)
    models = points.join(enough, CLASS, "left_semi").groupBy(*CLASS).applyInPandas(run, schema)
    usable = ((F.col("n_used") >= MIN_POINTS) & (F.col("r2") >= MIN_R2) & (F.col("residual_sd") <= MAX_SD)
              & (F.col("per_carbon") > 0) & (F.col("per_db") < 0))
    return models.withColumn("usable", usable)


def predicted(models_prefix: str = "") -> F.Column:
    p = models_prefix
    return (F.col(f"{p}intercept") + F.col(f"{p}per_carbon") * F.col("carbons") + F.col(f"{p}per_db") * F.col("double_bonds"))


def rt_model_filter(groups: DataFrame, models: DataFrame, sigma: float = 3.0, floor: float = 1.0) -> DataFrame:
    """Identified groups with ``rt_error, rt_z, rt_r2`` and ``off_model`` (|error| > max(3 sd, 1 min)).

    A class without a usable model is left unjudged.
    """
    rows = class_points(groups).join(models.filter("usable"), CLASS)
    err = F.col("rt") - predicted()
    return (rows.withColumn("rt_error", err).withColumn("rt_z", F.when(F.col("residual_sd") > 0, err / F.col("residual_sd")))
            .withColumn("off_model", F.abs(err) > F.greatest(F.lit(sigma) * F.col("residual_sd"), F.lit(floor)))
            .select(*GROUP, "name", "lipid_class", "prefix", "rt_error", "rt_z", F.col("r2").alias("rt_r2"), "off_model"))


def reliable_groups(groups: DataFrame, injections: DataFrame) -> DataFrame:
    """Groups found in at least half the injections (two at least), or all when there are none."""
    n = injections.groupBy(*RUN).agg(F.count(F.lit(1)).alias("n"))
    marked = groups.join(n, RUN).withColumn("__r", F.col("n_features") >= F.greatest(F.lit(2), F.floor(F.col("n") / 2)))
    any_ = F.max("__r").over(Window.partitionBy(*RUN))
    return marked.withColumn("__any", any_).filter(F.col("__r") | ~F.col("__any")).drop("n", "__r", "__any")


def class_selectivity(groups: DataFrame, value: str = "rt", min_n: int = 8) -> DataFrame:
    """Untrimmed least squares of ``value`` on C and DB per class, from sums of products.

    Everything is one aggregate and a closed-form 3 x 3 solve, on centred sums.
    """
    rows = groups.filter("carbons IS NOT NULL").select(*RUN, "lipid_class", F.col("carbons").cast("double").alias("c"),
                                                       F.col("double_bonds").cast("double").alias("d"), F.col(value).alias("y"))
    key = [*RUN, "lipid_class"]
    g = rows.groupBy(*key).agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("c").alias("levels"), F.avg("c").alias("mc"), F.avg("d").alias("md"), F.avg("y").alias("my"),
        F.var_pop("c").alias("cc"), F.var_pop("d").alias("dd"), F.var_pop("y").alias("yy"), F.covar_pop("c", "d").alias("cd"),
        F.covar_pop("c", "y").alias("cy"), F.covar_pop("d", "y").alias("dy"), (F.max("y") - F.min("y")).alias("span"))
    det = F.col("cc") * F.col("dd") - F.col("cd") * F.col("cd")
    b1 = (F.col("cy") * F.col("dd") - F.col("dy") * F.col("cd")) / F.col("det")
    b2 = (F.col("dy") * F.col("cc") - F.col("cy") * F.col("cd")) / F.col("det")
    out = g.filter((F.col("n") >= min_n) & (F.col("levels") >= 3)).withColumn("det", det).filter("det > 1e-12")
    out = out.withColumn("per_carbon", b1).withColumn("per_db", b2)
    out = out.withColumn("intercept", F.col("my") - F.col("per_carbon") * F.col("mc") - F.col("per_db") * F.col("md"))
    out = out.withColumn("r2", F.when(F.col("yy") > 0, (F.col("per_carbon") * F.col("cy") + F.col("per_db") * F.col("dy")) / F.col("yy")))
    return out.select(*key, "n", "intercept", "per_carbon", "per_db", "r2", "span")


def extend_identifications(groups: DataFrame, models: DataFrame, candidates: DataFrame, max_ppm: float = 10.0, sigma: float = 2.0,
                           max_error: float = 0.5) -> DataFrame:
    """Names for unidentified kept groups from mass and modelled retention.

    ``candidates``: cand_name, cand_mz, polarity, cand_adduct.  The group's polarity, ``max_ppm`` of
    its own mass, |dRT| within min(0.5 min, 2 sd) of a usable model, and exactly one candidate.
    """
    parsed = (candidates.select("cand_name").distinct().withColumn("p", N.parse_sum_name(F.col("cand_name"))).filter("p IS NOT NULL")
              .select("cand_name", "p.lipid_class", "p.prefix", "p.carbons", "p.double_bonds"))
    expected = (candidates.join(parsed, "cand_name").join(models.filter("usable"), ["polarity", "lipid_class", "prefix"])
                .withColumn("cand_rt", predicted()).withColumn("cand_window", F.least(F.lit(max_error), F.lit(sigma) * F.col("residual_sd")))
                .select(*RUN, "cand_name", "cand_adduct", "cand_mz", "cand_rt", "cand_window"))
    free = groups.filter("keep AND name IS NULL").select(*GROUP, "mz", "rt")
    hits = band_join(free, expected, [Band("mz", "cand_mz", max_ppm, "ppm", base="left"), Band("rt", "cand_rt", "cand_window", width=0.5)], keys=RUN)
    one = hits.groupBy(*GROUP).agg(F.count(F.lit(1)).alias("n"), F.first("cand_name").alias("cand_name"), F.first("cand_adduct").alias("adduct"))
    return one.filter("n = 1").select(*GROUP, N.demote_vinyl_ether(F.col("cand_name")).alias("name"), "adduct", F.lit("RT model").alias("source"))


def fit_series(points: DataFrame, anchors: DataFrame | None = None, keys: list[str] = RUN) -> DataFrame:
    """One homologous series per key: RT ~ C + DB (+ C squared); anchors join and are never trimmed."""
    cols = [*keys, "carbons", "double_bonds", "rt"]
    rows = points.select(*cols).withColumn("anchor", F.lit(False))
    if anchors is not None:
        rows = rows.unionByName(anchors.select(*cols).withColumn("anchor", F.lit(True)))
    names = ["intercept", "per_carbon", "per_db", "per_c2", "r2", "residual_sd", "n_used", "c_low", "c_high"]
    schema = ", ".join([f"{k} string" for k in keys] + [f"{n} {'long' if n == 'n_used' else 'double'}" for n in names])

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["anchor", "carbons", "double_bonds", "rt"], ascending=[False, True, True, True])
        fit = kernels.fit_series(pdf["carbons"], pdf["double_bonds"], pdf["rt"], pdf["anchor"], min_points=SERIES_MIN)
        head = {k: pdf[k].iloc[0] for k in keys}
        return pd.DataFrame([head | fit] if fit else [], columns=[*keys, *names])

    models = rows.groupBy(*keys).applyInPandas(run, schema)
    slope = lambda c: F.col("per_carbon") + 2 * F.col("per_c2") * F.col(c)
    usable = ((F.col("n_used") >= SERIES_MIN) & (F.col("r2") >= SERIES_R2) & (F.col("residual_sd") <= SERIES_SD)
              & (slope("c_low") > 0) & (slope("c_high") > 0) & (F.col("per_db") < 0))
    return models.withColumn("usable", usable)


def annotate_fatty_acids(groups: DataFrame, grid: DataFrame, anchors: DataFrame | None = None, tol: float = 0.01) -> DataFrame:
    """Names for unidentified kept negative groups that form a fatty-acid series.

    Each group takes the first composition (by C, then DB) within ``tol``; the series is fitted on
    the most abundant group per composition seen in three files; members inside three sd are named;
    nothing is named when the series is not usable.
    """
    free = groups.filter("keep AND name IS NULL AND polarity = '-'").select(*GROUP, "mz", "rt", "max_area", "n_features")
    hits = band_join(free, grid, [Band("mz", "fa_mz", tol)])
    first = hits.groupBy(*GROUP, "mz", "rt", "max_area", "n_features").agg(F.min(F.struct("carbons", "double_bonds")).alias("k"))
    first = first.select(*GROUP, "rt", "max_area", "n_features", "k.carbons", "k.double_bonds")
    points = first.filter(F.col("n_features") >= SERIES_FILES).groupBy(*RUN, "carbons", "double_bonds").agg(
        F.max_by("rt", F.struct("max_area", -F.col("group_id"))).alias("rt"))
    model = fit_series(points, anchors).filter("usable")
    fitted = (F.col("intercept") + F.col("per_carbon") * F.col("carbons") + F.col("per_c2") * F.col("carbons") * F.col("carbons")
              + F.col("per_db") * F.col("double_bonds"))
    rows = first.join(model, RUN).withColumn("rt_error", F.col("rt") - fitted)
    return rows.filter(F.abs("rt_error") <= F.lit(SERIES_SIGMA) * F.col("residual_sd")).select(
        *GROUP, F.concat(F.lit("FA "), F.col("carbons").cast("string"), F.lit(":"), F.col("double_bonds").cast("string")).alias("name"),
        "rt_error", F.lit("RT model").alias("source"))


def rt_correction(features: DataFrame) -> DataFrame:
    """Smoothed deviation (measured minus aligned) at each aligned retention of an injection.

    Local regression is sequential in retention, so it runs per injection, whose features are
    bounded by one LC run; its time grows with their number and its logarithm.
    """
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["rt_aligned", "group_id"]).reset_index(drop=True)
        places = pdf["rt_aligned"].astype(float).tolist()
        for i in range(1, len(places)):
            if places[i] <= places[i - 1]:
                places[i] = places[i - 1] + 1e-5
        x = np.array(places)
        y = (pdf["rt_measured"] - pdf["rt_aligned"]).to_numpy(dtype=float)
        return pd.DataFrame({"study_id": pdf["study_id"], "polarity": pdf["polarity"], "injection": pdf["injection"],
                             "knot_rt": x, "shift": kernels.loess_fit(x, y)})

    known = features.filter("rt_measured IS NOT NULL AND rt_measured <> 0").select(*INJ, "group_id", "rt_aligned", "rt_measured")
    return known.groupBy(*INJ).applyInPandas(run, "study_id string, polarity string, injection string, knot_rt double, shift double")


def corrected_rt(rows: DataFrame, knots: DataFrame, rt: str = "rt") -> DataFrame:
    """``rows`` plus ``corrected_rt``: rt minus the shift at the next knot above it; 0 past the last.

    An as-of lookup by ordering rows and knots of an injection together and carrying the next knot
    backwards.
    """
    cols = rows.columns
    marked = rows.withColumn("__t", F.col(rt)).withColumn("__k", F.lit(1)).withColumn("__s", F.lit(None).cast("double"))
    pins = knots.select(*INJ, F.col("knot_rt").alias("__t"), F.lit(0).alias("__k"), F.col("shift").alias("__s"))
    both = marked.unionByName(pins, allowMissingColumns=True)
    # from the latest time down; of equal times the row comes before the knot, so only knots strictly above are behind it
    passed = Window.partitionBy(*INJ).orderBy(F.desc("__t"), F.desc("__k")).rowsBetween(Window.unboundedPreceding, -1)
    shift = F.last("__s", ignorenulls=True).over(passed)
    out = both.withColumn("__n", shift).filter("__k = 1")
    return out.withColumn("corrected_rt", F.when(F.col("__n").isNull(), 0.0).otherwise(F.col(rt) - F.col("__n"))).select(*cols, "corrected_rt")


def fill_measured_rt(features: DataFrame, knots: DataFrame) -> DataFrame:
    """Features without a measured retention get it from the alignment fit of their injection."""
    have = F.col("rt_measured").isNotNull() & (F.col("rt_measured") != 0)
    looked = corrected_rt(features, knots, "rt_aligned")
    guess = F.when(F.col("corrected_rt") == 0, F.col("rt_aligned")).otherwise(2 * F.col("rt_aligned") - F.col("corrected_rt"))
    return looked.withColumn("rt_measured", F.when(have, F.col("rt_measured")).otherwise(guess)).drop("corrected_rt")


def ladders(edges: DataFrame, low: str, high: str) -> DataFrame:
    """node, rungs: every ``low`` node and the nodes above it in order, along edges that give a node one ``high`` at most.

    Known stretches are joined end to start, so a stretch doubles each round.
    """
    steps = edges.select(*RUN, F.col(low).alias("node"), F.array(high).alias("rungs"), F.col(high).alias("tail"))
    while True:
        steps = cut_lineage(steps)
        onward = steps.select(*[F.col(c).alias(c) for c in RUN], F.col("node").alias("tail"), F.col("rungs").alias("more"), F.col("tail").alias("end"))
        longer = steps.join(onward, [*RUN, "tail"], "left")
        if longer.filter("end IS NOT NULL").isEmpty():
            return steps.drop("tail")
        steps = longer.select(*RUN, "node", F.concat("rungs", F.coalesce("more", F.array().cast("array<bigint>"))).alias("rungs"), F.coalesce("end", "tail").alias("tail"))


def unclaimed_series(groups: DataFrame, min_files: int = 10, min_members: int = 4, tol: float = 0.005,
                     step_range: tuple[float, float] = (0.05, 3.0)) -> DataFrame:
    """CH2 series among unidentified, unremoved groups whose retention rises at every step.

    Every group's next rung is the most abundant group one CH2 heavier that elutes later. A ladder with
    ``min_members`` groups and a mean retention step in ``step_range`` is a series; it is reported unless a series
    that starts at a more abundant group (the smaller id on a tie) passes through its start. A reported ladder may
    share its upper rungs with others. ``series`` is the start's id. Ladders are as long as the mass range over CH2
    at most, so every group's ladder is a short array and no run is walked in one task.
    """
    from massloom.operators.acquisition import next_rungs
    free = groups.filter((F.col("name").isNull()) & F.col("keep") & (F.col("n_features") >= min_files)).withColumn("area", F.col("max_area"))
    nxt = next_rungs(free, tol=tol)
    about = free.select(*RUN, "group_id", "mz", "rt", "area")
    whole = ladders(nxt, "low_id", "high_id").withColumn("member_ids", F.concat(F.array("node"), "rungs")).filter(F.size("member_ids") >= min_members)
    members = whole.select(*RUN, F.col("node").alias("series"), F.size("member_ids").alias("n"), F.posexplode("member_ids").alias("at", "group_id")).join(about, [*RUN, "group_id"])
    ends = members.groupBy(*RUN, "series", "n").agg(F.max_by("rt", "at").alias("last"), F.min_by("rt", "at").alias("first"), F.min_by("area", "at").alias("start_area"))
    fit = ends.withColumn("mean_step", (F.col("last") - F.col("first")) / (F.col("n") - 1)).filter(F.col("mean_step").between(*step_range)).drop("n", "last", "first")
    good = members.join(fit, [*RUN, "series"])
    before = good.filter("at > 0").groupBy(*RUN, "group_id").agg(F.max(F.struct("start_area", (-F.col("series")).alias("neg"))).alias("passing"))
    starts = fit.join(before.select(*RUN, F.col("group_id").alias("series"), "passing"), [*RUN, "series"], "left")
    own = F.struct("start_area", (-F.col("series")).alias("neg"))
    chosen = starts.filter(F.col("passing").isNull() | (own > F.col("passing"))).select(*RUN, "series")
    return good.join(chosen, [*RUN, "series"]).select(*RUN, "series", (F.col("at") + 1).alias("member"), "group_id", "mz", "rt", "area", "mean_step")

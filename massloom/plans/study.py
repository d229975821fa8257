"""One study job: from searched spectra, features and injections to the result tables."""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from massloom.functions import names as N
from massloom.operators import groups as G
from massloom.operators import matrix as M
from massloom.operators import retention as R
from massloom.operators.band import spread
from massloom.operators.matrix import GROUP
from massloom.session import next_round
from massloom.sources.sinks import result_rows


@dataclass(frozen=True)
class Settings:
    """What a study may set; the defaults are those of the operators."""

    min_files: int = 2
    rt_filter: bool = True
    rt_filter_multiplier: float = 2.0
    model_filter: bool = True
    model_sigma: float = 3.0
    correlated_filter: bool = False
    split_peaks: bool = True
    adduct_pairs: bool = True
    blank_multiplier: float = 5.0
    presence: bool = False
    presence_fraction: float = 0.6
    presence_by: tuple[str, ...] = ()


#: ``study``: the class window gives way to the retention models, blanks need a factor of three, and groups must be present in a cell.
PRESETS = {"default": Settings(), "study": Settings(rt_filter=False, blank_multiplier=3.0, presence=True)}


def settings(preset: str = "default", **changes) -> Settings:
    """A preset with single settings changed; unknown names raise."""
    if preset not in PRESETS:
        raise ValueError(f"no preset {preset!r}; there are {sorted(PRESETS)}")
    return replace(PRESETS[preset], **changes)


def identify(hits: DataFrame, features: DataFrame, injections: DataFrame, chosen: Settings) -> DataFrame:
    """Groups of the linked features with the name, class, scores and adduct that their spectra support (null for none)."""
    groups = next_round(G.build_groups(features, injections, chosen.min_files))
    named = G.name_columns(G.associate(hits, features, groups))
    vote = next_round(G.vote_sum_name(named))
    reported = next_round(G.reported_name(vote, G.pool_candidates(named, vote), G.weighted_purity(named, vote)))
    support = G.support_scores_adduct(reported, named, groups).withColumn("adduct", F.when(F.col("adducts") != "", F.substring_index("adducts", "; ", 1)))
    labels = G.evidence_labels(reported).select(*GROUP, "name", "sum_name", "lipid_class", "chain_evidence", "purity_source")
    rows = groups.join(spread(labels), GROUP, "left").join(spread(support.select(*GROUP, "ms2_spectra", "ms2_files", "dot", "adduct")), GROUP, "left")
    return next_round(rows.withColumn("identified", F.col("name").isNotNull()).withColumn("source", F.when(F.col("identified"), "MS2")))


def verdicts(groups: DataFrame, areas: DataFrame, injections: DataFrame, adducts: DataFrame, chosen: Settings) -> tuple[DataFrame, DataFrame]:
    """GROUP, reason, stage: the stage that removes each group, in order; a removed group takes no part in later stages.

    Redundancy sweep, class window, retention models, unidentified rows that track an identified one, split peaks,
    adduct pairs, blanks, presence. Also the areas, to which absorbed halves of split peaks are added.
    """
    removed: list[DataFrame] = []

    def live() -> DataFrame:
        rows = groups.withColumn("keep", F.lit(True))
        return reduce(lambda left, gone: left.join(spread(gone.select(*GROUP)), GROUP, "left_anti"), removed, rows)

    def remove(rows: DataFrame) -> None:
        slim = rows.select(*[F.col(c).alias(c) for c in GROUP], F.col("reason").alias("reason"), F.lit(len(removed)).alias("stage"))
        removed.append(next_round(slim.dropDuplicates(GROUP)))

    lightest = groups.withColumn("fragments", F.lit(None).cast("array<double>"))
    remove(G.resolve_sweep(G.sweep_pairs(lightest, adducts, areas, injections), lightest))
    if chosen.rt_filter:
        kept = live().select(*GROUP, "keep")
        remove(G.class_rt_filter(groups.join(kept, GROUP, "left").na.fill(False, ["keep"]), chosen.rt_filter_multiplier))
    if chosen.model_filter:
        rows = live()
        remove(R.rt_model_filter(rows, R.fit_rt_models(rows), chosen.model_sigma).filter("off_model").withColumn("reason", F.lit("Off the retention model")))
    if chosen.correlated_filter:
        remove(G.correlated_unidentified(live(), areas, injections))
    if chosen.split_peaks:
        merges = next_round(G.merge_split_peaks(live(), areas, injections))
        remove(merges)
        areas = next_round(G.absorb_areas(areas, merges))
    if chosen.adduct_pairs:
        remove(G.remove_adduct_pairs(live(), adducts, areas, injections))
    remove(M.blank_filter(live().select(*GROUP), areas, injections, chosen.blank_multiplier).filter("NOT blank_pass").withColumn("reason", F.lit("Blank")))
    if chosen.presence:
        remove(M.presence_filter(live().select(*GROUP), areas, injections, chosen.presence_fraction, chosen.presence_by).filter("NOT presence_pass").withColumn("reason", F.lit("Detected in too few injections")))
    return reduce(DataFrame.unionByName, removed), areas


def run_study(hits: DataFrame, features: DataFrame, areas: DataFrame, injections: DataFrame, adducts: DataFrame, table: str = "final", preset: str = "default", **changes) -> tuple[DataFrame, DataFrame]:
    """Rows and areas of one result table (``unfiltered``, ``final``, ``identified``, ``normalised``) of every run at once.

    ``hits``: search results with ``corrected_rt``, purity and components. ``features``: linked features with their
    group_id. ``areas``: one row per group and injection. Stages follow one another in a fixed order, because each
    one judges what the ones before it kept. Groups, their hits and the verdicts of each stage are written tables.
    """
    chosen = settings(preset, **changes)
    groups = identify(hits, features, injections, chosen)
    groups = groups.withColumn("sum_name", F.coalesce("sum_name", N.sum_composition(F.col("name"))))
    removed, areas = verdicts(groups, areas, injections, adducts, chosen)
    return result_rows(groups, areas, injections, removed, table)

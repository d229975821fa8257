"""The study job over the stand-in tables."""

from pyspark.sql import functions as F

from massloom.functions import ions
from massloom.plans import standin as S
from massloom.plans.catalog.groups import features, hits
from massloom.plans.registry import query
from massloom.plans.study import run_study
from massloom.session import next_round


@query("study_unfiltered")
def study_unfiltered(spark, d):
    """Every group of every run with its name and the stage that removed it."""
    areas = next_round(S.areas(spark, d))  # read by nearly all stages
    table = next_round(features(spark, d, areas))
    rows, _ = run_study(hits(spark, d, table), table, areas, S.injections(spark, d), ions.adduct_table(spark), table="unfiltered", preset="study", presence_by=("grp",))
    return rows.select("study_id", "polarity", "group_id", "name", "filter_status", F.round("pooled_cv", 6).alias("pooled_cv"))

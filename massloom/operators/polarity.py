"""Two polarities of one study: which keeps a class, chain names carried across, agreement, one matrix."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from massloom.functions import names as N
from massloom.functions.numeric import spearman
from massloom.functions.roles import qc_flag
from massloom.operators.band import spread
from massloom.operators.matrix import GROUP, INJ, RUN

CARRY_RT = 0.20
DECOY = "DECOY"


def validate_classes(groups: DataFrame, table: DataFrame) -> DataFrame:
    """Status of every class per study: undecided, stale, moot, shared, single.

    ``groups`` carries lipid_class and identified; ``table``: lipid_class, assigned ('+' / '-').
    Decoy classes take no part.
    """
    seen = (groups.filter("identified AND lipid_class IS NOT NULL").filter(~F.upper("lipid_class").startswith(DECOY))
            .groupBy("study_id", "lipid_class").agg(F.max(F.col("polarity") == "+").alias("in_pos"), F.max(F.col("polarity") == "-").alias("in_neg"),
                                                    F.count(F.lit(1)).alias("rows")))
    studies = groups.select("study_id").distinct()
    # one entry per listed class and study: the table is a facility list of some dozens of rows
    listed = studies.withColumn("__t", table.agg(F.collect_set(F.struct("lipid_class", "assigned")).alias("t")).scalar()).withColumn(
        "__e", F.explode("__t")).select("study_id", "__e.lipid_class", "__e.assigned")
    out = seen.join(listed, ["study_id", "lipid_class"], "full").na.fill(False, ["in_pos", "in_neg"]).na.fill(0, ["rows"])
    both, none = F.col("in_pos") & F.col("in_neg"), ~F.col("in_pos") & ~F.col("in_neg")
    status = (F.when(both & F.col("assigned").isNull(), "undecided").when(none, "stale").when(both, "shared")
              .when(F.col("assigned").isNotNull(), "moot").otherwise("single"))
    return out.withColumn("status", status)


def apply_polarity(groups: DataFrame, table: DataFrame) -> DataFrame:
    """``groups`` with ``polarity_kept`` and the audit ``reason`` of rows a shared class loses.

    A class of both polarities that the table does not decide raises: guessing would delete lipids.
    """
    classes = validate_classes(groups, table)
    losing = classes.filter("status IN ('shared', 'undecided')").select("study_id", "lipid_class", "assigned", "status")
    out = groups.join(losing, ["study_id", "lipid_class"], "left")
    kept = F.when(F.col("status") == "undecided", F.raise_error(F.concat(
        F.lit("class in both polarities but not in the class-polarity table: "), F.col("lipid_class"))).cast("boolean")).otherwise(
        F.col("status").isNull() | ~F.col("identified") | (F.col("assigned") == F.col("polarity")))
    out = out.withColumn("polarity_kept", kept)
    reason = F.when(~F.col("polarity_kept"), F.concat(F.lit("polarity: "), F.col("lipid_class"), F.lit(" assigned to "),
                                                      F.when(F.col("assigned") == "+", "Pos").otherwise("Neg"))).otherwise("")
    return out.withColumn("reason", reason).select(*groups.columns, "polarity_kept", "reason")


def _nearest_offers(rows: DataFrame, offers: DataFrame, tolerance: float) -> DataFrame:
    """``rows`` with ``chains, source, there`` of the offers of their sum composition: the nearest of each chains and source within
    ``tolerance`` (of two equally near that of the smaller group id), and those without a retention; a row without one takes all chains and sources.

    Rows never meet all offers of a name: in a cell of retention both are put in order, and the last offer before and the first after a row are carried to it.
    """
    name, kind = [*RUN, "sum_name"], ["chains", "source"]
    width = 4 * tolerance if tolerance > 0 else 1.0
    cell = lambda c: F.floor(c / width)
    timed = offers.filter("there IS NOT NULL").groupBy(*name, *kind, F.col("there").cast("double").alias("there")).agg(F.min("offer_id").alias("offer_id"))
    timed = timed.withColumn("__cell", F.explode(F.sequence(cell(F.col("there") - tolerance - width * 1e-6), cell(F.col("there") + tolerance + width * 1e-6))))
    at = [*name, "__cell", *kind]
    asked = rows.filter("rt IS NOT NULL").withColumn("__cell", cell(F.col("rt"))).join(spread(timed.select(*at).distinct()), [*name, "__cell"])
    line = timed.select(*at, F.col("there").alias("__x"), F.struct("there", "offer_id").alias("__offer"), F.lit(None).cast(rows.schema["group_id"].dataType).alias("group_id"))
    line = line.unionByName(asked.select(*at, F.col("rt").alias("__x"), "group_id"), allowMissingColumns=True)
    # an offer stands before the rows of its own retention
    # either way; a frame to the end of its key would be read again for every row
    nearest_so_far = lambda x: F.last("__offer", ignorenulls=True).over(
        Window.partitionBy(*at).orderBy(x, F.col("__offer").isNull()).rowsBetween(Window.unboundedPreceding, 0))
    below, above = nearest_so_far(F.col("__x")), nearest_so_far(F.col("__x").desc())
    beside = line.withColumn("__below", below).withColumn("__above", above).filter("__offer IS NULL").withColumnRenamed("__x", "rt")
    far = lambda c: F.struct(F.abs(F.col(c)["there"] - F.col("rt")).alias("g"), F.col(c)["offer_id"].alias("id"))
    nearest = F.when(F.col("__above").isNull() | (F.col("__below").isNotNull() & (far("__below") <= far("__above"))), F.col("__below")).otherwise(F.col("__above"))
    columns = [*GROUP, "rt", *kind, "there"]
    near = beside.withColumn("there", nearest["there"]).filter(F.abs(F.col("there") - F.col("rt")) <= tolerance).select(*columns)
    untimed = rows.join(spread(offers.filter("there IS NULL").select(*name, *kind, "there").distinct()), name).select(*columns)
    everything = offers.select(*name, *kind).distinct().withColumn("there", F.lit(None).cast("double"))
    unplaced = rows.filter("rt IS NULL").join(spread(everything), name).select(*columns)
    return near.unionByName(untimed).unionByName(unplaced)


def carry_chains(groups: DataFrame, table: DataFrame, tolerance: float = CARRY_RT) -> DataFrame:
    """Chain-resolved name for sum-composition rows: ``group keys, chains, chains_from, rt_delta``.

    Same sum composition; retention within ``tolerance`` may only veto; exactly one resolved name
    must remain.  The other polarity is read for the classes this one won, the own one always.
    """
    named = groups.filter("name IS NOT NULL AND name <> ''")
    resolved = (named.filter(F.col("name").contains("_")).select(
        "study_id", F.col("polarity").alias("source"), "lipid_class", F.col("group_id").alias("offer_id"), F.col("name").alias("chains"), N.sum_composition(F.col("name")).alias("sum_name"), F.col("rt").alias("there")))
    won = validate_classes(groups.withColumn("identified", F.col("name").isNotNull()), table).filter("status = 'shared'").select(
        "study_id", "lipid_class", F.col("assigned").alias("winner"))
    own = resolved.withColumn("polarity", F.col("source"))
    other = (resolved.join(won, ["study_id", "lipid_class"]).filter(F.col("winner") != F.col("source"))
             .withColumn("polarity", F.col("winner")).drop("winner"))
    offers = other.unionByName(own.select(*other.columns))
    rows = named.filter(~F.col("name").contains("_")).select(*GROUP, "rt", F.col("name").alias("sum_name"))
    hits = _nearest_offers(rows, offers, tolerance)
    gap = F.abs(F.col("there") - F.col("rt"))
    best = hits.groupBy(*GROUP, "chains").agg(F.min_by(F.struct("source", (F.col("there") - F.col("rt")).alias("delta")), F.struct(gap.alias("g"), "source")).alias("b"))
    one = best.groupBy(*GROUP).agg(F.count(F.lit(1)).alias("n"), F.first(F.struct("chains", "b")).alias("x")).filter("n = 1")
    return one.select(*GROUP, "x.chains", F.col("x.b.source").alias("chains_from"), F.col("x.b.delta").alias("rt_delta"))


def fold_changes(areas: DataFrame, groups: DataFrame, injections: DataFrame, factor: str) -> DataFrame:
    """Per run, name and pair of levels (``base`` before ``level``): median over its rows of the log2 change."""
    level = injections.filter(F.coalesce(F.col(factor), F.lit("")) != "").select(*INJ, F.col(factor).cast("string").alias("level"))
    cells = areas.filter("area > 0").join(level, INJ).join(groups.filter("name IS NOT NULL AND name <> ''").select(*GROUP, "name"), GROUP)
    means = cells.groupBy(*GROUP, "name", "level").agg(F.avg(F.log2("area")).alias("mean"))
    base = means.select(*GROUP, F.col("level").alias("base"), F.col("mean").alias("base_mean"))
    per = means.join(base, GROUP).filter("base < level").withColumn("change", F.col("mean") - F.col("base_mean"))
    return per.groupBy(*RUN, "name", "base", "level").agg(F.median("change").alias("change"))


def polarity_agreement(changes: DataFrame, least: int = 3) -> tuple[DataFrame, DataFrame]:
    """Per lipid and level pair ``agree`` / ``OPPOSITE``; per study and pair shared count, Spearman, opposite share."""
    pair = ["study_id", "base", "level"]
    p = changes.filter("polarity = '+'").select(*pair, "name", F.col("change").alias("pos"))
    n = changes.filter("polarity = '-'").select(*pair, "name", F.col("change").alias("neg"))
    both = p.join(n, [*pair, "name"]).withColumn("agreement", F.when(F.col("pos") * F.col("neg") >= 0, "agree").otherwise("OPPOSITE"))
    rho = spearman(both, pair, "pos", "neg", "rho", "shared")
    opp = both.groupBy(*pair).agg(F.count_if(F.col("agreement") == "OPPOSITE").alias("opposite"))
    study = rho.join(opp, pair).filter(F.col("shared") >= least).withColumn("opposite_fraction", F.col("opposite") / F.col("shared"))
    return both, study


def combine(rows: DataFrame, areas: DataFrame, key: Column) -> DataFrame:
    """One long matrix of both polarities on polarity-free sample keys, with the scale of each row.

    ``key`` turns an injection name into its sample.  Areas are not rescaled between the blocks.  A
    sample measured in only one polarity of a study raises.
    """
    cells = areas.withColumn("sample", key)
    sides = cells.select("study_id", "polarity", "sample").distinct().groupBy("study_id", "sample").agg(F.count(F.lit(1)).alias("n"))
    expected = cells.select("study_id", "polarity").distinct().groupBy("study_id").agg(F.count(F.lit(1)).alias("m"))
    check = sides.join(expected, "study_id").withColumn("ok", F.when(F.col("n") < F.col("m"), F.raise_error(F.concat(
        F.lit("the two runs did not measure the same vials: "), F.col("sample"))).cast("boolean")).otherwise(F.lit(True))).select("study_id", "sample", "ok")
    mode = F.when(F.col("polarity") == "+", "Pos").otherwise("Neg")
    out = cells.join(check, ["study_id", "sample"]).filter("ok").join(rows, GROUP)
    flag = qc_flag(F.col("pooled_cv")) if "pooled_cv" in rows.columns else F.lit("")
    return out.withColumn("mode", mode).withColumn("scale", F.concat(F.lit("median-normalised within "), mode)).withColumn("qc_flag", flag).drop("ok", "injection")


def resolve_injection(names: DataFrame, injections: DataFrame, key: Column) -> DataFrame:
    """Metadata rows matched to injections by exact name first, else by the polarity-free key.

    ``names``: study_id, name and metadata; ``key`` is built on a column called ``name``.
    """
    inj = injections.select("study_id", F.col("injection"), F.col("injection").alias("name")).withColumn("k", key)
    exact = inj.join(names, ["study_id", "name"])
    meta = names.withColumn("k", key).drop("name")
    loose = inj.join(exact.select("study_id", "injection"), ["study_id", "injection"], "left_anti").join(meta, ["study_id", "k"])
    cols = [c for c in names.columns if c not in ("study_id", "name")]
    return exact.select("study_id", "injection", *cols, F.lit("exact").alias("matched_by")).unionByName(
        loose.select("study_id", "injection", *cols, F.lit("sample key").alias("matched_by")))

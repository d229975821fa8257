"""Sinks: result tables, method lists, records.  Long Parquet is the store; wide CSV is for readers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from massloom.functions import names as N
from massloom.operators.band import spread
from massloom.operators.groups import duplicate_names, duplicate_verdicts, lipid_keys
from massloom.operators.matrix import GROUP, RUN, apply_factors, median_factors, pooled_cv, recentre, wide_matrix
from massloom.operators.order import ordered


def result_rows(groups: DataFrame, areas: DataFrame, injections: DataFrame, verdicts: DataFrame, table: str = "final",
                drop_roles: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """Rows and areas of one result table.

    ``table``: ``unfiltered`` (every row with its reason), ``final`` (kept), ``identified`` (kept and
    named), ``normalised`` (identified, median-normalised and re-centred on the rows written).
    """
    reason = verdicts.groupBy(*GROUP).agg(F.max_by("reason", "stage").alias("filter_status"))
    rows = groups.join(spread(reason), GROUP, "left").na.fill("", ["filter_status"])
    if table != "unfiltered":
        rows = rows.filter("filter_status = ''").drop("filter_status")
    named = F.coalesce(F.trim("name"), F.lit("")) != ""
    if table in ("identified", "normalised"):
        rows = rows.filter(named)
    inj = injections.filter(~F.col("role").isin(list(drop_roles))) if drop_roles else injections
    cells = areas.join(rows.select(*GROUP), GROUP, "left_semi").join(inj.select("study_id", "polarity", "injection"), ["study_id", "polarity", "injection"], "left_semi")
    scale = None
    if table == "normalised":
        roles = tuple(r for r in ("sample", "qc", "standard", "blank") if r not in drop_roles)
        scale = recentre(cells, median_factors(cells, inj, roles))
    rows = rows.join(pooled_cv(cells, inj, scale).select(*GROUP, "pooled_cv"), GROUP, "left")
    if scale is not None:
        cells = apply_factors(cells, scale)
    rows = rows.withColumn("shorthand", N.shorthand(F.col("name"), F.coalesce("source", F.lit("")))).withColumn(
        "canonical_class", N.canonical_class(F.coalesce("lipid_class", "name")))
    rows = rows.join(lipid_keys(rows), GROUP, "left").join(duplicate_names(rows), GROUP, "left")
    if "rt_z" in rows.columns:
        rows = rows.join(duplicate_verdicts(rows), GROUP, "left")
    return rows, cells


def write_results(rows: DataFrame, areas: DataFrame, injections: list[str], path: str, fmt: str = "csv") -> None:
    """The wide matrix of one table, partitioned by study and polarity."""
    wide_matrix(rows, areas, injections).write.mode("overwrite").partitionBy(*RUN).options(header=True).format(fmt).save(path)


def exclusion_review(wasted: DataFrame) -> DataFrame:
    """Review layout: every entry with the evidence for it."""
    note = F.when(F.coalesce("series", F.lit("")) != "", F.concat("series", F.lit(" contamination"))).otherwise("background, never identified")
    return wasted.select(*RUN, F.format_string("%.4f", "mz").alias("m/z"), F.lit(1).alias("Charge"), F.col("scans").alias("MS2 scans wasted"),
                         F.format_string("%.2f-%.2f", "rt_lo", "rt_hi").alias("RT observed (min)"), F.when(F.col("in_blank"), "yes").otherwise("no").alias("In blank"),
                         F.coalesce("series", F.lit("")).alias("Series"), note.alias("Note"))


def _instrument(rows: DataFrame, start: Column, end: Column, comment: Column) -> DataFrame:
    sign = F.when(F.col("polarity") == "+", "Positive").otherwise("Negative")
    none = F.lit("")
    return rows.select(*RUN, F.format_string("%.4f", "mz").alias("Mass [m/z]"), none.alias("Formula [M]"), none.alias("Species"), F.lit(1).alias("CS [z]"),
                       sign.alias("Polarity"), start.alias("Start [min]"), end.alias("End [min]"), none.alias("(N)CE"), none.alias("MSX ID"), comment.alias("Comment"))


def exclusion_instrument(wasted: DataFrame) -> DataFrame:
    """Instrument layout; no time window, contamination is there for the whole run."""
    note = F.when(F.coalesce("series", F.lit("")) != "", F.concat("series", F.lit(" contamination"))).otherwise("background, never identified")
    return _instrument(wasted, F.lit(""), F.lit(""), F.concat(note, F.lit(" ("), F.col("scans").cast("string"), F.lit(" MS2)")))


def inclusion_instrument(rows: DataFrame, window: float = 0.5) -> DataFrame:
    """Instrument layout with a retention window per entry, floored at 0."""
    fmt = lambda c: F.format_string("%.2f", c)
    return _instrument(rows, fmt(F.greatest(F.col("rt") - window, F.lit(0.0))), fmt(F.col("rt") + window), F.lit("inclusion: MS1 feature never fragmented"))


#: Named orders of the lists: most wasted scans first, faintest feature first, earliest group first.
ORDERS = {"wasted": ("scans DESC", "mz"), "inclusion": ("max_area", "group_id"), "groups": ("rt", "group_id")}


def in_order(rows: DataFrame, name: str, keys: list[str] = RUN) -> DataFrame:
    """``rows`` with their ``place`` in one of ``ORDERS``; ties go to the smaller mass or group id."""
    order = [F.col(c.split()[0]).desc() if c.endswith("DESC") else F.col(c) for c in ORDERS[name]]
    return ordered(rows, *order, keys=keys)


def write_ordered(rows: DataFrame, name: str, path: str, fmt: str = "csv") -> None:
    """A list in its named order: files, read by name, and rows within them follow ``study, polarity, place``."""
    numbered = in_order(rows, name)
    by = [*RUN, "place"]
    numbered.repartitionByRange(*by).sortWithinPartitions(*by).write.mode("overwrite").options(header=True).format(fmt).save(path)


def write_list(rows: DataFrame, path: str) -> None:
    """A method list as CSV, one folder per study and polarity."""
    rows.withColumnRenamed("polarity", "run_polarity").write.mode("overwrite").partitionBy("study_id", "run_polarity").option("header", True).csv(path)


def write_record(rows: DataFrame, path: str) -> None:
    """Artefact, duty-cycle, polarity-filter or derived-setting records as JSON lines."""
    rows.write.mode("overwrite").json(path)


def write_standards(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").option("header", True).csv(path)

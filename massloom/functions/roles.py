"""Injection roles, polarity-free sample keys and quality flags."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# ---- fixed values: what a file name or a declared sample type says about an injection ----------
BLANK_NAME = r"(?i)blank|blk"
QC_NAME = r"(?i)(^|[_\-])qc([_\-]|\d|$)|pool"
STANDARD_NAME = r"(?i)std[_\-]?mix|stdmix|(^|[_\-])std([_\-]|\d|$)|standard|splash"
BLANK_TYPE = r"(?i)blank"
QC_TYPE = r"(?i)\bqc\b|quality\s*control"
STANDARD_TYPE = r"(?i)std\s*[_\-]?\s*bracket|standard"


def infer_role(name: Column, sample_type: Column | None = None) -> Column:
    """blank > qc > standard > sample, from the file name or the declared sample type."""
    stem = F.substring_index(name, "/", -1)
    declared = F.coalesce(sample_type, F.lit("")) if sample_type is not None else F.lit("")
    return (F.when(stem.rlike(BLANK_NAME) | declared.rlike(BLANK_TYPE), "blank")
            .when(stem.rlike(QC_NAME) | declared.rlike(QC_TYPE), "qc")
            .when(stem.rlike(STANDARD_NAME) | declared.rlike(STANDARD_TYPE), "standard")
            .otherwise("sample"))


def strip_polarity(name: Column, token: str) -> Column:
    """Remove one polarity token bounded by ``_`` or an end, wherever it sits, in any case."""
    pattern = rf"(?i)^(.*?)(?:^|_){token}(?=_|$)(.*)$"
    return F.when(name.rlike(pattern), F.concat(F.regexp_extract(name, pattern, 1),
                                                F.regexp_extract(name, pattern, 2))).otherwise(name)


def sample_key(name: Column) -> Column:
    """Injection identity without its polarity: one vial measured twice has one key."""
    cut = F.regexp_replace(name, r"(^|_)(Pos|Neg|POS|NEG|positive|negative)(_|$)", "$1")
    return F.regexp_replace(cut, r"^_+|_+$", "")


def learn_prefix(injections: DataFrame, name: str = "injection", keys: tuple[str, ...] = ("study_id",),
                 coverage: float = 0.6) -> DataFrame:
    """Longest shared prefix held by most names of a study: ``keys, prefix, held``.

    Candidates end at ``_`` or ``-`` and must be held by ``coverage`` of the names; the widest
    coverage wins, length only breaks ties, and trimming must keep the names distinct.  Studies
    of fewer than four names get none.
    """
    k = list(keys)
    names = injections.select(*k, F.col(name).alias("__n")).filter("length(__n) > 0").distinct()
    totals = names.groupBy(*k).agg(F.count(F.lit(1)).alias("__total")).filter("__total >= 4")
    cuts = F.filter(F.sequence(F.lit(1), F.length("__n")), lambda i: F.substring("__n", i, F.lit(1)).isin("_", "-"))
    candidates = (names.withColumn("prefix", F.explode(F.transform(cuts, lambda i: F.substring("__n", F.lit(1), i))))
                  .groupBy(*k, "prefix").agg(F.count(F.lit(1)).alias("__held"))
                  .join(totals, k).filter(F.col("__held") / F.col("__total") >= F.lit(coverage)))
    # a trimmed name may only collide with a name that does not carry the prefix
    carried = (names.join(candidates, k).filter(F.col("__n").startswith(F.col("prefix")))
               .select(*k, "prefix", F.expr("substring(__n, length(prefix) + 1)").alias("__n")))
    clashes = (carried.join(names, [*k, "__n"]).filter(~F.col("__n").startswith(F.col("prefix")))
               .select(*k, "prefix").distinct())
    safe = candidates.join(clashes, [*k, "prefix"], "left_anti")
    return (safe.groupBy(*k).agg(F.max(F.struct((F.col("__held") / F.col("__total")).alias("held"),
                                                F.length("prefix").alias("len"), "prefix")).alias("b"))
            .select(*k, "b.prefix", "b.held"))


def qc_flag(cv: Column) -> Column:
    """Band of a pooled CV in percent."""
    return (F.when(cv.isNull(), "").when(cv <= 20, "good").when(cv <= 30, "acceptable").otherwise("unreliable"))


def elution_volume(rt: Column, flow: Column) -> Column:
    """Retention time times flow: the axis on which methods of different flow compare."""
    return rt * flow


def number_injections(injections: DataFrame, order: str, keys: tuple[str, ...] = ("study_id",)) -> DataFrame:
    """``run_order`` 1..n inside a study by the given column."""
    return injections.withColumn("run_order", F.row_number().over(Window.partitionBy(*keys).orderBy(order)))

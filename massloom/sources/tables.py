"""Tabular inputs: search hits, result tables, exports, adducts, chains, sequences, metadata, lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from massloom.functions.ions import formula_mass
from massloom.functions.names import family_key, isobaric_alternatives
from massloom.operators.band import Band, band_join
from massloom.operators.matrix import GROUP, INJ, RUN

HIT_COLUMNS = {"MS2 ID": "ms2_id", "Retention Time (min)": "rt", "Rank": "rank", "Identification": "name", "Precursor Mass": "precursor_mz",
               "Library Mass": "library_mz", "Delta m/z": "delta_ppm", "Dot Product": "dot", "Reverse Dot Product": "reverse_dot", "Purity": "purity",
               "Spectral Components": "components", "Optimal Polarity": "optimal_polarity", "Native Spectrum": "is_native", "Library": "library",
               "Potential Fragments": "fragments", "sn Evidence": "sn_evidence"}
# columns of a result table that are not injections
META_COLUMNS = ["Retention Time (min)", "Quant Ion", "Polarity", "Area (max)", "Identification", "Lipid Class", "Features Found", "Compound Group",
                "Filter Status", "Adduct", "Dot Product", "Reverse Dot Product", "Purity", "MS2 Spectra", "MS2 Files", "Identification Source",
                "Pooled QC CV (%)", "Quant Ion (measured)", "Duplicate Name", "RT Model Error", "Duplicate Verdict", "Chains From", "Lipid Key",
                "RT Model Z", "RT Model R2", "Chain Evidence", "Purity Source", "Shorthand (LSI)", "Class (canonical)", "S/N", "Theoretical m/z",
                "Mass Error (ppm)"]


def _csv(spark: SparkSession, paths, **options) -> DataFrame:
    return spark.read.options(header=True, **options).csv(paths)


def parse_components(cell: Column) -> Column:
    """``PC 34:1 [M+H]+(82) / ...`` -> array of (name, share); parts that do not parse are skipped."""
    parts = F.filter(F.transform(F.split(F.coalesce(cell, F.lit("")), " / "), lambda p: F.trim(p)), lambda p: p.rlike(r"^.*\(-?\d+\)$"))
    return F.transform(parts, lambda p: F.struct(F.trim(F.regexp_extract(p, r"^(.*)\(-?\d+\)$", 1)).alias("name"),
                                                 F.regexp_extract(p, r"\((-?\d+)\)$", 1).cast("int").alias("share")))


def parse_masses(cell: Column) -> Column:
    """Pipe-separated masses; parts that are not numbers are skipped."""
    return F.filter(F.transform(F.split(F.coalesce(cell, F.lit("")), r"\|"), lambda p: F.trim(p).try_cast("double")), lambda m: m.isNotNull())


def parse_sn(cell: Column) -> Column:
    """Struct ``chain, ratio`` of a written sn-2 call; empty and 0 for a decline."""
    pattern = r"^(\S+) favoured sn-2 \(([\d.]+)x\)$"
    text = F.trim(F.coalesce(cell, F.lit("")))
    return F.struct(F.regexp_extract(text, pattern, 1).alias("chain"), F.coalesce(F.regexp_extract(text, pattern, 2).try_cast("double"), F.lit(0.0)).alias("ratio"))


def read_hits(spark: SparkSession, paths) -> DataFrame:
    """Search-hit tables; the injection is the file stem, rows with unreadable numbers are skipped."""
    raw = _csv(spark, paths).withColumn("injection", F.regexp_replace(F.substring_index("_metadata.file_path", "/", -1), r"(_Results)?\.csv$", ""))
    raw = raw.select("injection", *[F.col(f"`{old}`").alias(new) for old, new in HIT_COLUMNS.items() if old in raw.columns])
    numbers = ["rt", "precursor_mz", "library_mz", "dot", "reverse_dot"]
    out = raw
    for c in numbers:
        out = out.withColumn(c, F.col(c).try_cast("double"))
    for c in ("ms2_id", "rank", "purity"):
        out = out.withColumn(c, F.coalesce(F.col(c), F.lit("0")).try_cast("int"))
    flag = lambda c: F.lower(F.trim(F.coalesce(F.col(c), F.lit("")))) == "true"
    out = out.na.drop(subset=[*numbers, "ms2_id", "rank", "purity"]).withColumn("optimal_polarity", flag("optimal_polarity"))
    return out.withColumn("components", parse_components(F.col("components"))).withColumn("fragments", parse_masses(F.col("fragments")))


def read_results(spark: SparkSession, path) -> tuple[DataFrame, DataFrame]:
    """A wide result table as (rows with their metadata, long areas).

    Every column that is not a known metadata column is an injection; an empty table keeps its shape.
    """
    raw = _csv(spark, path)
    meta = [c for c in raw.columns if c in META_COLUMNS]
    inj = [c for c in raw.columns if c not in META_COLUMNS and c.strip() and not c.startswith("_c")]
    rows = raw.withColumn("group_id", F.col("`Compound Group`").cast("long")) if "Compound Group" in raw.columns else raw.withColumn("group_id", F.monotonically_increasing_id())
    quoted = [F.coalesce(F.col(f"`{c}`").try_cast("double"), F.lit(0.0)).alias(c) for c in inj]
    areas = rows.select("group_id", *quoted).unpivot(["group_id"], [f"`{c}`" for c in inj], "injection", "area").filter("area > 0")
    return rows.select("group_id", *[f"`{c}`" for c in meta]), areas


def read_nested_export(spark: SparkSession, path: str) -> DataFrame:
    """Three-level export: depth is the number of empty leading cells; child rows inherit the last
    parent above them.  ``line, depth, group_line, compound_line, cells``; header rows removed.

    Lines are ordered by the file offset of their split and their place in it.
    """
    raw = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                                       F.monotonically_increasing_id().alias("idx"))
    cells = F.transform(F.split("value", ","), lambda c: F.regexp_replace(F.trim(c), '^"|"$', ""))
    rows = raw.withColumn("cells", cells).filter(F.exists("cells", lambda c: c != ""))
    filled = F.transform("cells", lambda c, i: F.when(c != "", i))
    rows = rows.withColumn("depth", F.array_min(F.filter(filled, lambda i: i.isNotNull()))).withColumn("is_header", F.array_contains("cells", "Checked"))
    order = Window.partitionBy("file").orderBy("block", "idx")
    rows = rows.withColumn("line", F.row_number().over(order))
    seen = lambda d, head: F.last(F.when((F.col("depth") == d) & (F.col("is_header") == head), F.col("line")), ignorenulls=True).over(order)
    out = rows.withColumn("group_line", seen(0, False)).withColumn("compound_line", F.when(F.col("depth") > 0, seen(1, False)))
    for d in (0, 1, 2):
        h = F.last(F.when(F.col("is_header") & (F.least(F.col("depth"), F.lit(2)) == d), F.col("cells")), ignorenulls=True).over(order)
        out = out.withColumn(f"h{d}", h)
    names = F.when(F.col("depth") == 0, F.col("h0")).when(F.col("depth") == 1, F.col("h1")).otherwise(F.col("h2"))
    out = out.filter("NOT is_header").withColumn("names", names)
    fields = F.map_from_entries(F.array_distinct(F.filter(F.transform("names", lambda n, i: F.struct(n.alias("k"), F.get("cells", i).alias("v"))), lambda e: e["k"] != "")))
    return out.select("line", F.least("depth", F.lit(2)).alias("level"), "group_line", "compound_line", fields.alias("fields"))


def attach_measured_rt(features: DataFrame, unaligned: DataFrame, widths: DataFrame) -> DataFrame:
    """Aligned features with ``rt_measured`` from an unaligned export.

    Same injection and polarity, mass strictly within 5 ppm, retention within 1.0 min (its group
    within 2.0 and inside the bucket window), area ratio above 0.95.  The nearest in time wins.
    ``unaligned``: injection keys, u_mz, u_rt, u_area; ``features`` carries group_rt; ``widths``: run_fwhm.
    """
    f = features.join(widths, RUN)
    pairs = band_join(unaligned.select(*INJ, "u_mz", "u_rt", "u_area"), f, [Band("u_mz", "mz", 5.0, "ppm", strict=True), Band("u_rt", "rt_aligned", 1.0, strict=True)], keys=INJ,
                      where="area > 0 AND u_area / area > 0.95 AND abs(group_rt - u_rt) < 2.0")
    b = lambda c: F.floor(c / 0.1)
    w = F.greatest(F.col("run_fwhm") * 3, F.lit(1e-6))
    pairs = pairs.filter(b(F.col("group_rt")).between(b(F.col("u_rt") - w), b(F.col("u_rt") + w)))
    best = pairs.groupBy(*GROUP, "injection").agg(F.min_by("u_rt", F.struct(F.abs(F.col("u_rt") - F.col("rt_aligned")), "u_rt")).alias("rt_measured"))
    return features.join(best, [*GROUP, "injection"], "left")


def read_adducts(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Adduct tables in order of precedence: the first definition of a name wins; mass from the formula."""
    out = None
    for rank, p in enumerate(paths):
        t = _csv(spark, p).select(F.trim("Name").alias("adduct"), F.trim("Formula").alias("formula"), (F.upper(F.trim("Loss")) == "TRUE").alias("is_loss"),
                                  F.trim("Polarity").alias("polarity"), F.coalesce(F.col("Charge").try_cast("double"), F.lit(1.0)).cast("int").alias("charge"),
                                  F.struct(F.lit(rank), F.col("_metadata.file_block_start"), F.monotonically_increasing_id()).alias("ord"))
        out = t if out is None else out.unionByName(t)
    first = out.filter("adduct <> ''").withColumn("rn", F.row_number().over(Window.partitionBy("adduct").orderBy("ord"))).filter("rn = 1")
    return first.withColumn("adduct_rank", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("ord")) - 1).withColumn(
        "adduct_mass", formula_mass(F.col("formula"))).drop("ord", "rn")


def read_chains(spark: SparkSession, path) -> DataFrame:
    """Fatty-acid chains: ``chain, base, formula``; disabled rows take part as well."""
    return _csv(spark, path).select(F.col("Name").alias("chain"), F.col("Base").alias("base"), F.col("Formula").alias("formula"))


def read_class_polarity(spark: SparkSession, default: str, override: str | None = None) -> DataFrame:
    """Class -> assigned polarity, the study's file over the facility's.  An unreadable row raises."""
    def one(p: str, origin: str) -> DataFrame:
        t = _csv(spark, p, comment="#").select(F.trim("class").alias("lipid_class"), F.trim("polarity").alias("raw")).filter("lipid_class <> ''")
        code = F.lower("raw")
        sign = (F.when(code.isin("pos", "positive", "+"), "+").when(code.isin("neg", "negative", "-"), "-")
                .otherwise(F.raise_error(F.concat(F.lit("unreadable polarity for class "), "lipid_class")).cast("string")))
        return t.select("lipid_class", sign.alias(origin))

    table = one(default, "d")
    if override is None:
        return table.select("lipid_class", F.col("d").alias("assigned"), F.lit("default").alias("origin"))
    both = table.join(one(override, "s"), "lipid_class", "full")
    return both.select("lipid_class", F.coalesce("s", "d").alias("assigned"), F.when(F.col("s").isNotNull(), "study").otherwise("default").alias("origin"))


def _sequence_rows(spark: SparkSession, path: str) -> DataFrame:
    """Rows of a sequence file below the line that names its columns: ``pos`` and one map of fields."""
    raw = spark.read.text(path).select("value", F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("idx"))
    line = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("block", "idx"))  # one sequence file
    rows = raw.withColumn("line", line).withColumn("cells", F.transform(F.split("value", ","), lambda c: F.trim(c)))
    head = F.first(F.when(F.array_contains("cells", "File Name"), F.struct("line", "cells")), ignorenulls=True).over(Window.partitionBy(F.lit(0)))
    rows = rows.withColumn("h", head).filter("line > h.line")
    fields = F.map_from_entries(F.transform(F.col("h.cells"), lambda n, i: F.struct(F.concat(n, F.when(n == "", i.cast("string")).otherwise("")).alias("k"), F.get("cells", i).alias("v"))))
    rows = rows.withColumn("f", fields).filter(F.coalesce(F.col("f")["File Name"], F.lit("")) != "")
    return rows.withColumn("pos", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("line"))).select("pos", "f")


def read_sequence(spark: SparkSession, path: str) -> DataFrame:
    """``name, run_order``: row order, or the number of ``Sample ID`` when every one reads inj<digits>.

    A polarity-qualified name is added wherever the path tells the polarity; the first occurrence of
    a name wins.
    """
    rows = _sequence_rows(spark, path).select("pos", F.col("f")["File Name"].alias("name"), F.try_element_at("f", F.lit("Sample ID")).alias("sid"),
                                              F.lower(F.coalesce(F.try_element_at("f", F.lit("Path")), F.lit(""))).alias("where"))
    declared = F.bool_and(F.coalesce(F.col("sid"), F.lit("")).rlike(r"(?i)^inj[_\-]?\d+$")).over(Window.partitionBy(F.lit(0)))
    rows = rows.withColumn("declared", declared)
    order = F.when(F.col("declared"), F.regexp_extract("sid", r"(\d+)\D*$", 1).cast("int")).otherwise(F.col("pos")).cast("int")
    pol = F.when(F.col("declared"), None).when(F.col("where").contains("neg"), "Neg").when(F.col("where").contains("pos"), "Pos")
    long = rows.select("pos", order.alias("run_order"), F.explode(F.array_compact(F.array("name", F.when(pol.isNotNull(), F.concat("name", F.lit("_"), pol))))).alias("name"))
    return long.groupBy("name").agg(F.min_by("run_order", "pos").alias("run_order"))


def read_sample_types(spark: SparkSession, path: str) -> DataFrame:
    """``name, sample_type`` of a sequence file; the first occurrence of a name wins."""
    rows = _sequence_rows(spark, path).select("pos", F.col("f")["File Name"].alias("name"), F.coalesce(F.try_element_at("f", F.lit("Sample Type")), F.lit("")).alias("t"))
    return rows.groupBy("name").agg(F.min_by("t", "pos").alias("sample_type"))


def run_order_from_stamps(files: DataFrame, planned: DataFrame) -> DataFrame:
    """Run order per study from acquisition stamps when at least max(2, 80 %) of its files carry one,
    else from the sequence; with the number of injections in a different place in the sequence.

    ``files``: study_id, injection, stamp (timestamp or null); ``planned``: study_id, injection, planned_order.
    """
    n = F.count(F.lit(1)).over(Window.partitionBy("study_id"))
    k = F.count("stamp").over(Window.partitionBy("study_id"))
    rows = files.withColumn("by_stamp", k >= F.greatest(F.lit(2), F.ceil(n * 0.8))).join(planned, ["study_id", "injection"], "left")
    s = Window.partitionBy("study_id").orderBy(F.col("stamp").asc_nulls_last(), "injection")
    rows = rows.withColumn("so", F.when(F.col("stamp").isNotNull(), F.row_number().over(s)))
    rows = rows.withColumn("run_order", F.when(F.col("by_stamp"), F.col("so")).otherwise(F.col("planned_order")))
    placed = F.col("run_order").isNotNull() & F.col("planned_order").isNotNull()
    both = Window.partitionBy("study_id", placed)
    rows = rows.withColumn("ra", F.row_number().over(both.orderBy("run_order"))).withColumn("rb", F.row_number().over(both.orderBy("planned_order")))
    moved = F.count_if(placed & F.col("by_stamp") & (F.col("ra") != F.col("rb"))).over(Window.partitionBy("study_id"))
    return rows.select("study_id", "injection", "run_order", F.when(F.col("by_stamp"), "acquisition timestamp").otherwise("sequence file").alias("order_source"),
                       moved.alias("n_moved"))


def read_metadata(spark: SparkSession, path, columns: list[str]) -> DataFrame:
    """``injection`` (the first column) and the asked group columns, trimmed."""
    raw = _csv(spark, path)
    key = raw.columns[0]
    return raw.filter(F.coalesce(F.trim(f"`{key}`"), F.lit("")) != "").select(F.trim(f"`{key}`").alias("injection"),
                                                                             *[F.coalesce(F.trim(f"`{c}`"), F.lit("")).alias(c) for c in columns])


def read_standards(spark: SparkSession, path) -> DataFrame:
    """``standard, formula, adduct, polarity, expected_mz``; the mass is computed, never read."""
    from massloom.operators.calibrate import with_standard_mz
    t = _csv(spark, path).filter(F.coalesce(F.trim("name"), F.lit("")) != "").select(F.trim("name").alias("standard"), F.trim("formula").alias("formula"),
                                                                                   F.trim("adduct").alias("adduct"), F.trim("polarity").alias("polarity"))
    return with_standard_mz(t)


def read_anchors(spark: SparkSession, path) -> DataFrame:
    """Authentic retention standards: ``carbons, double_bonds, rt``; rows that do not parse are skipped."""
    raw = spark.read.csv(path)
    name = F.col(raw.columns[0])
    rows = raw.select(F.regexp_extract(name, r"(\d+):(\d+)", 1).alias("c"), F.regexp_extract(name, r"(\d+):(\d+)", 2).alias("d"), F.col(raw.columns[1]).try_cast("double").alias("rt"))
    return rows.filter("c <> '' AND rt IS NOT NULL").select(F.col("c").cast("int").alias("carbons"), F.col("d").cast("int").alias("double_bonds"), "rt")


def distinct_files(files: DataFrame, chunks: DataFrame) -> DataFrame:
    """Acquisitions without duplicates: mzML over raw for a stem, then one of files equal in size and in
    content (shortest name, then alphabetical).

    ``files``: study_id, path, size.  ``chunks``: path, chunk_no, data, the whole content of each file.
    Only sizes held by several files are hashed, chunk by chunk; a file's digest is that of its chunks'.
    """
    name = F.substring_index("path", "/", -1)
    rows = files.withColumn("name", name).withColumn("stem", F.regexp_replace("name", r"\.[^.]*$", ""))
    best = F.row_number().over(Window.partitionBy("study_id", "stem").orderBy(F.desc(F.lower("name").endswith(".mzml")), "name"))
    rows = rows.withColumn("k", best).filter("k = 1")
    same = F.count(F.lit(1)).over(Window.partitionBy("study_id", "size"))
    rows = rows.withColumn("several", same > 1)
    hashed = chunks.join(rows.filter("several").select("path").distinct(), "path", "left_semi").select("path", "chunk_no", F.sha2("data", 256).alias("h"))
    whole = hashed.groupBy("path").agg(F.sha2(F.array_join(F.transform(F.array_sort(F.collect_set(F.struct("chunk_no", "h"))), lambda c: c["h"]), ""), 256).alias("digest"))
    rows = rows.join(whole, "path", "left").withColumn("digest", F.coalesce("digest", "path"))
    pick = F.row_number().over(Window.partitionBy("study_id", "size", "digest").orderBy(F.length("name"), "name"))
    return rows.withColumn("k", pick).filter("k = 1").select("study_id", "path", "size")


def read_consensus(spark: SparkSession, path) -> DataFrame:
    """Consensus list with its ``a/b/c`` alternatives expanded into one isobaric group per entry.

    Input columns: source, tier, name, value.
    """
    raw = _csv(spark, path).withColumn("grp", F.concat_ws("|", "source", "tier", "name"))
    rows = raw.withColumn("alternative", F.explode(isobaric_alternatives(F.col("name")))).withColumn("k", family_key(F.col("alternative")))
    return rows.select("source", "tier", "name", "grp", "alternative", F.col("value").try_cast("double").alias("value"), "k.family", "k.kind", "k.carbons", "k.double_bonds")

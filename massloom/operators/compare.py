"""Comparisons: against a reference table, published lists, a consensus benchmark, other methods."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from massloom.functions import names as N
from massloom.functions.ions import isotope_ions, peak_width
from massloom.functions.numeric import spearman
from massloom.operators import kernels
from massloom.operators.band import Band, apart, band_exists, band_join, deal, spread
from massloom.operators.matrix import GROUP, RUN
from massloom.operators.order import quantiles
from massloom.session import next_round

#: Groups of one block whose neighbours are counted.
COISOLATED = 2_048
#: Spectra, and groups, of one block in which spectra taken on groups are counted.
FRAGMENTED = 16_384


def fragmentation_audit(groups: DataFrame, scans: DataFrame, ppm: float = 10.0, rt_tol: float = 0.1,
                        mz_shifts: tuple[float, ...] = (3.111, -3.111, 7.377, -7.377), rt_shifts: tuple[float, ...] = (4.0, -4.0)) -> DataFrame:
    """Share of groups with any MS2, by evidence class, at the true position and at displaced ones.

    All displacements are one table of positions and one semi-join.
    """
    moves = [("real", 0.0, 0.0)] + [("decoy m/z", s, 0.0) for s in mz_shifts] + [("decoy RT", 0.0, s) for s in rt_shifts]
    opts = F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.lit(m).alias("dm"), F.lit(t).alias("dt"), F.lit(i).alias("move")) for i, (k, m, t) in enumerate(moves)]))
    pos = groups.withColumn("o", opts).select(*GROUP, "evidence", "o.kind", "o.move", (F.col("mz") + F.col("o.dm")).alias("p_mz"), (F.col("rt") + F.col("o.dt")).alias("p_rt"))
    hit = band_join(pos, scans.select(*RUN, F.col("precursor_mz").alias("s_mz"), F.col("rt").alias("s_rt")),
                    [Band("p_mz", "s_mz", ppm * 1.0001, "ppm", base="left"), Band("p_rt", "s_rt", rt_tol)], keys=RUN, how="left_semi")
    n = pos.groupBy(*RUN, "evidence", "kind").agg(F.count(F.lit(1)).alias("n"))
    k = hit.groupBy(*RUN, "evidence", "kind").agg(F.count(F.lit(1)).alias("fragmented"))
    return n.join(k, [*RUN, "evidence", "kind"], "left").na.fill(0, ["fragmented"]).withColumn("share", F.col("fragmented") / F.col("n"))


def failed_spectra(groups: DataFrame, ms2: DataFrame, artefacts: dict[str, float], ppm: float = 10.0, rt_tol: float = 0.1) -> DataFrame:
    """Why acquired spectra failed: per evidence class the median TIC, peak count and artefact share of
    the spectra taken on its groups.

    A spectrum counts once for each group it was taken on.  Spectra and groups meet in blocks of both axes, which leave one
    row a spectrum and class with the number of its groups; a pair is never a row.
    """
    bad = F.create_map(*[F.lit(x) for kv in artefacts.items() for x in kv])[F.col("polarity")]
    total = F.aggregate("peaks", F.lit(0.0), lambda a, p: a + p["intensity"])
    art = F.aggregate(F.filter("peaks", lambda p: F.abs(p["mz"] - bad) < 0.01), F.lit(0.0), lambda a, p: a + p["intensity"])
    s = ms2.select(*RUN, F.col("precursor_mz").alias("s_mz"), F.col("rt").alias("s_rt"), F.size("peaks").alias("n_peaks"), total.alias("tic"), art.alias("art"))
    # bins wide enough to be few whatever the tolerances; masses are binned by their logarithm
    reach_mz, reach_rt = Band("s_mz", "mz", ppm, "ppm").reach(), float(rt_tol)
    wide, long = max(2 * reach_mz, 0.01), max(2 * reach_rt, 1.0)
    reach = lambda c, tol, width: F.explode(F.sequence(F.floor((c - tol) / width - 1e-6), F.floor((c + tol) / width + 1e-6)))
    left = s.filter("tic > 0 AND s_mz > 0 AND s_rt IS NOT NULL AND NOT isnan(s_mz) AND NOT isnan(s_rt)").withColumn(
        "__m", F.floor(F.log("s_mz") / wide)).withColumn("__t", F.floor(F.col("s_rt") / long)).withColumn("__by", F.xxhash64("s_mz", "s_rt", "tic", F.monotonically_increasing_id()))
    right = groups.select(*GROUP, "evidence", "mz", "rt").filter("mz > 0 AND rt IS NOT NULL AND NOT isnan(mz) AND NOT isnan(rt)").withColumn(
        "__m", reach(F.log("mz"), F.lit(reach_mz), wide)).withColumn("__t", reach(F.col("rt"), F.lit(reach_rt), long))
    at = [*RUN, "__m", "__t"]
    left, right = deal(left, right, at, ["__by"], ["group_id"], FRAGMENTED)
    kept = left.select(*RUN, "n_peaks", "tic", "art").schema.fields
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in [*kept, T.StructField("evidence", T.StringType()), T.StructField("n", T.LongType())]])
    run = kernels.spectra_on_groups(ppm, rt_tol, [f.name for f in kept], to_arrow_schema(schema))
    at = [*at, "__s", "__l"]
    rows = next_round(apart(left, *at).groupBy(*at).cogroup(apart(right, *at).groupBy(*at)).applyInArrow(run, schema))
    keys = [*RUN, "evidence"]
    middles = quantiles(rows, keys, {"median_tic": (F.col("tic"), 0.5), "median_peaks": (F.col("n_peaks"), 0.5),
                                     "artefact_share": (F.col("art") / F.col("tic"), 0.5)}, F.col("n"))
    return rows.groupBy(*keys).agg(F.sum("n").alias("spectra")).join(middles, keys, "left")


def _sum_names(rows: DataFrame) -> DataFrame:
    return rows.filter("name IS NOT NULL AND trim(name) <> ''").withColumn("sum_name", N.sum_composition(F.trim("name")))


def trace_missing(reference: DataFrame, ours: DataFrame, unfiltered: DataFrame, hits: DataFrame, mz_tol: float = 0.01, rt_tol: float = 0.5) -> DataFrame:
    """Stage at which each reference molecule missing from ``ours`` was lost.

    filtered (with its reason) / identified, no feature / named differently / never fragmented.
    ``reference`` and ``unfiltered`` carry name, mz, rt; ``unfiltered`` also reason; ``hits`` name.
    """
    have = _sum_names(ours).select(*RUN, "sum_name").distinct()
    first = _sum_names(reference).groupBy(*RUN, "sum_name").agg(F.min_by(F.struct("mz", "rt"), "group_id").alias("p")).select(*RUN, "sum_name", "p.mz", "p.rt")
    gone = first.join(have, [*RUN, "sum_name"], "left_anti")
    near = band_join(_sum_names(unfiltered).select(*RUN, F.col("sum_name").alias("u_sum"), F.col("name").alias("u_name"), F.col("group_id").alias("u_id"),
                                                   F.coalesce("reason", F.lit("")).alias("u_reason"), F.col("mz").alias("u_mz"), F.col("rt").alias("u_rt")),
                     gone, [Band("u_mz", "mz", mz_tol), Band("u_rt", "rt", rt_tol)], keys=RUN)
    same = near.filter("u_sum = sum_name").groupBy(*RUN, "sum_name").agg(F.max_by("u_reason", "u_id").alias("u_reason"))
    other = near.filter("u_sum <> sum_name").groupBy(*RUN, "sum_name").agg(F.min_by("u_name", "u_id").alias("u_name"))
    seen = _sum_names(hits.withColumn("name", N.lipid_name(F.col("name")))).select(*RUN, "sum_name").distinct().withColumn("seen", F.lit(True))
    out = gone.join(same, [*RUN, "sum_name"], "left").join(other, [*RUN, "sum_name"], "left").join(seen, [*RUN, "sum_name"], "left")
    verdict = (F.when(F.col("u_reason").isNotNull(), F.concat(F.lit("filtered: "), F.when(F.col("u_reason") == "", "kept").otherwise(F.col("u_reason"))))
               .when(F.col("seen"), "identified, no feature").when(F.col("u_name").isNotNull(), F.concat(F.lit("named differently: "), "u_name"))
               .otherwise("never fragmented"))
    return out.select(*RUN, "sum_name", verdict.alias("verdict"))


def compare_results(ours: DataFrame, reference: DataFrame) -> DataFrame:
    """Per run and class (null: all): molecules and exact names on each side and shared."""
    def side(df: DataFrame, flag: str, exact: bool) -> DataFrame:
        rows = _sum_names(df)
        key = F.trim("name") if exact else F.col("sum_name")
        return rows.select(*RUN, F.lit("exact" if exact else "molecule").alias("level"), key.alias("k")).distinct().withColumn(flag, F.lit(True))

    both = None
    for exact in (False, True):
        j = side(ours, "o", exact).join(side(reference, "r", exact), [*RUN, "level", "k"], "full")
        both = j if both is None else both.unionByName(j)
    both = both.withColumn("lipid_class", N.head(F.col("k")))
    return both.groupingSets([["study_id", "polarity", "level", "lipid_class"], ["study_id", "polarity", "level"]], "study_id", "polarity", "level", "lipid_class").agg(
        F.count("o").alias("ours"), F.count("r").alias("reference"), F.count_if(F.col("o") & F.col("r")).alias("shared"))


def recovery_split(reference: DataFrame, ours: DataFrame, standard_prefix: str = "D5TG") -> DataFrame:
    """Reference molecules per run: recovered, spiked standard, found in the other polarity, absent."""
    mine = _sum_names(ours).filter(~F.upper("name").startswith("DECOY")).select("study_id", "polarity", "sum_name").distinct()
    here = mine.withColumn("here", F.lit(True))
    there = mine.withColumn("polarity", F.when(F.col("polarity") == "+", "-").otherwise("+")).withColumn("there", F.lit(True))
    rows = _sum_names(reference).select(*RUN, "sum_name").distinct().join(here, [*RUN, "sum_name"], "left").join(there, [*RUN, "sum_name"], "left")
    fate = (F.when(F.col("here"), "recovered").when(F.col("sum_name").startswith(standard_prefix), "standard").when(F.col("there"), "other polarity").otherwise("absent"))
    return rows.groupBy(*RUN, fate.alias("fate")).agg(F.count(F.lit(1)).alias("molecules"))


def published_names(names: DataFrame) -> DataFrame:
    """Published names without internal standards and UNKNOWN placeholders."""
    return names.filter(~F.col("name").rlike(N.INTERNAL_STANDARD_PATTERN) & ~F.upper("name").startswith("UNKNOWN") & (F.trim("name") != ""))


def list_agreement(published: DataFrame, ours: DataFrame) -> DataFrame:
    """Per study: species and molecular keys published, ours and shared; null shares when nothing was
    published (which is not 0 %)."""
    def keys(df: DataFrame, flag: str) -> DataFrame:
        k = df.select("study_id", N.comparison_keys(F.col("name")).alias("k"))
        long = k.select("study_id", F.explode(F.array(F.struct(F.lit("molecular").alias("level"), F.col("k.molecular").alias("key")),
                                                     F.struct(F.lit("species").alias("level"), F.col("k.species").alias("key")))).alias("e")).select("study_id", "e.*")
        return long.filter("key <> ''").distinct().withColumn(flag, F.lit(True))

    both = keys(published_names(published), "p").join(keys(ours.filter(~F.upper("name").startswith("DECOY")), "o"), ["study_id", "level", "key"], "full")
    out = both.groupBy("study_id", "level").agg(F.count("p").alias("published"), F.count("o").alias("ours"), F.count_if(F.col("p") & F.col("o")).alias("shared"))
    return (out.withColumn("of_theirs", F.when(F.col("published") > 0, 100 * F.col("shared") / F.col("published")))
            .withColumn("of_ours", F.when(F.col("ours") > 0, 100 * F.col("shared") / F.col("ours")))
            .withColumn("status", F.when(F.col("published") == 0, "no names deposited").otherwise("ok")))


def species_table(groups: DataFrame) -> DataFrame:
    """One row per species key: the MS2 row before the model row, then the larger area."""
    rows = _sum_names(groups).filter(~F.upper("name").startswith("DECOY")).withColumn("k", N.family_key(F.col("sum_name"))).select(
        "study_id", "polarity", "name", "source", "area", "cv", "k.family", "k.kind", "k.carbons", "k.double_bonds")
    key = ["study_id", "family", "kind", "carbons", "double_bonds"]
    best = rows.groupBy(*key).agg(F.max_by(F.struct("name", "source", "area", "cv", "polarity"), F.struct((F.col("source") == "MS2").alias("m"), "area")).alias("b"))
    return best.select(*key, "b.*")


def consensus_score(species: DataFrame, consensus: DataFrame, in_scope: list[str]) -> tuple[DataFrame, DataFrame]:
    """Recall by tier and family (an entry is found through any isobaric alternative), and the share of
    our species in covered families that any list holds.

    ``consensus``: grp, tier, family, kind, carbons, double_bonds, value.
    """
    key = ["family", "kind", "carbons", "double_bonds"]
    studies = species.select("study_id").distinct()
    entries = consensus.groupBy("grp", "tier").agg(F.max(F.when(F.col("kind") != "other", F.col("family"))).alias("entry_family")).filter(
        F.col("entry_family").isin(in_scope))
    found = (consensus.join(species.select("study_id", *key, "source"), key).groupBy("study_id", "grp", "tier")
             .agg(F.max(F.col("source") == "MS2").alias("ms2")))
    # one row per entry and study: the studies scored ride along as a small array, not as a product
    ids = studies.agg(F.collect_set("study_id").alias("s"))
    base = entries.withColumn("s", ids.scalar()).withColumn("study_id", F.explode("s")).drop("s")
    scored = base.join(found, ["study_id", "grp", "tier"], "left")
    recall = scored.groupBy("study_id", "tier", "entry_family").agg(F.count(F.lit(1)).alias("entries"), F.count_if(F.coalesce("ms2", F.lit(False))).alias("ms2"), F.count("ms2").alias("any_source"))
    listed = consensus.filter("kind <> 'other'").select(*key).distinct().withColumn("listed", F.lit(True))
    covered = consensus.filter("kind <> 'other'").select("family").distinct()
    precision = (species.join(covered, "family", "left_semi").join(listed, key, "left").groupBy("study_id", "family", "source")
                 .agg(F.count(F.lit(1)).alias("species"), F.count("listed").alias("listed")))
    return recall, precision


def consensus_quant(species: DataFrame, consensus: DataFrame, least: int = 5) -> DataFrame:
    """Within-family Spearman of consensus value and our area over matched MS2 species."""
    key = ["family", "kind", "carbons", "double_bonds"]
    pts = consensus.filter("tier = 'Ref'").join(species.filter("source = 'MS2' AND area > 0").select("study_id", *key, "area", "polarity"), key)
    per = pts.groupBy("study_id", "family", "polarity").agg(F.count(F.lit(1)).alias("n"))
    pol = per.groupBy("study_id", "family").agg(F.max_by("polarity", F.struct("n", "polarity")).alias("polarity"))
    kept = pts.join(pol, ["study_id", "family", "polarity"])
    return spearman(kept, ["study_id", "family"], "value", "area", "rho", "n").filter(F.col("n") >= least)


def miss_reasons(published: DataFrame, ours: DataFrame, library: DataFrame, floors: dict[str, int], run_polarities: DataFrame, void: float = 1.0) -> DataFrame:
    """Why a published species is not reported: impossible / void / class absent / species absent /
    wrong polarity / not detected.  ``published`` may carry rt; ``library``: name, polarity."""
    spec = lambda df: df.withColumn("species", N.comparison_keys(F.col("name"))["species"]).filter("species <> ''")
    missing = spec(published_names(published)).groupBy("study_id", "species").agg(F.min("rt").alias("rt")).join(
        spec(ours).select("study_id", "species").distinct(), ["study_id", "species"], "left_anti")
    lib = spec(library.select(N.library_lipid(F.col("name")).alias("name"), "polarity")).withColumn("cls", F.substring_index(N.head(F.col("species")), "[", 1))
    classes = lib.select("cls").distinct().withColumn("has_class", F.lit(True))
    held = lib.select("species").distinct().withColumn("has_species", F.lit(True))
    right = lib.join(run_polarities, "polarity").select("study_id", "species").distinct().withColumn("right_polarity", F.lit(True))
    rows = (missing.withColumn("cls", F.substring_index(N.canonical_class(N.head(F.col("species"))), "[", 1)).join(classes, "cls", "left")
            .join(held, "species", "left").join(right, ["study_id", "species"], "left"))
    least = F.create_map(*[F.lit(x) for kv in floors.items() for x in kv])[F.col("cls")]
    carbons = F.regexp_extract("species", r"^\S+ (\d+):\d+", 1)
    reason = (F.when((carbons != "") & (carbons.cast("int") < least), "chemically impossible").when(F.col("rt") <= void, "void")
              .when(F.col("has_class").isNull(), "class absent").when(F.col("has_species").isNull(), "species absent")
              .when(F.col("right_polarity").isNull(), "wrong polarity").otherwise("not detected"))
    return rows.select("study_id", "species", reason.alias("reason"))


def quant_agreement(ours: DataFrame, reference: DataFrame, least: int = 5) -> DataFrame:
    """Per molecule: Pearson of log10 areas and median area ratio over paired samples.

    Both tables: study_id, name, sample, area.  Rows sharing a composition are combined by median.
    """
    def table(df: DataFrame, col: str) -> DataFrame:
        return _sum_names(df).filter(~F.upper("name").startswith("DECOY")).groupBy("study_id", "sum_name", "sample").agg(F.median("area").alias(col))

    both = table(ours, "b").join(table(reference, "a"), ["study_id", "sum_name", "sample"]).filter("a > 0 AND b > 0")
    return both.groupBy("study_id", "sum_name").agg(F.count(F.lit(1)).alias("n"), F.corr(F.log10("a"), F.log10("b")).alias("r"),
                                                    F.median(F.col("b") / F.col("a")).alias("ratio")).filter((F.col("n") >= least) & F.col("r").isNotNull())


def rt_agreement(ours: DataFrame, published: DataFrame, limit: float = 0.5) -> DataFrame:
    """Per study: retention differences to a published list by species, and how well the model's own
    flag (|z| >= 2) predicts them.  ``ours`` may carry rt_z."""
    k = lambda df: df.withColumn("species", N.comparison_keys(F.col("name"))["species"]).filter("species <> '' AND rt IS NOT NULL")
    p = k(published).groupBy("study_id", "species").agg(F.median("rt").alias("there"))
    o = k(ours).groupBy("study_id", "species").agg(F.min_by(F.struct("rt", "rt_z"), "group_id").alias("x")).select("study_id", "species", "x.*")
    d = o.join(p, ["study_id", "species"]).withColumn("d", F.abs(F.col("rt") - F.col("there")))
    bad, flagged = F.col("d") > limit, F.abs("rt_z") >= 2
    return d.groupBy("study_id").agg(F.count(F.lit(1)).alias("shared"), F.median("d").alias("median_gap"), F.max("d").alias("max_gap"), F.avg((~bad).cast("int")).alias("within"),
                                     F.count_if(flagged).alias("flagged"), F.count_if(flagged & bad).alias("flagged_bad"), F.count_if(~flagged).alias("clean"), F.count_if(~flagged & bad).alias("clean_bad"))


def coisolation(groups: DataFrame, volume: float = 15.0, mz: float = 1.0) -> DataFrame:
    """Identified neighbours inside the isolation window at the same elution volume, per group.

    Neighbours are counted in blocks of both axes; a pair is never a row.

    ``groups`` carries ev (elution volume).
    """
    a = groups.select(*GROUP, "mz", "ev")
    b = groups.select(*RUN, F.col("group_id").alias("n_id"), F.col("mz").alias("n_mz"), F.col("ev").alias("n_ev"))
    reach = lambda c, tol: F.explode(F.sequence(F.floor((F.col(c) - tol) / (2 * tol) - 1e-6), F.floor((F.col(c) + tol) / (2 * tol) + 1e-6)))
    at = [*RUN, "__m", "__e"]
    left = a.filter("mz IS NOT NULL AND ev IS NOT NULL").withColumn("__m", F.floor(F.col("mz") / (2 * mz))).withColumn("__e", F.floor(F.col("ev") / (2 * volume)))
    right = b.filter("n_mz IS NOT NULL AND n_ev IS NOT NULL").withColumn("__m", reach("n_mz", mz)).withColumn("__e", reach("n_ev", volume))
    left, right = deal(left, right, at, ["group_id"], ["n_id"], COISOLATED)
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in [*left.select(*GROUP).schema.fields, T.StructField("neighbours", T.LongType())]])
    run = kernels.neighbours({("mz", "n_mz"): mz, ("ev", "n_ev"): volume}, ("group_id", "n_id"), GROUP, to_arrow_schema(schema))
    at = [*at, "__s", "__l"]
    counts = left.groupBy(*at).cogroup(right.groupBy(*at)).applyInArrow(run, schema).groupBy(*GROUP).agg(F.sum("neighbours").alias("neighbours"))
    return a.select(*GROUP).join(spread(counts), GROUP, "left").na.fill(0, ["neighbours"])


def method_summary(groups: DataFrame, run_minutes: float) -> DataFrame:
    """Elution window (1st to 99th percentile), density, median gap and co-isolated share per run."""
    order = Window.partitionBy(*RUN).orderBy("ev")  # one run's identified rows
    gaps = groups.withColumn("gap", F.col("ev") - F.lag("ev").over(order))
    rt, ev = F.col("rt"), F.col("ev")
    ends = quantiles(gaps, RUN, {"rt_low": (rt, 0.01), "rt_high": (rt, 0.99), "ev_low": (ev, 0.01), "ev_high": (ev, 0.99), "median_gap_ul": (F.col("gap"), 0.5)})
    base = gaps.groupBy(*RUN).agg(F.count(F.lit(1)).alias("n")).join(ends, RUN, "left").select(
        *RUN, "n", (F.col("rt_high") - F.col("rt_low")).alias("window_min"), (F.col("ev_high") - F.col("ev_low")).alias("window_ul"), "median_gap_ul")
    near = coisolation(groups)
    co = near.groupBy(*RUN).agg((100 * F.avg((F.col("neighbours") > 0).cast("int"))).alias("pct_coisolated"), F.avg("neighbours").alias("mean_neighbours"))
    co = co.join(quantiles(near, RUN, {"median_neighbours": (F.col("neighbours"), 0.5)}), RUN, "left")
    return base.join(co, RUN).withColumn("pct_of_run", 100 * F.col("window_min") / run_minutes).withColumn("ids_per_ml", 1000 * F.col("n") / F.col("window_ul"))


def resolution_at_risk(ions: DataFrame, low: float = 60000, high: float = 120000, isotopes: int = 2) -> DataFrame:
    """Pairs of differently named ions resolved at ``high`` but not at ``low`` resolving power (at m/z
    200), isotope peaks included.  ``ions``: polarity, name, mz (one row per library ion)."""
    one = ions.withColumn("r", F.round("mz", 4)).groupBy("polarity", "name", "r").agg(F.min("mz").alias("mz")).drop("r")
    grid = isotope_ions(one, "mz", isotopes)
    a = grid.select("polarity", F.col("name").alias("name_a"), F.col("isotope").alias("iso_a"), F.col("mz").alias("mz_a")).withColumn("reach", peak_width(F.col("mz_a"), low))
    b = grid.select("polarity", F.col("name").alias("name_b"), F.col("isotope").alias("iso_b"), F.col("mz").alias("mz_b"))
    pairs = band_join(b, a, [Band("mz_b", "mz_a", "reach", width=0.02)], keys=["polarity"], where="mz_b > mz_a AND name_a <> name_b", salt=2)
    return pairs.filter((F.col("mz_b") - F.col("mz_a")) > peak_width(F.col("mz_a"), high)).select(
        "polarity", "mz_a", "name_a", "iso_a", "name_b", "iso_b", (F.col("mz_b") - F.col("mz_a")).alias("delta"))


def at_risk_coeluting(pairs: DataFrame, observed: DataFrame, window: float = 0.07) -> DataFrame:
    """At-risk pairs whose lipids were both observed within ``window`` minutes.  ``observed``: polarity, name, rt."""
    bare = lambda c: F.regexp_replace(c, r"\s*\[M[^\]]*\][+-]\d*\s*;?\s*$", "")
    keyed = pairs.withColumn("ka", bare(F.col("name_a"))).withColumn("kb", bare(F.col("name_b")))
    o = observed.select("polarity", bare(F.trim("name")).alias("k"), "rt").distinct()
    a = keyed.select("polarity", "ka", "kb").distinct().join(o.select("polarity", F.col("k").alias("ka"), F.col("rt").alias("rt_a")), ["polarity", "ka"])
    b = o.select("polarity", F.col("k").alias("kb"), F.col("rt").alias("rt_b"))
    near = band_join(a, b, [Band("rt_a", "rt_b", window)], keys=["polarity", "kb"]).select("polarity", "ka", "kb").distinct()
    return keyed.join(near, ["polarity", "ka", "kb"], "left_semi").drop("ka", "kb")


def paired_methods(scans: DataFrame, exclusion: DataFrame, rows: DataFrame) -> DataFrame:
    """Per arm: MS2 scans, share on an excluded mass (10 ppm), confirmed rows, delivered rows, molecules.

    ``scans``: arm, polarity, precursor_mz; ``exclusion``: polarity, ex_mz; ``rows``: arm, polarity, name, source.
    """
    hit = band_exists(scans, exclusion, Band("precursor_mz", "ex_mz", 10.0, "ppm", base="left"), "on_list", ["polarity"])
    s = hit.groupBy("arm", "polarity").agg(F.count(F.lit(1)).alias("ms2_scans"), F.avg(F.col("on_list").cast("int")).alias("on_excluded_mass"))
    ms2 = F.coalesce(F.col("source"), F.lit("")) == "MS2"
    r = _sum_names(rows).filter(~F.upper("name").startswith("DECOY")).groupBy("arm", "polarity").agg(
        F.count_if(ms2).alias("confirmed"), F.count(F.lit(1)).alias("delivered"), F.count_distinct(F.when(ms2, F.col("sum_name"))).alias("molecules"))
    return s.join(r, ["arm", "polarity"], "left").na.fill(0, ["confirmed", "delivered", "molecules"])


"""Library construction: decoys, screens, hold-outs, enumeration from recipes, imports.

``library`` as in ``search``: name, precursor_mz, peaks<mz, intensity, annotation, type, chain>.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from massloom.functions import names as N
from massloom.functions.ions import max_double_bonds
from massloom.operators import kernels
from massloom.operators.band import deal

CH2, HEAD_SHIFT = 14.015650, 6.3721
MS1_TOL = MS2_TOL = 0.01
#: Decoys, and targets, of one block of the screen.
SCREENED = 256
_ONE = r"([dtmDTM]|[OPop]-)?(\d+):(\d+)"
_CHAINS = r"_\[((?:[dtmDTM]|[OPop]-)?\d+:\d+(?:,\s*(?:[dtmDTM]|[OPop]-)?\d+:\d+)*)\]\s*$"


def chain_text(annotation: Column) -> Column:
    """The chains an annotation names (``14:0, 16:1``), empty when it names none."""
    return F.regexp_extract(F.coalesce(annotation, F.lit("")), _CHAINS, 1)


def shift_chains(text: Column, shift: int) -> Column:
    """``d18:1, 16:0`` with every chain ``shift`` carbons longer, prefixes kept."""
    parts = F.transform(F.split(text, r",\s*"), lambda p: F.concat(
        F.regexp_extract(p, _ONE, 1), (F.regexp_extract(p, _ONE, 2).cast("int") + shift).cast("string"), F.lit(":"), F.regexp_extract(p, _ONE, 3)))
    return F.array_join(parts, ", ")


def _decoy_name(name: Column) -> Column:
    return F.concat(F.lit("DECOY_ "), name)


def make_decoys(library: DataFrame, shift: int = 3) -> DataFrame:
    """Decoy of each entry with chain peaks: every chain peak moves by CH2 x ``shift`` per chain it
    names and is relabelled; precursor and other peaks stay so that it competes."""
    def move(p: Column) -> Column:
        chains = chain_text(p["annotation"])
        count = F.size(F.split(chains, ","))
        moved = shift_chains(chains, shift)
        label = F.concat(F.regexp_replace(p["annotation"], _CHAINS, ""), F.lit("_["), moved, F.lit("]"))
        return F.when(chains == "", p).otherwise(
            p.withField("mz", F.round(p["mz"] + count * F.lit(shift * CH2), 4)).withField("annotation", label).withField("chain", moved))

    has = F.exists("peaks", lambda p: chain_text(p["annotation"]) != "")
    return library.filter(has).withColumn("peaks", F.transform("peaks", move)).withColumn("name", _decoy_name(F.col("name")))


def head_group_decoys(library: DataFrame, shift: float = HEAD_SHIFT) -> DataFrame:
    """Decoy of each entry without chain peaks: every peak displaced by an impossible mass."""
    none = ~F.exists("peaks", lambda p: chain_text(p["annotation"]) != "")
    moved = F.transform("peaks", lambda p: p.withField("mz", F.round(p["mz"] + F.lit(shift), 4)))
    return library.filter(none & (F.size("peaks") > 0)).withColumn("peaks", moved).withColumn("name", _decoy_name(F.col("name")))


def _asserted(name: Column) -> Column:
    """Distinct chains a name asserts, sorted."""
    body = N.tail(N.bare_name(F.regexp_replace(name, "^DECOY_ ?", "")))
    return F.array_sort(F.array_distinct(F.filter(F.split(body, "_"), lambda c: c.contains(":"))))


def _chain_masses(peaks: str) -> Column:
    return F.transform(F.filter(peaks, lambda p: chain_text(p["annotation"]) != ""), lambda p: p["mz"])


def screen_decoys(decoys: DataFrame, targets: DataFrame) -> DataFrame:
    """Decoys a real entry at the same precursor cannot be told from: ``name, target, rule``.

    ``same-composition`` (the shifted fragments assert the target's chains), ``decoy-in-target`` and
    ``target-in-decoy`` (chain peaks contained either way).  A decoy without chain peaks never
    collides.  The first target by name and the first rule that applies are reported, also where several entries
    have that name.  Decoys and targets meet in blocks, and a block leaves one target a decoy.
    """
    asserted = F.array_sort(F.array_distinct(F.flatten(F.transform(F.filter("peaks", lambda p: chain_text(p["annotation"]) != ""),
                                                                   lambda p: F.split(chain_text(p["annotation"]), r",\s*")))))
    d = decoys.select("name", "precursor_mz", _chain_masses("peaks").alias("d_mz"), asserted.alias("d_comp")).filter(F.size("d_mz") > 0)
    t = targets.select(F.col("name").alias("target"), F.col("precursor_mz").alias("t_prec"), _chain_masses("peaks").alias("t_mz"), _asserted(F.col("name")).alias("t_comp"))
    width = 2 * MS1_TOL
    edge = lambda side: F.floor((F.col("t_prec") + side * MS1_TOL) / width + side * 1e-6)
    # equal rows collide alike; those left differ in what deals them to blocks
    d = d.filter("precursor_mz IS NOT NULL").distinct().withColumn("__bin", F.floor(F.col("precursor_mz") / width))
    t = t.filter("t_prec IS NOT NULL").distinct().withColumn("__bin", F.explode(F.sequence(edge(-1), edge(1))))
    d, t = deal(d, t, ["__bin"], ["name", "precursor_mz", "d_mz"], ["target", "t_prec", "t_mz"], SCREENED)
    schema = T.StructType([T.StructField("name", T.StringType()), T.StructField("target", T.StringType()), T.StructField("place", T.LongType())])
    at = ["__bin", "__s", "__l"]
    hit = d.groupBy(*at).cogroup(t.groupBy(*at)).applyInArrow(kernels.collisions(MS1_TOL, MS2_TOL, to_arrow_schema(schema)), schema)
    rules = F.array(*[F.lit(r) for r in ("same-composition", "decoy-in-target", "target-in-decoy")])
    first = hit.groupBy("name").agg(F.min(F.struct("target", "place")).alias("h"))
    return first.select("name", "h.target", F.get(rules, F.col("h.place").cast("int")).alias("rule"))


def infer_chain_peaks(library: DataFrame, tol: float = 0.01) -> DataFrame:
    """Chain-specific peaks of unannotated entries, from homologues one CH2 apart: ``name, moved``.

    A peak is chain-specific when the entry one carbon shorter in exactly one chain (equal double
    bonds, same class) has it CH2 lighter and not at the same mass.  Entries pair by an equi-join on
    class, double bonds and the carbons left after removing one.
    """
    pairs = N.chain_pairs(N.tail(N.bare_name(F.col("name"))))
    base = library.select("name", N.head(N.bare_name(F.col("name"))).alias("cls"), pairs.alias("c"), F.col("peaks.mz").alias("mz")).filter("size(c) > 0 AND size(mz) > 0")
    longer = base.withColumn("at", F.explode(F.sequence(F.lit(0), F.size("c") - 1))).select(
        "name", "cls", "mz", F.transform("c", lambda x, i: F.when(i == F.col("at"), F.concat(
            (F.substring_index(x, ":", 1).cast("int") - 1).cast("string"), F.lit(":"), F.substring_index(x, ":", -1))).otherwise(x)).alias("key"))
    shorter = base.select(F.col("name").alias("other"), "cls", F.col("mz").alias("other_mz"), F.col("c").alias("key"))
    rows = longer.join(shorter, ["cls", "key"])
    moved = F.filter("mz", lambda m: F.exists("other_mz", lambda o: F.abs(m - o - CH2) < tol) & ~F.exists("other_mz", lambda o: F.abs(m - o) < tol))
    rows = rows.withColumn("moved", F.transform(moved, lambda m: F.round(m, 4))).filter("size(moved) > 0")
    return rows.groupBy("name").agg(F.min_by("moved", "other").alias("moved"))


def unannotated_decoys(library: DataFrame, shift: int = 3, tol: float = 0.01) -> DataFrame:
    """Decoys of unannotated entries: inferred chain peaks moved, everything else kept."""
    rows = library.join(infer_chain_peaks(library, tol), "name")
    step = F.lit(shift * CH2)
    peaks = F.transform("peaks", lambda p: F.when(F.exists("moved", lambda m: m == F.round(p["mz"], 4)),
                                                  p.withField("mz", F.round(p["mz"] + step, 4))).otherwise(p))
    return rows.withColumn("peaks", peaks).withColumn("name", _decoy_name(F.col("name"))).drop("moved")


def holdout(library: DataFrame, held: DataFrame) -> DataFrame:
    """Library without every species that could produce a held-out name (matched on composition)."""
    keys = held.select(N.composition_key(F.col("name")).alias("k")).distinct()
    return library.withColumn("k", N.composition_key(F.col("name"))).join(keys, "k", "left_anti").drop("k")


def import_class(atlas: DataFrame, pattern: str, rename: tuple[str, str] | None = None, min_peaks: int = 3) -> DataFrame:
    """Entries of one class of a public atlas in this library's spelling.

    ``;2O`` becomes ``;O2``, chains in parentheses and after a slash become ``_`` separated, thin
    entries are dropped.  ``atlas`` carries compound_class.
    """
    rows = atlas.filter(F.col("compound_class").rlike(f"^({pattern})$") & (F.size("peaks") >= min_peaks))
    name = F.col("name")
    if rename:
        name = F.regexp_replace(name, f"^{rename[0]} ", f"{rename[1]} ")
    name = F.regexp_replace(name, r";(\d)O\b", ";O$1")
    name = F.regexp_replace(name, r"\((?:O-|FA )?(\d+:\d+)\)", "_$1_")
    name = F.regexp_replace(F.regexp_replace(F.replace(name, F.lit("/"), F.lit("_")), "_+", "_"), " _", " ")
    return rows.withColumn("name", F.regexp_replace(name, r"_+(\s|$)", "$1"))


def enumerate_library(recipes: DataFrame, held: DataFrame | None = None) -> DataFrame:
    """Entries of every recipe: carbon x double-bond grid (x chain pairs), precursor and fragments.

    ``recipes``: lipid_class, adduct, n_chains (1 or 2), c_min, c_max, db_max, base_mass (neutral
    mass with no chain attached), chain_mass (mass added per chain beside CH2 and H2 terms),
    adduct_mass, losses array<struct<loss double, intensity double, annotation string>> (constant
    neutral losses), chain_loss (mass lost with one chain's acid, null for none).
    Chains follow the methylene-interrupted ceiling of double bonds; compositions in ``held`` (name
    without adduct) are skipped.
    """
    c12, h1 = 12.0, 1.0078250319
    chain = lambda c, d: c * F.lit(c12) + (2 * c - 2 * d) * F.lit(h1)
    grid = recipes.withColumn("c1", F.explode(F.sequence("c_min", "c_max")))
    grid = grid.withColumn("d1", F.explode(F.sequence(F.lit(0), F.least("db_max", max_double_bonds(F.col("c1"))))))
    second = F.when(F.col("n_chains") == 2, F.sequence("c1", "c_max")).otherwise(F.array(F.lit(0)))
    grid = grid.withColumn("c2", F.explode(second))
    grid = grid.withColumn("d2", F.explode(F.when(F.col("n_chains") == 2, F.sequence(F.lit(0), F.least("db_max", max_double_bonds(F.col("c2"))))).otherwise(F.array(F.lit(0)))))
    grid = grid.filter((F.col("n_chains") == 1) | (F.col("c2") > F.col("c1")) | (F.col("d2") >= F.col("d1")))
    one = F.concat(F.col("c1").cast("string"), F.lit(":"), F.col("d1").cast("string"))
    two = F.concat(F.col("c2").cast("string"), F.lit(":"), F.col("d2").cast("string"))
    grid = grid.withColumn("chains", F.when(F.col("n_chains") == 2, F.array(one, two)).otherwise(F.array(one)))
    grid = grid.withColumn("lipid", F.concat("lipid_class", F.lit(" "), F.array_join("chains", "_")))
    mass = (F.col("base_mass") + chain(F.col("c1"), F.col("d1")) + F.col("chain_mass")
            + F.when(F.col("n_chains") == 2, chain(F.col("c2"), F.col("d2")) + F.col("chain_mass")).otherwise(0.0))
    grid = grid.withColumn("neutral_mass", mass).withColumn("precursor_mz", F.col("neutral_mass") + F.col("adduct_mass"))
    if held is not None:
        grid = grid.join(held.select(F.col("name").alias("lipid")).distinct(), "lipid", "left_anti")
    peak = lambda mz, i, a, c: F.struct(mz.alias("mz"), i.cast("double").alias("intensity"), a.alias("annotation"), c.alias("chain"))
    fixed = F.transform("losses", lambda x: peak(F.col("precursor_mz") - x["loss"], x["intensity"], x["annotation"], F.lit("")))
    per_chain = F.transform(F.array_distinct("chains"), lambda c: peak(
        F.col("precursor_mz") - F.col("chain_loss") - chain(F.substring_index(c, ":", 1).cast("int"), F.substring_index(c, ":", -1).cast("int")),
        F.lit(999.0), F.concat(F.lit("Alkyl Neutral Loss_["), c, F.lit("]")), c))
    peaks = F.concat(fixed, F.when(F.col("chain_loss").isNotNull(), per_chain).otherwise(F.filter(per_chain, lambda p: F.lit(False))))
    kept = F.filter(peaks, lambda p: p["mz"] < F.col("precursor_mz") - 2.0)
    return grid.select(F.concat("lipid", F.lit(" "), "adduct").alias("name"), "lipid", "lipid_class", "precursor_mz", kept.alias("peaks"))


def verify_enumeration(enumerated: DataFrame, held: DataFrame, tol: float = 0.001) -> DataFrame:
    """Disagreements between enumerated and held entries of the same name: precursor, or a fragment
    the held entry does not have.  Nothing is returned when the rule reproduces them."""
    rows = enumerated.select("name", F.col("precursor_mz").alias("mine"), F.col("peaks.mz").alias("my_peaks")).join(
        held.select("name", F.col("precursor_mz").alias("theirs"), F.col("peaks.mz").alias("their_peaks")), "name")
    off = F.abs(F.col("mine") - F.col("theirs")) > tol
    lost = F.filter("my_peaks", lambda m: ~F.exists("their_peaks", lambda t: F.abs(m - t) <= tol))
    rows = rows.withColumn("problem", F.when(off, "precursor").when(F.size(lost) > 0, "fragment")).withColumn("missing", F.when(off, F.array().cast("array<double>")).otherwise(lost))
    return rows.filter("problem IS NOT NULL").select("name", "problem", "mine", "theirs", "missing")

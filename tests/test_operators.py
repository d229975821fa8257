"""Operators on hand-made cases and against brute force."""

import random
import time

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from massloom.functions import ions, names as N, peaks as P, roles
from massloom.operators import acquisition as A
from massloom.operators import calibrate as C
from massloom.operators import groups as G
from massloom.operators import kernels as K
from massloom.operators import library as L
from massloom.operators import matrix as M
from massloom.operators import polarity as PO
from massloom.operators import qc as Q
from massloom.operators import retention as R
from massloom.operators import scans as X
from massloom.operators import search as SE
from massloom.operators.band import Band, band_exists, band_join, components, islands

RUN = "study_id string, polarity string"


def one(spark, expr, **cols):
    df = spark.createDataFrame([tuple(cols.values())], list(cols))
    return df.select(expr.alias("x")).collect()[0]["x"]


# ---- band joins -------------------------------------------------------------------------------

@pytest.mark.parametrize("unit,tol,strict,salt", [("da", 0.25, False, 1), ("da", 0.25, True, 3), ("ppm", 2000.0, False, 2), ("ppm", 2000.0, True, 1)])
def test_band_join_matches_brute_force(spark, unit, tol, strict, salt):
    rng = random.Random(1)
    a = [(i % 2, round(rng.uniform(100, 110), 2)) for i in range(150)] + [(0, 100.0), (1, 105.25)]
    b = [(i % 2, round(rng.uniform(100, 110), 2)) for i in range(150)] + [(0, 100.25), (1, 105.0)]
    la = spark.createDataFrame([(i, *r) for i, r in enumerate(a)], "ia int, k int, x double")
    lb = spark.createDataFrame([(i, *r) for i, r in enumerate(b)], "ib int, k int, y double")
    gap = (lambda x, y: abs(x - y)) if unit == "da" else (lambda x, y: abs(x - y) / y * 1e6)
    ok = (lambda g: g < tol) if strict else (lambda g: g <= tol)
    want = sorted((i, j) for i, (k, x) in enumerate(a) for j, (q, y) in enumerate(b) if k == q and ok(gap(x, y)))
    band = Band("x", "y", tol, unit, strict)
    got = sorted((r["ia"], r["ib"]) for r in band_join(la, lb, [band], keys=["k"], salt=salt).collect())
    assert got == want
    flag = {r["ia"]: r["f"] for r in band_exists(la, lb, band, "f", ["k"]).collect()}
    assert {i for i, f in flag.items() if f} == {i for i, _ in want}
    semi = {r["ia"] for r in band_join(la, lb, [band], keys=["k"], how="left_semi").collect()}
    anti = {r["ia"] for r in band_join(la, lb, [band], keys=["k"], how="left_anti").collect()}
    assert semi == {i for i, _ in want} and anti == set(range(len(a))) - semi


def test_band_join_negative_values_and_no_rows(spark):
    a = spark.createDataFrame([(-0.05,), (0.05,)], "x double")
    b = spark.createDataFrame([(0.0,)], "y double")
    assert band_join(a, b, [Band("x", "y", 0.05)]).count() == 2
    assert band_join(a, b.limit(0), [Band("x", "y", 0.05)]).count() == 0


def test_hot_bin_stays_whole(spark):
    """A third of all rows in one bin: every pair is still produced, whatever the salt or partitions."""
    a = spark.range(900).select(F.when(F.col("id") < 300, 500.0).otherwise(F.col("id") * 1.0).alias("x"), F.col("id").alias("ia"))
    b = spark.range(30).select((F.lit(500.0) + F.col("id") * 0.0001).alias("y"), F.col("id").alias("ib"))
    want = band_join(a, b, [Band("x", "y", 0.01)]).count()
    assert want == 301 * 30
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    assert band_join(a, b, [Band("x", "y", 0.01)], salt=7).count() == want
    spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_islands(spark):
    rng = random.Random(2)
    x = sorted(round(rng.uniform(100, 101), 4) for _ in range(400))
    want, n = [], 0
    for i, v in enumerate(x):
        n += i == 0 or (v - x[i - 1]) / v * 1e6 > 20
        want.append(n)
    df = spark.createDataFrame([(v,) for v in x], "mz double")
    got = [r["cluster"] for r in islands(df, "mz", 20.0, "ppm").orderBy("mz").collect()]
    assert got == want


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, 101), (102, 101)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    assert all(got[i] == 1 for i in range(1, 41)) and got[102] == 100 and got[101] == 100


# ---- scores and purity ------------------------------------------------------------------------

def _walk(s, l, tol, reverse):
    """Two-pointer score written out peak by peak."""
    i = j = 0
    n = ls = ss = 0.0
    while i < len(l) or j < len(s):
        both = i < len(l) and j < len(s)
        if both and abs(s[j][0] - l[i][0]) <= tol:
            lw, sw = l[i][0] ** 0.9 * l[i][1] ** 1.2, s[j][0] ** 0.9 * s[j][1] ** 1.2
            n, ls, ss, i, j = n + lw * sw, ls + lw * lw, ss + sw * sw, i + 1, j + 1
        elif j >= len(s) or (both and l[i][0] < s[j][0]):
            ls += 0 if reverse else (0.9 * l[i][0] * l[i][1] ** 1.2) ** 2
            i += 1
        else:
            ss += 0 if reverse else (0.9 * s[j][0] * (s[j][1] / 2) ** 1.2) ** 2
            j += 1
    return 1000 * n * n / (ss * ls) if n > 0 else 0.0


def test_similarity_kernel():
    rng = np.random.default_rng(3)
    rows = []
    for _ in range(60):
        l = sorted((float(m), float(i)) for m, i in zip(rng.uniform(100, 102, rng.integers(0, 12)), rng.uniform(5, 999, 12)))
        s = sorted((float(m), float(i)) for m, i in zip(rng.uniform(100, 102, rng.integers(0, 12)), rng.uniform(5, 999, 12)))
        rows.append((s, l))
    rows.append((rows[0][1] or [(100.0, 5.0)], rows[0][1] or [(100.0, 5.0)]))
    off = lambda k: np.concatenate(([0], np.cumsum([len(r[k]) for r in rows]))).astype(np.int64)
    flat = lambda k, c: np.array([p[c] for r in rows for p in r[k]])
    f, b = K.similarity_scores(off(0), flat(0, 0), flat(0, 1), off(1), flat(1, 0), flat(1, 1), 0.1)
    for k, (s, l) in enumerate(rows):
        assert f[k] == pytest.approx(_walk(s, l, 0.1, False), rel=1e-9, abs=1e-9)
        assert b[k] == pytest.approx(_walk(s, l, 0.1, True), rel=1e-9, abs=1e-9)
    assert f[-1] == pytest.approx(1000.0)


def _entry(name, peaks, native=True):
    return {"name": name, "is_native": native, "peaks": [{"mz": m, "intensity": i, "type": t, "chain": c} for m, i, t, c in peaks]}


def test_purity_shares_and_missing_chain():
    base = {"16:0": ["Alkyl"], "18:1": ["Alkyl"], "18:0": ["Alkyl"], "16:1": ["Alkyl"]}
    kind = "O-1_Alkyl Fragment"
    a = _entry("PC 16:0_18:1 [M-H]-;", [(255.2, 900.0, kind, "16:0"), (281.2, 999.0, kind, "18:1")])
    b = _entry("PC 16:1_18:0 [M-H]-;", [(253.2, 900.0, kind, "16:1"), (283.2, 999.0, kind, "18:0")])
    mz, inten = [253.2, 255.2, 281.2, 283.2], [100.0, 300.0, 300.0, 100.0]
    assert K.purity_of(mz, inten, [a, b], base, 0.01)[:2] == (75, [("PC 16:0_18:1 [M-H]-;", 75), ("PC 16:1_18:0 [M-H]-;", 25)])
    assert K.purity_of([255.2], [300.0], [a], base, 0.01) == (0, [], [])  # one chain missing is fatal
    c = _entry("PC 16:0_18:1 [M-H]-;", [(255.2, 900.0, None, "16:0")])
    assert K.purity_of(mz, inten, [c], base, 0.01)[0] == 0  # an unannotated peak scores nothing


def test_purity_joins_only_rivals(spark):
    kind = "O-1_Alkyl Fragment"
    pair = lambda x, y: [(x[0], 900.0, "", kind, x[1]), (y[0], 999.0, "", kind, y[1])]
    rows = [("PC 16:0_18:1 [M-H]-;", 760.5, pair((255.2, "16:0"), (281.2, "18:1"))), ("PC 16:1_18:0 [M-H]-;", 760.5, pair((253.2, "16:1"), (283.2, "18:0"))),
            ("PC 16:1_18:0 [M+H]+;", 760.5, pair((253.2, "16:1"), (283.2, "18:0"))), ("PC 15:0_18:0 [M-H]-;", 760.503, pair((253.2, "16:1"), (283.2, "18:0"))),
            ("X 1:0 [M-H]-;", 400.0, pair((253.2, "16:1"), (283.2, "18:0"))), ("X 2:0 [M-H]-;", 900.0, pair((253.2, "16:1"), (283.2, "18:0")))]
    library = spark.createDataFrame([("l", 0, k, name, mz, True, True, peaks) for k, (name, mz, peaks) in enumerate(rows)],
                                    "library string, lib_rank int, entry_seq long, name string, precursor_mz double, is_native boolean, optimal_polarity boolean, "
                                    "peaks array<struct<mz double, intensity double, annotation string, type string, chain string>>")
    ms2 = spark.createDataFrame([("A", "-", "S", 1, 760.5, 1.0, [(253.2, 100.0), (255.2, 300.0), (281.2, 300.0), (283.2, 100.0)])],
                                f"{RUN}, injection string, ms2_id long, precursor_mz double, rt double, peaks array<struct<mz double, intensity double>>")
    chains = spark.createDataFrame([(c, "Alkyl") for c in ("16:0", "18:1", "18:0", "16:1")], "chain string, base string")
    got = SE.purity(ms2, library, chains).first()
    assert got["name"] == "PC 16:0_18:1 [M-H]-;" and got["purity"] == 75
    assert [tuple(c) for c in got["components"]] == [("PC 16:0_18:1 [M-H]-;", 75), ("PC 16:1_18:0 [M-H]-;", 25)]
    assert sorted(set(got["explained"])) == [253.2, 255.2, 281.2, 283.2]


def test_search_excludes_equal_tolerance_and_outer_precursors(spark):
    lib = [("L1", 500.0, 0), ("L2", 500.004, 1), ("L3", 600.0, 2), ("L0", 400.0, 3)]
    pk = [(100.0, 999.0), (150.0, 500.0)]
    library = spark.createDataFrame([("l", 0, s, n, m, True, True, [(a, b, "", None, "") for a, b in pk]) for n, m, s in lib],
                                    "library string, lib_rank int, entry_seq long, name string, precursor_mz double, is_native boolean, optimal_polarity boolean, "
                                    "peaks array<struct<mz double, intensity double, annotation string, type string, chain string>>")
    ms2 = spark.createDataFrame([("A", "+", "S", i, m, 1.0, pk) for i, m in enumerate([500.002, 500.012, 600.0, 400.0, 700.0])],
                                f"{RUN}, injection string, ms2_id long, precursor_mz double, rt double, peaks array<struct<mz double, intensity double>>")
    got = {r["ms2_id"]: r["name"] for r in SE.search(ms2, library).collect()}
    # equal scores: lower fine bin first; precursors on the ends of the library range are not searched
    assert got == {0: "L1", 1: "L2"}
    assert SE.search(ms2, library, max_results=5).filter("ms2_id = 0").count() == 2


# ---- names ------------------------------------------------------------------------------------

@pytest.mark.parametrize("name,want", [("PC 16:0_18:1", "PC 34:1"), ("SM d18:1_16:0", "SM d34:1"), ("TG 16:0_18:1_18:2", "TG 52:3"),
                                       ("FAHFA 18:1-(O-18:0)", "FAHFA 18:1-(O-18:0)"), ("Plasmenyl-PE P-18:0_20:4", "Plasmenyl-PE P-38:4"), ("Cholesterol", "Cholesterol")])
def test_sum_composition(spark, name, want):
    assert one(spark, N.sum_composition(F.col("n")), n=name) == want


@pytest.mark.parametrize("name,source,want", [
    ("PC 16:0_18:1", "MS2", "PC 16:0_18:1"), ("SM d34:1", "MS2", "SM 34:1;O2"), ("Plasmenyl-PE P-38:4", "MS2", "PE P-38:4"),
    ("Plasmenyl-PE P-38:4", "RT model", "PE O-38:4"), ("PC[OH] OH-16:0_18:2", "MS2", "PC 16:0_18:2;O"), ("CL 18:2_18:2_18:2_18:2", "MS2", "CL 72:8"),
    ("GlcCer[NS] d34:1", "MS2", "HexCer 34:1;O2"), ("Mystery 1:0", "MS2", ""), ("LysoPC 16:0", "MS2", "LPC 16:0")])
def test_shorthand(spark, name, source, want):
    assert one(spark, N.shorthand(F.col("n"), F.col("s")), n=name, s=source) == want


@pytest.mark.parametrize("name,want", [("GlcCer_NS d34:1", "HexCer[NS]"), ("Cer-NS", "Cer[NS]"), ("gm3-nana d34:1", "GM3[NANA]"), ("TAG 52:3", "TG"), ("LysoPA", "LPA"), ("SE", "SE")])
def test_canonical_class(spark, name, want):
    assert one(spark, N.canonical_class(F.col("n")), n=name) == want


def test_comparison_keys(spark):
    a = one(spark, N.comparison_keys(F.col("n")), n="Cer d18:1/16:0")
    b = one(spark, N.comparison_keys(F.col("n")), n="Cer(16:0_18:1),O2 [M+H]+")
    assert a == b and a["species"] == "Cer 34:1;O2"
    assert one(spark, N.comparison_keys(F.col("n")), n="PC P-32:1 or PC O-32:2")["molecular"] == ""


def test_names_small(spark):
    assert one(spark, N.adduct_sign(F.col("n")), n="CL 72:8 [M-2H]2-") == "-"
    assert one(spark, N.top_ether(F.col("n")), n="Plasmenyl-PE P-40:7") == "PE O-40:7"
    assert one(spark, N.demote_vinyl_ether(F.col("n")), n="Alkenyl-TG P-52:3") == "TG O-52:3"
    assert one(spark, N.lipid_name(F.col("n")), n="d5TG 10:0_10:0_10:0 [M+NH4]+;") == "D5TG 10:0_10:0_10:0"
    assert one(spark, N.chain_key(F.col("n")), n="PC 18:1_16:0 [M+H]+;") == one(spark, N.chain_key(F.col("n")), n="PC 16:0_18:1")
    assert one(spark, N.lipid_category(F.col("n")), n="LysoPC") == "Glycerophospholipids"
    p = one(spark, N.parse_sum_name(F.col("n")), n="GlcCer[NS] d18:1_16:0")
    assert tuple(p) == ("HexCer[NS]", "d", 34, 1)


def test_roles_and_flags(spark):
    want = {"Blank_Std_01": "blank", "Pool_Pos_01": "qc", "x_QC_2": "qc", "Std_Mix_3": "standard", "S_05": "sample", "acquire": "sample"}
    df = spark.createDataFrame([(n,) for n in want], "n string").select("n", roles.infer_role(F.col("n")).alias("r"))
    assert {r["n"]: r["r"] for r in df.collect()} == want
    assert one(spark, roles.strip_polarity(F.col("n"), "Pos"), n="Pool_POS_01") == "Pool_01"
    assert one(spark, roles.strip_polarity(F.col("n"), "Pos"), n="Positive_control") == "Positive_control"
    inj = spark.createDataFrame([("A", n) for n in ["KF_Brain_1", "KF_Brain_2", "KF_Brain_3", "KF_Brain_4", "Blank_1"]], "study_id string, injection string")
    assert roles.learn_prefix(inj).collect()[0]["prefix"] == "KF_Brain_"


def test_masses(spark):
    assert one(spark, ions.formula_mass(F.col("f")), f="H-1O-1") == pytest.approx(-17.00273967, abs=1e-6)
    assert one(spark, ions.formula_mass(F.col("f")), f="(13C)H4") == pytest.approx(13.00335483 + 4 * 1.007825035)
    assert ions.fatty_acid_grid(spark).filter("carbons = 15").count() == 2
    with pytest.raises(Exception, match="unknown element"):
        spark.createDataFrame([("C2Zz1", "[M+H]+")], "f string, a string").select(ions.standard_mz(F.col("f"), F.col("a"))).collect()


def test_peak_model(spark):
    h = one(spark, P.relative_height(F.col("w"), F.col("a"), F.col("t")), w=0.1, a=5.0, t=5.05)
    assert h == pytest.approx(0.5, abs=0.01)
    assert one(spark, P.relative_height(F.col("w"), F.col("a"), F.col("t")), w=0.1, a=5.0, t=6.0) == 0.001


# ---- area table -------------------------------------------------------------------------------

def _injections(spark, roles_):
    return spark.createDataFrame([("A", "+", f"i{k}", r, k + 1, "g1" if k % 2 else "g2") for k, r in enumerate(roles_)],
                                 f"{RUN}, injection string, role string, run_order int, grp string")


def _areas(spark, table):
    return spark.createDataFrame([("A", "+", g, f"i{k}", float(v)) for g, row in table.items() for k, v in enumerate(row) if v],
                                 f"{RUN}, group_id long, injection string, area double")


def _groups(spark, ids, **extra):
    df = spark.createDataFrame([("A", "+", g) for g in ids], f"{RUN}, group_id long")
    for k, v in extra.items():
        df = df.withColumn(k, v)
    return df


def test_blank_filter_cases(spark):
    inj = _injections(spark, ["blank", "sample", "sample"])
    a = _areas(spark, {1: [10, 50, 50], 2: [10, 49, 50], 3: [0, 1, 0], 4: [0, 1, 1]})
    got = {r["group_id"]: r["blank_pass"] for r in M.blank_filter(_groups(spark, [1, 2, 3, 4]), a, inj).collect()}
    assert got == {1: True, 2: False, 3: False, 4: True}
    free = M.blank_filter(_groups(spark, [3]), a, _injections(spark, ["sample", "sample", "sample"])).collect()
    assert free[0]["blank_pass"]


def test_presence_cases(spark):
    inj = _injections(spark, ["sample"] * 6 + ["qc"] * 2 + ["blank"])
    a = _areas(spark, {1: [1, 0, 1, 0, 0, 0, 1, 1, 1], 2: [1, 1, 0, 0, 0, 0, 0, 0, 1]})
    got = {r["group_id"]: r["presence_pass"] for r in M.presence_filter(_groups(spark, [1, 2]), a, inj, by=("grp",)).collect()}
    assert got == {1: True, 2: False}
    none = M.presence_filter(_groups(spark, [1]), a, inj.filter("run_order <= 2"), by=("grp",)).collect()
    assert none[0]["presence_pass"] is None


def test_precision_against_numpy_and_degenerate(spark):
    rng = np.random.default_rng(5)
    role = ["qc"] * 4 + ["sample"] * 6
    table = {g: np.where(rng.random(10) < (0.15 if g > 3 else 0), 0, rng.lognormal(10, 0.4, 10)) for g in range(30)}
    inj, a, g = _injections(spark, role), _areas(spark, table), _groups(spark, range(30))
    m = np.array(list(table.values()))
    m = m / np.array([np.median(c[c > 0]) for c in m.T])
    full = (m[:, :4] > 0).all(axis=1)
    cv = 100 * m[full, :4].std(axis=1, ddof=1) / m[full, :4].mean(axis=1)
    d = m[full, :4].std(axis=1, ddof=1) / m[full, 4:].std(axis=1, ddof=1)
    got = Q.precision(g, a, inj).collect()[0]
    assert got["usable"] and got["median_pool_cv"] == pytest.approx(np.median(cv)) and got["median_d_ratio"] == pytest.approx(np.median(d))
    bare = Q.precision(g, a, _injections(spark, ["sample"] * 10)).collect()[0]
    assert not bare["usable"] and "pooled QC" in bare["reason"]
    assert Q.missingness(g.withColumn("name", F.lit(None).cast("string")), a, _injections(spark, ["qc"] * 10)).collect()[0]["reason"] == "no sample injections"


def test_rank_tests(spark):
    pts = spark.createDataFrame([("A", "a" if i < 6 else "b", float(i)) for i in range(12)], "study_id string, level string, v double")
    r = Q.rank_test(pts, ["study_id"], "level", "v").collect()[0]
    assert r["statistic"] == 0 and r["p"] == pytest.approx(0.0051, abs=5e-4)  # U = 0, continuity-corrected
    pts3 = spark.createDataFrame([("A", "abc"[i // 5], float(i)) for i in range(15)], "study_id string, level string, v double")
    assert Q.rank_test(pts3, ["study_id"], "level", "v").collect()[0]["p"] == pytest.approx(0.0019, abs=6e-4)


def test_score_space_against_svd(spark):
    rng = np.random.default_rng(6)
    table = {g: rng.lognormal(8, 1, 8) for g in range(40)}
    s = Q.score_space(Q.gram(_areas(spark, table), _injections(spark, ["sample"] * 6 + ["qc"] * 2))).orderBy("injection").toPandas()
    x = np.log10(np.array(list(table.values())).T + 1)
    x = x - x.mean(axis=0)
    x = x / np.sqrt(x.std(axis=0, ddof=1))
    u, sv, _ = np.linalg.svd(x, full_matrices=False)
    assert np.allclose(np.abs(s["pc1"]), np.abs(u[:, 0] * sv[0])) and np.allclose(s["explained1"], sv[0] ** 2 / (sv ** 2).sum())
    assert Q.f_quantile(0.95, 3, 20) == pytest.approx(3.0984, abs=1e-3)


# ---- groups -----------------------------------------------------------------------------------

def _sweep(spark, rows):
    cols = f"{RUN}, group_id long, mz double, rt double, fwhm double, max_area double, adduct string, sum_name string, fragments array<double>"
    return spark.createDataFrame([("A", "+", *r) for r in rows], cols)


def test_sweep_rules(spark):
    h, na = 1.007825035, 22.9897677
    g = _sweep(spark, [
        (1, 500.0 + h, 5.00, 0.2, 900.0, "[M+H]+", "PC 1:0", [300.0]), (2, 501.003 + h, 5.01, 0.2, 90.0, None, None, None),  # isotope
        (3, 500.0 + na, 5.02, 0.2, 80.0, None, None, None),                                                               # sodium of 1
        (4, 300.0, 5.03, 0.2, 70.0, None, None, None),                                                                    # in-source fragment of 1
        (5, 1000.0 + h, 5.04, 0.2, 60.0, None, None, None),                                                               # dimer of 1
        (6, 500.01 + h, 5.05, 0.2, 950.0, "[M+H]+", "PC 1:0", None),                                                      # same lipid, larger
        (7, 700.0, 9.00, 0.2, 10.0, None, None, None), (8, 700.0 + na - h, 9.20, 0.2, 9.0, None, None, None)])            # beyond half a width
    inj, a = _injections(spark, ["sample"] * 6), _areas(spark, {k: [1, 2, 3, 4, 5, 6] for k in range(1, 9)})
    pairs = G.sweep_pairs(g, ions.adduct_table(spark), a, inj)
    got = {r["group_id"]: (r["reason"], r["merged_into"]) for r in G.resolve_sweep(pairs, g).collect()}
    assert got[2][0] == "M+1 isotope" and got[3][0] == "Adduct of existing identified peak"
    assert got[4][0] == "In-source fragment" and got[5][0] == "Dimer" and got[1] == ("Redundant Identification", 6)
    assert 6 not in got and 7 not in got and 8 not in got


def test_split_peaks(spark):
    g = spark.createDataFrame([("A", "+", i, 700.0 + i * 1e-4, 5.0 + i * 0.02, 0.1, n, "[M+H]+", True) for i, n in [(1, "PC 34:1"), (2, "PC 34:1"), (3, "PE 1:0"), (4, "PE 1:0")]],
                              f"{RUN}, group_id long, mz double, rt double, fwhm double, name string, adduct string, keep boolean")
    inj = _injections(spark, ["qc"] * 4 + ["sample"] * 6)
    left = [100, 20, 90, 30, 50, 60, 40, 30, 70, 20]
    a = _areas(spark, {1: left, 2: [130 - v for v in left], 3: [10, 20, 10, 20, 5, 30, 2, 8, 4, 9], 4: [20, 41, 19, 40, 40, 3, 22, 9, 8, 1]})
    m = G.merge_split_peaks(g, a, inj).collect()
    assert len(m) == 1 and {m[0]["group_id"], m[0]["survivor"]} == {1, 2} and m[0]["kind"] == "precision"
    assert G.absorb_areas(a, spark.createDataFrame(m)).filter(F.col("group_id") == m[0]["survivor"]).filter("abs(area - 130) < 1e-9").count() == 10
    assert G.merge_split_peaks(g, a, inj.filter("run_order > 2")).count() == 0  # two pools are no evidence


def test_adduct_pair_direction_and_tracking(spark):
    na_h = 21.98194
    g = spark.createDataFrame([("A", "+", 1, 760.0, 5.0, 0.1, "PE 40:1", "PE 40:1", "[M+H]+", "PE", 900), ("A", "+", 2, 760.0 + na_h, 5.01, 0.1, "PE 42:4", "PE 42:4", "[M+Na]+", "PE", 950)],
                              f"{RUN}, group_id long, mz double, rt double, fwhm double, name string, sum_name string, adduct string, lipid_class string, dot int")
    inj = _injections(spark, ["sample"] * 9)
    up = list(range(1, 10))
    got = G.remove_adduct_pairs(g, ions.adduct_table(spark), _areas(spark, {1: up, 2: [3 * v for v in up]}), inj).collect()
    assert [r["group_id"] for r in got] == [2] and got[0]["reason"].startswith("Adduct pair: the [M+Na]+ of PE 40:1")
    assert G.remove_adduct_pairs(g, ions.adduct_table(spark), _areas(spark, {1: up, 2: up[::-1]}), inj).count() == 0


def test_letters(spark):
    df = spark.createDataFrame([(1,), (26,), (27,), (703,)], "p int").select(G._letters(F.col("p")).alias("l"))
    assert [r["l"] for r in df.collect()] == ["a", "z", "aa", "aaa"]


# ---- retention --------------------------------------------------------------------------------

def _class(spark, slope, outliers=0):
    rows = [("A", "+", k, f"PC {30 + k % 9}:{k % 4}", 2.0 + slope * (30 + k % 9) - 0.3 * (k % 4) + (k % 7) * 0.001 + (9.0 if k < outliers else 0.0)) for k in range(40)]
    return spark.createDataFrame(rows, f"{RUN}, group_id long, name string, rt double")


def test_rt_models(spark):
    m = R.fit_rt_models(_class(spark, 0.2, outliers=3)).collect()[0]
    assert m["usable"] and m["per_carbon"] == pytest.approx(0.2, abs=0.01) and m["n_used"] == 37
    assert not R.fit_rt_models(_class(spark, -0.2)).collect()[0]["usable"]
    assert R.fit_rt_models(_class(spark, 0.2).limit(5)).count() == 0
    off = R.rt_model_filter(_class(spark, 0.2, outliers=3), R.fit_rt_models(_class(spark, 0.2, outliers=3)))
    assert sorted(r["group_id"] for r in off.filter("off_model").collect()) == [0, 1, 2]


def test_extension_needs_one_candidate(spark):
    models = R.fit_rt_models(_class(spark, 0.2))
    g = spark.createDataFrame([("A", "+", 1, 700.0, 2.0 + 0.2 * 34, None, True), ("A", "+", 2, 800.0, 2.0 + 0.2 * 34, None, True)],
                              f"{RUN}, group_id long, mz double, rt double, name string, keep boolean")
    cand = spark.createDataFrame([("PC 34:0", 700.0, "+", "[M+H]+"), ("PC 34:0", 800.001, "+", "[M+H]+"), ("PC 16:0_18:0", 800.002, "+", "[M+Na]+")],
                                 "cand_name string, cand_mz double, polarity string, cand_adduct string")
    got = R.extend_identifications(g, models, cand).collect()
    assert [(r["group_id"], r["name"], r["adduct"]) for r in got] == [(1, "PC 34:0", "[M+H]+")]


def test_loess_follows_a_smooth_shift():
    x = np.sort(np.random.default_rng(7).uniform(0, 20, 200))
    y = 0.1 + 0.02 * x
    y[50] += 5
    fit = K.loess_fit(x, y)
    assert abs(np.delete(fit - (0.1 + 0.02 * x), range(40, 61))).max() < 1e-6


def test_loess_by_moments_is_the_laid_out_line(monkeypatch):
    rng = np.random.default_rng(3)
    x = np.sort(np.concatenate([rng.normal(5, 0.01, 3000), rng.uniform(1, 25, 4000)]))
    y = 0.05 * np.sin(x) + 0.01 * rng.standard_normal(7000) + (rng.random(7000) < 0.02)
    by_moments = K.loess_fit(x, y)
    monkeypatch.setattr(K, "LOESS_LEAVES", 7000)
    assert abs(by_moments - K.loess_fit(x, y)).max() < 1e-12


def test_loess_does_not_cost_the_square_of_its_points():
    x = np.sort(np.random.default_rng(4).uniform(0, 20, 100_000))
    since = time.process_time()
    fit = K.loess_fit(x, 0.1 + 0.02 * x)
    assert time.process_time() - since < 60
    assert abs(fit - (0.1 + 0.02 * x)).max() < 1e-9


# ---- acquisition, scans, calibration ----------------------------------------------------------

def _trace(spark, signal, step=0.05):
    rows = [("A", "+", "S", 1, [(i * step, float(v)) for i, v in enumerate(signal)])]
    return spark.createDataFrame(rows, f"{RUN}, injection string, target_id int, trace array<struct<rt double, signal double>>")


def _peak(axis, signal, centre, half):
    core = np.abs(axis - centre) <= half
    if core.sum() == 0 or (~core).sum() < 3 or signal.max() <= 0:
        return None
    base = np.median(signal[~core])
    sigma = np.median(np.abs(signal[~core] - base)) * 1.4826
    sigma = sigma if sigma > 0 else max(base, 1.0) * 0.1
    apex = np.where(core)[0][np.argmax(signal[core])]
    if signal[apex] - base <= 0:
        return None
    run, above = 1, signal > base + sigma
    for d in (-1, 1):
        k = apex + d
        while 0 <= k < len(signal) and above[k]:
            run, k = run + 1, k + d
    return (axis[apex], (signal[apex] - base) / sigma) if run >= 3 else None


def test_peak_test_against_brute_force(spark):
    rng = np.random.default_rng(8)
    for k in range(6):
        s = rng.uniform(0, 10, 40)
        if k % 2:
            s[18:23] += [20, 60, 90, 50, 15]
        elif k == 4:
            s[20] += 500  # one-scan spike
        got = _trace(spark, s).select(X.peak_test(F.col("trace"), F.lit(1.0), F.lit(0.3)).alias("p")).collect()[0]["p"]
        want = _peak(np.arange(40) * 0.05, s, 1.0, 0.3)
        assert (got is None) == (want is None)
        if want:
            assert tuple(got) == pytest.approx(want)


def test_merge_frames_anchor(spark):
    df = spark.createDataFrame([([(500.0, 1.0), (500.025, 1.0), (500.04, 2.0)],)], "peaks array<struct<mz double, intensity double>>")
    p = X.merge_frames(df).collect()[0]["peaks"]
    assert [(round(x["mz"], 4), x["intensity"]) for x in p] == [(500.0125, 2.0), (500.04, 2.0)]


def test_derived_settings_and_order_statistics(spark):
    rng = np.random.default_rng(9)
    v = rng.lognormal(6, 1, 2500)
    df = spark.createDataFrame(pd.DataFrame({"study_id": "A", "polarity": "+", "intensity": v}))
    want = np.median(v[v <= np.percentile(v, 10)])
    assert C.noise_floor(df).collect()[0]["floor"] == pytest.approx(want)
    few = C.derive_setting("mass_offset_ppm", df.limit(10), "intensity").collect()[0]
    assert few["value"] is None and few["skipped_reason"]
    with pytest.raises(ValueError):
        C.derive_setting("min_fraction", df, "intensity")
    with pytest.raises(ValueError):
        C.apply_file_calibration(df.withColumn("calibrated_ppm", F.lit(0.0)), df)


# ---- polarity and library ---------------------------------------------------------------------

def test_polarity_guard_and_carry(spark):
    g = spark.createDataFrame([("A", "+", 1, "PC", "PC 34:1", 5.0, True), ("A", "-", 2, "PC", "PC 16:0_18:1", 5.1, True), ("A", "-", 3, "PE", "PE 36:2", 6.0, True),
                               ("A", "+", 4, "DECOY_", "DECOY_ x", 1.0, True), ("A", "-", 5, "DECOY_", "DECOY_ x", 1.0, True)],
                              f"{RUN}, group_id long, lipid_class string, name string, rt double, identified boolean")
    table = spark.createDataFrame([("PC", "+")], "lipid_class string, assigned string")
    kept = {r["group_id"]: r["polarity_kept"] for r in PO.apply_polarity(g, table).collect()}
    assert kept == {1: True, 2: False, 3: True, 4: True, 5: True}
    with pytest.raises(Exception, match="not in the class-polarity table"):
        PO.apply_polarity(g, table.withColumn("lipid_class", F.lit("SM"))).collect()
    got = PO.carry_chains(g, table).collect()
    assert [(r["group_id"], r["chains"], r["chains_from"]) for r in got] == [(1, "PC 16:0_18:1", "-")]
    far = g.withColumn("rt", F.when(F.col("group_id") == 2, 9.0).otherwise(F.col("rt")))
    assert PO.carry_chains(far, table).count() == 0


def test_combine_refuses_different_vials(spark):
    a = spark.createDataFrame([("A", "+", 1, "S1_Pos", 1.0), ("A", "-", 2, "S2_Neg", 1.0)], f"{RUN}, group_id long, injection string, area double")
    rows = a.select("study_id", "polarity", "group_id")
    with pytest.raises(Exception, match="same vials"):
        PO.combine(rows, a, F.regexp_replace("injection", "_(Pos|Neg)$", "")).collect()


def test_decoys_and_screen(spark):
    schema = "name string, precursor_mz double, peaks array<struct<mz double, intensity double, annotation string, type string, chain string>>"
    lib = spark.createDataFrame([
        ("PX 14:0_16:1 [M+H]+;", 718.5387, [(211.2, 999.0, "O_Alkyl Fragment_[14:0]", "t", "14:0"), (591.4, 10.0, "C_DG Fragment_[14:0, d16:1]", "t", "14:0, d16:1"), (184.07, 5.0, "C_Fragment_[]", "t", "")]),
        ("Q 1 [M+H]+;", 300.0, [(100.0, 999.0, "C_Fragment_[]", "t", "")])], schema)
    d = L.make_decoys(lib, 3).collect()
    assert len(d) == 1 and [round(p["mz"], 4) for p in d[0]["peaks"]] == [253.2470, 675.4939, 184.07] and d[0]["peaks"][1]["chain"] == "17:0, d19:1"
    assert [round(p["mz"], 4) for p in L.head_group_decoys(lib).collect()[0]["peaks"]] == [106.3721]
    target = spark.createDataFrame([("PE 17:0_19:1 [M+H]+;", 718.54, [(253.247, 9.0, "O_Alkyl Fragment_[17:0]", "t", "17:0")])], schema)
    assert L.screen_decoys(L.make_decoys(lib, 3), target).collect()[0]["rule"] == "target-in-decoy"
    assert L.screen_decoys(L.head_group_decoys(lib), lib).count() == 0


def test_links_stay_within_the_radius_of_their_centre(spark):
    r = np.random.default_rng(8)
    mz, rt = r.uniform(200, 260, 3000), r.uniform(0, 5, 3000)
    rows = [("A", "+", f"I{k}", g * 4 + k, float(mz[g] * (1 + r.normal(0, 5e-7))), float(rt[g] + r.normal(0, 1 / 120)), float(r.integers(1, 10**6))) for g in range(3000) for k in range(4)]
    frame = spark.createDataFrame(rows, "study_id string, polarity string, injection string, feature_id long, mz double, rt_aligned double, area double")
    got = X.link_features(frame).collect()
    at = {x[3]: x for x in rows}
    assert sorted(x.feature_id for x in got) == sorted(at) and len({(x.link, x.injection) for x in got}) == len(got)
    members = {}
    for x in got:
        centre = at[int(x.link.split("/")[1])]
        assert abs(x.mz - centre[4]) / centre[4] <= 10e-6 and abs(x.rt_aligned - centre[5]) <= 0.25
        members.setdefault(x.link, set()).add(x.feature_id // 4)
    assert sum(len(m) == 1 for m in members.values()) >= 0.97 * len(members)
    assert X.link_features(frame.limit(0)).count() == 0


def test_unclaimed_series_as_a_greedy_walk(spark):
    r = random.Random(3)
    rows = [("A", "+", k, None, True, 12, float(r.randint(1, 40)), round(300 + r.choice([0, 0.002, 0.004]) + 14.01565 * r.randint(0, 9), 5), round(r.uniform(1, 9), 2)) for k in range(150)]
    frame = spark.createDataFrame(rows, RUN + ", group_id long, name string, keep boolean, n_features int, max_area double, mz double, rt double")
    about = {x[2]: x for x in rows}

    def above(k):
        fits = [x for x in rows if abs(about[k][7] + A.CH2 - x[7]) <= 0.005 and x[8] > about[k][8]]
        return max(fits, key=lambda x: (x[6], -x[2]))[2] if fits else None

    claimed, want = set(), set()
    for start in sorted(about, key=lambda k: (-about[k][6], k)):
        chain = [start]
        while start not in claimed and (k := above(chain[-1])) is not None:
            chain.append(k)
        mean = (about[chain[-1]][8] - about[start][8]) / (len(chain) - 1) if len(chain) >= 4 else 0
        if 0.05 <= mean <= 3.0:
            claimed.update(chain)
            want |= {(start, n + 1, k) for n, k in enumerate(chain)}
    assert {(x.series, x.member, x.group_id) for x in R.unclaimed_series(frame).collect()} == want and len(want) > 8


@pytest.mark.parametrize("spacing", [5.0, 0.012])  # masses that fall apart, and masses that must be walked
def test_blocks_score_as_the_walk_and_keep_the_best(spark, monkeypatch, spacing):
    rng = random.Random(3)

    def peaks(n):
        mz = sorted(round(100 + spacing * k + rng.uniform(-0.004, 0.004), 4) for k in rng.sample(range(12), n))
        return [(m, rng.uniform(20.0, 999.0)) for m in mz]

    spectra = [("A", "+", "i", i, 500.0 + 0.004 * rng.randrange(6), 1.0, peaks(rng.randint(1, 8))) for i in range(60)]
    entries = [("L", 0, i, f"PC {i} [M+H]+;", 500.0 + 0.004 * rng.randrange(6), True, "+", peaks(rng.randint(1, 8))) for i in range(40)]
    entries += [("L", 0, 100 + i, f"copy {i} [M+H]+;", *e[4:]) for i, e in enumerate(entries[:10])]
    ms2 = spark.createDataFrame(spectra, f"{RUN}, injection string, ms2_id long, precursor_mz double, rt double, peaks array<struct<mz double, intensity double>>")
    lib = spark.createDataFrame(entries, "library string, lib_rank int, entry_seq long, name string, precursor_mz double, is_native boolean, optimal_polarity string, peaks array<struct<mz double, intensity double>>")
    prepared = SE.prepare_spectra(ms2), SE.prepare_library(lib)
    walked = SE.score(SE.candidates(*prepared)).select("ms2_id", "entry_seq", "dot", "reverse_dot").collect()
    dealt = SE.score(SE.candidates(*prepared, blocks=7), columns=["ms2_id", "entry_seq"]).collect()
    want, got = ({(r["ms2_id"], r["entry_seq"]): (r["dot"], r["reverse_dot"]) for r in rows} for rows in (walked, dealt))
    assert len(walked) == len(dealt) and want.keys() == got.keys() and len(want) > 500
    assert all(got[k] == pytest.approx(v, rel=1e-9, abs=1e-9) for k, v in want.items())
    mass = {e[2]: e[4] for e in entries}
    low = min(mass.values())
    ranked: dict = {}
    for (s, e), (dot, _) in want.items():
        if dot > 1:
            ranked.setdefault(s, []).append((-round(dot, 9), (mass[e] - low) // 0.001, -mass[e], e))
    monkeypatch.setattr(SE, "BLOCK", 7)
    top = SE.search(ms2, lib, max_results=3, keep_peaks=True).collect()
    assert {(r["ms2_id"], r["rank"]): r["entry_seq"] for r in top} == {(s, i + 1): x[-1] for s, v in ranked.items() for i, x in enumerate(sorted(v)[:3])}
    content = {e[2]: e[-1] for e in entries}
    assert all([tuple(p) for p in r["lib_peaks"]] == content[r["entry_seq"]] for r in top)


def test_search_and_purity_carry_no_peaks_through_sorts(spark):
    kind = "array<struct<mz double, intensity double>>"
    ms2 = spark.createDataFrame([("A", "+", "i", 1, 500.0, 1.0, [(100.0, 9.0)])], f"{RUN}, injection string, ms2_id long, precursor_mz double, rt double, peaks {kind}")
    lib = spark.createDataFrame([("L", 0, 1, "x", 500.0, True, True, [(100.0, 9.0)])], f"library string, lib_rank int, entry_seq long, name string, precursor_mz double, is_native boolean, optimal_polarity boolean, peaks {kind}")
    plan = SE.search(ms2, lib, keep_peaks=True)._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapCoGroupsInArrow" in plan and "ArrowEvalPython" not in plan and "min_by" not in plan


def test_correlated_unidentified_in_blocks_matches_brute_force(spark, monkeypatch):
    rng = random.Random(8)
    monkeypatch.setattr(G, "CORRELATED", 5)
    names = [f"s{i}" for i in range(12)]
    inj = spark.createDataFrame([("A", "+", n, "blank" if i == 0 else "sample") for i, n in enumerate(names)], f"{RUN}, injection string, role string")
    base = [rng.uniform(1e3, 1e9) for _ in names]
    groups, areas = [], {}
    for i in range(60):
        groups.append(("A", "+", i, round(rng.uniform(0, 4), 3), 0.2 + 0.1 * (i % 3), i % 9 != 0, i % 2 == 0))
        noise = (0.0, 0.1, 0.3, 5.0)[i % 4]
        row = [1e6 if i % 10 == 7 else b * (1 + rng.uniform(-noise, noise)) for b in base]
        areas[i] = {n: v for n, v in zip(names, row, strict=True) if rng.random() > 0.3 and v > 0}
    g = spark.createDataFrame(groups, f"{RUN}, group_id long, rt double, fwhm double, keep boolean, identified boolean")
    a = spark.createDataFrame([("A", "+", i, n, v) for i, row in areas.items() for n, v in row.items()], f"{RUN}, group_id long, injection string, area double")

    def corr(i, j):
        shared = [n for n in names[1:] if n in areas[i] and n in areas[j]]
        x, y = [areas[i][n] for n in shared], [areas[j][n] for n in shared]
        if len(shared) < 5:
            return None
        return 0.0 if min(x) == max(x) or min(y) == max(y) else float(np.corrcoef(x, y)[0, 1])

    live = [r for r in groups if r[5]]
    pairs = [(u[2], i[2]) for u in live if not u[6] for i in live if i[6] and abs(u[3] - i[3]) < u[4] / 0.5]
    want = {u for u, i in pairs if (corr(u, i) or 0.0) >= 0.95}
    got = [r["group_id"] for r in G.correlated_unidentified(g, a, inj).collect()]
    assert len(got) == len(set(got)) and set(got) == want and 3 < len(want) < len({u for u, _ in pairs})
    frame = spark.createDataFrame([("A", "+", u, i) for u, i in pairs], f"{RUN}, id_a long, id_b long")
    for r in Q.pair_corr(frame, a, inj).collect():
        value = corr(r["id_a"], r["id_b"])
        assert r["r"] == (None if value is None else pytest.approx(value, abs=1e-9))


def test_pairs_are_never_spread_over_cells(spark):
    """A pair used to become one row for each cell; now a group's cells travel as one row."""
    inj = spark.createDataFrame([("A", "+", "s", "sample")], f"{RUN}, injection string, role string")
    areas = spark.createDataFrame([("A", "+", 1, "s", 2.0)], f"{RUN}, group_id long, injection string, area double")
    pairs = spark.createDataFrame([("A", "+", 1, 1)], f"{RUN}, id_a long, id_b long")
    plan = Q.pair_corr(pairs, areas, inj)._jdf.queryExecution().optimizedPlan().toString()
    assert "corr(" not in plan and "collect_list" in plan


def test_coisolation_counts_in_blocks(spark, monkeypatch):
    from massloom.operators import compare as C
    rng = random.Random(5)
    monkeypatch.setattr(C, "COISOLATED", 4)
    rows = [("A", "+" if i % 2 else "-", i, round(rng.uniform(-2, 6), 2), round(rng.uniform(0, 60), 1)) for i in range(120)] + [("A", "+", 500, None, 3.0)]
    frame = spark.createDataFrame(rows, f"{RUN}, group_id long, mz double, ev double")
    near = C.coisolation(frame, 15.0, 1.0)
    assert "SortMergeJoin [study_id" in near._jdf.queryExecution().executedPlan().toString() and "FlatMapCoGroupsInArrow" in near._jdf.queryExecution().executedPlan().toString()
    want = {a[2]: sum(b[1] == a[1] and b[2] != a[2] and None not in (a[3], b[3]) and abs(a[3] - b[3]) <= 1.0 and abs(a[4] - b[4]) <= 15.0 for b in rows) for a in rows}
    got = {r["group_id"]: r["neighbours"] for r in near.collect()}
    assert got == want and sum(want.values()) > 300


def test_screen_decoys_in_blocks_matches_brute_force(spark, monkeypatch):
    monkeypatch.setattr(L, "SCREENED", 5)
    rng = random.Random(4)

    def peaks():
        return sorted({round(100 + 0.008 * rng.randrange(5), 3) for _ in range(rng.randint(1, 3))})

    entry = lambda name, mz, comp: (name, round(500 + 0.005 * rng.randrange(6), 3), [(m, 9.0, f"X_[{comp}]", "t", comp) for m in mz])
    decoys = [entry(f"DECOY_ PC {i % 12}:0_2:0 [M+H]+;", peaks(), f"{10 + i % 9}:0") for i in range(40)]
    targets = [entry(f"PC {10 + i % 11}:0_{10 + i % 11}:0 [M+H]+;", peaks(), "7:0") for i in range(40)]
    schema = "name string, precursor_mz double, peaks array<struct<mz double, intensity double, annotation string, type string, chain string>>"
    screened = L.screen_decoys(spark.createDataFrame(decoys, schema), spark.createDataFrame(targets, schema))
    assert "FlatMapCoGroupsInArrow" in screened._jdf.queryExecution().executedPlan().toString()
    asserted = {r["name"]: r["c"] for r in spark.createDataFrame(targets, schema).select("name", L._asserted(F.col("name")).alias("c")).collect()}
    within = lambda a, b: all(any(abs(x[0] - y[0]) <= L.MS2_TOL for y in b) for x in a)
    want: dict = {}
    for name, mz, p in decoys:
        for target, other, q in targets:
            if abs(mz - other) <= L.MS1_TOL:
                rule = 0 if asserted[target] and sorted({p[0][4]}) == asserted[target] else 1 if within(p, q) else 2 if within(q, p) else 3
                if rule < 3:
                    want[name] = min(want.get(name, (target, rule)), (target, rule))
    rules = ("same-composition", "decoy-in-target", "target-in-decoy")
    assert {r["name"]: (r["target"], rules.index(r["rule"])) for r in screened.collect()} == want and len(want) > 5


def test_candidates_of_one_mass_are_spread_over_tasks(spark):
    ms2 = spark.range(3000).selectExpr("'A' AS study_id", "'+' AS polarity", "'S_1' AS injection", "id AS ms2_id", "760.01e0 + id % 3 * 1e-4 AS precursor_mz", "1e0 AS rt", "array(named_struct('mz', 100e0, 'intensity', 1e0)) AS peaks")
    lib = spark.range(3002).selectExpr("'l' AS library", "0 AS lib_rank", "id AS entry_seq", "concat('PC ', id) AS name", "CASE id WHEN 0 THEN 700e0 WHEN 1 THEN 800e0 ELSE 760.012e0 + id % 3 * 1e-4 END AS precursor_mz", "true AS is_native",
                                       "true AS optimal_polarity", "array(named_struct('mz', 100e0, 'intensity', 1e0, 'annotation', '', 'type', '', 'chain', '')) AS peaks")
    per_task = [r["count"] for r in SE.candidates(ms2, lib).groupBy(F.spark_partition_id()).count().collect()]
    assert sum(per_task) == 9_000_000
    assert max(per_task) < 9_000_000


def test_next_rungs_are_the_most_abundant_later_ones(spark, monkeypatch):
    monkeypatch.setattr(A, "RUNGS", 16)
    rng = random.Random(5)
    rows = [("A", "+", i, 500 + rng.choice([0.0, A.CH2, 2 * A.CH2]) + rng.uniform(-0.02, 0.02), rng.uniform(1, 3), rng.choice([1.0, 2.0, 2.0, None])) for i in range(300)]
    got = {r["low_id"]: r["high_id"] for r in A.next_rungs(spark.createDataFrame(rows, f"{RUN}, group_id long, mz double, rt double, area double")).collect()}
    want = {}
    for _, _, i, mz, rt, _ in rows:
        above = [(-1.0 if area is None else area, -j) for _, _, j, other, later, area in rows if abs(mz + A.CH2 - other) <= 0.01 and later > rt]
        if above:
            want[i] = -max(above)[1]
    assert got == want
    assert len(want) > 50

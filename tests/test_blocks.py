"""Counts, pairs and ranks that are found in blocks or ranges, against brute force."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from massloom.operators import compare as C
from massloom.operators import polarity as P
from massloom.operators import qc as K
from massloom.operators import search as Q
from massloom.operators import scans as X
from massloom.operators.order import averaged_places, quantiles


def _ranks(values):
    v = np.asarray(values, dtype=float)
    return np.array([(v < x).sum() + ((v == x).sum() + 1) / 2 for x in v])


def _rho(x, y):
    a, b = _ranks(x), _ranks(y)
    return 0.0 if np.ptp(a) == 0 or np.ptp(b) == 0 else float(np.corrcoef(a, b)[0, 1])


def _run(spark, rng, n_groups, n_inj, blank=()):
    """Areas of a run by (group, injection), with ties and gaps; every injection is a sample but for ``blank``."""
    noise = lambda i: rng.choice([0, 5, 5, 20, rng.randrange(1, 90)])
    trend = lambda i: 10 * i + rng.choice([0, 0, 5])
    cells = {(g, i): float((noise if g % 3 else trend)(i)) for g in range(n_groups) for i in range(n_inj)}
    areas = spark.createDataFrame([("A", "+", g, f"I{i:02d}", v) for (g, i), v in cells.items() if v > 0], "study_id string, polarity string, group_id long, injection string, area double")
    injections = spark.createDataFrame([("A", "+", f"I{i:02d}", "blank" if i in blank else "sample", i + 1) for i in range(n_inj)], "study_id string, polarity string, injection string, role string, run_order int")
    return cells, areas, injections


def test_averaged_places_across_ranges(spark):
    rng = random.Random(4)
    rows = [(k, rng.choice([0.0, 1.5, float(rng.randrange(60)), rng.random()])) for k in "AB" for _ in range(300)] + [("C", 2.0)] * 5
    counts = spark.createDataFrame(rows, "k string, v double").groupBy("k", "v").agg(F.count(F.lit(1)).alias("n"))
    got = {(r["k"], r["v"]): r["place"] for r in averaged_places(counts, ["k"], "v").collect()}
    for k in "ABC":
        v = [x for key, x in rows if key == k]
        assert [got[k, x] for x in v] == list(_ranks(v))
    assert averaged_places(counts.limit(0), ["k"], "v").count() == 0


def test_profile_screen_sorts_no_injection_in_one_task(spark):
    rng = random.Random(5)
    cells, areas, injections = _run(spark, rng, 60, 9, blank=(0, 1))
    out = K.profile_screen(areas, injections)
    assert not re.search(r"windowspecdefinition\(study_id#\d+, polarity#\d+, injection#\d+, area", out._jdf.queryExecution().optimizedPlan().toString())
    medians = [np.median([v for (g, i), v in cells.items() if i == j and v > 0]) for j in range(9)]
    norm = {k: v / medians[k[1]] for k, v in cells.items()}
    reference = {g: m for g in range(60) if (m := np.median([norm[g, i] for i in range(2, 9)])) > 0}
    rho = {i: _rho(list(reference.values()), [norm[g, i] for g in reference]) for i in range(9)}
    got = {int(r["injection"][1:]): r for r in out.collect()}
    assert {i: got[i]["rho"] for i in got} == pytest.approx(rho, abs=1e-12) and len(got) == 9
    least = min(rho[i] for i in range(2, 9))
    assert all(got[i]["below_sample_band"] == (round(rho[i], 12) < round(least, 12)) for i in rho)


def test_quantiles_of_weighted_rows(spark):
    rng = random.Random(6)
    rows = [(rng.choice("AB"), rng.choice([0.0, -3.0, rng.gauss(0, 5)]), rng.randrange(1, 9)) for _ in range(90)]
    df = spark.createDataFrame(rows, "k string, x double, w long")
    got = {r["k"]: r for r in quantiles(df, ["k"], {"low": (F.col("x"), 0.3), "mid": (F.col("x"), 0.5)}, F.col("w")).collect()}
    for k in "AB":
        x = [v for key, v, w in rows if key == k for _ in range(w)]
        assert [got[k]["low"], got[k]["mid"]] == pytest.approx([np.quantile(x, 0.3), np.median(x)], rel=1e-12)


def test_failed_spectra_counts_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(C, "FRAGMENTED", 8)
    rng = random.Random(7)
    masses = [500.0 * (1 + k * 5e-6) for k in range(8)]
    groups = [("A", rng.choice("+-"), g, rng.choice(["MS2", "unidentified"]), rng.choice(masses), rng.randrange(40) / 8) for g in range(120)]
    spectra = [("A", rng.choice("+-"), rng.choice(masses), rng.randrange(40) / 8, [(100.0 + k, float(rng.randrange(9))) for k in range(rng.randrange(4))]) for _ in range(90)]
    groups += [("A", "+", 900, "MS2", None, 1.0), ("A", "+", 901, "MS2", 500.0, None)]
    spectra += [("A", "+", None, 1.0, [(100.0, 1.0)]), ("B", "+", 500.0, 1.0, [(100.0, 1.0)])]
    g = spark.createDataFrame(groups, "study_id string, polarity string, group_id long, evidence string, mz double, rt double")
    s = spark.createDataFrame(spectra, "study_id string, polarity string, precursor_mz double, rt double, peaks array<struct<mz: double, intensity: double>>")
    pairs = {}
    for gs, gp, _, evidence, mz, rt in groups:
        for ss, sp, pm, st, peaks in spectra:
            tic = sum(i for _, i in peaks)
            if (gs, gp) == (ss, sp) and tic > 0 and None not in (mz, rt, pm) and abs(pm - mz) / mz * 1e6 <= 10.0 and abs(st - rt) <= 0.5:
                art = sum(i for m, i in peaks if abs(m - {"+": 100.0, "-": 101.0}[gp]) < 0.01)
                pairs.setdefault((gs, gp, evidence), []).append((tic, len(peaks), art / tic))
    out = {(r.study_id, r.polarity, r.evidence): r for r in C.failed_spectra(g, s, {"+": 100.0, "-": 101.0}, rt_tol=0.5).collect()}
    assert set(out) == set(pairs) and sum(map(len, pairs.values())) > 200
    for k, rows in pairs.items():
        assert out[k].spectra == len(rows)
        assert [out[k].median_tic, out[k].median_peaks, out[k].artefact_share] == pytest.approx(list(np.median(np.array(rows), axis=0)), rel=1e-12)
    assert C.failed_spectra(g, s.limit(0), {"+": 100.0, "-": 101.0}).count() == 0


def test_annotation_ambiguity_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(K, "AMBIGUOUS", 8)
    rng = random.Random(8)
    cells, areas, injections = _run(spark, rng, 70, 8, blank=(0,))
    names = ["PC 34:1", "PC 16:0_18:1", "PC 16:0_18:1 [M+H]+", "PE 36:2", "PE 18:1_18:1", None, " "]
    rows = [("A", "+", g, rng.choice(names), 700.0 + rng.randrange(12) * 0.004, rng.randrange(30) / 20, 0.21) for g in range(70)]
    g = spark.createDataFrame(rows, "study_id string, polarity string, group_id long, name string, mz double, rt double, fwhm double")
    out = {(r.id_a, r.id_b): r for r in K.annotation_ambiguity(g, areas, injections).collect()}
    bare = lambda n: n.replace(" [M+H]+", "")
    named = [(g_, bare(n), mz, rt) for _, _, g_, n, mz, rt, _ in rows if (n or "").strip()]
    window = float(np.mean([0.21] * len(named)))
    want = {(a[0], b[0]): (a, b) for a in named for b in named if a[1] != b[1] and (a[3], a[2], a[0]) < (b[3], b[2], b[0]) and abs(a[2] - b[2]) <= 0.01 and abs(a[3] - b[3]) <= window}
    assert set(out) == set(want) and len(want) > 50
    sums = {"PC 16:0_18:1": "PC 34:1", "PE 18:1_18:1": "PE 36:2"}
    kinds = set()
    for key, (a, b) in want.items():
        x, y = ([cells[k[0], i] for i in range(1, 8)] for k in (a, b))
        enough = min(sum(v > 0 for v in x), sum(v > 0 for v in y)) >= 4
        r = _rho(x, y) if enough else None
        assert out[key].r == (pytest.approx(r, abs=1e-12) if enough else None)
        if r is None or abs(r - 0.8) > 1e-9:
            kind = "rejected" if r is None or r < 0.8 else "summed and resolved" if sums.get(a[1]) == b[1] or sums.get(b[1]) == a[1] else "same peak"
            assert out[key].kind == kind
            kinds.add(kind)
    assert len(kinds) > 1


def test_chromatograms_from_whole_scans(spark):
    rng = random.Random(9)
    scans = [("A", "+", i, k, k * 0.25, [(rng.choice([499.99, 500.0, 500.004, 500.02, 700.0]), float(rng.randrange(1, 9))) for _ in range(rng.randrange(6))]) for i in "xy" for k in range(20)]
    scans += [("A", "+", "x", 50, None, [(500.0, 1.0)]), ("A", "+", "x", 51, 1.1, None), ("A", "+", "x", 52, 1.2, [(500.0, None), (None, 3.0), (500.0, 2.0)])]
    targets = [("A", "+", i, t, mz, lo, hi) for i in "xyz" for t, (mz, lo, hi) in enumerate([(500.0, 0.25, 3.0), (500.004, 1.75, 2.0), (700.0, -1.0, 9.0), (900.0, 2.0, 4.1), (500.0, 8.0, 9.0)])]
    ms1 = spark.createDataFrame(scans, "study_id string, polarity string, injection string, scan_no long, rt double, peaks array<struct<mz: double, intensity: double>>")
    t = spark.createDataFrame(targets, "study_id string, polarity string, injection string, target_id int, t_mz double, t_lo double, t_hi double")
    for how in ("sum", "max"):
        want = {}
        for _, _, i, k, mz, lo, hi in targets:
            for _, _, j, n, rt, peaks in scans:
                if i == j and rt is not None and lo <= rt < hi:
                    found = [x for m, x in peaks or [] if m is not None and x is not None and mz - mz * 10e-6 <= m < mz + mz * 10e-6]
                    want[i, k, n] = (rt, (sum if how == "sum" else max)(found or [0.0]))
        out = X.xic(ms1, t, how=how)
        assert "explode(peaks" not in out._jdf.queryExecution().optimizedPlan().toString()
        assert {(r.injection, r.target_id, r.scan_no): (r.rt, r.signal) for r in out.collect()} == want and any(v for _, v in want.values())
    assert X.xic(ms1.limit(0), t).count() == 0


def test_chains_are_carried_from_the_nearest_offer(spark):
    rng = random.Random(11)
    rows = []
    for g in range(240):
        pol = rng.choice("+-")
        name = rng.choice(["PC 34:1", "PC 34:1", "PC 16:0_18:1", "PC 16:1_18:0", "PE 36:2", "PE 18:1_18:1"])
        rows.append(("A", pol, g, name[:2], name, None if rng.random() < 0.03 else round(rng.uniform(0, 40), 2)))
    frame = spark.createDataFrame(rows, "study_id string, polarity string, group_id long, lipid_class string, name string, rt double")
    table = spark.createDataFrame([("PC", "+"), ("PE", "-")], "lipid_class string, assigned string")
    won, sums = {"PC": "+", "PE": "-"}, {"PC 16:0_18:1": "PC 34:1", "PC 16:1_18:0": "PC 34:1", "PE 18:1_18:1": "PE 36:2"}
    for offered in (rows, [r for r in rows if "_" not in r[4] or r[5] is not None]):
        want = {}
        for _, pol, g, _, name, rt in offered:
            best = {}
            for _, source, _, cls, chains, there in offered:
                if "_" in name or sums.get(chains) != name or not (source == pol or won[cls] == pol):
                    continue
                gap = None if None in (rt, there) else abs(there - rt)
                if gap is None or gap <= 0.2:
                    key = ((0, 0.0) if gap is None else (1, gap), source)
                    best[chains] = min(best.get(chains, (key, None)), (key, None if gap is None else there - rt), key=lambda b: b[0]) if chains in best else (key, None if gap is None else there - rt)
            if len(best) == 1:
                (chains, ((_, source), delta)), = best.items()
                want[g] = (chains, source, None if delta is None else round(abs(delta), 9))
        out = P.carry_chains(frame.join(spark.createDataFrame([(r[2],) for r in offered], "group_id long"), "group_id", "left_semi"), table)
        # a row meets the offers next to it, never all of its name
        assert not re.search(r"Join [^\n]*there#\d+ - ", out._jdf.queryExecution().optimizedPlan().toString())
        got = {r.group_id: (r.chains, r.chains_from, None if r.rt_delta is None else round(abs(r.rt_delta), 9)) for r in out.collect()}
        assert got == want and len(want) > 10
    assert P.carry_chains(frame.limit(0), table).count() == 0


def test_crowded_bins_are_dealt_to_few_blocks(spark, monkeypatch):
    """Blocks grow with a bin, so rows are copied a few times only, and their parts give what one part gives."""
    rng = random.Random(12)
    peaks = lambda: [(100.0 + 10 * k + rng.choice([0, 0.004]), float(rng.randrange(1, 99))) for k in range(6)]
    spectra = [("A", "-", "I", i, 700.0 + i % 3 * 0.004, float(i), peaks()) for i in range(230)]
    entries = [("L", 0, i, f"PC 1{i % 4}:0_18:{i % 2} [M-H]-;", 700.0 + i % 3 * 0.004, True, i % 5 > 0,
                [(m, x, "", "C1_Alkyl Fragment" if k < 2 else "C_Fragment", "" if k > 1 else f"1{i % 4}:0" if k else f"18:{i % 2}") for k, (m, x) in enumerate(peaks())]) for i in range(90)]
    ms2 = spark.createDataFrame(spectra, "study_id string, polarity string, injection string, ms2_id long, precursor_mz double, rt double, peaks array<struct<mz: double, intensity: double>>")
    lib = spark.createDataFrame(entries + [("L", 0, -1, "PC 0:0 [M-H]-;", 600.0, True, True, [(100.0, 1.0, "", "", "")]), ("L", 0, -2, "PC 0:0 [M-H]-;", 800.0, True, True, [(100.0, 1.0, "", "", "")])],
                                "library string, lib_rank int, entry_seq long, name string, precursor_mz double, is_native boolean, optimal_polarity boolean, "
                                "peaks array<struct<mz: double, intensity: double, annotation: string, type: string, chain: string>>")
    chains = lib.selectExpr("explode(peaks.chain) AS chain", "'Alkyl' AS base").distinct()

    def found():
        top = sorted((r.ms2_id, r["rank"], r.entry_seq, round(r.dot, 6)) for r in Q.search(ms2, lib, max_results=3).collect())
        pure = sorted((r.ms2_id, r.purity, str(r.components), tuple(r.explained)) for r in Q.purity(ms2, lib, chains).collect())
        pairs = Q.score(Q.candidates(Q.prepare_spectra(ms2), Q.prepare_library(lib), blocks=Q.BLOCK), columns=["ms2_id", "entry_seq"])
        return top, pure, sorted((r.ms2_id, r.entry_seq, round(r.dot, 6)) for r in pairs.collect())

    whole = found()
    assert len(whole[0]) > 600 and any(p for _, p, _, _ in whole[1]) and len(whole[2]) > 5000
    for name, value in (("BLOCK", 4), ("DEALT", 64), ("PAIRED", 8), ("PURITY_BLOCK", 2), ("PURITY_MOST", 16)):
        monkeypatch.setattr(Q, name, value)
    dealt = Q.candidates(Q.prepare_spectra(ms2), Q.prepare_library(lib), blocks=Q.BLOCK, most=Q.DEALT)
    assert dealt.spectra.groupBy("ms2_id", "__bin").count().agg(F.max("count")).first()[0] <= 8  # 23 blocks of entries before
    assert found() == whole

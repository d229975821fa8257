"""Ordered pair verdicts against a walk over the whole list."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from massloom.functions import ions
from massloom.operators import groups as G
from massloom.operators import resolve
from massloom.operators.order import quantiles
from massloom.operators.resolve import follow, settle_in_order
from massloom.session import next_round

KEYS = ["study_id", "polarity"]


def _rule():
    """A rule that depends on all decisions before it: the fuller end takes the other's weight and drops it."""
    def decide(pair, first, second):  # nested, so that it is sent to the workers by value
        if first["into"] is None and second["into"] is None and pair["w"] % 3:
            win, lose = (first, second) if first["v"] >= second["v"] else (second, first)
            win["v"] = (win["v"] * 3 + lose["v"]) % 1009
            lose["into"] = win["group_id"]
        else:
            first["v"] = (first["v"] + 7 * second["v"]) % 1009
    return decide


_decide = _rule()


def _walk(pairs, nodes):
    state = {(n[0], n[1], n[2]): {"group_id": n[2], "v": n[3], "into": None} for n in nodes}
    for p in sorted(pairs, key=lambda p: (p[:2], p[4])):
        _decide({"w": p[4]}, state[(p[0], p[1], p[2])], state[(p[0], p[1], p[3])])
    touched = {(p[0], p[1], p[i]) for p in pairs for i in (2, 3)}
    return {(*k, s["v"], s["into"]) for k, s in state.items() if k in touched}


def _frames(spark, pairs, nodes):
    p = spark.createDataFrame(pairs, "study_id string, polarity string, a long, b long, w long")
    n = spark.createDataFrame(nodes, "study_id string, polarity string, group_id long, v long")
    return p, n.withColumn("into", F.lit(None).cast("long"))


@pytest.mark.parametrize("block", [25, 10_000])
def test_any_block_gives_the_walk(spark, block):
    rng = random.Random(5)
    pairs, nodes = [], []
    for run, (n, m) in {("A", "+"): (60, 90), ("A", "-"): (12, 40), ("B", "+"): (200, 60)}.items():
        nodes += [(*run, i, rng.randrange(1000)) for i in range(n)]
        seen = {tuple(sorted(rng.sample(range(n), 2))) for _ in range(m)}
        # one end stands in a third of all pairs of its run
        seen |= {(0, i) for i in range(1, min(n, 30))}
        places = rng.sample(range(10_000), len(seen))
        pairs += [(*run, a, b, w) for (a, b), w in zip(sorted(seen), places)]
    p, n = _frames(spark, pairs, nodes)
    got = {tuple(r) for r in settle_in_order(p, [F.col("w")], ("a", "b"), n, _decide, block=block).collect()}
    assert got == _walk(pairs, nodes)


def test_a_long_chain_passes_from_block_to_block(spark):
    nodes = [("A", "+", i, i * 31 % 997) for i in range(3001)]
    pairs = [("A", "+", i, i + 1, i + 1) for i in range(3000)]
    p, n = _frames(spark, pairs, nodes)
    got = {tuple(r) for r in settle_in_order(p, [F.col("w")], ("a", "b"), n, _decide, block=1000).collect()}
    assert got == _walk(pairs, nodes)


def test_edges(spark):
    p, n = _frames(spark, [("A", "+", 1, 9, 1)], [("A", "+", 1, 5)])
    assert settle_in_order(p, [F.col("w")], ("a", "b"), n, _decide).count() == 0  # 9 is no node
    assert settle_in_order(p.limit(0), [F.col("w")], ("a", "b"), n, _decide).count() == 0
    to = spark.createDataFrame([("A", "+", i, i + 1) for i in range(9)] + [("B", "+", 1, 2)], "study_id string, polarity string, group_id long, into long")
    ends = {(r.study_id, r.group_id): r.into for r in follow(to, "group_id", "into").collect()}
    assert ends == {**{("A", i): 9 for i in range(9)}, ("B", 1): 2}


def test_quantiles_against_sorting(spark):
    rng = random.Random(9)
    rows = [("A", rng.choice([rng.uniform(-50, 50), rng.gauss(0, 1e-3), 10 ** rng.uniform(-8, 8), -(10 ** rng.uniform(-3, 3)), 0.0, 2.5, 2.5, None, float("nan")]), 1.0) for _ in range(700)]
    rows += [("B", 7.0, None)] * 50 + [("C", -1.0, 2.0), ("C", 4.0, None), ("D", None, float("nan"))]
    df = spark.createDataFrame(rows, "k string, x double, y double")
    shares = [0.0, 0.01, 0.25, 0.5, 0.95, 1.0]
    wanted = {f"q{i}": (F.col("x"), q) for i, q in enumerate(shares)}
    got = {r["k"]: r for r in quantiles(df, ["k"], {**wanted, "y_mid": (F.abs(F.col("y")) * -1, 0.5)}).collect()}
    assert set(got) == {"A", "B", "C"}  # D has no value
    for k in got:
        x = sorted(v for key, v, _ in rows if key == k and v is not None and v == v)
        assert [got[k][f"q{i}"] for i in range(len(shares))] == pytest.approx([float(np.quantile(x, q)) for q in shares], rel=1e-12, abs=1e-15)
    assert got["A"]["y_mid"] == -1.0 and got["B"]["y_mid"] is None and got["C"]["y_mid"] == -2.0
    assert quantiles(df.limit(0), ["k"], wanted).count() == 0


def test_ions_are_packed_in_order(spark):
    def walk(rows):
        ions = {}
        for g, _, mz in sorted(r[:3] for r in rows if r[2] is not None):
            kept = ions.setdefault(g, [])
            if all(abs(mz - q) / q * 1e6 >= 20 for q in kept):
                kept.append(mz)
        return {(g, mz, i + 1) for g, kept in ions.items() for i, mz in enumerate(kept)}

    rng = random.Random(2)
    rows = [(g, f"S_{i:02d}", 500.0 * (1 + rng.randrange(90) * 1e-6), float(rng.randrange(9)), rng.choice("+-")) for g in range(12) for i in range(25)]
    rows += [(99, "S_00", None, None, "+"), (98, "S_00", 400.0, 5.0, "-"), (98, "S_00", 400.0, 5.0, "-")]
    f = spark.createDataFrame(rows, "group_id long, injection string, mz double, area double, polarity string")
    assert {tuple(r) for r in G.distinct_ions(f, ["group_id"]).collect()} == walk(rows)
    quant = {r["group_id"]: r for r in G.quant_ions(f, ["group_id"]).collect()}
    assert (quant[99]["quant_ion"], quant[99]["n_ions"], quant[99]["positive"], quant[99]["negative"]) == (None, 0, True, False)
    for g in range(12):
        best = min((r for r in rows if r[0] == g), key=lambda r: (-r[3], r[1], r[2]))
        assert (quant[g]["quant_ion"], quant[g]["quant_polarity"]) == (best[2], best[4])
    assert G.distinct_ions(f.limit(0), ["group_id"]).count() == 0


def _drop():
    def decide(pair, first, second):
        if first["into"] is None and second["into"] is None:
            win, lose = (first, second) if first["v"] >= second["v"] else (second, first)
            lose["into"] = win["group_id"]
    return decide


def test_blocks_do_not_wait_for_one_another(spark, monkeypatch):
    """Where decisions stop mattering after a while, a chain over thirty blocks takes a few rounds."""
    tables = []
    monkeypatch.setattr(resolve, "next_round", lambda df, *older: tables.append(1) or next_round(df, *older))
    rng = random.Random(3)
    nodes = [("A", "+", i, rng.randrange(1000)) for i in range(901)]
    pairs = [("A", "+", i, j, 3 * i + j - i) for i in range(899) for j in (i + 1, i + 2)]
    state = {n[2]: {"group_id": n[2], "v": n[3], "into": None} for n in nodes}
    for p in sorted(pairs, key=lambda p: p[4]):
        _drop()(None, state[p[2]], state[p[3]])
    p, n = _frames(spark, pairs, nodes)
    got = {r["group_id"]: r["into"] for r in settle_in_order(p, [F.col("w")], ("a", "b"), n, _drop(), block=60, reads=[]).collect()}
    assert got == {k: s["into"] for k, s in state.items() if k < 901}
    assert len(tables) < 10


def _sweep_rows(spark):
    rng = random.Random(4)
    rows = [("A", "+", k, round(500 + rng.choice([0, 1.003, 21.98194, -250.0]) + k % 3 * 1e-4, 4), round(rng.uniform(1, 3), 2), rng.choice([0.1, 0.4]), float(rng.randrange(50)),
             *rng.choice([("[M+H]+", "PC 1:0", [250.0]), ("[M+Na]+", "PC 1:0", None), (None, None, None)])) for k in range(90)]
    g = spark.createDataFrame(rows, "study_id string, polarity string, group_id long, mz double, rt double, fwhm double, max_area double, adduct string, sum_name string, fragments array<double>")
    inj = spark.createDataFrame([("A", "+", f"I{i}", "sample", i) for i in range(9)], "study_id string, polarity string, injection string, role string, run_order int")
    cells = {(k, i): float(rng.randrange(1, 9)) for k in range(85) for i in range(9) if rng.random() < 0.7}  # five groups have none
    areas = spark.createDataFrame([("A", "+", k, f"I{i}", v) for (k, i), v in cells.items()], "study_id string, polarity string, group_id long, injection string, area double")
    return g, inj, areas, cells


@pytest.mark.parametrize("together", [65_536, 7])
def test_sweep_pairs_meet_their_cells_in_blocks(spark, monkeypatch, together):
    monkeypatch.setattr(G, "TOGETHER", together)
    g, inj, areas, cells = _sweep_rows(spark)
    out = G.sweep_pairs(g, ions.adduct_table(spark), areas, inj)
    assert "ArrowEvalPython" not in out._jdf.queryExecution().optimizedPlan().toString()  # no row of a pair holds cells
    got = out.collect()
    rt = {r["group_id"]: r["rt"] for r in g.collect()}
    assert len(got) > 100 and {r["rule"] for r in got} >= {"isotope", "known", "unknown", "source", "redundant"}
    for r in got:
        both = [(cells[r["later"], i], cells[r["earlier"], i]) for i in range(9) if (r["later"], i) in cells and (r["earlier"], i) in cells]
        x, y = [v for v, _ in both], [v for _, v in both]
        flat = len(x) < 5 or min(x) == max(x) or min(y) == max(y)
        rho = 0.0 if flat else float(np.corrcoef(x, y)[0, 1])
        assert r["tracks"] == (len(x) < 5 or rho >= 0.5) or abs(rho - 0.5) < 1e-9
        assert (r["later_rt"], r["earlier_rt"]) == (rt[r["later"]], rt[r["earlier"]]) and (r["later_rt"], r["later"]) > (r["earlier_rt"], r["earlier"])
    for rule, pairs, ends in (("isotope", G.isotope_pairs(g), ("light", "heavy")), ("redundant", G.redundant_pairs(g), ("later", "earlier")),
                              ("known", G.adduct_pairs_known(g, ions.adduct_table(spark)), ("known", "other")), ("source", G.in_source_pairs(g), ("parent", "fragment"))):
        mine = sorted((r["later"], r["earlier"]) if r["forward"] else (r["earlier"], r["later"]) for r in got if r["rule"] == rule)
        assert mine == sorted((r[ends[0]], r[ends[1]]) for r in pairs.collect())

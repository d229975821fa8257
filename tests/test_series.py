"""Repeat-unit series against a plain walk over each run's sorted masses."""

import random
from collections import defaultdict

import pytest

from massloom.operators import acquisition as A
from massloom.operators import series as R

SCHEMA = "study_id string, polarity string, mz double, scans long"


def walk(masses, discover=True):
    labels, masses = {}, sorted(set(masses))

    def claim(step, name, least):
        rest = [m for m in masses if m not in labels]
        before = len(labels)
        for start in rest:
            path, at = [], start
            while at is not None and at not in labels:
                path.append(at)
                near = [m for m in rest if at + step - R.SERIES_TOL <= m <= at + step + R.SERIES_TOL]
                at = min(near, key=lambda m: (abs(m - at - step), -m), default=None)
            if len(path) >= least:
                labels.update(dict.fromkeys(path, name))
        return len(labels) > before

    for name, step in R.REPEATS.items():
        claim(step, name, 3)
    while discover:
        rest = [m for m in masses if m not in labels]
        votes = defaultdict(list)
        for i, a in enumerate(rest):
            for b in rest[i + 1:]:
                cell = round(b - a, 2)
                if 20 <= b - a <= 200 and abs(cell - round(cell / R.CH2) * R.CH2) > 0.02:
                    votes[cell].append(b - a)
        best = max(votes.values(), key=len, default=[])
        if len(best) < 3:
            break
        step = sum(best) / len(best)
        if not claim(step, f"unnamed Δ{step:.3f}", 4):
            break
    return labels


def label(spark, runs, **how):
    rows = [(s, p, m, 1) for (s, p), ms in runs.items() for m in ms]
    out = R.assign_series(spark.createDataFrame(rows, SCHEMA).repartition(3), **how)
    assert out.columns == ["study_id", "polarity", "mz", "scans", "series"]
    found = defaultdict(dict)
    for r in out.collect():
        found[r.study_id, r.polarity][r.mz] = r.series
    return found


def test_series_of_plain_ladders(spark):
    runs = {("peg", "+"): [300.0 + 44.02621 * k for k in range(5)], ("ch2", "+"): [400.0 + 14.01565 * k for k in range(8)], ("pair", "+"): [300.0, 344.02621],
            ("odd", "-"): [500.0 + 33.333 * k for k in range(5)], ("salt", "-"): [44.9982 + 67.98738 * k for k in range(4, 12)], ("three", "+"): [500.0 + 33.333 * k for k in range(3)],
            ("column", "+"): [906.2654 + 74.01872 * k for k in range(6)] + [910.5]}
    found = {k[0]: set(v.values()) for k, v in label(spark, runs).items()}
    assert found == {"peg": {"PEG"}, "ch2": {""}, "pair": {""}, "odd": {"unnamed Δ33.333"}, "salt": {"sodium formate"}, "three": {""}, "column": {"polysiloxane", ""}}


@pytest.mark.parametrize("seed", [0])
def test_series_by_walking(spark, seed):
    """Crowded masses: ladders meet, short ones lapse, and named units take what an unnamed one would have wanted."""
    r = random.Random(seed)
    runs = {}
    for run in ("A", "B"):
        masses = {round(r.uniform(100, 420), 4) for _ in range(60)}
        for step in (44.02621, 58.04186, 31.4159):
            for _ in range(4):
                low = r.uniform(100, 200)
                masses |= {round(low + step * k + r.uniform(-0.006, 0.006), 4) for k in range(r.randint(2, 6))}
        runs[run, "+"] = sorted(masses)
    found = label(spark, runs)
    for key, masses in runs.items():
        want = walk(masses)
        assert {m: s for m, s in found[key].items() if s} == want and len(want) > 15


def test_series_rows_stay(spark):
    rows = [("A", "+", 300.0 + 44.02621 * k, k) for k in range(4)] + [("A", "+", 300.0, 9), ("A", "+", None, 5), ("B", "+", 1.0, 1)]
    out = R.assign_series(spark.createDataFrame(rows, SCHEMA), discover=False).collect()
    assert sorted((r.scans, r.series) for r in out) == [(0, "PEG"), (1, ""), (1, "PEG"), (2, "PEG"), (3, "PEG"), (5, ""), (9, "PEG")]
    assert {r.series for r in out if r.mz == 300.0} == {"PEG"} and [r.series for r in out if r.mz is None] == [""]
    assert R.assign_series(spark.createDataFrame([], SCHEMA)).count() == 0


def test_long_ladders_that_drift(spark):
    """Seventy rungs that drift over the turn of the remainder stay one ladder, whatever tiles they cross."""
    masses = [22.4 + 22.5085 * k for k in range(1, 71)] + [45.0, 90.3]
    rows = spark.createDataFrame([("A", "+", m, 22.5) for m in masses], "study_id string, polarity string, mz double, step double")
    for tile in (0.3, 1.0, 50.0):
        found = [r.mz for r in R.claimed(R.next_rung(rows), 4, tile=tile).collect()]
        assert sorted(found) == masses[:70]


def test_modifier_needs_evidence(spark):
    def survey(name, ladder, noise):
        return [("A", name, f"S{i}", i, m, 1.0) for i in range(6) for m in [*ladder, *noise]]

    formate = [44.9982 + 67.98738 * k for k in range(1, 8)]
    acetate = [59.0139 + 82.00303 * k for k in range(1, 8)]
    rows = survey("-", formate, [500.123]) + survey("+", formate, acetate) + survey("?", formate[:4], [])
    out = {r.polarity: (r.formate, r.acetate, r.call, r.reason) for r in A.detect_modifier(spark.createDataFrame(rows, "study_id string, polarity string, injection string, scan_no int, mz double, intensity double")).collect()}
    assert out == {"-": (42, 0, "formate", ""), "+": (42, 42, None, "both present"), "?": (24, 0, None, "too thin")}


def test_votes_leave_lipid_steps_out(spark):
    masses = spark.createDataFrame([("A", "+", 400.0 + 14.01565 * k, 1) for k in range(8)] + [("A", "+", 400.0 + 33.333 * k, 1) for k in range(1, 5)], SCHEMA)
    cells = {r.cell: r.n for r in R.delta_votes(masses).collect()}
    assert cells[33.33] == 4 and not any(abs(c - 28.03) < 0.02 for c in cells)
    (best,) = R.commonest_step(masses).collect()
    assert best.n == 4 and abs(best.step - 33.333) < 1e-9

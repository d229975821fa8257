"""Repeat-unit series of contaminants: ladders of masses one unit apart, and a vote of mass differences for unnamed units.

Nothing here gathers a run.  Each mass points to the mass one unit above it; masses of one ladder have nearly
the same remainder by the unit, so ladders are settled in tiles of the remainder with a halo as wide as
a ladder can drift.  Unnamed units come from a histogram of the differences of all pairs, counted where
the pairs arise.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from massloom.operators.band import Band, band_join
from massloom.operators.matrix import RUN
from massloom.session import next_round

# ---- fixed values: repeat units of common contaminants ----------------------------------------
REPEATS = {"polysiloxane": 74.01872, "PEG": 44.02621, "PPG": 58.04186, "PTFE/PFPE": 99.99361,
           "PFPE": 65.99146, "sodium formate": 67.98738, "sodium acetate": 82.00303}
CH2, CH2_GUARD = 14.01565, 0.02
SERIES_TOL, MIN_NAMED, MIN_UNNAMED, UNNAMED_RANGE = 0.01, 3, 4, (20.0, 200.0)
#: Width of a tile of remainders, and the mass range that bounds the rungs of a ladder; heavier masses only widen the halo.
TILE, MASS_RANGE = 1.0, 2000.0


def next_rung(masses: DataFrame, keys: list[str] = RUN, tol: float = SERIES_TOL) -> DataFrame:
    """``low, high, step``: the mass nearest one ``step`` above each mass, within ``tol``; the heavier of two as near.

    ``masses``: keys, mz, step (one of a key).
    """
    left = masses.select(*keys, "step", F.col("mz").alias("low"), (F.col("mz") + F.col("step")).alias("target"))
    pairs = band_join(left, masses.select(*keys, F.col("mz").alias("high")), [Band("target", "high", tol)], keys=keys)
    nearest = F.min_by("high", F.struct(F.abs(F.col("target") - F.col("high")), -F.col("high")))
    return pairs.groupBy(*keys, "low", "step").agg(nearest.alias("high"))


def claimed(rungs: DataFrame, least: int, keys: list[str] = RUN, tol: float = SERIES_TOL, tile: float = TILE) -> DataFrame:
    """``keys, mz, step`` of the masses that ladders of at least ``least`` masses take.

    Ladders start where nothing points, the lightest first, and end where another has taken the next mass.  Only
    those that share a top can meet.  From its top a ladder drifts by ``tol`` a rung at most, so the tile of remainders
    that holds the top, with that halo, holds all ladders under it; each tile settles the tops it holds.
    """
    rungs = rungs.withColumn("halo", tol * (F.ceil(F.greatest(F.lit(MASS_RANGE), F.col("high")) / F.col("step")) + 2))
    rungs = rungs.withColumn("tiles", F.greatest(F.lit(1), F.floor(F.col("step") / tile)).cast("int")).withColumn("wide", F.col("step") / F.col("tiles"))
    rest = F.col("low") - F.floor(F.col("low") / F.col("step")) * F.col("step")
    reached = F.sequence(F.floor((rest - F.col("halo")) / F.col("wide")), F.floor((rest + F.col("halo")) / F.col("wide")))
    tiled = rungs.withColumn("tile", F.explode(F.array_distinct(F.transform(reached, lambda t: F.pmod(t, F.col("tiles"))))))

    def settle(pdf: pd.DataFrame) -> pd.DataFrame:
        here, step, wide, tiles = (pdf[c].iloc[0] for c in ("tile", "step", "wide", "tiles"))
        above = dict(zip(pdf["low"], pdf["high"]))
        top: dict[float, float] = {}
        for mass in sorted(above, reverse=True):
            top[mass] = top.get(above[mass], above[mass])
        taken: set[float] = set()
        for mass in sorted(set(above) - set(above.values())):
            if int((top[mass] % step) // wide) % tiles != here:
                continue
            ladder = []
            while mass is not None and mass not in taken:
                ladder.append(mass)
                mass = above.get(mass)
            if len(ladder) >= least:
                taken.update(ladder)
        out = pd.DataFrame({"mz": sorted(taken), "step": step}, dtype=float)
        return out.assign(**{k: pdf[k].iloc[0] for k in keys})[[*keys, "mz", "step"]]

    schema = rungs.select(*keys, F.col("low").alias("mz"), "step").schema
    return tiled.groupBy(*keys, "tile").applyInPandas(settle, schema)


def delta_votes(masses: DataFrame, keys: list[str] = RUN, span: tuple[float, float] = UNNAMED_RANGE, salt: int = 8) -> DataFrame:
    """``cell, n, step, first``: how many pairs of masses differ by each hundredth (halves to the even one), their mean difference
    and their lightest mass.

    Multiples of CH2, which lipid series step by, have no vote.  The pairs of a mass lie within ``span``, and counts are
    combined where they arise; only one row a cell and task is sent.
    """
    parts = int(masses.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # a fixed number: few masses still make many pairs
    place = [*keys, "tile", "salt"]
    left = masses.select(*keys, F.col("mz").alias("low"), F.floor(F.col("mz") / span[1]).alias("tile"), F.pmod(F.xxhash64("mz"), F.lit(salt)).alias("salt"))
    right = masses.select(*keys, F.col("mz").alias("high"), F.floor(F.col("mz") / span[1]).alias("t")).withColumn("tile", F.explode(F.array(F.col("t") - 1, F.col("t")))).drop("t")
    right = right.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salt - 1).cast("long"))))
    pairs = left.repartition(parts, *place).join(right.repartition(parts, *place), place)
    # whole millionths: halves of a cell and sums are exact, whatever order the pairs come in
    pairs = pairs.withColumn("delta", F.rint((F.col("high") - F.col("low")) * 1e6).cast("long")).filter(F.col("delta").between(*[round(x * 1e6) for x in span]))
    under, rest = F.expr("delta div 10000"), F.expr("delta % 10000")
    up = (rest > 5000) | ((rest == 5000) & (under % 2 == 1))
    pairs = pairs.withColumn("cell", (under + up.cast("long")) / F.lit(100.0))
    lipid = F.abs(F.col("cell") - F.rint(F.col("cell") / CH2) * CH2) <= CH2_GUARD
    mean = F.sum("delta") / F.count(F.lit(1)) / F.lit(1e6)
    return pairs.filter(~lipid).groupBy(*keys, "cell").agg(F.count(F.lit(1)).alias("n"), mean.alias("step"), F.min("low").alias("first"))


def commonest_step(masses: DataFrame, keys: list[str] = RUN, least: int = MIN_UNNAMED - 1) -> DataFrame:
    """``step, n`` of the cell with most votes, at least ``least``; of equals the one met first from the lightest mass."""
    votes = delta_votes(masses, keys).filter(F.col("n") >= least)
    best = F.max_by(F.struct("step", "n"), F.struct("n", -F.col("first"), -F.col("cell")))
    return votes.groupBy(*keys).agg(best.alias("__b")).select(*keys, "__b.step", "__b.n")


def assign_series(rows: DataFrame, keys: list[str] = RUN, discover: bool = True, repeats: dict[str, float] = REPEATS) -> DataFrame:
    """``rows`` (distinct precursors, column ``mz``) plus ``series``, empty where a mass belongs to none.

    Named units claim in the order of ``repeats``, then, in each run as long as a unit claims anything, the step with
    most votes among the masses left.  Rows of one mass share its series; a null mass has none.
    """
    masses = rows.filter("mz IS NOT NULL").select(*keys, F.col("mz").cast("double").alias("mz")).distinct()
    labels = next_round(masses.withColumn("series", F.lit(None).cast("string")).withColumn("turn", F.lit(-1)))

    def claim(free: DataFrame, least: int, name, turn: int, *older: DataFrame) -> DataFrame:
        found = claimed(next_rung(free, keys), least, keys).select(*keys, "mz", name.alias("__s"))
        marked = labels.join(found, [*keys, "mz"], "left").withColumn("turn", F.when(F.col("__s").isNotNull(), turn).otherwise(F.col("turn")))
        return next_round(marked.withColumn("series", F.coalesce("series", "__s")).select(*keys, "mz", "series", "turn"), labels, *older)

    turn = 0
    for turn, (name, step) in enumerate(repeats.items()):
        labels = claim(labels.filter("series IS NULL").select(*keys, "mz", F.lit(step).alias("step")), MIN_NAMED, F.lit(name), turn)
    # a run votes again while its last turn claimed something; one without a winner has ended
    running = None
    while discover:
        free = labels.filter("series IS NULL").select(*keys, "mz")
        free = free if running is None else free.join(running, keys, "left_semi")
        winners = next_round(commonest_step(free, keys))
        if winners.isEmpty():
            break
        turn += 1
        free = labels.filter("series IS NULL").select(*keys, "mz").join(winners.select(*keys, "step"), keys)
        labels = claim(free, MIN_UNNAMED, F.format_string("unnamed Δ%.3f", "step"), turn, winners)
        running = labels.filter(F.col("turn") == turn).select(*keys).distinct()
    found = labels.filter("series IS NOT NULL").select(*keys, "mz", F.col("series").alias("__s"))
    return rows.join(found, [*keys, "mz"], "left").select(*rows.columns, F.coalesce("__s", F.lit("")).alias("series"))

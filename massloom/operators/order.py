"""Places in an order, without sorting a key in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from massloom.operators.matrix import RUN
from massloom.session import next_round


def ordered(rows: DataFrame, *order: Column, keys: list[str] = RUN, place: str = "place") -> DataFrame:
    """``rows`` plus ``place``, their number from 1 in the ``order`` of each key.

    The whole table is cut into ranges of (keys, order), each range is sorted in its task, and the places come from the
    numbers of rows in the ranges before it; no key is ever sorted in one task.  ``order`` should be total: rows
    that tie in it are numbered in any order.  The ranges are a written table, so a lost executor cannot number anew
    what others have read.  An empty table stays empty.
    """
    by = [*[F.col(k) for k in keys], *order]
    cut = rows.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("__at", F.monotonically_increasing_id())
    # the identifier holds the range in its upper bits and the row within it in the lower 33
    cut = next_round(cut.withColumn("__range", F.shiftright("__at", 33)))
    sizes = cut.groupBy("__range").agg(F.count(F.lit(1)).alias("n"))
    # one row for each range: as many as there are shuffle partitions
    before = sizes.select("__range", (F.sum("n").over(Window.orderBy("__range")) - F.col("n")).alias("__before"))
    global_place = F.col("__at").bitwiseAND((1 << 33) - 1) + F.col("__before") + 1
    numbered = cut.join(F.broadcast(before), "__range").withColumn("__global", global_place)
    starts = numbered.groupBy(*[F.col(k).alias(f"__{k}") for k in keys]).agg(F.min("__global").alias("__first"))
    same = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys]
    # one row a key
    return numbered.join(F.broadcast(starts), same).select(*[f"`{c}`" for c in rows.columns], (F.col("__global") - F.col("__first") + 1).alias(place))


def averaged_places(counts: DataFrame, keys: list[str], value: str, n: str = "n") -> DataFrame:
    """``counts`` (``keys``, distinct ``value``, its number ``n``) plus ``place``: the rank from 1 that ``n`` equal values share.

    Ranges of (keys, value) are numbered one by one, each from the numbers in the ranges before it, so no task holds the
    values of a key.  The ranges are a written table, as in ``ordered``.
    """
    by = [*keys, value]
    cut = next_round(counts.repartitionByRange(*by).withColumn("__range", F.spark_partition_id()))
    within = F.sum(n).over(Window.partitionBy("__range", *keys).orderBy(value))
    sizes = cut.groupBy("__range", *keys).agg(F.sum(n).alias("__n"))
    # a row for each range and each key that begins in it
    before = sizes.select("__range", *keys, (F.sum("__n").over(Window.partitionBy(*keys).orderBy("__range")) - F.col("__n")).alias("__before"))
    placed = cut.withColumn("__upto", within).join(F.broadcast(before), ["__range", *keys])
    place = F.col("__before") + F.col("__upto") - F.col(n) + (F.col(n) + 1) / F.lit(2.0)
    return placed.select(*[f"`{c}`" for c in counts.columns], place.alias("place"))


def placed_spearman(rows: DataFrame, keys: list[str], place: str, y: str, out: str = "rho") -> DataFrame:
    """``keys, out``: Spearman of keys of any size, from the averaged rank ``place`` of one side and the values ``y`` of the other.

    Rows of equal ``y`` are added up where they lie, and only distinct values are put in order.  Ranks are taken about their
    mean.  A key with no spread on either side gets 0.
    """
    x = F.col(place)
    at = rows.groupBy(*keys, y).agg(F.count(F.lit(1)).alias("n"), F.sum(x).alias("__x"), F.sum(x * x).alias("__xx"))
    both = averaged_places(at, keys, y, "n")
    n, p = F.col("n"), F.col("place")
    sums = both.groupBy(*keys).agg(F.sum(n).alias("n"), F.sum("__x").alias("__x"), F.sum("__xx").alias("__xx"), F.sum(n * p).alias("__y"))
    mean = sums.select(*keys, (F.col("__x") / n).alias("__mx"), (F.col("__y") / n).alias("__my"), (F.col("__xx") - F.col("__x") * F.col("__x") / n).alias("__vx"))
    # one row a key
    about = both.join(F.broadcast(mean), keys)
    dy = p - F.col("__my")
    agg = about.groupBy(*keys).agg(F.sum((F.col("__x") - n * F.col("__mx")) * dy).alias("__c"), F.first("__vx").alias("__vx"), F.sum(n * dy * dy).alias("__vy"))
    rho = F.when((F.col("__vx") > 0) & (F.col("__vy") > 0), F.col("__c") / F.sqrt(F.col("__vx") * F.col("__vy")))
    return agg.select(*keys, F.coalesce(rho, F.lit(0.0)).alias(out))


#: Cells of the logarithmic grid per factor e, and the shift that puts those of every positive double above 0.
CELLS, SHIFT = 1000, 800_000


def quantiles(rows: DataFrame, keys: list[str], wanted: dict[str, tuple[Column, float]], weight: Column | None = None) -> DataFrame:
    """``keys`` and one column per name of ``wanted`` (value, share): exact quantiles, interpolated like ``percentile``.

    Values of either sign are counted on a logarithmic grid, with map-side combine.  The cells that hold the wanted ranks
    follow from the counts, and only values of these cells are put in order, as (value, count) pairs: no task holds the
    distinct values of a key.  Nulls and NaN are left out; a name without a value is null, and a key without any has no row.
    Key columns are not null.  ``weight``, a whole number above 0, is how many times a row counts.
    """
    weight = F.lit(1) if weight is None else weight
    values = list({str(v): v for v, _ in wanted.values()}.values())
    tags = {str(v): i for i, v in enumerate(values)}
    entry = F.explode(F.array(*[F.struct(F.lit(i).alias("tag"), v.cast("double").alias("v")) for i, v in enumerate(values)]))
    v = F.col("v")
    size = F.floor(F.log(F.abs(v)) * CELLS).cast("long") + SHIFT
    p = (rows.select(*keys, entry.alias("__e"), weight.cast("long").alias("w")).select(*keys, "__e.tag", "__e.v", "w").filter(v.isNotNull() & ~F.isnan(v))
         .withColumn("cell", F.when(v > 0, size).when(v < 0, -size).otherwise(F.lit(0).cast("long"))))
    at = [*keys, "tag"]
    cells = p.groupBy(*at, "cell").agg(F.sum("w").alias("n"))
    up = Window.partitionBy(*at).orderBy("cell")
    cells = cells.withColumn("upto", F.sum("n").over(up)).withColumn("total", F.sum("n").over(Window.partitionBy(*at)))
    place = lambda q: (F.col("total") - 1) * F.lit(float(q))
    asked = F.array(*[F.struct(F.lit(tags[str(c)]).alias("t"), F.lit(name).alias("name"), side.alias("side"), rank.cast("long").alias("rank"), place(q).alias("place"))
                      for name, (c, q) in wanted.items() for side, rank in ((F.lit(0), F.floor(place(q)) + 1), (F.lit(1), F.ceil(place(q)) + 1))])
    inside = lambda r: (r["t"] == F.col("tag")) & (r["rank"] <= F.col("upto")) & (r["rank"] > F.col("upto") - F.col("n"))
    held = cells.withColumn("asked", F.filter(asked, inside)).filter(F.size("asked") > 0).withColumn("before", F.col("upto") - F.col("n"))
    counts = p.join(held.select(*at, "cell"), [*at, "cell"], "left_semi").groupBy(*at, "cell", "v").agg(F.sum("w").alias("c"))
    placed = counts.withColumn("last", F.sum("c").over(Window.partitionBy(*at, "cell").orderBy("v")))
    found = (placed.join(held.select(*at, "cell", "before", F.explode("asked").alias("r")), [*at, "cell"])
             .filter((F.col("before") + F.col("last") >= F.col("r.rank")) & (F.col("before") + F.col("last") - F.col("c") < F.col("r.rank"))))
    side = lambda name, k: F.max(F.when((F.col("r.name") == name) & (F.col("r.side") == k), v))

    def between(name: str) -> Column:
        low, high, spot = side(name, 0), side(name, 1), F.max(F.when(F.col("r.name") == name, F.col("r.place")))
        return F.when(low == high, low).otherwise((F.ceil(spot) - spot) * low + (spot - F.floor(spot)) * high)

    return found.groupBy(*keys).agg(*[between(name).alias(name) for name in wanted])

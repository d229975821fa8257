"""Verdicts on pairs that must be decided in a prescribed order, without any one task walking a run.

The pairs of a run are numbered in their order and cut into blocks of neighbouring places.  All blocks are walked at once, each
from the states its ends are thought to have when it begins; a round then hands every end's state on to the next block it
stands in, and blocks that began from another state are walked anew.  When no block did, every block began where the one before it
ended, so the result is that of the walk, whatever the size of a block.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from massloom.operators.band import spread
from massloom.operators.matrix import RUN
from massloom.operators.order import ordered
from massloom.session import next_round

#: Pairs one task walks at most; only speed depends on it.
BLOCK = 200_000
#: Pairs that are Python objects at once.
WALKED = 8_192


def settle_in_order(pairs: DataFrame, order: list[Column], ends: tuple[str, str], nodes: DataFrame, decide: Callable[[dict, dict, dict], None],
                    keys: list[str] = RUN, node: str = "group_id", block: int = BLOCK, reads: Sequence[str] | None = None) -> DataFrame:
    """The ``nodes`` that stand in a pair, in their state after ``decide`` has seen all pairs in ``order``.

    ``pairs``: keys, the two ``ends`` and the columns that ``decide`` ``reads`` (all, unless named), one row a pair; ``order`` is total.  ``nodes``: keys, ``node`` and
    its state, one row a node.  ``decide(pair, first, second)`` changes the states, which are dicts, in place, and reads nothing
    else.  A pair with an end that ``nodes`` lacks is passed over.

    A seat is a node in a block.  A round is one pass over the blocks that began from another state than the one they are now
    handed, and one written table of seats.  The first block is right after the first round, and each round settles at least
    one more of every run, so there are no more rounds than a chain of pairs has blocks, plus one; where a decision stops
    mattering after a while, as where a dropped group drops no other, there are few.
    """
    first, second = ends
    at = [*keys, node]
    numbered = ordered(pairs, *order, keys=keys)
    told = list(dict.fromkeys([*ends, *(reads if reads is not None else [c for c in pairs.columns if c not in keys])]))
    walked = next_round(numbered.select(*keys, *told, "place", F.floor((F.col("place") - 1) / block).alias("__block")))
    one, other = (walked.select(*keys, F.col(e).alias(node), "__block") for e in ends)
    state = T.StructType([T.StructField(f.name, f.dataType, True) for f in nodes.schema.fields])
    begin = nodes.select(*at, F.struct(*[f"`{c}`" for c in nodes.columns]).cast(state).alias("__in"))
    seats = next_round(one.union(other).distinct().join(spread(begin), at).withColumn("__out", F.lit(None).cast(state)))
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in seats.select(*at, "__block", "__in", "__out").schema.fields])
    arrow = to_arrow_schema(schema)

    def walk(mine: pa.Table, held: pa.Table) -> pa.Table:
        held = held.select(arrow.names)
        if not mine.num_rows or not held.num_rows:
            return held.cast(arrow)
        states = held["__in"].to_pylist()
        by_node = dict(zip(held[node].to_pylist(), states, strict=True))
        met: set = set()
        for batch in mine.sort_by("place").select(told).to_batches(max_chunksize=WALKED):
            for values in zip(*map(_values, batch.columns), strict=True):
                pair = dict(zip(told, values, strict=True))
                x, y = by_node.get(pair[first]), by_node.get(pair[second])
                if x is not None and y is not None:
                    decide(pair, x, y)
                    met.update((pair[first], pair[second]))
        ended = [n if k in met else None for k, n in by_node.items()]
        return held.drop_columns(["__out"]).append_column("__out", pa.array(ended, arrow.field("__out").type)).cast(arrow)

    before = Window.partitionBy(*at).orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    handed = F.coalesce(F.last("__out", ignorenulls=True).over(before), F.col("__in"))
    mine = walked
    while not mine.isEmpty():
        done = mine.groupBy(*keys, "__block").cogroup(seats.groupBy(*keys, "__block")).applyInArrow(walk, schema)
        moved = done.withColumn("__next", handed).withColumn("__moved", ~F.col("__next").eqNullSafe(F.col("__in")))
        seats = next_round(moved.select(*at, "__block", F.col("__next").alias("__in"), "__out", "__moved"), seats)
        # one row a block
        again = F.broadcast(seats.filter("__moved").select(*keys, "__block").distinct())
        mine = walked.join(again, [*keys, "__block"], "left_semi")
        seats_path, seats = seats._round_path, seats.drop("__moved")
        seats._round_path = seats_path
    return seats.filter("__out IS NOT NULL").groupBy(*at).agg(F.max_by("__out", "__block").alias("__last")).select(*[F.col(f"__last.`{c}`").alias(c) for c in nodes.columns])


def _values(column: pa.Array) -> list:
    """As ``to_pylist``, which is slow for plain numbers."""
    plain = pa.types.is_integer(column.type) or pa.types.is_floating(column.type) or pa.types.is_boolean(column.type)
    return column.to_numpy(zero_copy_only=False).tolist() if plain and not column.null_count else column.to_pylist()


def follow(pointers: DataFrame, node: str, to: str, keys: list[str] = RUN) -> DataFrame:
    """``keys, node, to``: where each chain of pointers ends.  The pointers form no circle; each round doubles the steps taken."""
    at = next_round(pointers.select(*keys, node, to))
    while True:
        ahead = at.select(*keys, F.col(node).alias(to), F.col(to).alias("__next"))
        step = at.join(spread(ahead), [*keys, to], "left")
        if step.filter("__next IS NOT NULL").isEmpty():
            return at
        at = next_round(step.select(*keys, node, F.coalesce("__next", to).alias(to)), at)

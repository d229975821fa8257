"""Exact top-k by inner product: distances to pivots bound every score, and candidates are evaluated in the order of their bounds."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from massloom.llm.common import slices, written

#: Pivots, the vectors they are chosen from (those of smallest hash), queries of one pass on average.
PIVOTS, SAMPLE, PASS = 16, 1024, 8192
#: Queries and candidates bounded at once.
TOGETHER, BATCH = 512, 2048
#: Highest bounds evaluated before all others, times k.
HEAD = 8
_LONG = np.iinfo(np.int64)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of the integer rows of ``a`` and ``b``; what no long can hold becomes the nearest long."""
    most = int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0)) * max(a.shape[1], 1)
    if most < 1 << 53:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    if most <= _LONG.max:
        return a @ b.T
    return np.clip(a.astype(object) @ b.T.astype(object), _LONG.min, _LONG.max).astype(np.int64)


def distances(vectors: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Of each row to each pivot; the shorter of two vectors counts as filled up with zeros."""
    x, p = vectors.astype(np.float64), pivots.astype(np.float64)
    both = min(x.shape[1], p.shape[1])
    squares = (x * x).sum(1)[:, None] + (p * p).sum(1)[None] - 2 * x[:, :both] @ p[:, :both].T
    return np.sqrt(np.maximum(squares, 0))


def choose_pivots(sample: list[np.ndarray], count: int = PIVOTS) -> np.ndarray:
    """The longest vector, then each time the one farthest from all chosen."""
    width = max((len(v) for v in sample), default=0)
    table = np.zeros((len(sample), width))
    for row, vector in zip(table, sample, strict=True):
        row[:len(vector)] = vector
    chosen, gap = [], (table * table).sum(1)
    for _ in range(min(count, len(sample))):
        chosen.append(int(gap.argmax()))
        apart = distances(table, table[chosen[-1:]])[:, 0]
        gap = apart if len(chosen) == 1 else np.minimum(gap, apart)
    return table[chosen]


class Best:
    """The k best (score, id) of each query so far; ties go to the smaller id."""

    def __init__(self, queries: int, k: int) -> None:
        self.k = k
        self.score = np.full((queries, k), _LONG.min)
        self.id = np.full((queries, k), _LONG.max)
        self.found = np.zeros((queries, k), dtype=bool)

    def least(self) -> np.ndarray:
        """The score a candidate has to reach, minus infinity while fewer than k are found."""
        return np.where(self.found[:, -1], self.score[:, -1].astype(np.float64), -np.inf)

    def add(self, rows: np.ndarray, scores: np.ndarray, ids: np.ndarray, allowed: np.ndarray) -> None:
        """Candidates (columns) of the queries ``rows``."""
        score, name = np.hstack([self.score[rows], scores]), np.hstack([self.id[rows], np.broadcast_to(ids, scores.shape)])
        found = np.hstack([self.found[rows], allowed])
        order = np.lexsort((name, -np.maximum(score, -_LONG.max), ~found), axis=1)[:, :self.k]
        self.score[rows], self.id[rows], self.found[rows] = (np.take_along_axis(x, order, 1) for x in (score, name, found))


def _evaluate(best: Best, q: dict, ids: np.ndarray, copies: np.ndarray, x: np.ndarray, table: np.ndarray) -> None:
    """One batch of candidates: the highest bounds first, then all that can still reach the k-th best score."""
    size = (x.astype(np.float64) ** 2).sum(1)
    gap = np.zeros((len(q["id"]), len(ids)))
    for column in range(table.shape[1]):
        np.maximum(gap, np.abs(q["table"][:, column, None] - table[None, :, column]), out=gap)
    bound = (q["size"][:, None] + size[None]) * (0.5 + 1e-9) - 0.5 * gap * gap + 1
    head = min(best.k * HEAD, len(ids))
    rows = np.flatnonzero((bound >= best.least()[:, None]).any(1))
    if not len(rows):
        return

    def score(rows: np.ndarray, columns: np.ndarray, fresh: np.ndarray | None = None) -> None:
        found = products(q["vector"][rows], x[columns])
        own = (ids[columns][None] == q["id"][rows, None]) & (copies[columns] == 1)[None] & (found == q["square"][rows, None]) & (size[columns][None] == q["size"][rows, None])
        best.add(rows, found, ids[columns], ~own if fresh is None else ~own & fresh)

    first = np.argpartition(-bound[rows], head - 1, axis=1)[:, :head]
    seen = np.zeros((len(rows), len(ids)), dtype=bool)
    np.put_along_axis(seen, first, True, 1)
    for at in range(0, len(rows), 64):
        columns = np.unique(first[at:at + 64])
        score(rows[at:at + 64], columns, seen[at:at + 64][:, columns])
    left = ~seen & (bound[rows] >= best.least()[rows, None])
    for at in range(0, len(rows), 256):
        columns = np.flatnonzero(left[at:at + 256].any(0))
        some = np.flatnonzero(left[at:at + 256].any(1)) + at
        if len(columns):
            score(rows[some], columns, left[some][:, columns])


def _matrix(column: pa.ListArray) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), len(flat) // len(column)) if len(flat) else flat.reshape(len(column), 0)


def _pass(pivoted: DataFrame, queries: pd.DataFrame, pivots: np.ndarray, k: int) -> DataFrame:
    """query_no, score, vec_id: the k best candidates of each task for the queries of one pass."""
    groups = []
    for dims, rows in queries.groupby("dims"):
        for at in range(0, len(rows), TOGETHER):
            some = rows.iloc[at:at + TOGETHER]
            vector = np.array(some["vector"].tolist(), dtype=np.int64).reshape(len(some), dims)
            groups.append({"no": some["no"].to_numpy(), "id": some["vec_id"].to_numpy(), "vector": vector, "table": distances(vector, pivots),
                           "size": (vector.astype(np.float64) ** 2).sum(1), "square": np.array([products(v[None], v[None])[0, 0] for v in vector])})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(len(q["id"]), k) for q in groups]
        for part in slices(batches, BATCH):
            lengths = part.column(2).value_lengths().to_numpy()
            for dims in np.unique(lengths):
                some = part.filter(pa.array(lengths == dims))
                ids, copies, x, table = some.column(0).to_numpy(), some.column(1).to_numpy(), _matrix(some.column(2)), _matrix(some.column(3))
                for b, q in zip(best, groups, strict=True):
                    if q["vector"].shape[1] == dims:
                        _evaluate(b, q, ids, copies, x, table)
        for b, q in zip(best, groups, strict=True):
            at, rank = np.nonzero(b.found)
            yield pa.RecordBatch.from_arrays([pa.array(q["no"][at], pa.int64()), pa.array(b.score[at, rank], pa.int64()), pa.array(b.id[at, rank], pa.int64())], ["no", "score", "vec_id"])

    return pivoted.mapInArrow(run, "no long, score long, vec_id long")


def _tabled(rows: DataFrame, pivots: np.ndarray) -> DataFrame:
    """The pivot table: each vector with its distances to the pivots and its nearest one."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, BATCH):
            lengths = part.column(2).value_lengths().to_numpy()
            for dims in np.unique(lengths):
                some = part.filter(pa.array(lengths == dims))
                table = distances(_matrix(some.column(2)), pivots)
                rows = pa.ListArray.from_arrays(np.arange(0, table.size + 1, table.shape[1], dtype=np.int32), table.ravel())
                yield pa.RecordBatch.from_arrays([*some.columns, rows, pa.array(table.argmin(1).astype(np.int32)), pa.array(table.min(1))], ["vec_id", "copy", "vector", "table", "cell", "near"])

    return rows.select("vec_id", "copy", "vector").mapInArrow(run, "vec_id long, copy int, vector array<long>, table array<double>, cell int, near double")


def integer_vectors(rows: DataFrame, vec_col: str, scale: int) -> Column:
    """floor(scale * x) of every component as double, null where the vector or a component is null or not finite."""
    whole = F.col(vec_col).cast("array<double>")
    odd = F.exists(whole, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.when(~F.coalesce(odd, F.lit(True)), F.transform(whole, lambda x: F.greatest(F.least(F.floor(x * scale), F.lit(1 << 31)), F.lit(-(1 << 31)))))


def top_k(rows: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding", *, scale: int = 256, pivots: int = PIVOTS, queries_a_pass: int = PASS) -> DataFrame:
    """The k candidates of highest integer inner product for every query row, against all other rows.

    Every vector gets its distances to the pivots once, in a written table dealt out by nearest pivot. With them,
    |q - x| is at least the largest |d(q, p) - d(x, p)|, and the inner product at most (|q|^2 + |x|^2 - |q - x|^2) / 2.
    The queries pass over the table in blocks of about ``queries_a_pass``, dealt out by hash; a task bounds each batch of candidates,
    evaluates the highest bounds exactly, and of the others those whose bound reaches the k-th best score.

    Result: query_id, rank (from 1), vec_id, score. Ties go to the smaller vec_id. Components are floor(scale * x),
    at most 2^31 either way. Vectors that are null or hold null or non-finite components take no part, nor do rows
    without an id; a query meets vectors of its own length only. Rows are what counts: a repeated row is another
    candidate, also of itself, and another query with rows of its own. More than k + 1 rows of one vector cannot all
    be reported, so as many of smallest id stand for them. An empty table gives no rows.
    """
    spark = rows.sparkSession
    good = rows.select(F.col(id_col).cast("long").alias("vec_id"), integer_vectors(rows, vec_col, scale).alias("vector"), F.coalesce(is_query, F.lit(False)).alias("asks")).filter("vec_id IS NOT NULL AND vector IS NOT NULL").withColumn("h", F.xxhash64("vector"))
    order = Window.partitionBy("h", "vector").orderBy("vec_id")
    kept = good.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k + 1)
    kept = kept.withColumn("copy", F.row_number().over(Window.partitionBy("h", "vector", "vec_id").orderBy("place")))
    kept = written(kept.select("vec_id", "copy", "vector", "h"))
    sample = kept.filter("copy = 1").select("h", "vector").distinct().orderBy("h", "vector").limit(SAMPLE).collect()
    chosen = choose_pivots([np.array(r["vector"], dtype=np.float64) for r in sample], pivots)
    none = spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    if not len(chosen):
        return none
    pivoted = written(_tabled(kept, chosen).repartitionByRange("cell", "near").sortWithinPartitions("cell", "near"))
    asked = good.filter("asks").groupBy("vec_id", "h", "vector").agg(F.count("*").alias("times"))
    asked = written(asked.select(F.monotonically_increasing_id().alias("no"), "vec_id", "vector", F.size("vector").alias("dims"), "times"))
    passes = -(-asked.count() // queries_a_pass)
    found = []
    for number in range(passes):
        block = asked.filter(F.pmod(F.xxhash64("no"), F.lit(passes)) == number)
        part = _pass(pivoted, block.select("no", "vec_id", "vector", "dims").toPandas(), chosen, k)
        best = part.withColumn("rank", F.row_number().over(Window.partitionBy("no").orderBy(F.desc("score"), "vec_id"))).filter(F.col("rank") <= k)
        found.append(written(best))
    if not found:
        return none
    whole = found[0]
    for one in found[1:]:
        whole = whole.union(one)
    names = asked.select("no", F.col("vec_id").alias("query_id"), "times")
    return whole.join(names, "no").withColumn("time", F.explode(F.sequence(F.lit(1), F.col("times").cast("int")))).select("query_id", "rank", "vec_id", "score")

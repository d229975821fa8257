"""Registered queries: each key maps a Spark callable and, where expressible, its reference SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def _bigint_counts(sql: str) -> str:
    """The reference engine counts conditions in a wider integer than Spark's; cast each such count."""
    out, at = "", 0
    while (start := sql.find("count_if(", at)) >= 0:
        depth, end = 1, start + len("count_if(")
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[end], 0)
            end += 1
        out += f"{sql[at:start]}cast({sql[start:end]} AS bigint)"
        at = end
    return out + sql[at:]


def query(key: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register the decorated ``(spark, sf_dir) -> DataFrame`` under ``key``."""
    def add(fn: Query) -> Query:
        if key in QUERIES:
            raise KeyError(key)
        QUERIES[key] = fn
        if sql is not None:
            ORACLES[key] = _bigint_counts(sql)
        return fn
    return add

"""Registry of the named queries and their DuckDB oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None, texts: tuple[str, ...] = ()):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name`` with its oracle SQL.

    ``texts`` names array columns that are reported as comma-joined text
    (NULL stays NULL) on both sides, so results compare as flat values.
    """
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        if texts:
            def run(spark, sf_dir, _fn=fn):
                df = _fn(spark, sf_dir)
                return df.withColumns({c: F.array_join(c, ",") for c in texts})
            run.__name__, run.__doc__ = fn.__name__, fn.__doc__
            QUERIES[name] = run
        else:
            QUERIES[name] = fn
        if sql is not None:
            text_sql = sql
            if texts:
                repl = ", ".join(f"array_to_string({c}, ',') AS {c}" for c in texts)
                text_sql = f"SELECT * REPLACE ({repl}) FROM (\n{sql}\n) AS q"
            ORACLE[name] = text_sql
        return fn
    return deco

"""Registered queries and the SQL that gives the same result."""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None, text: tuple[str, ...] = ()):
    """Register a query. Columns named in ``text`` (dates, timestamps) are compared as text."""
    def keep(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            out = fn(spark, sf_dir)
            return out.withColumns({c: F.col(c).cast("string") for c in text}) if text else out

        QUERIES[name] = run
        if sql is not None:
            casts = ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in text)
            SQL[name] = f"SELECT * REPLACE ({casts}) FROM ({sql.strip()}) q" if text else sql.strip()
        return fn
    return keep

"""Registration of queries with their SQL. Results carry dates and timestamps as text, so that engines compare alike."""

from __future__ import annotations

import functools

from pyspark.sql import functions as F


def register(queries: dict, oracles: dict):
    def query(sql: str | None = None):
        def add(f):
            @functools.wraps(f)
            def run(spark, d):
                df = f(spark, d)
                formats = {"date": "yyyy-MM-dd", "timestamp": "yyyy-MM-dd HH:mm:ss"}
                return df.select(*[F.date_format(F.col(f"`{c}`"), formats[t]).alias(c) if t in formats else F.col(f"`{c}`") for c, t in df.dtypes])

            queries[f.__name__] = run
            if sql:
                oracles[f.__name__] = sql
            return f

        return add

    return query

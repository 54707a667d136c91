"""Named queries and their comparison SQL."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query under a name, with DuckDB SQL for the same result if it has one."""

    def keep(fn):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return keep


def r6(value, digits: int = 6) -> Column:
    return F.round(F.col(value) if isinstance(value, str) else value, digits)


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double column, so that summation order cannot show."""
    return df.select(*[F.round(c, digits).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


def long(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("long") for c in cols})

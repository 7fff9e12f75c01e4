"""Where the registered queries and their oracles are collected."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltide.sources.tables import scan_parquet

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
CTES: dict[str, tuple[tuple[str, ...], str]] = {}


def cte(name: str, body: str, *needs: str) -> None:
    CTES[name] = (needs, body)


def with_ctes(body: str, *names: str) -> str:
    """The body behind a WITH clause of the named CTEs and all they need."""
    order: list[str] = []

    def add(name: str) -> None:
        for need in CTES[name][0]:
            add(need)
        if name not in order:
            order.append(name)

    for name in names:
        add(name)
    if not order:
        return body
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n][1].strip()})" for n in order) + "\n" + body.strip()


def query(sql: str | None = None, *ctes: str):
    """Register a query under its function's name, with its oracle if there is one."""

    def register(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = with_ctes(sql, *ctes)
        return fn

    return register


def r6(df: DataFrame, *cols: str) -> DataFrame:
    """Round the named columns (all double columns, if none is named) to six digits."""
    names = cols or [c for c, t in df.dtypes if t in ("double", "float")]
    return df.withColumns({c: F.round(c, 6) for c in names})


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str, spread_by: str | None = None) -> DataFrame:
    return scan_parquet(spark, f"{sf_dir}/{name}.parquet", columns=columns, spread_by=spread_by)

"""Query registry: one entry per operator, with its DuckDB oracle.

Each entry binds an operator to the driver tables (``build(spark, sf_dir)``)
and carries an independent SQL statement over the same Parquet tables.
Floating columns listed in ``dbl`` are rounded identically on both sides
(``round(x + 1e-9, digits)``: the epsilon keeps exact decimal ties and
negative zero from flipping between engines).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.plans import oracle_views, views


@dataclass
class Entry:
    name: str
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None
    dbl: tuple[str, ...] = field(default_factory=tuple)
    digits: int = 6
    stored: bool = False


REGISTRY: dict[str, Entry] = {}


def register(name: str, sql: str | None = None, dbl=(), digits: int = 6, stored: bool = False):
    """``stored``: the query reads the sequence more than once, so it is written once first."""
    def deco(fn):
        if name in REGISTRY:
            raise KeyError(f"duplicate query {name}")
        REGISTRY[name] = Entry(name, fn, sql, tuple(dbl), digits, stored)
        return fn
    return deco


def _round_cols(df: DataFrame, cols, digits) -> DataFrame:
    if not cols:
        return df
    return df.withColumns({c: F.round(F.col(c) + F.lit(1e-9), digits) for c in cols})


def spark_query(e: Entry) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        if not e.stored:
            return _round_cols(e.build(spark, sf_dir), e.dbl, e.digits)
        with views.stored_views():
            return _round_cols(e.build(spark, sf_dir), e.dbl, e.digits)
    run.__name__ = e.name
    return run


def oracle(e: Entry) -> str | None:
    if e.sql is None:
        return None
    sql = oracle_views.with_views(e.sql.strip())
    if e.dbl:
        rep = ", ".join(f"round({c} + 1e-9, {e.digits}) AS {c}" for c in e.dbl)
        sql = f"SELECT * REPLACE ({rep}) FROM ({sql}) AS _q"
    return sql


def load_all() -> dict[str, Entry]:
    """Import every plan module so its ``@register`` decorators run."""
    from stratum.plans import catalog  # noqa: F401
    return REGISTRY


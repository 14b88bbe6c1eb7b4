"""Registered queries: one Spark job per operator plus its DuckDB twin.

Every query reads the driver tables of ``sf_dir`` (through the member table
or the scored set that Spark derives from them), so its work grows with the
tables. ``oracle`` is ANSI SQL over the same parquet views, with the fixture
CTEs of ``fixture_sql`` prepended; ``None`` means model-dependent output that
is checked by row count and properties only.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .fixture_sql import with_fixtures

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}
_ORACLE: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn: Query) -> Query:
        if name in _QUERIES:
            raise ValueError(f"duplicate query {name}")
        _QUERIES[name] = fn
        if oracle is not None:
            _ORACLE[name] = with_fixtures(oracle)
        return fn
    return deco


# Doubles are compared after rounding to this many decimals on both sides:
# averages, deviations and double sums are order dependent across engines.
DIGITS = 6


def _rounded(fn: Query) -> Query:
    from pyspark.sql import functions as F
    from pyspark.sql import types as T

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = fn(spark, sf_dir)
        return df.select(*[F.round(F.col(f"`{f.name}`"), DIGITS).alias(f.name)
                           if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f"`{f.name}`")
                           for f in df.schema.fields])
    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


def queries() -> dict[str, Query]:
    """Registered queries; double columns of those with a SQL twin are rounded
    to ``DIGITS`` decimals (output formatting for the comparison)."""
    _load()
    return {k: (_rounded(v) if k in _ORACLE else v) for k, v in _QUERIES.items()}


def raw_queries() -> dict[str, Query]:
    _load()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    from .double_columns import DOUBLE_COLUMNS
    _load()
    out = {}
    for k, sql in _ORACLE.items():
        cols = DOUBLE_COLUMNS.get(k)
        if cols:
            rep = ", ".join(f'round("{c}", {DIGITS}) AS "{c}"' for c in cols)
            sql = f"SELECT * REPLACE ({rep}) FROM (\n{sql}\n) AS _q"
        out[k] = sql
    return out


def _load():
    # importing the modules registers their queries
    import importlib
    for mod in ("q_profile", "q_features", "q_evaluate", "q_campaign", "q_models", "q_sources",
                "q_streaming"):
        importlib.import_module(f"{__package__}.{mod}")


# --- SQL helpers shared by the query modules --------------------------------

def union_all(parts) -> str:
    return "\nUNION ALL\n".join(parts)

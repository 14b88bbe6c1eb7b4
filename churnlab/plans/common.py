"""Shared inputs of the registered queries (column roles of the member table)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..session import reuse
from . import members as M

ID = "member_id"
Y = "churn"
NUM = ["fee", "visits", "avg_value", "urgent", "returns", "parts", "wait_days"]
COUNTERS = ["visits", "urgent", "returns", "parts"]
CAT = ["segment", "region", "pref"]


def members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The member table, computed once per plan that reads it.

    Queries read it several times (aggregates, scalar subqueries, joins
    back); without it each read would redo the join of orders, lines,
    events and customers.
    """
    return reuse(M.members(spark, sf_dir))


def planted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reuse(M.with_planted(M.members(spark, sf_dir)))


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reuse(M.scores(M.members(spark, sf_dir)))

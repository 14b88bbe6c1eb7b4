"""Plan-shape checks: the properties the operators rely on at scale."""

import contextlib
import io

import pytest

from churnlab.operators import evaluate as E
from churnlab.operators import ordered as O
from churnlab.operators import splits as D
from churnlab.plans import members as MB
from conftest import SF_SMALL


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.fixture(scope="module")
def members(spark):
    return MB.members(spark, SF_SMALL)


def test_member_scan_pushes_cutoff_and_prunes(members):
    p = plan(members)
    assert "LessThan(o_orderdate,2001-02-01" in p
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_returnflag:string,l_shipdate:timestamp_ntz>" in p
    assert "ReadSchema: struct<user_id:bigint,event_type:string>" in p


def test_splits_neither_shuffle_nor_sort_the_rows(spark):
    wide = spark.read.parquet(f"{SF_SMALL}/customer.parquet")
    for df in (D.stratified_split(wide, "c_custkey", "c_mktsegment"), D.three_way_split(wide, "c_custkey", "c_mktsegment"),
               D.undersample(wide, "c_custkey", "c_mktsegment")):
        p = df._jdf.queryExecution().executedPlan().toString()
        assert not any(step in p for step in ("Exchange", "Sort", "Window", "Join"))
    p = plan(D.kfold(wide, "c_custkey", "c_mktsegment"))
    windows = [line for line in p.splitlines() if line.strip().startswith("Arguments:") and "row_number" in line]
    assert windows and all("_hb" in w for w in windows)


def test_grouped_curves_have_no_single_partition_step(members):
    s = MB.scores(members)
    for df in (E.metrics(s, "y_true", "y_score", 0.5, by=["model_key"]),
               E.roc_curve(s, "y_true", "y_score", by=["model_key"])):
        assert "SinglePartition" not in plan(df)


def test_ranges_of_a_group_are_dealt_by_group_and_range(spark, members):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = E.metrics(MB.scores(members), "y_true", "y_score", 0.5, by=["model_key"])
        assert "hashpartitioning(model_key" in plan(df) and "_rt_bucket" in "".join(
            x for x in plan(df).splitlines() if "REPARTITION_BY_COL" in x)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_top_n_has_no_window_over_a_whole_group(members):
    s = MB.scores(members).persist()
    for n in (100, 5000):
        p = plan(O.top_n(s, "y_score", "member_id", n, by=["model_key"]))
        assert "WindowGroupLimit" not in p and "row_number" not in p

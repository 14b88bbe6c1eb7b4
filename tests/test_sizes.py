"""Work that follows the size of the tables: shuffle parts, passes over the inputs."""

import datetime as dt

from churnlab.plans import members as MB
from churnlab.plans import preprocess as PP


def write_tables(spark, path, members=40):
    """Orders, lines and events of ``members`` members; member 0 has no order."""
    day = lambda k: dt.datetime(2000, 1, 1) + dt.timedelta(days=k)
    t = {"region": ([(0, "ASIA"), (1, "EUROPE")], "r_regionkey int, r_name string"),
         "nation": ([(0, "A", 0), (1, "B", 1)], "n_nationkey int, n_name string, n_regionkey int"),
         "customer": ([(i, i % 2, i * 10.0, "AB"[i % 2]) for i in range(members)],
                      "c_custkey long, c_nationkey int, c_acctbal double, c_mktsegment string"),
         "orders": ([(i * 10 + k, i, day(i + 60 * k), 100.0 + i + k, "1-URGENT" if k % 3 == 0 else "5-LOW")
                     for i in range(1, members) for k in range(1 + i % 9)],
                    "o_orderkey long, o_custkey long, o_orderdate timestamp, o_totalprice double, o_orderpriority string"),
         "lineitem": ([(i * 10 + k, (i + j) % 7, "RN"[j % 2], day(i + 60 * k + j)) for i in range(1, members)
                       for k in range(1 + i % 9) for j in range(3)],
                      "l_orderkey long, l_partkey long, l_returnflag string, l_shipdate timestamp"),
         "events": ([(i, ("click", "view", "purchase")[i % 3]) for i in range(members)], "user_id long, event_type string")}
    for name, (rows, schema) in t.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{path}/{name}.parquet")
    return path


def test_line_steps_have_tasks_by_the_size_of_the_line_table(spark, tmpdir_path):
    path = write_tables(spark, f"{tmpdir_path}/t")
    plain = sorted(map(str, MB.members(spark, path).collect()))
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200")     # a line table of many parts
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        parts = spark.read.parquet(f"{path}/lineitem.parquet").rdd.getNumPartitions()
        m = MB.members(spark, path)
        p = m._jdf.queryExecution().executedPlan().toString()
        for keys in ("l_orderkey", "o_orderkey", "o_custkey"):
            found = [x for x in p.splitlines() if f"hashpartitioning({keys}#" in x and f" {8 * parts})" in x]
            assert found, keys
        assert sorted(map(str, m.collect())) == plain
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_preprocessing_reads_the_order_tables_once(spark, tmpdir_path, monkeypatch):
    path = write_tables(spark, f"{tmpdir_path}/t")
    built = []
    real = MB.members

    def counted(*args):
        out = real(*args)
        runs = spark.sparkContext.accumulator(0)

        def tell(batches):
            for b in batches:
                runs.add(b.num_rows)
                yield b
        built.append(runs)
        return out.mapInArrow(tell, out.schema)
    monkeypatch.setattr(PP.MB, "members", counted)
    from churnlab.operators import models as M
    spec = M.ModelSpec("importance", "gbt", {"maxIter": 1, "maxDepth": 2})
    m, top, _ = PP.preprocess(spark, path, importance_spec=spec)
    assert m.count() == top.count() == 40
    # a mark of missing values can rank in the top half though the table has no such column
    assert top.columns[4] == "avg_value_missing" and "avg_value_missing" not in m.columns
    assert [r[0] for r in top.filter("avg_value_missing = 1").select("member_id").collect()] == [0]
    assert [r.value for r in built] == [40]     # every member row computed once


def test_selection_passes_and_copies_keep_methods_short(spark, monkeypatch):
    from churnlab import session
    from churnlab.operators import selection
    key = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(key)
    seen = []

    class Watched:      # a result that notes the setting under which it is made
        sparkSession = spark
        write = property(lambda self: self)
        limit = mode = lambda self, _: self

        def collect(self):
            seen.append(spark.conf.get(key))
            return []

        def parquet(self, path):
            seen.append(spark.conf.get(key))
            spark.range(1).write.parquet(path)

    selection._collect(Watched())
    session.materialize(Watched())
    assert seen == ["8000", "8000"] and spark.conf.get(key) == before
    outer, inner = session.compiled_methods(spark), session.compiled_methods(spark)
    outer.__enter__()
    inner.__enter__()
    outer.__exit__(None, None, None)
    assert spark.conf.get(key) == "8000"        # another thread is still inside
    inner.__exit__(None, None, None)
    assert spark.conf.get(key) == before


def test_psi_of_all_features_reads_written_sketches(spark, tmpdir_path):
    from churnlab.plans.q_campaign import h10_psi_all_features
    path = write_tables(spark, f"{tmpdir_path}/t")
    out = h10_psi_all_features(spark, path)
    assert "Generate" not in out._jdf.queryExecution().optimizedPlan().toString()
    rows = {r.feature: r for r in out.collect()}
    assert len(rows) == 10 and {r.rows for r in rows.values()} == {rows["fee"].rows}
    spark.catalog.clearCache()


def test_sweep_scores_are_written_once(spark, tmpdir_path):
    from churnlab.operators import models as M
    from churnlab.operators import splits as D
    df = spark.createDataFrame([(i, float(i % 7), float(i % 5), int(i % 7 > 3)) for i in range(80)], "id long, a double, b double, y int")
    df = D.stratified_split(df, "id", "y", 0.25, 42)
    specs = [M.ModelSpec("logistic", "logistic", {"maxIter": 5}), M.ModelSpec("knn", "knn", {"k": 3, "weights": "uniform"})]
    out = M.sweep(specs, df, {"full": ["a", "b"]}, "id", "y", exclude=(None, "b"), parallel=2)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInPandas" not in plan and "UDF" not in plan
    assert {(r.model_key, r["count"]) for r in out.groupBy("model_key").count().collect()} == {
        (k, 20) for k in ("logistic_full", "logistic_full_without_b", "knn_full", "knn_full_without_b")}

"""Registered queries: sources and sinks (A*) as write -> read round trips.

Each query writes a table Spark derived from the driver tables into the
shared scratch folder (under ``spark.checkpoint.dir``) and reads it back
through the library's reader, so the twin is the table itself.
"""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from ..operators import evaluate as E
from ..operators import features as C
from ..session import scratch_path
from ..sources import files as A
from ..sources.store import ResultStore, read_documents
from .common import ID, members, scores
from .registry import register

K = ["model_key"]


@register("a1_csv_roundtrip", "SELECT * FROM members")
def a1_csv_roundtrip(spark, sf):
    m = members(spark, sf)
    path = A.write_table(m, scratch_path(spark, "members_csv"), "csv", options={"nullValue": "NA"})
    return A.read_members(spark, path, schema=m.schema)


@register("a2_projected_scan", "SELECT member_id, visits, pref FROM members")
def a2_projected_scan(spark, sf):
    m = members(spark, sf)
    path = A.write_table(m, scratch_path(spark, "members_csv"), "csv", options={"nullValue": "None"})
    return A.read_members(spark, path, schema=m.schema, columns=[ID, "visits", "pref"])


@register("a2_first_rows", "SELECT member_id, visits, pref FROM members ORDER BY member_id LIMIT 100")
def a2_first_rows(spark, sf):
    # the limit is the feature: the first rows of a member file by id
    m = members(spark, sf)
    path = A.write_table(m, scratch_path(spark, "members_csv"), "csv", options={"nullValue": "None"})
    return A.read_members(spark, path, schema=m.schema, columns=[ID, "visits", "pref"], limit=100, first_by=ID)


@register("a5_processed_sink", """
SELECT * EXCLUDE (segment, region), """ + ", ".join(
    f"CAST(coalesce(segment = '{v}', false) AS INTEGER) AS \"segment_{v}\""
    for v in ["BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]) + """
FROM members""")
def a5_processed_sink(spark, sf):
    m = members(spark, sf).drop("region")
    enc = C.OneHotFirstDrop(["segment"]).fit(m).transform(m)
    path = A.write_table(enc, scratch_path(spark, "processed"), "parquet", order_by=[ID])
    return spark.read.parquet(path)


@register("a6_scored_set_roundtrip", "SELECT * FROM scores")
def a6_scored_set_roundtrip(spark, sf):
    path = A.write_table(scores(spark, sf), scratch_path(spark, "scores"), "parquet")
    return spark.read.parquet(path)


def _conf_sql(t: str) -> str:
    return f"""SELECT model_key, CASE WHEN tp + fp = 0 THEN 0 ELSE tp / (tp + fp) END AS precision,
  CASE WHEN tp + fn = 0 THEN 0 ELSE tp / (tp + fn) END AS recall FROM (SELECT model_key,
  count(*) FILTER (WHERE y_score >= {t} AND y_true <> 1) AS fp, count(*) FILTER (WHERE y_score < {t} AND y_true = 1) AS fn,
  count(*) FILTER (WHERE y_score >= {t} AND y_true = 1) AS tp FROM scores GROUP BY model_key) c"""


@register("a7_result_upsert", f"""
old AS (SELECT model_key, 'baseline' AS label, 0.5::DOUBLE AS threshold, precision, recall FROM ({_conf_sql('0.5')}) o),
new AS (SELECT model_key, CASE WHEN model_key = 'rule_50' THEN 'baseline' ELSE 'tuned' END AS label,
               0.4::DOUBLE AS threshold, precision, recall FROM ({_conf_sql('0.4')}) n)
SELECT *, 1 AS schema_version FROM old WHERE NOT EXISTS
  (SELECT 1 FROM new WHERE new.model_key = old.model_key AND new.label = old.label)
UNION ALL
SELECT *, 1 AS schema_version FROM new""")
def a7_result_upsert(spark, sf):
    s = scores(spark, sf)

    def records(t, label):
        m = E.classification_metrics(s, "y_true", "y_score", t, K)
        return m.select("model_key", label.alias("label"), F.lit(float(t)).alias("threshold"), "precision", "recall")

    path = scratch_path(spark, "results")
    A.upsert(spark, path, records(0.5, F.lit("baseline")))
    new = records(0.4, F.when(F.col("model_key") == "rule_50", "baseline").otherwise("tuned"))
    return A.upsert(spark, path, new)


@register("a7_latest_records", f"""
r AS (SELECT *, 1 AS run FROM ({_conf_sql('0.5')}) a UNION ALL SELECT *, 3 FROM ({_conf_sql('0.4')}) b
      UNION ALL SELECT *, 2 FROM ({_conf_sql('0.6')}) c WHERE model_key <> 'rule_50'),
k AS (SELECT *, row_number() OVER (PARTITION BY model_key ORDER BY run DESC) AS rn FROM r WHERE NOT (model_key = 'rule_50' AND run = 3))
SELECT model_key, 'test' AS label, CAST(run AS INTEGER) AS run, precision, recall, 1 AS schema_version FROM k WHERE rn = 1""")
def a7_latest_records(spark, sf):
    # runs arrive out of order; the run number, not the arrival, decides
    s = scores(spark, sf)
    store = ResultStore(spark, scratch_path(spark, "result_store"), sequence="run")

    def records(t, run, where):
        m = E.classification_metrics(s, "y_true", "y_score", t, K).filter(where)
        return m.select("model_key", F.lit("test").alias("label"), F.lit(run).alias("run"), "precision", "recall")

    store.upsert(records(0.5, 1, "true"))
    store.upsert(records(0.4, 3, "model_key <> 'rule_50'"))
    return store.upsert(records(0.6, 2, "model_key <> 'rule_50'"))


@register("a8_result_documents", """
b AS (SELECT model_key,
  count(*) FILTER (WHERE y_score < 0.5 AND y_true <> 1) AS tn, count(*) FILTER (WHERE y_score >= 0.5 AND y_true <> 1) AS fp,
  count(*) FILTER (WHERE y_score < 0.5 AND y_true = 1) AS fn, count(*) FILTER (WHERE y_score >= 0.5 AND y_true = 1) AS tp
  FROM scores GROUP BY model_key)
SELECT model_key, CASE WHEN model_key <> 'rule_full' THEN 'main' END AS label,
       CASE WHEN model_key <> 'rule_full' THEN (tp + tn) / (tn + fp + fn + tp) END AS accuracy,
       tn + fp + fn + tp AS total_samples, tn, fp, fn, tp, NULL::VARCHAR AS error FROM b
UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, 'not a JSON document'
UNION ALL SELECT 'empty', NULL, NULL, NULL, NULL, NULL, NULL, NULL, 'no confusion matrix of two classes'""")
def a8_result_documents(spark, sf):
    # one document per file: a flat legacy record, a consolidated document, a cut one, one without results
    m = E.classification_metrics(scores(spark, sf), "y_true", "y_score", 0.5, K).withColumn(
        "matrix", F.array(F.array("tn", "fp"), F.array("fn", "tp"))).withColumn(
        "total", F.col("tn") + F.col("fp") + F.col("fn") + F.col("tp"))
    flat = m.filter("model_key = 'rule_full'").select(F.to_json(F.struct(
        "model_key", F.col("total").alias("total_samples"), F.col("matrix").alias("confusion_matrix"))).alias("doc"))
    record = F.struct(F.struct(F.col("total").alias("total_samples")).alias("performance"), F.col("matrix").alias("confusion_matrix"),
                      F.struct("accuracy").alias("test_metrics"))
    joined = m.filter("model_key <> 'rule_full'").agg(F.map_from_entries(F.collect_list(
        F.struct("model_key", F.create_map(F.lit("main"), record)))).alias("results"))
    docs = flat.union(joined.select(F.to_json(F.struct("results")))).union(
        spark.range(0, 1, 1, 1).select(F.explode(F.array(F.lit('{"model_key": "cut", "acc'), F.lit('{"model_key": "empty"}')))))
    path = scratch_path(spark, "documents")
    docs.withColumn("file", F.xxhash64("doc")).write.partitionBy("file").text(path)
    return read_documents(spark, f"{path}/*/*.txt").select("model_key", "label", "accuracy", "total_samples", "tn", "fp", "fn", "tp", "error")


@register("a8_read_results", """
b AS (SELECT model_key,
  count(*) FILTER (WHERE y_score < 0.5 AND y_true <> 1) AS tn, count(*) FILTER (WHERE y_score >= 0.5 AND y_true <> 1) AS fp,
  count(*) FILTER (WHERE y_score < 0.5 AND y_true = 1) AS fn, count(*) FILTER (WHERE y_score >= 0.5 AND y_true = 1) AS tp
  FROM scores GROUP BY model_key)
SELECT model_key, CASE WHEN model_key = 'rule_full' THEN NULL ELSE (tp + tn) / (tn + fp + fn + tp) END AS accuracy,
       tn + fp + fn + tp AS total_samples, tn, tp FROM b""")
def a8_read_results(spark, sf):
    s = scores(spark, sf)
    m = E.classification_metrics(s, "y_true", "y_score", 0.5, K)
    rec = m.select("model_key",
                   F.when(F.col("model_key") != "rule_full", F.col("accuracy")).alias("accuracy"),
                   (F.col("tn") + F.col("fp") + F.col("fn") + F.col("tp")).alias("total_samples"),
                   F.array(F.array("tn", "fp"), F.array("fn", "tp")).alias("confusion_matrix"))
    path = scratch_path(spark, "records")
    rec.write.mode("overwrite").json(path)   # legacy records (rule_full) carry no accuracy field
    got = A.read_results(spark, path, multi_line=False)
    return got.select("model_key", "accuracy", "total_samples",
                      F.col("confusion_matrix")[0][0].alias("tn"), F.col("confusion_matrix")[1][1].alias("tp"))


def write_record_files(path: str, records: list[dict]) -> None:
    """Helper for tests: one pretty-printed JSON document per file."""
    import os
    os.makedirs(path, exist_ok=True)
    for r in records:
        with open(os.path.join(path, f"{r['model_key']}_results.json"), "w", encoding="utf-8") as f:
            json.dump(r, f, indent=4)

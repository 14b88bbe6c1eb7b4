"""Result records: a versioned table of the latest ones, and documents of any shape.

``ResultStore`` (A7) keeps whole snapshots in folders of their own. A commit is one
small numbered file that names its snapshot; the highest complete commit is the
table. A commit file is created only if its number is free, so of two writers one
wins and the other merges again; a reader between any two steps sees the old table or
the new one, and a writer that dies leaves a folder that nothing names.

``read_documents`` (A8) reads one JSON document per file as a VARIANT and takes each
field from where the known shapes have it; what cannot be used stays, with a reason.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA_VERSION = 1


class ResultStore:
    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str] = ("model_key", "label"),
                 sequence: str | None = None):
        """``keys`` identify a record; with ``sequence`` (a time, a run number) the record with
        its greatest value is the latest, wherever it comes from and whenever it arrives. A
        null sequence is older than all others."""
        self.spark, self.path, self.keys, self.sequence = spark, path.rstrip("/"), list(keys), sequence
        self._jvm = spark.sparkContext._jvm
        root = self._hadoop(self.path)
        self._fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _hadoop(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def _commits(self) -> list[tuple[int, str]]:
        """Complete commits, oldest first: number and snapshot folder."""
        folder = self._hadoop(f"{self.path}/_commits")
        if not self._fs.exists(folder):
            return []
        out = []
        for st in self._fs.listStatus(folder):
            name = st.getPath().getName()
            if name.isdigit() and st.getLen():
                stream = self._fs.open(st.getPath())
                try:
                    text = self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
                finally:
                    stream.close()
                if text.endswith("\n"):         # else its writer has not finished
                    out.append((int(name), json.loads(text)["snapshot"]))
        return sorted(out)

    def read(self, version: int | None = None) -> DataFrame | None:
        """The latest table, or that of an earlier version still kept; None before the first."""
        commits = self._commits()
        if version is not None:
            commits = [c for c in commits if c[0] == version]
            if not commits:
                raise ValueError(f"version {version} is not in {self.path}")
        return self.spark.read.parquet(f"{self.path}/{commits[-1][1]}") if commits else None

    @property
    def version(self) -> int:
        return max((n for n, _ in self._commits()), default=0)

    def _commit(self, number: int, snapshot: str) -> bool:
        """Create the commit file; False if the number is taken."""
        at = self._hadoop(f"{self.path}/_commits/{number:012d}")
        if self._fs.exists(at):
            return False
        try:
            out = self._fs.create(at, False)
        except Exception as e:      # noqa: BLE001 -- the JVM's exception: the file came into being meanwhile
            if self._fs.exists(at):
                return False
            raise e
        out.write(bytearray((json.dumps({"snapshot": snapshot}) + "\n").encode()))
        out.close()
        return True

    def upsert(self, new: DataFrame, retries: int = 10) -> DataFrame:
        """Merge ``new`` and commit the result. Without ``sequence`` new records replace stored
        ones, and of several new records of a key the greatest in column order stays."""
        new = new.withColumn("schema_version", F.lit(SCHEMA_VERSION))
        for _ in range(retries):
            number = self.version
            old = self.read(number) if number else None
            if old is not None and old.filter(F.col("schema_version") != SCHEMA_VERSION).limit(1).count():
                raise ValueError(f"unsupported schema_version in {self.path}")
            snapshot = f"snapshot-{uuid.uuid4().hex}"
            self.latest(old, new).write.parquet(f"{self.path}/{snapshot}")
            if self._commit(number + 1, snapshot):
                return self.read(number + 1)
        raise RuntimeError(f"{self.path}: other writers committed {retries} times meanwhile")

    def latest(self, old: DataFrame | None, new: DataFrame) -> DataFrame:
        """One record per key: a grouped maximum, combined before the shuffle, so a key with
        very many records is no single task."""
        both = new.withColumn("_new", F.lit(1))
        if old is not None:
            both = both.unionByName(old.withColumn("_new", F.lit(0)), allowMissingColumns=True)
        rest = [c for c in both.columns if c not in self.keys and c != "_new"]
        age = [F.col(f"`{self.sequence}`")] if self.sequence else []
        order = F.struct(*[x.alias(f"_a{i}") for i, x in enumerate(age)], "_new", *[F.col(f"`{c}`").alias(f"_r{i}") for i, c in enumerate(rest)])
        best = both.groupBy(*self.keys).agg(F.max(order).alias("_b"))
        cols = {c: F.col(f"_b._r{i}") for i, c in enumerate(rest)}
        return best.select(*[F.col(f"`{c}`") if c in self.keys else cols[c].alias(c) for c in both.columns if c != "_new"])

    def vacuum(self, keep: int = 2) -> int:
        """Delete the snapshots and commits before the last ``keep``; the number deleted."""
        gone = self._commits()[:-keep] if keep > 0 else []
        for number, snapshot in gone:       # the commit first: what it names is then no table
            self._fs.delete(self._hadoop(f"{self.path}/_commits/{number:012d}"), False)
            self._fs.delete(self._hadoop(f"{self.path}/{snapshot}"), True)
        return len(gone)


# Where the shapes of result documents keep a field: flat records, then records with
# nested performance and test metrics.
FIELDS = {
    "model_key": (("$.model_key",), "string"), "model_name": (("$.model_name", "$.model"), "string"),
    "label": (("$.label", "$.experiment.label"), "string"), "dataset": (("$.experiment.dataset", "$.experiment.feature_set"), "string"),
    "excluded_feature": (("$.experiment.excluded_feature",), "string"),
    "accuracy": (("$.accuracy", "$.test_metrics.accuracy"), "double"),
    "precision": (("$.precision", "$.test_metrics.precision"), "double"), "recall": (("$.recall", "$.test_metrics.recall"), "double"),
    "f1": (("$.f1_score", "$.test_metrics.f1"), "double"), "roc_auc": (("$.auc_score", "$.test_metrics.roc_auc"), "double"),
    "pr_auc": (("$.pr_auc", "$.test_metrics.pr_auc"), "double"), "threshold": (("$.threshold",), "double"),
    "latency_ms": (("$.avg_latency_ms", "$.performance.avg_latency_ms"), "double"),
    "total_samples": (("$.total_samples", "$.performance.total_samples"), "bigint"),
    "tn": (("$.confusion_matrix[0][0]",), "bigint"), "fp": (("$.confusion_matrix[0][1]",), "bigint"),
    "fn": (("$.confusion_matrix[1][0]",), "bigint"), "tp": (("$.confusion_matrix[1][1]",), "bigint"),
}


def read_documents(spark: SparkSession, glob: str) -> DataFrame:
    """One row per record of the JSON files under ``glob``: the fields of ``FIELDS`` (absent or
    of another type: null), ``file`` and ``error``. A file holds one record, or a consolidated
    document ``{"results": {model_key: {label: record}}}``. ``error`` is null for usable
    records; broken documents, and records without a model or a confusion matrix, have a reason."""
    docs = (spark.read.text(glob, wholetext=True)
            .select(F.col("_metadata.file_path").alias("file"), F.try_parse_json("value").alias("doc")))
    many = F.coalesce(F.schema_of_variant("doc").startswith("OBJECT"), F.lit(False)) & F.expr(
        "try_variant_get(doc, '$.results', 'variant') is not null")
    docs = docs.withColumn("many", F.coalesce(many, F.lit(False)))
    one = docs.filter(~F.col("many")).select("file", F.lit(None).cast("string").alias("k"), F.lit(None).cast("string").alias("l"), "doc")
    nested = spark.sql("""SELECT file, m.key AS k, r.key AS l, r.value AS doc FROM {d} d,
        LATERAL variant_explode(try_variant_get(d.doc, '$.results', 'variant')) m, LATERAL variant_explode(m.value) r
        WHERE d.many""", d=docs)
    rows = one.unionByName(nested)
    cols = {}
    for name, (paths, kind) in FIELDS.items():
        cols[name] = F.coalesce(*[F.expr(f"try_variant_get(doc, '{p}', '{kind}')") for p in paths])
    cols["model_key"] = F.coalesce(F.col("k"), cols["model_key"])
    cols["label"] = F.coalesce(F.col("l"), cols["label"])
    out = rows.select("file", "doc", *[c.alias(n) for n, c in cols.items()])
    cells = F.col("tn").isNull() | F.col("fp").isNull() | F.col("fn").isNull() | F.col("tp").isNull()
    error = (F.when(F.col("doc").isNull(), "not a JSON document").when(F.col("model_key").isNull(), "no model_key")
             .when(cells, "no confusion matrix of two classes"))
    return out.withColumn("error", error).drop("doc")

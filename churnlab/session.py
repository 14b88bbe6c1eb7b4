"""Session helpers.

The library never creates a session behind the caller's back inside an
operator; these helpers are for scripts, tests and the bench.
"""

from __future__ import annotations

import os
import tempfile
import threading
from contextlib import contextmanager

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, app: str = "churnlab",
              shuffle_partitions: int | None = None,
              extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings the operators assume."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if master and master.startswith("local"):
        conf["spark.driver.memory"] = os.environ.get("CHURNLAB_DRIVER_MEMORY", "12g")
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and written intermediate tables.

    Read from ``spark.checkpoint.dir`` (set by the cluster). Only in local mode
    (tests, the bench) and only when it is unset, a scratch folder is created;
    on a cluster a machine-local folder would not be shared, so it is refused.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not conf:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (e.g. on the cluster file system)")
        conf = tempfile.mkdtemp(prefix="churnlab-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(conf)
    return sc.getCheckpointDir() or conf


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for a written table under the shared checkpoint folder."""
    import uuid
    base = checkpoint_dir(spark)
    return f"{base.rstrip('/')}/tables/{name}-{uuid.uuid4().hex[:12]}"


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


#: bytes of bytecode up to which HotSpot compiles a method; longer ones are interpreted
JIT_METHOD_BYTES = 8000


_inside: dict[int, list] = {}      # by session: blocks that are open, the setting before the first
_guard = threading.Lock()


@contextmanager
def compiled_methods(spark: SparkSession):
    """Queries run inside give up whole-stage code where one of its methods would be too
    long for HotSpot to compile: long conditions (one comparison for each rank in
    question) then run as compiled code of single operators. Results are the same.
    Threads may be inside together; the last one to leave restores the setting."""
    key = "spark.sql.codegen.hugeMethodLimit"
    with _guard:
        held = _inside.setdefault(id(spark), [0, spark.conf.get(key)])
        held[0] += 1
        spark.conf.set(key, str(min(int(held[1]), JIT_METHOD_BYTES)))
    try:
        yield
    finally:
        with _guard:
            held[0] -= 1
            if not held[0]:
                del _inside[id(spark)]
                spark.conf.set(key, held[1])


def materialize(df, name: str = "stage"):
    """Cut the lineage of a table that several jobs will read (iterative fits,
    sweeps, profiles): write it as Parquet into the shared checkpoint folder
    and read it back. One computation (``checkpoint()`` of an unpersisted
    plan computes it twice), a columnar copy that later scans prune and
    filter, and it survives executor loss; ``localCheckpoint`` would not."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with compiled_methods(spark):
        df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def reuse(df):
    """Keep a table that one plan reads several times (aggregate + scalar
    subquery + join back): computed once, lazily, spilled to disk when memory
    is short; lost blocks are recomputed from lineage on executor loss."""
    from pyspark import StorageLevel
    return df.persist(StorageLevel.MEMORY_AND_DISK)

"""Session helpers: building a local session for tests/bench, and the shared
checkpoint folder used to cut lineage in iterative operators."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "tabmine") -> SparkSession:
    """Session for tests and the local bench. On a cluster, use the session the
    platform gives you; nothing in the library depends on this builder."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.default.parallelism", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.autoBroadcastJoinThreshold", "32m")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the platform sets it to a shared (distributed) folder and we only
    read it.  Only when it is unset (tests, local runs) do we create our own."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get(CHECKPOINT_CONF, None) or sc.getConf().get(CHECKPOINT_CONF, None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="tabmine-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.conf.set(CHECKPOINT_CONF, configured)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


_PINNED: list[str] = []
_ON_RELEASE: list = []


def on_release(fn) -> None:
    """Call ``fn()`` when pinned tables are released (whoever keeps DataFrames over them)."""
    _ON_RELEASE.append(fn)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` as a Parquet table under the shared checkpoint folder
    and read it back: computed once, survives executor loss (the files are on
    the shared store), and pins a non-deterministic plan (range bounds, AQE
    choices) to one result.  Partitioning is kept as written."""
    spark = df.sparkSession
    root = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{root}/tabmine-{uuid.uuid4().hex}"
    df.write.mode("error").parquet(path)
    _PINNED.append(path)
    return spark.read.parquet(path)


def release_pinned(spark: SparkSession) -> int:
    """Delete the tables this process pinned with ``cut_lineage`` (through the
    Hadoop FileSystem of each path, so it works on HDFS or object stores).
    Call only after every DataFrame read from them has been consumed.  Returns
    the number of tables removed."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    removed = 0
    for fn in _ON_RELEASE:
        fn()
    while _PINNED:
        path = jvm.org.apache.hadoop.fs.Path(_PINNED.pop())
        if path.getFileSystem(conf).delete(path, True):
            removed += 1
    return removed

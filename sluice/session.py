"""Session helpers: a sane local session for tests and a shared scratch root.

Scratch data (staged files, snapshot tables, checkpoints) always goes under
the folder the cluster names in ``spark.checkpoint.dir``.  Only when that is
unset in a local run (tests) do we create a private folder and register it as
the checkpoint dir, so every later caller sees the same root; on a cluster an
unset folder is an error.
"""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "sluice") -> SparkSession:
    """A local session configured like the cluster one (AQE on, UTC, no UI)."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder; set a private one only when unset."""
    sc = spark.sparkContext
    root = sc.getCheckpointDir()
    if not root:
        root = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
            "spark.checkpoint.dir", None)
        if root:
            sc.setCheckpointDir(root)
        elif not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        else:
            sc.setCheckpointDir(tempfile.mkdtemp(prefix="sluice-ckpt-"))
        root = sc.getCheckpointDir()
    return root.rstrip("/")


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A fresh, unique folder name under the shared checkpoint root."""
    return f"{checkpoint_root(spark)}/sluice/{purpose}-{uuid.uuid4().hex[:12]}"


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str):
    return spark.read.parquet(table_path(sf_dir, name))


@contextlib.contextmanager
def conf_for(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """SQL settings for the jobs started inside the block, then as before."""
    old = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def listing_conf(spark: SparkSession) -> dict[str, str]:
    """Settings for reads of many paths: their files are listed by a few tasks a
    core instead of a task a path (Spark's own limit is 10,000 tasks)."""
    return {"spark.sql.sources.parallelPartitionDiscovery.parallelism":
            str(min(10_000, 4 * spark.sparkContext.defaultParallelism))}


def cluster_conf(shuffle_bytes: int = 100 * 2**40, partition_bytes: int = 512 * 2**20
                 ) -> dict[str, str]:
    """Settings for a large cluster (pass to ``SparkSession.builder.config``).

    ``spark.sql.shuffle.partitions`` starts at the largest shuffle divided by
    ``partition_bytes`` (AQE then coalesces small partitions and splits
    skewed join partitions); broadcasts stay behind a 64 MiB size check;
    decommissioning moves shuffle blocks off executors that are going away.
    """
    partitions = max(200, -(-shuffle_bytes // partition_bytes))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256m",
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": "256m",
        "spark.sql.autoBroadcastJoinThreshold": "64m",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
        "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.decommission.enabled": "true",
        "spark.storage.decommission.enabled": "true",
        "spark.storage.decommission.shuffleBlocks.enabled": "true",
        "spark.task.maxFailures": "8",
        "spark.ui.enabled": "false",
    }


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``sluice`` importable by the Python workers of this application.

    Jobs that run Python on the executors (``mapInPandas``) need the package
    there, as any PySpark library does (``--py-files``).  The package is
    zipped in memory, written once to the shared checkpoint folder and
    added with ``addPyFile``; calling this again is a no-op.
    """
    import io
    import os
    import zipfile

    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as zf:
        for root, _, files in os.walk(pkg_dir):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    zf.write(full, os.path.relpath(full, os.path.dirname(pkg_dir)))
    path = f"{scratch_path(spark, 'pyfiles')}/sluice.zip"
    jvm = sc._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(sc._jsc.hadoopConfiguration())
    out = fs.create(p, True)
    try:
        out.write(bytearray(buf.getvalue()))
    finally:
        out.close()
    sc.addPyFile(str(fs.makeQualified(p).toString()))
    _SHIPPED.add(app)

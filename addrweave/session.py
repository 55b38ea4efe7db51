"""Session helpers: build a local session for tests/bench and find the shared scratch folder."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

# Settings that matter for the plans in this package: AQE (runtime coalescing,
# skew-join splitting, broadcast conversion from measured shuffle sizes) and no UI.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "addrweave") -> SparkSession:
    """A local session for tests and the benchmark (the cluster brings its own)."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", "8g")
    # local sessions only; a cluster session names its shared folder itself
    builder = builder.config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="addrweave-ckpt-"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster that setting points at shared storage and is used as is. Only when it
    is unset (local tests) do we create one under the local temp folder.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder: intermediate tables are written there")
        # unset on a local master: tests and local runs only
        d = tempfile.mkdtemp(prefix="addrweave-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path inside the shared checkpoint folder (for written intermediate tables)."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, f"{name}-{uuid.uuid4().hex[:12]}")


def write_read(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage: write a table into the shared checkpoint folder and read it back."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def side_by_side(*jobs):
    """Results of independent functions that run Spark jobs, each in a thread of its own: a small job of one fills the
    cores that the last tasks of another leave idle. The first error is raised when all have ended."""
    from pyspark import inheritable_thread_target

    in_thread = inheritable_thread_target(SparkSession.active())
    with ThreadPoolExecutor(len(jobs)) as threads:
        return [f.result() for f in [threads.submit(in_thread(job)) for job in jobs]]


def remove_scratch(spark: SparkSession, path: str) -> None:
    """Delete a table written under ``scratch_path`` (nothing else)."""
    if not path.startswith(ensure_checkpoint_dir(spark).rstrip("/") + "/"):
        raise ValueError(f"{path} is not in the checkpoint folder")
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in Python workers: send it along as ``--py-files`` would, once per
    application, unless the workers' PYTHONPATH names it already."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    if root in os.environ.get("PYTHONPATH", "").split(os.pathsep) or not os.path.isdir(root):
        return
    app = spark.sparkContext.applicationId
    if app not in _SHIPPED:
        _SHIPPED.add(app)
        at = os.path.join(tempfile.mkdtemp(prefix="addrweave-py-"), "addrweave")
        spark.sparkContext.addPyFile(shutil.make_archive(at, "zip", root, "addrweave"))


_SHIPPED: set[str] = set()

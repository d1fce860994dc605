"""Session settings the library relies on."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark.sql import SparkSession
from pyspark.util import inheritable_thread_target

# Always set: no web page, and what defines results (UTC wall clock, ANSI casts).
FIXED_CONF = {
    "spark.ui.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}
# Used where spark-submit names no other value: the runtime re-planning the
# joins count on (AQE broadcast conversion, skew splitting).
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def scale_conf(input_bytes: int, total_cores: int, target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Partition sizing for an input of ``input_bytes`` on ``total_cores`` cores.

    Scan splits and shuffle partitions are sized so one task holds about
    ``target_partition_bytes`` (well inside an executor core's share of
    memory, so sorts and hash joins spill rarely), with at least three waves
    of tasks.  AQE then coalesces small shuffle partitions towards the
    advisory size and splits skewed ones, so the initial number errs high.
    For 100 TB on 1,000 executors x 8 cores this gives about 410,000 initial
    shuffle partitions and 256 MB scan splits.
    """
    partitions = max(3 * total_cores, -(-int(input_bytes) // target_partition_bytes))
    mb = target_partition_bytes >> 20
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": f"{mb}m",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": f"{max(mb // 2, 1)}m",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": f"{mb * 4}m",
    }


def build_session(master: str | None = None, app: str = "rollcall",
                  shuffle_partitions: int | None = None,
                  conf: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = dict(FIXED_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    given = spark.sparkContext.getConf()
    for key, value in DEFAULT_CONF.items():
        if key not in settings and not given.contains(key):
            spark.conf.set(key, value)
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def run_concurrently(spark: SparkSession, *jobs: Callable) -> list:
    """Results of the jobs, run in threads that keep the caller's job group, pool and description."""
    with ThreadPoolExecutor(max_workers=max(1, len(jobs))) as pool:
        return [f.result() for f in [pool.submit(inheritable_thread_target(spark)(job)) for job in jobs]]


_LOCAL_DIRS: dict[int, str] = {}
_LOCAL_LOCK = threading.Lock()   # extractions call this from several driver threads


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared folder for materialised intermediates.

    The cluster names it in ``spark.checkpoint.dir``; it is only invented here
    when Spark runs in local mode (tests, laptops).  A cluster without that
    setting is an error, since a machine-local folder would not survive the
    loss of an executor.  Works with classic and Connect sessions.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # a Spark Connect session has no SparkContext
        sc = None
    current = (sc.getCheckpointDir() if sc is not None else None) or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if sc is not None and not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    master = sc.master if sc is not None else (spark.conf.get("spark.master", None) or "")
    if not master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    with _LOCAL_LOCK:
        if sc is not None and sc.getCheckpointDir():
            return sc.getCheckpointDir()
        if id(spark) not in _LOCAL_DIRS:
            _LOCAL_DIRS[id(spark)] = tempfile.mkdtemp(prefix="rollcall-ckpt-")
        folder = _LOCAL_DIRS[id(spark)]
        if sc is not None:
            sc.setCheckpointDir(folder)
            return sc.getCheckpointDir() or folder
        return folder


_RUNS: list[str] = []      # folders of the runs that are open, the innermost last


def scratch_folder(spark: SparkSession) -> str:
    """Where intermediates go: the folder of the open run, else the checkpoint folder."""
    return _RUNS[-1] if _RUNS else ensure_checkpoint_dir(spark).rstrip("/")


@contextmanager
def run_folder(spark: SparkSession) -> Iterator[str]:
    """A folder under the checkpoint folder for the intermediates of one run, removed when the run ends.

    What the run returns must be written before that.
    """
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/rollcall-run-{uuid.uuid4().hex}"
    _RUNS.append(folder)
    try:
        yield folder
    finally:
        _RUNS.remove(folder)
        remove_folder(spark, folder)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder through Spark's file system layer (a Connect session leaves it to the folder's expiry)."""
    jvm = getattr(spark, "_jvm", None)
    if jvm is not None:
        folder = jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def materialize(df, name: str = "stage"):
    """Write ``df`` as Parquet to the shared checkpoint folder and read it back.

    Cuts the lineage: later actions and retried tasks read the files instead
    of recomputing (or re-deciding) what produced them.  The folder is the
    one the cluster names in ``spark.checkpoint.dir`` (or that of the open run in it).
    """
    spark = df.sparkSession
    path = f"{scratch_folder(spark)}/rollcall-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)

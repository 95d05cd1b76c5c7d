"""Spark session and lineage helpers.

Cluster settings (executor sizing, shuffle partitions for the target data size,
``spark.checkpoint.dir``) come from the deployment; the builder here only fills
in values that are unset, which is what tests and the local bench rely on.
"""

from __future__ import annotations

import os
import tempfile
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from threading import local

from pyspark import SparkConf, SparkContext
from pyspark.sql import DataFrame, SparkSession

# Settings every job of this package expects. AQE re-plans joins from runtime
# sizes (broadcast only when the materialised side is small), coalesces small
# shuffle partitions and splits skewed join partitions.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    # delete reliable checkpoints (id assignment) once nothing references them
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(master: str | None = None, app_name: str = "rosterflow",
                shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session; the package defaults fill in only what is unset.

    Whatever the deployment configures (``spark-submit`` options, spark-defaults,
    an active session) wins over the defaults; arguments of this call win over
    both. Outside ``spark-submit``, without a configured master, the session is
    local with ``$BENCH_CPUS`` (or all) threads.
    """
    builder = SparkSession.builder.appName(app_name)
    conf = dict(extra or {})
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if master:
        builder = builder.master(master)
    if SparkSession.getActiveSession() is None and not os.environ.get("SPARK_REMOTE"):
        submitted = "PYSPARK_GATEWAY_PORT" in os.environ or "--master" in os.environ.get("PYSPARK_SUBMIT_ARGS", "")
        SparkContext._ensure_initialized()
        given = SparkConf()               # with what spark-submit and spark-defaults have set
        # without a submit, Spark's launcher has put a master of its own there
        if master is None and not submitted and given.get("spark.master", "local[*]") == "local[*]":
            builder = builder.master(os.environ.get("SPARK_MASTER") or f"local[{os.environ.get('BENCH_CPUS', '*')}]")
        defaults = {**DEFAULT_CONF, "spark.driver.memory": os.environ.get("SPARK_DRIVER_MEMORY", "16g")}
        conf = {**{k: v for k, v in defaults.items() if not given.contains(k)}, **conf}
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the deployment sets it to a shared file system; only when it is
    unset (local tests, the bench) a scratch folder is created here. Under Spark
    Connect (no SparkContext) the server's setting is used as is.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: checkpoints are configured on the server
        return spark.conf.get("spark.checkpoint.dir", "")
    path = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not path:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (e.g. on HDFS / object storage); "
                               "checkpoints must survive executor loss")
        path = tempfile.mkdtemp(prefix="rosterflow-ckpt-")
        try:
            spark.conf.set("spark.checkpoint.dir", path)
        except Exception:  # some deployments reject runtime changes of core settings
            pass
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(path)
    return path


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder (reliable checkpoint).

    Survives executor loss, unlike a cached or locally checkpointed frame.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


#: Seconds from which on a write is followed by a collection on the driver: until one, what the query has shuffled stays on the disks.
COLLECT_AFTER = 5.0
#: Codec of stored tables: keys and hashes written as text take half the room of the default one's.
CODEC = "zstd"
_scopes = local()


def stored(df: DataFrame) -> DataFrame:
    """``df`` written as Parquet into the shared checkpoint folder and read back.

    Cuts the lineage like a reliable checkpoint, but columnar: later passes read the columns they need, counts come
    from the file footers, and the files survive lost executors. ``drop_stored`` and ``scratch`` delete them again.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/stored-{uuid.uuid4().hex}"
    with shuffles_released(spark):
        df.write.option("compression", CODEC).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._rosterflow_path = path
    if getattr(_scopes, "frames", None) is not None:
        _scopes.frames.append(out)
    return out


@contextmanager
def shuffles_released(spark: SparkSession):
    """After a query in here that took long, the shuffle files of ended queries go from the disks.

    Spark removes them once the driver's collector has found their plans dead. A driver that only plans hardly collects
    (by itself every 30 minutes), and the files of all steps until then would add up.
    """
    began = time.monotonic()
    yield
    if time.monotonic() - began > COLLECT_AFTER:
        # the first one still meets what the listeners of the query that has just ended hold
        spark._jvm.System.gc()
        time.sleep(0.2)
        spark._jvm.System.gc()


def drop_stored(*frames: DataFrame) -> None:
    """Delete the files of frames that ``stored`` has returned, once nothing that is still to run reads them."""
    for df in frames:
        place = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df._rosterflow_path)
        place.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(place, True)


def same_files(df: DataFrame, kept: DataFrame) -> DataFrame:
    """``df``, which reads the files of the stored frame ``kept`` alone, so that dropping it drops these."""
    df._rosterflow_path = kept._rosterflow_path
    return df


@contextmanager
def scratch() -> Iterator[list[DataFrame]]:
    """What this thread stores in here is deleted at the end, but for the frames that are taken out of the list."""
    outer = getattr(_scopes, "frames", None)
    _scopes.frames = frames = []
    try:
        yield frames
    finally:
        _scopes.frames = outer
        drop_stored(*frames)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one of the driver-provided parquet tables."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")

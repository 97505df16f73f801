"""Session helpers: a local session for tests/bench and the checkpoint folder."""

from __future__ import annotations

import os
import tempfile
from weakref import WeakKeyDictionary

from pyspark import SparkContext
from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "tideline") -> SparkSession:
    """A local[*] session configured like the tests and the bench expect."""
    b = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("TIDELINE_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    The cluster's setting is always used when present.  Only a local-mode
    session without one (a test) gets a fresh folder of its own; on a cluster
    a missing setting is an error, since a machine-local folder would not be
    visible to other executors.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if conf:
        sc.setCheckpointDir(conf)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set; point it at a shared folder")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="tideline-ckpt-"))
    return sc.getCheckpointDir()


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder (for written tables)."""
    import uuid

    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/tideline-{name}-{uuid.uuid4().hex[:12]}"
    _SCRATCH.setdefault(spark.sparkContext, []).append(path)
    return path


_SCRATCH: WeakKeyDictionary[SparkContext, list[str]] = WeakKeyDictionary()


def scratch_folders(spark: SparkSession) -> list[str]:
    """The scratch folders named in this application and not dropped since."""
    return list(_SCRATCH.get(spark.sparkContext, ()))


def drop_scratch(spark: SparkSession, keep: tuple[str, ...] = ()) -> int:
    """Delete the scratch folders that this application has named, but for those under ``keep``.

    Results are lazy and read these folders: call it once they have been written
    or collected.  Returns the number of folders deleted.
    """
    jvm, n = spark.sparkContext._jvm, 0
    for path in scratch_folders(spark):
        if any(path == k or path.startswith(k.rstrip("/") + "/") for k in keep):
            continue
        p = jvm.org.apache.hadoop.fs.Path(path)
        n += bool(p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True))
        _SCRATCH[spark.sparkContext].remove(path)
    return n


def materialize(df, name: str = "table"):
    """Write ``df`` as Parquet under the shared checkpoint folder and read it back.

    This cuts lineage like ``checkpoint()`` but runs the plan once (a reliable
    RDD checkpoint computes it a second time to save it), and the table
    survives the loss of any executor.
    """
    path = scratch_dir(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)

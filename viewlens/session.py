"""Session helpers: shared checkpoint folder, lineage cuts, scratch tables.

On a cluster the shared folder comes from ``spark.checkpoint.dir``. Only a
local master without that setting gets a private temporary folder; any other
master must name one, since executors cannot see the driver's disk.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark import SparkContext
from pyspark.sql import DataFrame, SparkSession

_CONF_KEY = "spark.checkpoint.dir"
_made: list[str] = []


def build_local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "viewlens") -> SparkSession:
    """Local session used by tests and the bench (no UI, AQE on)."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def is_local(master: str) -> bool:
    """Driver and executors share one machine's folders."""
    return master == "local" or master.startswith("local[")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder; a private one only on a local master that names none."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get(_CONF_KEY, None) or sc.getConf().get(_CONF_KEY, None)
    if not configured:
        if not is_local(sc.master):
            raise ValueError(f"set {_CONF_KEY} to a folder that the driver and all executors share (master {sc.master})")
        configured = tempfile.mkdtemp(prefix="viewlens-ckpt-")
        _made.append(configured)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused folder under the shared checkpoint folder; removed when the application ends."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/viewlens-{name}-{uuid.uuid4().hex}"
    _made.append(path)
    return path


def remove_scratch() -> None:
    """Remove the folders made by ``scratch_path`` and the private checkpoint folder."""
    sc = SparkContext._active_spark_context
    if sc is None:
        return
    while _made:
        path = sc._jvm.org.apache.hadoop.fs.Path(_made.pop())
        path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


@atexit.register
def _at_exit() -> None:
    try:
        remove_scratch()
    except Exception:  # noqa: BLE001 - the JVM may be gone already; nothing is left to report to
        pass


def materialize(df: DataFrame) -> DataFrame:
    """Cut lineage with a reliable checkpoint in the shared folder.

    Used where one intermediate result feeds several jobs: later jobs read
    the written files instead of recomputing the whole upstream plan, and a
    lost executor costs only a re-read.
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back: later passes read only the columns they use."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

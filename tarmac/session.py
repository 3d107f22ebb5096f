"""Session defaults and the shared checkpoint folder.

The library never changes the configuration of a session it is handed; these
helpers are for entry points (bench, tests, the driver contract) that build
their own session.
"""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

# Defaults for sessions built by this package.  Day and hour buckets are taken
# in the session time zone for TIMESTAMP (LTZ) inputs, so pin it to UTC.
SESSION_DEFAULTS: dict[str, str] = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # No per-call Python call-site capture (several Py4J round trips per API call).
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def large_scale_settings(input_bytes: int, largest_shuffle_fraction: float = 0.15) -> dict[str, str]:
    """Starting configuration for a cluster run over ``input_bytes`` of parquet.

    * scans: 256 MB splits (a few row groups per task);
    * shuffles: start with enough partitions that the largest shuffle (the
      segment rows keyed by ticket or flight, about ``largest_shuffle_fraction``
      of the input once columns are pruned) lands at ~128 MB per partition;
      AQE then coalesces small stages down to the same advisory size;
    * skew: AQE splits any join partition above 256 MB and 5x the median.
    """
    mb = 1024 * 1024
    shuffle_bytes = max(int(input_bytes * largest_shuffle_fraction), 1)
    partitions = max(200, -(-shuffle_bytes // (128 * mb)))
    return {
        "spark.sql.files.maxPartitionBytes": str(256 * mb),
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * mb),
        # coalesce to the advisory size rather than to one task per core: no
        # swarm of tiny tasks on a busy cluster
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(256 * mb),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    }


def build_session(
    master: str | None = None,
    app_name: str = "tarmac",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the package defaults."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(SESSION_DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and written intermediate tables.

    Taken from the session (``spark.checkpoint.dir`` or the context's
    checkpoint dir).  Only when neither is set AND Spark runs in local mode
    (tests, local runs) is a scratch folder created and registered; on a
    cluster an unset folder is an error, never a machine-local path.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if not configured:
        if not sc.master.startswith("local"):
            # A machine-local folder would scatter written tables across nodes.
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        configured = tempfile.mkdtemp(prefix="tarmac-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def ship_package(spark: SparkSession) -> None:
    """Give Python workers this package, as ``--py-files`` does (once a session).

    The archive is served by the driver, so it may lie in the driver's own folder.
    """
    sc = spark.sparkContext
    if getattr(sc, "_tarmac_shipped", False):
        return
    home = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="tarmac-py-"), "tarmac.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, names in os.walk(home):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, os.path.dirname(home)))
    sc.addPyFile(archive)
    sc._tarmac_shipped = True

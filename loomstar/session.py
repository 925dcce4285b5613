"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# AQE measures shuffle output at run time: it broadcasts a side only when its
# real size is under the threshold, splits hot join partitions and merges tiny
# ones.  forceOptimizeSkewedJoin keeps the split even when a later aggregate
# then needs a shuffle of its own.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
}


def sizing(input_bytes: int, cores: int) -> dict[str, str]:
    """Task sizes for a run over `input_bytes` on `cores`, as settings.

    Shuffle partitions start near 256 MB at any size, at least two per core, and
    AQE merges what turns out small.  Scan tasks grow from 128 MB where the input
    would otherwise make more than a hundred of them per core, which keeps the
    number of shuffle blocks in bounds.
    """
    mib = 1 << 20
    partitions = max(-(-input_bytes // (256 * mib)), 2 * cores)
    scan = max(input_bytes // (100 * cores), 128 * mib)
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(scan),
    }


def build_session(app_name: str = "loomstar", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the defaults above; `conf` overrides them.

    `spark.sql.shuffle.partitions` is left to the cluster unless given, since
    the right starting number follows from its executors, not from this code.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in `spark.checkpoint.dir`.

    Only a local master may go without it: there one machine is the cluster,
    so a temporary folder is shared by every task.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if named:
        if not context.getCheckpointDir():
            context.setCheckpointDir(named)
        return named
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    own = tempfile.mkdtemp(prefix="loomstar-")
    context.setCheckpointDir(own)
    return own


def _scratch_folder(spark: SparkSession) -> str:
    return f"{scratch_root(spark)}/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in this application's part of the shared scratch folder."""
    return f"{_scratch_folder(spark)}/{name}-{uuid.uuid4().hex}"


def clear_scratch(spark: SparkSession) -> None:
    """Remove what this application has put under `scratch_path`.

    Call it once no result that was read from there is needed any more; a
    DataFrame returned by a load or a query may still be.
    """
    folder = spark._jvm.org.apache.hadoop.fs.Path(_scratch_folder(spark))
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)

"""Session set-up and shared scratch locations.

Jobs that must materialise an intermediate result (a rendered dump, a TSV
export, a stream's input and output) write it below the folder the cluster
names in ``spark.checkpoint.dir``: a shared filesystem every executor sees,
so a lost executor never takes written data with it. Only when the setting is
absent (local tests) do we pick a folder ourselves and register it.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_PKG_DIR = "strandline"


def get_spark(
    master: str | None = None,
    shuffle_partitions: int | None = None,
    app_name: str = "strandline",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or reuse) a session with the settings the pipelines assume.

    AQE stays on: it coalesces small shuffle partitions, splits skewed ones
    and re-plans joins from runtime sizes. The UI is off (no listening port).
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # whatever the input's size: moderate splits, and shuffle partitions
        # coalesced to a size rather than to the number of cores
        "spark.sql.files.maxPartitionBytes": str(128 << 20),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(64 << 20),
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scale_settings(input_bytes: int, total_cores: int) -> dict[str, str]:
    """Settings sized to an input volume, for ``get_spark(extra=...)``.

    * input splits of 128 MiB: the per-row work (regex, XPath, tokenising)
      is CPU-bound, so many moderate tasks balance better than few big ones;
    * AQE starts from one shuffle partition per 512 MiB of input (at least
      two per core) and coalesces them to ~128 MiB after the map side has
      run; the partial aggregates usually shrink the shuffle far below that;
    * skewed shuffle partitions are split (skew join) rather than left to
      one task.
    """
    initial = max(2 * total_cores, input_bytes // (512 << 20))
    return {
        "spark.sql.files.maxPartitionBytes": str(128 << 20),
        "spark.sql.shuffle.partitions": str(initial),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(initial),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 << 20),
        "spark.sql.adaptive.skewJoin.enabled": "true",
    }


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Read from the session; set only where unset in local mode (tests), in
    which case the folder is also registered as the RDD checkpoint directory so that
    ``DataFrame.checkpoint()`` and our written tables share one place.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS/S3/NFS) every executor sees")
        root = tempfile.mkdtemp(prefix="strandline-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the checkpoint root for one job run.

    Not created here: Spark's writers create it, and refuse an existing one
    in the default save mode.
    """
    return f"{checkpoint_root(spark)}/{_PKG_DIR}/{name}-{uuid.uuid4().hex}"

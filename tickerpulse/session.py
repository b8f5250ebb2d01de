"""Session helpers: one place for the settings every job relies on."""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

# Settings the results depend on (time zone) or that shape every plan.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def sizing_conf(input_bytes: int, total_cores: int, target_partition_bytes: int = 256 << 20,
                max_split_bytes: int = 256 << 20) -> dict[str, str]:
    """Partition settings that follow the data volume.

    Scans are split at ``max_split_bytes``; the shuffle starts with about
    one partition per ``target_partition_bytes`` of input (at least two
    waves of the cluster's cores) and AQE coalesces partitions that come
    out small after partial aggregation, aiming at the same size, so no
    reducer holds more than it can sort or hash in memory before spilling.
    At 100 TB this gives ~400k initial shuffle partitions; the counts and
    top-k stages, which shuffle partially aggregated rows, coalesce to a
    small fraction of that.
    """
    parts = max(2 * total_cores, -(-input_bytes // target_partition_bytes))
    # Spark never splits below openCostInBytes (4 MB); for small inputs that
    # leaves cores idle, so the floor drops to about four splits per core.
    # At large inputs the default stays.
    open_cost = max(1 << 20, min(4 << 20, input_bytes // max(1, 4 * total_cores)))
    return {
        "spark.sql.files.maxPartitionBytes": str(max_split_bytes),
        "spark.sql.files.openCostInBytes": str(open_cost),
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(target_partition_bytes),
    }


def build_session(master: str | None = None, app: str = "tickerpulse",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with UTC time and AQE on.

    ``shuffle_partitions`` should follow the data: a few per core for the
    test scale factors; on a cluster pass ``sizing_conf(...)`` in ``extra``.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in BASE_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    for k in ("spark.sql.session.timeZone",):
        spark.conf.set(k, BASE_CONF[k])
    ensure_checkpoint_dir(spark)
    return spark


_LOCAL_DIRS: dict[str, str] = {}


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names.

    On a cluster ``spark.checkpoint.dir`` must point at shared storage and is
    used as is; without it this raises, since executors and driver share no
    local folder. Only a session in local mode gets a fresh local folder,
    one per application.
    """
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not d:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = _LOCAL_DIRS.get(sc.applicationId) or tempfile.mkdtemp(prefix="tickerpulse-ckpt-")
        _LOCAL_DIRS[sc.applicationId] = d
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for staged tables."""
    base = ensure_checkpoint_dir(spark)
    import uuid
    return os.path.join(base, f"{name}-{uuid.uuid4().hex[:12]}")


def staged(df, name: str = "staged"):
    """Write ``df`` to the shared checkpoint folder and read it back: cuts the lineage,
    and gives joins a plain side that adaptive execution can split."""
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

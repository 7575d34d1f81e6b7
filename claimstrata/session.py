"""Session settings and the shared work folder."""

from __future__ import annotations

import math
import tempfile
import uuid

from pyspark.sql import SparkSession

SHUFFLES_END_WITH_JOB = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

# Results must not depend on the zone of the driver machine, and a month is
# replaced as a whole (static overwrite) so that vanished payers disappear.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "static",
    # Hashed ids are hexadecimal text: half the space, where snappy leaves them as they are.
    "spark.sql.parquet.compression.codec": "zstd",
    # A job's shuffle files go when it ends, not when the driver happens to collect garbage: the
    # jobs of a run would else hold all their shuffles on disk at once.
    SHUFFLES_END_WITH_JOB: "true",
    # HotSpot never compiles a method above 8000 bytes; run such a stage as
    # separate operators instead of interpreting it.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}

_MIB = 1024 * 1024
_local_folder: str | None = None


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL settings the pipeline relies on."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def shuffle_settings(shuffle_bytes: int, cores: int, target_mib: int = 512) -> dict[str, str]:
    """Settings that keep a reduce partition near `target_mib` of shuffled data.

    Start from enough partitions for the whole shuffle (never fewer than the
    cores); adaptive execution then merges small ones and splits skewed ones
    around the same size.  100 TB at the default target gives 200,000.
    """
    partitions = max(cores, math.ceil(shuffle_bytes / (target_mib * _MIB)))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": f"{target_mib}m",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": f"{4 * target_mib}m",
    }


def workspace(spark: SparkSession, purpose: str) -> str:
    """A new folder name below the cluster's shared `spark.checkpoint.dir`.

    A checkpoint folder set on the context serves as well.  Only a local session
    without either gets a temporary folder; on a cluster every executor must see
    the folder, so it is required.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = _temporary_folder()
    return f"{base.rstrip('/')}/claimstrata/{purpose}-{uuid.uuid4().hex}"


def _temporary_folder() -> str:
    global _local_folder
    if _local_folder is None:
        _local_folder = tempfile.mkdtemp(prefix="claimstrata-")
    return _local_folder

"""Session settings for large runs, and the shared folder for intermediate tables."""

from __future__ import annotations

import math
import tempfile
import uuid

from pyspark.sql import SparkSession

SHUFFLE_PARTITION_BYTES = 256 * 1024 * 1024
# Tasks on either side of a shuffle; the driver tracks an entry per pair of them.
SHUFFLE_TASKS = 50_000


def recommended_conf(input_bytes: int, cores: int) -> dict[str, str]:
    """Settings for a run over ``input_bytes`` on ``cores`` executor cores.

    Partitions have 256 MB and AQE merges what turns out small. Beyond 50,000 tasks a side they grow
    instead (2 GB at 100 TB), and sorts spill. Streaming state goes to RocksDB, which keeps it off
    the heap and bounds what one executor must hold.
    """
    split = max(SHUFFLE_PARTITION_BYTES, math.ceil(input_bytes / SHUFFLE_TASKS))
    partitions = max(cores * 2, math.ceil(input_bytes / split))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.files.maxPartitionBytes": str(split),
        # Streaming state cannot be re-partitioned after the first run, hence cores, not bytes.
        "spark.sql.shuffle.partitions": str(max(8, cores)),
        "spark.sql.streaming.stateStore.providerClass": (
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
        ),
    }


def workspace(spark: SparkSession, label: str) -> str:
    """A fresh folder under the shared checkpoint folder of the session.

    Only a local session without that setting gets a folder of this machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="tidemark-")
    return f"{base.rstrip('/')}/tidemark/{label}-{uuid.uuid4().hex}"

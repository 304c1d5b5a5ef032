"""Session-level helpers: where jobs may write, and the tuning knobs the package reads."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by the cluster.

    Only a local-mode session without the setting falls back to a temporary folder; on a cluster a
    machine-local folder would lose data, so that is an error.
    """
    configured = spark.conf.get(CHECKPOINT_CONF, None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder shared by all executors")
    return _local_fallback()


@cache
def _local_fallback() -> str:
    return tempfile.mkdtemp(prefix="pricing-audit-")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder; two runs never write to the same one."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))

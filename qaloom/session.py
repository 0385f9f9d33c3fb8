"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


ARROW_BYTES = str(16 << 20)


def build_session(app: str = "qaloom", master: str | None = None, shuffle_partitions: int | None = None) -> SparkSession:
    """Session with the settings the jobs are written for.

    On a cluster leave ``master`` and ``shuffle_partitions`` unset: the former comes from
    spark-submit, and AQE coalesces the latter down from the cluster's own setting.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        # one Arrow batch holds at most so many rows and, of long texts, about so many bytes
        .config("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
        .config("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BYTES)
    )
    if master:
        builder = builder.master(master).config("spark.ui.enabled", "false").config("spark.driver.memory", "8g")
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, label: str, root: str | None = None) -> str:
    """A new path under ``root``, by default under the cluster's shared checkpoint folder.

    Only where ``spark.checkpoint.dir`` is unset and all tasks run in the driver's process is a temporary folder used.
    """
    root = root or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.conf.get("spark.master", "")
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="qaloom-")
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"

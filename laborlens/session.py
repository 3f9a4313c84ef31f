"""Session construction and the shared scratch location."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on. Sizes (memory, initial shuffle partitions) belong
# to the cluster's own configuration and are not set here.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    # no recording of the Python line behind every column expression
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app_name: str = "laborlens", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**BASE_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A fresh folder under the cluster's shared checkpoint directory.

    The directory is read from ``spark.checkpoint.dir``. Only a local master (one process) may
    fall back to a temporary folder, because there every task shares the machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.fullmatch(r"local(\[[^]]*])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
        root = tempfile.mkdtemp(prefix="laborlens-")
    path = f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
    _scratch.append(path)
    return path


_scratch: list[str] = []


def clear_scratch(spark: SparkSession) -> int:
    """Delete the intermediate tables that this program has written, once no result of it is read any more; their number."""
    from .sources.files import remove

    paths, _scratch[:] = _scratch[:], []
    for path in paths:
        remove(spark, path)
    return len(paths)

"""The folder that driver and executors share."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir of the session. Where it is unset, a temporary folder if everything runs in
    one process, as in tests; on a cluster that would be a folder of one machine, so it is an error."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        have = spark.sparkContext._jsc.sc().getCheckpointDir()
        found = have.get() if have.isDefined() else None
    if not found:
        if not spark.sparkContext._jsc.sc().isLocal():
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="loomlog-")
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")

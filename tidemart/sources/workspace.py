"""Where a job may write: the shared folder of the cluster."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder; on a
    cluster such a folder would not be seen by the other machines.
    """
    folder = spark.conf.get(CHECKPOINT_DIR, None)
    folder = folder or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    master = spark.conf.get("spark.master", "local")
    if not master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder all machines share")
    return f"{tempfile.gettempdir()}/tidemart"


def new_folder(spark: SparkSession, purpose: str) -> str:
    """A path below the shared folder that nothing has used yet."""
    return f"{shared_folder(spark)}/{purpose}-{uuid.uuid4().hex}"

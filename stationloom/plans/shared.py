"""A folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new place called after ``name`` in the folder of ``spark.checkpoint.dir``.

    Without that setting only a local session has one, in a temporary folder of its own.
    """
    context = spark.sparkContext
    folder = context.getCheckpointDir() or context.getConf().get("spark.checkpoint.dir", None)
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="shared-")
        context.setCheckpointDir(folder)
    return f"{folder}/{name}-{uuid.uuid4().hex}"

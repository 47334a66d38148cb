"""Where intermediate tables and streaming checkpoints go."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder below the shared folder the cluster names in ``spark.checkpoint.dir``.

    Without that setting only a local session gets a folder of its own: on a cluster a folder of one
    machine would be lost with it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="ebbline-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"

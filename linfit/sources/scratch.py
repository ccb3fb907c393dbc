"""Where intermediate tables are written."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for an intermediate table.

    It lies in the shared folder the session names in ``spark.checkpoint.dir``, where every
    executor can read and write it. Only a session without one, a local run, gets a temporary
    folder of this machine, removed when the process ends.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return f"{shared.rstrip('/')}/linfit-{name}-{uuid.uuid4().hex}"
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the whole cluster")
    folder = tempfile.mkdtemp(prefix=f"linfit-{name}-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return f"{folder}/table"

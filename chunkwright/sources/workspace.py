"""Where written tables go: the folder that the cluster shares."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_OWN: dict[str, str] = {}


def workspace(spark: SparkSession, name: str) -> str:
    """A new folder in spark.checkpoint.dir; where that is unset, which is an error but in local mode, in a folder of this process."""
    kept = spark.conf.get("spark.checkpoint.dir", None)
    if not kept and not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that the cluster shares")
    if not kept:
        kept = _OWN.setdefault("dir", "file://" + tempfile.mkdtemp(prefix="spark-workspace-"))
    return f"{kept.rstrip('/')}/{name}-{uuid.uuid4().hex}"

"""A fresh folder for intermediate tables and query checkpoints, and shuffled rows that leave the disk in time."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

SETTING = "spark.checkpoint.dir"
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder the session names. Only a local session without that
    setting gets a temporary folder of this machine."""
    base = spark.conf.get(SETTING, None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {SETTING} to a folder all executors share")
        base = tempfile.mkdtemp(prefix="retail-stream-")
    return f"{base.rstrip('/')}/retail_stream/{name}-{uuid.uuid4().hex}"


@contextmanager
def no_old_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffled rows of what is written meanwhile leave the disk when it is written, and not when the driver happens
    to collect its garbage."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(SHUFFLE_CLEANUP) if before is None else spark.conf.set(SHUFFLE_CLEANUP, before)

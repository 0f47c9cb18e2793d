"""How streams keep the logs of their progress."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyarrow import fs
from pyspark.sql import SparkSession

MANAGER = "spark.sql.streaming.checkpointFileManagerClass"
_PLAIN = "org.apache.spark.sql.execution.streaming.checkpointing.FileSystemBasedCheckpointFileManager"


@contextmanager
def plain_logs(spark: SparkSession, path: str) -> Iterator[None]:
    """Streams that start inside, with checkpoints and file sinks below a local folder, write each log entry and rename it
    by way of Hadoop's FileSystem. Spark's own choice does the same through FileContext, which without Hadoop's native
    library starts a process for each look at a link. Elsewhere, where the session has a choice of its own, and before
    Spark 4.1 nothing changes."""
    local = isinstance(fs.FileSystem.from_uri(path)[0], fs.LocalFileSystem)
    if not local or spark.conf.get(MANAGER, None) is not None or tuple(map(int, spark.version.split(".")[:2])) < (4, 1):
        yield
        return
    spark.conf.set(MANAGER, _PLAIN)
    try:
        yield
    finally:
        spark.conf.unset(MANAGER)

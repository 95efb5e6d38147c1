"""Durable places for intermediate data: the shared folder the cluster names."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

CONF = "spark.checkpoint.dir"


def checkpoint_root(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir. Only a local session without one gets a temporary folder."""
    root = spark.conf.get(CONF, None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"set {CONF} to a folder that every executor can reach")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="shardleaf-"))
        root = spark.sparkContext.getCheckpointDir()
    return root


_made: ContextVar[list[str] | None] = ContextVar("made", default=None)


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new folder of its own under the shared folder."""
    path = f"{checkpoint_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    made = _made.get()
    if made is not None:
        made.append(path)
    return path


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Remove the intermediate tables that are written inside the block when it ends.

    Frames that read them must not be used afterwards: write results elsewhere before the block ends.
    """
    token = _made.set([])
    try:
        yield
    finally:
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        for made in _made.get() or []:
            path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(made)
            path.getFileSystem(conf).delete(path, True)
        _made.reset(token)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write df as a table in the shared folder and go on from there: survives the loss of any executor.

    It also gives later stages a plain scan. Its size is known, so broadcasts are decided on facts.
    Its rows come in the same order when a task is run again. And a join on it has an exchange of its
    own on either side, which AQE needs to split a skewed key; a side that was just grouped on the
    join key has none.
    """
    path = shared_dir(df.sparkSession, "table")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

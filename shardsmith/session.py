"""Session helpers: building a session and locating the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings the library relies on: AQE for runtime re-planning and skew splits,
# UTC so that timestamp text is stable, and no UI server.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, app: str = "shardsmith", **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in {**DEFAULT_CONF, **conf}.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession, *parts: str, unique: bool = False) -> str:
    """A folder under the cluster's shared ``spark.checkpoint.dir``.

    The checkpoint directory is the one folder every executor can reach; it
    is read from the session.  Only when it is unset and the master is local
    (tests) do we pick a local one and register it on the session; on a cluster
    that would scatter files over the executors, so it is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="shardsmith-")
        spark.sparkContext.setCheckpointDir(base)
        spark.conf.set("spark.checkpoint.dir", base)
    base = base.rstrip("/")
    path = "/".join([base, "shardsmith", *parts])
    if unique:
        path = f"{path}/{uuid.uuid4().hex}"
        for made in _scopes:
            made.append(path)
    return path


_scopes: list[list[str]] = []  # of the scopes that are open, what was handed out since


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[list[str]]:
    """Remove, at the end of the ``with`` block, every scratch folder that was handed out in it.

    Operators write intermediate tables to the shared folder, and the frames
    they return read them, so only the caller knows when they are done with:
    write or collect the results inside the block.
    """
    made: list[str] = []
    _scopes.append(made)
    try:
        yield made
    finally:
        _scopes[:] = [s for s in _scopes if s is not made]
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        for path in made:
            p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(conf).delete(p, True)

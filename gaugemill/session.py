"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app: str = "gaugemill", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings the library is tested with; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_CONF, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


WORK_DIR = "gaugemill.work.dir"


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared work folder of the session.

    That is the folder named by ``spark.checkpoint.dir`` when the session was built, else the one the session names as
    ``gaugemill.work.dir``, which can be set at any time. Without either only a local master gets a folder of its own
    (tests); a cluster must name one, since a machine-local folder is not visible to other executors. What is written
    there lasts until the owner of the folder removes it: results may read it for as long as they are used.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(WORK_DIR, None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(
                "no work folder: build the session with spark.checkpoint.dir, or call "
                f'spark.conf.set("{WORK_DIR}", ...), with a folder shared by all executors'
            )
        root = tempfile.mkdtemp(prefix="gaugemill-")
        spark.conf.set(WORK_DIR, root)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"

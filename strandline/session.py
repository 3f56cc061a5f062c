"""Session, shared folder and scoped settings."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import SparkSession


def build_session(app: str = "strandline", master: str | None = None, **conf: object) -> SparkSession:
    """A session with the settings the library relies on; the cluster's own settings win elsewhere."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, str(value))
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """The folder all executors can reach: ``spark.checkpoint.dir``.

    A folder of our own is made only where the setting is absent and the master is local.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        configured = spark.sparkContext.getCheckpointDir()
    if not configured:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        configured = tempfile.mkdtemp(prefix="strandline-")
        spark.sparkContext.setCheckpointDir(configured)
    return configured.rstrip("/")


def new_folder(spark: SparkSession, label: str) -> str:
    """A path nobody else uses, inside the shared folder. Nothing is created yet."""
    return f"{shared_root(spark)}/strandline/{label}-{uuid.uuid4().hex}"


def new_table_name(label: str) -> str:
    return f"{label}_{uuid.uuid4().hex}"


@contextlib.contextmanager
def settings(spark: SparkSession, conf: dict[str, str]) -> Iterator[None]:
    """Apply session settings for the actions started inside the block, then put the old ones back."""
    before = {key: spark.conf.get(key, None) for key in conf}
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)

"""Session defaults and the shared folder for tables that a job writes on the way."""

import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(app: str, master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings every job here expects; ``conf`` wins over them."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.ui.enabled": "false",
    }
    settings.update({key.replace("__", "."): value for key, value in conf.items()})
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession, label: str) -> str:
    """A fresh path every executor can reach.

    It lies under ``spark.checkpoint.dir``, the folder the cluster names. Only a
    single-machine session may fall back to a local temporary folder; on a
    cluster such a folder would not be shared, so that is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="repopulse-")
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"

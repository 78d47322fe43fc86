"""Sessions that read a lake as it is written: UTC, ANSI, partition values as text."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

#: Temporary folders of local sessions that name no shared one, by application.
_LOCAL: dict[str, str] = {}

#: Partition values such as interval=1d must stay text, and timestamps must not move.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def session(name: str = "tidelake", master: str | None = None, **settings: str) -> SparkSession:
    """A session with SETTINGS; settings given here win. Dots in names are written as __."""
    builder = SparkSession.builder.appName(name).config(map=SETTINGS | {k.replace("__", "."): v for k, v in settings.items()})
    return (builder.master(master) if master else builder).getOrCreate()


def s3_settings(endpoint: str, key: str, secret: str) -> dict[str, str]:
    """Hadoop settings for a lake in an S3-compatible store, read as s3a:// paths."""
    return {
        "spark.hadoop.fs.s3a.endpoint": endpoint,
        "spark.hadoop.fs.s3a.access.key": key,
        "spark.hadoop.fs.s3a.secret.key": secret,
        "spark.hadoop.fs.s3a.path.style.access": "true",
    }


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the folder that the cluster shares, ``spark.checkpoint.dir``; only a local session may go without one."""
    context = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not found:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        if context.applicationId not in _LOCAL:
            _LOCAL[context.applicationId] = "file://" + tempfile.mkdtemp(prefix="tidelake-")
        found = _LOCAL[context.applicationId]
    return f"{found.rstrip('/')}/{name}-{uuid.uuid4().hex}"

"""Session settings the plans rely on, and the shared scratch folder."""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

RUNTIME_SETTINGS = {
    # Timestamps are UTC instants; hours and days are cut in UTC.
    "spark.sql.session.timeZone": "UTC",
    # One commit or repository may hold a third of all rows: let AQE split its
    # join partition even where that costs an extra shuffle above the join.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else created."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def build_session(app_name: str = "patchlens", master: str | None = None, **settings: str):
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A new folder name in the cluster's shared checkpoint folder.

    Only where the session names no such folder (tests) is a local one used.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="run-")
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"

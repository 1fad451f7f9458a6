"""Session set-up and the shared scratch folder."""

import tempfile
import uuid

from pyspark.sql import SparkSession


def get_session(app_name: str = "ledgerloom", **conf: str) -> SparkSession:
    """Session for the jobs; cluster settings stay with spark-submit."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder for intermediate tables, below ``spark.checkpoint.dir``.

    Every executor must be able to reach it, so a machine-local folder is made
    only when the setting is absent and the master itself is local.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="ledgerloom-")
        spark.conf.set("spark.checkpoint.dir", base)  # one folder for the session
    return f"{base.rstrip('/')}/ledgerloom/{purpose}-{uuid.uuid4().hex[:12]}"

"""Session settings the operators rely on."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that change results; all can be set on a running session.
RESULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    # A JSON object that repeats a key keeps the last value, as most decoders do.
    "spark.sql.variant.allowDuplicateKeys": "true",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the settings that results depend on to a running session."""
    for key, value in RESULT_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: str = "*", **conf: str) -> SparkSession:
    """A local session for tests and the bench; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("jsonflow")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
    )
    for key, value in {**RESULT_CONF, **conf}.items():
        builder = builder.config(key, value)
    return prepare(builder.getOrCreate())


def shared_dir(spark: SparkSession) -> str:
    """A fresh folder all executors can reach, below ``spark.checkpoint.dir``.

    Only a local session may do without that setting; it gets a temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return f"{root.rstrip('/')}/jsonflow-{uuid.uuid4().hex}"
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder the whole cluster shares")
    return tempfile.mkdtemp(prefix="jsonflow-")

"""Session settings and the shared working folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


# Classifier reports compile into long methods; above HotSpot's own limit such a method is
# never compiled to machine code, so whole-stage code past it is slower than none.
TUNING = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def tune(spark: SparkSession) -> SparkSession:
    """Runtime settings the reports rely on."""
    for k, v in TUNING.items():
        if spark.conf.get(k) != v:
            spark.conf.set(k, v)
    return spark


def build_session(app: str = "venuelake", cpus: str | int = "*", **conf: str) -> SparkSession:
    """A local session for tests and the bench. On a cluster use the submitted session."""
    b = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("VENUELAKE_DRIVER_MEMORY", "12g"))
    )
    for k, v in conf.items():
        b = b.config(k.replace("__", "."), v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder all executors can reach, below ``spark.checkpoint.dir``.

    Only a local-mode session without that setting gets a temporary folder; a cluster
    session without it is an error, since a machine-local path would lose data with its host.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):  # local-cluster is a cluster
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        base = tempfile.mkdtemp(prefix="venuelake-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"

"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def configure(spark: SparkSession) -> SparkSession:
    """Settings the results or the plans rely on.

    Event times are instants while stored tables are zone-less, so the session is in UTC.
    Lookups join a spine several times; when those joins share their keys, Spark would
    rather keep the partitioning than split a skewed one, unless told to.
    """
    wanted = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    }
    for name, value in wanted.items():
        if spark.conf.get(name) != value:
            spark.conf.set(name, value)
    return spark


def local_session(cores: int | str = 8, app: str = "tidemark", **conf: str) -> SparkSession:
    """A local session for tests and the bench. Clusters bring their own session."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cores) if cores != "*" else "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.sources.partitionColumnTypeInference.enabled", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def workdir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder for tables, checkpoints and landed files of one job.

    It lies under ``spark.checkpoint.dir``, the shared folder the cluster names.
    Only a local master may go without that setting; a machine-local folder on a
    cluster would be lost with its executor.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        base = tempfile.mkdtemp(prefix="tidemark-")
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"

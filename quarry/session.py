"""Session builder and shared settings."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# HotSpot never compiles a method of more than 8,000 bytes. Operators whose fused code
# is longer run one by one, in methods short enough to be compiled.
COMPILED = {"spark.sql.codegen.hugeMethodLimit": "8000"}

# Settings every job relies on. AQE re-plans joins at runtime from real sizes,
# coalesces small shuffle partitions and splits skewed ones; broadcast stays
# behind Spark's measured-size threshold.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.session.timeZone": "UTC",
    **COMPILED,
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app_name: str = "quarry", extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder for lineage cuts and derived files.

    On a cluster this is the shared folder named by ``spark.checkpoint.dir``;
    a missing setting is an error there, because a machine-local folder would
    lose files. Only a local master gets a scratch folder of its own.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        master = spark.conf.get("spark.master", "")
        if not re.match(r"local($|\[)", master):
            raise RuntimeError(
                f"set spark.checkpoint.dir to a folder all executors share (master {master!r})")
        d = tempfile.mkdtemp(prefix="quarry-ckpt-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", d)
    try:
        spark.sparkContext.setCheckpointDir(d)
    except Exception:  # Spark Connect: the server reads spark.checkpoint.dir
        pass
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-path under the shared folder, unique across drivers that
    share it: application id plus a random part."""
    app = spark.conf.get("spark.app.id", "app")
    return f"{shared_dir(spark).rstrip('/')}/{name}-{app}-{uuid.uuid4().hex}"

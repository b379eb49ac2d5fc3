"""Session settings and the folder for tables that outlive a stage."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Only what the library relies on. Sizing (executors, memory, number of shuffle
# partitions) belongs to the cluster; AQE coalesces or splits from there.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.optimizer.dynamicPartitionPruning.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}


def build_session(
    master: str | None = None,
    app_name: str = "tallyhouse",
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """A session with the library's settings; ``conf`` wins over them."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder written tables go to: the one the cluster names.

    ``spark.checkpoint.dir`` is read from the session. Only a local session
    without it gets a temporary folder of its own; on a cluster a machine-local
    folder would be lost with the machine, so that is an error.
    """
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set: name a folder every executor can reach"
        )
    own = tempfile.mkdtemp(prefix="tallyhouse-")
    sc.setCheckpointDir(own)
    return sc.getCheckpointDir().rstrip("/")

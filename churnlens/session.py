"""The Spark session of a run, and the two settings the operators rely on."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def build_session(app_name: str = "churnlens", **settings: str) -> SparkSession:
    """Get or create a session. ``settings`` use ``__`` for the dots of a key."""
    builder = SparkSession.builder.appName(app_name)
    for name, value in settings.items():
        builder = builder.config(name.replace("__", "."), value)
    return pin_time_zone(builder.getOrCreate())


def pin_time_zone(spark: SparkSession, zone: str = "UTC") -> SparkSession:
    """Hours and dates are cut in the session time zone, so it has to be fixed."""
    spark.conf.set("spark.sql.session.timeZone", zone)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared checkpoint folder of the cluster.

    Only a local session without one gets a folder of its own; on a cluster a
    folder on one machine would be lost with that machine.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is not None:
        return
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        context.setCheckpointDir(shared)
    elif context.master == "local" or context.master.startswith("local["):
        context.setCheckpointDir(tempfile.mkdtemp(prefix="churnlens-checkpoint-"))
    else:
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")

"""Session settings the jobs rely on, and the shared checkpoint folder."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Spark sizes the work at run time: partitions are coalesced, split and
# broadcast by their measured size, never by a guess in the code.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Shredding costs far more than its input has bytes: small inputs still go to all cores.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.aggregatePushdown": "true",
    "spark.sql.variant.allowDuplicateKeys": "true",
    # A list of keys reaches the Parquet pages as it is, not as its least and greatest key.
    "spark.sql.parquet.pushdown.inFilterThreshold": "500",
}


def session(app: str = "clinloom", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings above; ``conf`` adds or replaces entries."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the checkpoint folder the cluster names in ``spark.checkpoint.dir``.

    A local test session without the setting gets a fresh temporary folder; on
    a cluster that would lose data with the machine, so it is refused there.
    """
    context = spark.sparkContext
    if context.getCheckpointDir():
        return
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        context.setCheckpointDir(named)
    elif context.master.startswith("local"):
        context.setCheckpointDir(tempfile.mkdtemp(prefix="clinloom-checkpoint-"))
    else:
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")


def ensure_json_settings(spark: SparkSession) -> None:
    """Let JSON objects repeat a key, of which the last counts, also in sessions made elsewhere."""
    key = "spark.sql.variant.allowDuplicateKeys"
    if spark.conf.get(key) != SETTINGS[key]:
        spark.conf.set(key, SETTINGS[key])

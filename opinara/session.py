"""Session settings and lineage cutting."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# What the operators rely on; everything else is left to the cluster.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Python workers hold one Arrow batch at a time; long pages and prompts must not add up.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(32 << 20),
    # A repeated JSON key keeps its last value instead of losing the record.
    "spark.sql.variant.allowDuplicateKeys": "true",
}


def build_session(app_name: str = "opinara", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**REQUIRED_CONF, **conf}.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def configure(spark: SparkSession) -> SparkSession:
    """Apply the required settings to a session someone else created."""
    for key, value in REQUIRED_CONF.items():
        spark.conf.set(key, value)
    return spark


def materialize(df: DataFrame) -> DataFrame:
    """Compute ``df`` once and cut its lineage with a reliable checkpoint.

    Used where a result is both expensive (external calls, the record rules)
    and read several times. The files go to the folder the cluster names in
    ``spark.checkpoint.dir``, which has to be set.
    """
    checkpoint_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def checkpoint_folder(spark: SparkSession, otherwise: str | None = None) -> str:
    """The folder of ``spark.checkpoint.dir``; a session without one gets ``otherwise``, which all executors have to see."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        shared = context.getConf().get("spark.checkpoint.dir") or otherwise
        if shared is None:
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        context.setCheckpointDir(shared)
    return context.getCheckpointDir()

"""Session settings and the shared folder for checkpoints."""

from __future__ import annotations

import atexit
import shutil
import tempfile

from pyspark.sql import DataFrame, SparkSession

#: Settings every job relies on; sizes are left to the cluster.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Join state is kept beside the heap, and the slower of a join's sides holds the watermark.
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.multipleWatermarkPolicy": "min",
    # Offsets are asked for without a consumer group; consumers are kept from batch to batch.
    "spark.sql.streaming.kafka.useDeprecatedOffsetFetching": "false",
    "spark.kafka.consumer.cache.enabled": "true",
}


def local_session(cores: int = 8, shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A session for tests and benches on this machine."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("tidemark").config("spark.driver.memory", memory)
    for name, value in SETTINGS.items():
        builder = builder.config(name, value)
    spark = (
        builder.config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def cut_lineage(df: DataFrame) -> DataFrame:
    """``df`` as a reliable checkpoint in the folder all executors share.

    ``spark.checkpoint.dir`` names that folder. Only where it is unset and Spark runs in this
    process, as in tests, a temporary folder is used and removed at the end; on a cluster
    without one RuntimeError is raised, as no other machine could read it.
    """
    spark = df.sparkSession
    context = spark.sparkContext
    shared = context.getConf().get("spark.checkpoint.dir", None)
    if context.getCheckpointDir() is None:
        if shared is None:
            if not (context.master == "local" or context.master.startswith("local[")):
                raise RuntimeError("spark.checkpoint.dir must name a folder that all machines share")
            shared = tempfile.mkdtemp(prefix="tidemark-")
            atexit.register(shutil.rmtree, shared, ignore_errors=True)
        context.setCheckpointDir(shared)
    return df.checkpoint(eager=True)


def shuffle_width(spark: SparkSession) -> int:
    """The number of partitions a shuffle makes in this session."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


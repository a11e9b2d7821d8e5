"""Change feeds as streams or bounded tables: from Kafka, or from files of the same columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

#: What a feed has, whatever it is read from.
COLUMNS = T.StructType(
    [
        T.StructField("key", T.StringType()),
        T.StructField("value", T.StringType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)


def _typed(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in COLUMNS])


def kafka_stream(spark: SparkSession, servers: str, topic: str, starting: str = "earliest", per_trigger: int = 100_000, fail_on_loss: bool = False, **options: str) -> DataFrame:
    """A topic as a stream. Needs Spark's Kafka connector on the classpath."""
    reader = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic)
    reader = reader.option("startingOffsets", starting).option("maxOffsetsPerTrigger", per_trigger).option("failOnDataLoss", str(fail_on_loss).lower())
    return _typed(reader.options(**options).load())


def kafka_table(spark: SparkSession, servers: str, topic: str, **options: str) -> DataFrame:
    """All of a topic, from its first offset to its last at the start of the query."""
    reader = spark.read.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic)
    return _typed(reader.option("startingOffsets", "earliest").option("endingOffsets", "latest").options(**options).load())


def file_stream(spark: SparkSession, folder: str, per_trigger: int = 1) -> DataFrame:
    """A folder of Parquet files with a feed's columns, as a stream of ``per_trigger`` files a batch."""
    return spark.readStream.schema(COLUMNS).option("maxFilesPerTrigger", per_trigger).parquet(folder)


def file_table(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(COLUMNS).parquet(folder)


def jdbc_table(spark: SparkSession, url: str, name: str, key: str | None = None, bounds: tuple[int, int] | None = None, parts: int = 8, **options: str) -> DataFrame:
    """A database table; with ``key`` and ``bounds`` it is read in ``parts`` ranges side by side."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", name).options(**options)
    if key and bounds:
        reader = reader.option("partitionColumn", key).option("lowerBound", bounds[0]).option("upperBound", bounds[1]).option("numPartitions", parts)
    return reader.load()


def as_messages(envelopes: DataFrame, topic: str = "feed") -> DataFrame:
    """A table of envelopes as the messages it came in: the envelope's fields as JSON, tombstones with a null value."""
    value = F.when(F.col("op").isNotNull(), F.to_json(F.struct("op", "before", "after", "ts_ms")))
    return envelopes.select(
        F.col("msg_key").alias("key"), value.alias("value"), F.lit(topic).alias("topic"), F.col("kafka_partition").alias("partition"),
        F.col("kafka_offset").alias("offset"), F.timestamp_millis(F.col("ts_ms").try_cast("bigint")).alias("timestamp"),
    )

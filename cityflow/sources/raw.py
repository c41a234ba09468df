"""Raw record sources: message broker topics, or files with the same schema.

A raw record has the columns of `RAW_SCHEMA` whatever it was read from, and the same call gives a
stream or a batch. The broker source needs Spark's Kafka package on the class path.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cityflow.config import FLOWS

HEADER_TYPE = "array<struct<key:string,value:binary>>"

RAW_SCHEMA = T.StructType(
    [
        T.StructField("flow", T.StringType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("kafka_ts", T.TimestampType()),
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.StringType()),
        T.StructField(
            "headers",
            T.ArrayType(
                T.StructType([T.StructField("key", T.StringType()), T.StructField("value", T.BinaryType())])
            ),
        ),
    ]
)


@dataclass(frozen=True)
class KafkaSource:
    """Topics of a broker. `pattern` is matched again as the stream runs, so new topics join in."""

    servers: str
    prefix: str = ""
    topics: str | None = None
    pattern: str | None = None
    # "earliest" replays everything kept; "latest" only what comes in from now on.
    starting: str = "earliest"
    # Bounded intake per micro-batch.
    max_offsets: int | None = None
    options: dict[str, str] = field(default_factory=dict)

    def reader_options(self, flow: str, streaming: bool) -> dict[str, str]:
        """Options of the Kafka reader for one flow."""
        if self.pattern:
            subscription = {"subscribePattern": self.pattern}
        else:
            subscription = {"subscribe": self.topics or f"{self.prefix}raw_{flow}"}
        chosen = {
            "kafka.bootstrap.servers": self.servers,
            "includeHeaders": "true",
            # Batch reads always begin at the oldest record unless told otherwise.
            "startingOffsets": self.starting if streaming else "earliest",
            **subscription,
        }
        if streaming and self.max_offsets:
            chosen["maxOffsetsPerTrigger"] = str(self.max_offsets)
        return {**chosen, **self.options}


@dataclass(frozen=True)
class FileSource:
    """A folder of raw records as Parquet or JSON lines."""

    path: str
    format: str = "parquet"
    # Bounded intake per micro-batch.
    max_files: int | None = None


def read_raw(spark: SparkSession, flow: str, source: KafkaSource | FileSource, streaming: bool = True) -> DataFrame:
    """Raw records of one flow, as a stream or as a batch over everything there is."""
    if flow not in FLOWS:
        raise ValueError(f"unknown flow {flow!r}, expected one of {', '.join(FLOWS)}")
    reader = spark.readStream if streaming else spark.read
    if isinstance(source, KafkaSource):
        records = reader.format("kafka").options(**source.reader_options(flow, streaming)).load()
        records = records.withColumn("value", F.col("value").cast("string")).withColumnRenamed("timestamp", "kafka_ts")
    else:
        reader = reader.schema(RAW_SCHEMA)
        if streaming and source.max_files:
            reader = reader.option("maxFilesPerTrigger", source.max_files)
        records = reader.format(source.format).load(source.path)
        records = records.where(F.col("flow").isNull() | (F.col("flow") == flow))
    columns = [F.lit(flow).alias("flow") if f.name == "flow" else F.col(f.name) for f in RAW_SCHEMA.fields]
    return records.select(*columns)


def read_rejected(spark: SparkSession, source: KafkaSource | FileSource, streaming: bool = True) -> DataFrame:
    """Dead-letter records, with their context headers as the map `hdr` (key case kept)."""
    from cityflow.operators.context import with_headers

    return with_headers(read_raw(spark, "errors", source, streaming), keep_case=True)


def drop_replayed(records: DataFrame, watermark: str | None = None) -> DataFrame:
    """One record per (topic, partition, offset); streams need a watermark to bound the state."""
    coordinates = ["topic", "partition", "offset"]
    if records.isStreaming:
        if watermark is None:
            raise ValueError("a stream needs a watermark")
        return records.withWatermark("kafka_ts", watermark).dropDuplicatesWithinWatermark(coordinates)
    return records.dropDuplicates(coordinates)

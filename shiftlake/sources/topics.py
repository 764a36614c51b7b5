"""Topic sources, with files standing in for a broker."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Start positions; group offsets and none resume from the checkpoint.
START_POSITIONS = {"earliest": "earliest", "latest": "latest", "groupoffsets": None, "none": None}

# Options of the source itself.
SOURCE_OPTIONS = {name.lower(): name for name in (
    "assign", "startingOffsets", "startingOffsetsByTimestamp", "startingTimestamp", "endingOffsets",
    "endingOffsetsByTimestamp", "endingTimestamp", "failOnDataLoss", "kafkaConsumer.pollTimeoutMs", "fetchOffset.numRetries",
    "fetchOffset.retryIntervalMs", "maxOffsetsPerTrigger", "minOffsetsPerTrigger", "maxTriggerDelay", "minPartitions",
    "maxRecordsPerPartition", "groupIdPrefix", "includeHeaders", "startingOffsetsByTimestampStrategy")}

# Offsets of a topic that no partition reaches within a retention time.
OFFSET_SPAN = 1 << 46

BUILT_IN_CHARSETS = {"US-ASCII", "ISO-8859-1", "UTF-8", "UTF-16BE", "UTF-16LE", "UTF-16", "UTF-32"}


@dataclass(frozen=True)
class TopicSource:
    """One topic, a comma list, or a pattern of topics.

    ``extra`` holds options of the source under their own names (see
    ``SOURCE_OPTIONS``); anything else is a property of the broker client.
    """

    servers: str
    topic: str
    is_pattern: bool = False
    start: str = "latest"
    group: str | None = None
    discovery_seconds: int | None = None
    extra: dict[str, str] = field(default_factory=dict)

    def options(self) -> dict[str, str]:
        """Reader options of the broker source."""
        position = self.start.lower()
        if position not in START_POSITIONS:
            raise ValueError(f"unknown start position {self.start!r}")
        out = {"kafka.bootstrap.servers": self.servers,
               "subscribePattern" if self.is_pattern else "subscribe": self.topic}
        if START_POSITIONS[position]:
            out["startingOffsets"] = START_POSITIONS[position]
        if self.group:
            out["kafka.group.id"] = self.group
        if self.discovery_seconds is not None:
            out["kafka.metadata.max.age.ms"] = str(self.discovery_seconds * 1000)
        for name, value in self.extra.items():
            own = SOURCE_OPTIONS.get(name.lower())
            out[own or (name if name.startswith("kafka.") else f"kafka.{name}")] = value
        return out


def read_topics(spark: SparkSession, source: TopicSource) -> DataFrame:
    """Stream of ``topic, key, value`` (binary), ``seq`` and ``timestamp``.

    ``seq`` orders by partition, then offset: offsets alone repeat across
    partitions, and ties would leave the order of equal times open.
    """
    raw = spark.readStream.format("kafka").options(**source.options()).load()
    return raw.select("topic", "key", "value", place("partition", "offset").alias("seq"), "timestamp")


def place(partition: str, offset: str) -> Column:
    """One total order of the records of a topic."""
    return F.col(partition).cast("long") * OFFSET_SPAN + F.col(offset)


def tag_records(raw: DataFrame, key_type: str = "topic", charset: str = "UTF-8") -> DataFrame:
    """Decode the value and tag each record with its topic or its key.

    Any charset the JVM knows; those beyond the ANSI list need a session switch.
    """
    if charset.upper() not in BUILT_IN_CHARSETS:
        raw.sparkSession.conf.set("spark.sql.legacy.javaCharsets", "true")
    value = F.decode(F.col("value"), charset)
    if key_type == "topic":
        tag = F.col("topic")
    elif key_type == "key":
        tag = F.decode(F.col("key"), charset)
    else:
        raise ValueError(f"key type is topic or key, not {key_type!r}")
    return raw.select(tag.alias("topic"), value.alias("value"),
                      *[c for c in raw.columns if c not in ("topic", "key", "value")])


def stream_table(spark: SparkSession, path: str, schema: str | None = None, fmt: str = "parquet",
                 max_files: int | None = None) -> DataFrame:
    """Stream over the files of a table. ``max_files`` bounds a micro-batch."""
    reader = spark.readStream.format(fmt)
    reader = reader.schema(schema or spark.read.format(fmt).load(path).schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    # As a pattern the path may be one file as well as a folder.
    return reader.load(f"{path[:-1]}[{path[-1]}]")


def read_topic_folders(spark: SparkSession, root: str, topics: str, schema: str | StructType, is_pattern: bool = False, fmt: str = "parquet",
                       max_files: int | None = None) -> DataFrame:
    """Stream over a folder per topic below ``root``, each row with its ``topic``: a comma list, or a pattern of names.

    Folders are looked for in every micro-batch, so a topic that appears later
    is found; the checkpoint knows the files that were read.
    """
    names = [t.strip() for t in topics.split(",") if t.strip()]
    # A pattern matches whole names; the rest of what the folder holds is not read beyond its listing.
    glob = "*" if is_pattern else "{" + ",".join(names) + "}"
    reader = spark.readStream.format(fmt).schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    rows = reader.load(f"{root.rstrip('/')}/{glob}")
    folder = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2)
    out = rows.select("*", F.url_decode(folder).alias("topic"))
    return out.where(F.col("topic").rlike(f"^(?:{topics})$")) if is_pattern else out


def json_view(spark: SparkSession, feed: DataFrame, name: str, schema: str, kept: Sequence[str] = ()) -> DataFrame:
    """Register JSON texts with a declared schema as a view, batch or stream; ``kept`` are further columns of the feed.

    A line that is no JSON object is left out.
    """
    out = feed.select(*kept, F.from_json("value", schema, {"columnNameOfCorruptRecord": "_bad"}).alias("_r"), F.json_object_keys("value").isNotNull().alias("_ok"))
    out = out.where("_ok").select(*kept, "_r.*")
    out.createOrReplaceTempView(name)
    return out


def map_batches(run: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that skips empty batches."""
    def each(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            run(batch, batch_id)

    return each

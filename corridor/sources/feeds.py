"""Feed sources: JSON envelopes in a landing folder -> one row per record.

Each feed file is a JSON object whose records sit under one envelope key
(``data``, ``snapshots``, ``incidents``, ``plans``). The envelope is read
with a fixed schema ``<key> array<variant>``: no inference, and each
record's fields stay loosely typed (VARIANT) so the validators can tell a
JSON number from a JSON string. A file without the key yields no rows
(``posexplode`` of NULL), an empty batch rather than an error. A malformed
file (or line) yields one record without fields whose ``corrupt_record`` holds
the text: the validators reject it, so it reaches the quarantine.

The same reader serves batch (``spark.read``) and streaming
(``spark.readStream``) so a micro-batch is processed exactly like a batch.

Splitting: a multi-line JSON document is read by one task, which is right
for the usual landing file (one poll). A source that lands very large files
should write JSON Lines (one envelope per line, ``multi_line=False``): Spark
then splits each file across tasks, and the records of each envelope are
exploded where they are read, before any shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Feed:
    name: str
    envelope: str
    fields: tuple[str, ...]
    interval: str          # trigger interval of the periodic ingest
    ts: str = "timestamp"


# Feed envelopes, record fields and poll cadence.
FEEDS = {
    "traffic": Feed("traffic", "data", ("segment_id", "current_speed", "congestion_score", "timestamp"),
                    "5 minutes"),
    "weather": Feed("weather", "snapshots", ("latitude", "longitude", "temperature", "rain_intensity",
                                             "precipitation", "visibility", "timestamp"), "15 minutes"),
    "incidents": Feed("incidents", "incidents", ("incident_type", "description", "latitude", "longitude",
                                                 "severity", "status", "timestamp"), "10 minutes"),
    "construction": Feed("construction", "plans", ("description", "geometry_type", "coordinates", "status",
                                                   "start_date", "end_date"), "60 minutes"),
}


def envelope_schema(feed: Feed) -> str:
    return f"`{feed.envelope}` array<variant>, corrupt_record string"


def _envelopes(raw: DataFrame, feed: Feed) -> DataFrame:
    """Envelopes with the place they were read from."""
    return raw.select(
        F.when(F.col("corrupt_record").isNotNull(), F.expr("array(CAST(NULL AS VARIANT))"))
        .otherwise(F.col(feed.envelope)).alias("_records"), "corrupt_record",
        F.col("_metadata.file_modification_time").alias("file_time"), F.col("_metadata.file_name").alias("source_file"),
        F.col("_metadata.file_block_start").alias("_block"))


def explode_records(env: DataFrame, feed: Feed, multi_line: bool = True) -> DataFrame:
    """One row per record of the envelopes read by :func:`read_envelopes`.

    ``ordinal`` = (file time, file name, block, line, position) orders records of
    a batch the way they arrived, so keep-last dedupe does not depend on row
    order after a shuffle; several JSON Lines envelopes of one file stay
    apart by their line. ``pos`` (position in the envelope) is kept as a number
    and ``file_time`` as the base of per-record default timestamps. ``record_id``
    is a hash of file, position and content, the same on every replay; equal records of
    JSON Lines are numbered within their block of the file, and the hash takes block and number too.
    """
    line = F.lit(0).cast("long") if multi_line else F.monotonically_increasing_id()
    env = env.select("*", line.alias("_line"))
    rec = env.select(F.posexplode("_records").alias("pos", "_rec"), "corrupt_record", "file_time", "source_file",
                     "_block", "_line")
    told = F.coalesce(F.col("_rec").cast("string"), F.col("corrupt_record"))
    place = ["source_file", "pos", told]
    if not multi_line:
        # A block is one split of a file, so a group is never larger than one task's input.
        equal = Window.partitionBy("source_file", "_block", "pos", F.xxhash64(told))
        rec = rec.withColumn("_equal", F.row_number().over(equal.orderBy("_line")))
        place += ["_block", "_equal"]
    return rec.select(
        F.struct(F.col("file_time").alias("mtime"), F.col("source_file").alias("file"), F.col("_block").alias("block"),
                 F.col("_line").alias("line"), "pos").alias("ordinal"),
        F.col("pos").cast("long").alias("pos"), "source_file", "file_time", "corrupt_record",
        F.xxhash64(*place).alias("record_id"),
        *[F.try_variant_get(F.col("_rec"), f"$.{f}", "variant").alias(f) for f in feed.fields])


def _options(reader, feed: Feed, multi_line: bool):
    return (reader.schema(envelope_schema(feed)).option("multiLine", multi_line)
            .option("columnNameOfCorruptRecord", "corrupt_record"))


def read_feed(spark: SparkSession, path: str, feed: Feed | str, multi_line: bool = True) -> DataFrame:
    feed = FEEDS[feed] if isinstance(feed, str) else feed
    return explode_records(_envelopes(_options(spark.read, feed, multi_line).json(path), feed), feed, multi_line)


def read_envelope_stream(spark: SparkSession, path: str, feed: Feed | str, multi_line: bool = True,
                         max_files_per_trigger: int | None = None) -> DataFrame:
    """The landing folder as a stream of envelopes; a micro-batch explodes them with ``explode_records``."""
    feed = FEEDS[feed] if isinstance(feed, str) else feed
    r = _options(spark.readStream, feed, multi_line)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return _envelopes(r.json(path), feed)


def read_table(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """Stored table scan with a column list (pruned at the parquet reader)."""
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def lookup(df: DataFrame, key: str, value) -> DataFrame:
    """Point lookup by key; callers raise not-found on an empty result."""
    return df.filter(F.col(key) == F.lit(value))


def lookup_one(df: DataFrame, key: str, value):
    """The single row with ``key == value``; ``LookupError`` when absent."""
    rows = lookup(df, key, value).limit(2).collect()
    if not rows:
        raise LookupError(f"{key}={value} not found")
    return rows[0]


def missing_keys(requested: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """Batch form of the not-found check: requested keys absent from the table."""
    return requested.select(key).distinct().join(table.select(key), key, "left_anti")

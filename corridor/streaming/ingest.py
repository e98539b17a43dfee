"""Periodic feed ingest as Structured Streaming queries.

One ``StreamingQuery`` per feed, each with its own checkpoint, so one
feed's failure never stops another. Each micro-batch runs the same batch
function as a batch job (validate -> transform -> load) inside
``foreachBatch``. Writes are commits of the checkpoint's identity and the
micro-batch id: a batch that is replayed after a failure takes the place of its
own output, and a new checkpoint adds to what an old one wrote. No
watermark: late records are accepted and appended with their own time.
"""

from __future__ import annotations

import logging
import time
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from corridor.functions import fields as fl
from corridor.functions.normalize import ZONE_STATUSES
from corridor.operators import transform as tf
from corridor.operators import validate as vd
from corridor.sinks import tables
from corridor.sinks.commits import FAN, CommitTable
from corridor.sinks.files import Files
from corridor.sources.feeds import FEEDS, explode_records, read_envelope_stream
from corridor.streaming.kept import ReadingSummaries

log = logging.getLogger(__name__)

_KEEP = ("ordinal", "pos", "source_file", "record_id")


def _with_segment_check(batch: DataFrame, segments: DataFrame | None) -> DataFrame:
    """Mark records whose segment is in the parent table; the validator rejects the others."""
    if segments is None:
        return batch
    known = segments.select(F.col("segment_id").alias("_segment")).distinct().withColumn("segment_known", F.lit(True))
    marked = batch.withColumn("_segment", fl.as_long(batch, "segment_id")).join(known, "_segment", "left")
    # A segment id that is missing or no number has its own rule.
    return (marked.withColumn("segment_known", F.coalesce("segment_known", F.col("_segment").isNull()))
            .drop("_segment"))


def process_traffic(batch: DataFrame, batch_id: int, out: str, strict: bool = False,
                    segments: DataFrame | None = None, stream: str = "batch") -> dict:
    batch = _with_segment_check(batch, segments)
    batch = batch.withColumn("has_time", fl.present(batch, "timestamp"))
    valid, rejected = vd.validate_traffic(batch, ts="timestamp", keep=(*_KEEP, "has_time"))
    loaded = tf.transform_traffic(valid, ts="timestamp", has_time="has_time", keep=("record_id",))
    n = tables.load_traffic_readings(loaded, f"{out}/traffic_readings", batch_id, rejected=rejected, strict=strict,
                                     stream=stream)
    return {"loaded": n, "rejected": _quarantine(rejected, out, "traffic", batch_id, stream)}


def _quarantine(rejected: DataFrame, out: str, feed: str, batch_id: int, stream: str) -> int:
    """Rejected records with their reasons (the dead-letter table), as JSON text."""
    cols = [F.col(c).cast("string").alias(c) if c not in ("reason", "pos", "source_file") else F.col(c)
            for c in rejected.columns if c not in ("ordinal", "has_time", "segment_known")]
    return _commit(rejected.select(*cols), f"{out}/quarantine/{feed}", batch_id, stream)


def _commit(df: DataFrame, path: str, batch_id: int, stream: str) -> int:
    """Rows of a batch with their stream and number, in place of an earlier attempt's."""
    marked = df.withColumn("stream", F.lit(stream)).withColumn("batch_id", F.lit(int(batch_id)).cast("long"))
    return CommitTable(df.sparkSession, path).write(marked, batch_id, stream)


def process_weather(batch: DataFrame, batch_id: int, out: str, strict: bool = False, stream: str = "batch") -> dict:
    valid, rejected = vd.validate_weather(batch, ts="timestamp", keep=_KEEP)
    t = tf.transform_weather(valid, ts="timestamp", keep=["source_file", "pos", "record_id"])
    n = tables.load_weather_snapshots(t, f"{out}/weather_snapshots", batch_id, rejected=rejected, strict=strict,
                                      stream=stream)
    return {"loaded": n, "rejected": _quarantine(rejected, out, "weather", batch_id, stream)}


def process_incidents(batch: DataFrame, batch_id: int, out: str, strict: bool = False, stream: str = "batch") -> dict:
    valid, rejected = vd.validate_incident(batch, ts="timestamp", keep=_KEEP)
    t = tf.transform_incident(valid, ts="timestamp", keep=["source_file", "pos", "record_id"])
    n = tables.load_incidents(t, f"{out}/incidents", batch_id, rejected=rejected, strict=strict, stream=stream)
    return {"loaded": n, "rejected": _quarantine(rejected, out, "incidents", batch_id, stream)}


def process_construction(batch: DataFrame, batch_id: int, out: str, strict: bool = False, stream: str = "batch") -> dict:
    valid, rejected = vd.validate_construction(batch, keep=_KEEP, statuses=ZONE_STATUSES)
    t = tf.transform_construction(valid, keep=["source_file", "pos", "record_id"])
    n = tables.load_construction_zones(t, f"{out}/construction_zones", batch_id, rejected=rejected, strict=strict,
                                       stream=stream)
    return {"loaded": n, "rejected": _quarantine(rejected, out, "construction", batch_id, stream)}


PROCESSORS: dict[str, Callable[..., dict]] = {
    "traffic": process_traffic, "weather": process_weather,
    "incidents": process_incidents, "construction": process_construction,
}


TABLES = {"traffic": "traffic_readings", "weather": "weather_snapshots", "incidents": "incidents",
          "construction": "construction_zones"}


def write_ingest_log(spark: SparkSession, out: str, feed: str, batch_id: int, res: dict, stream: str = "batch") -> None:
    """One accounting row per micro-batch: received = loaded + deduped + rejected + parked.

    Each feed writes under its own ``ingest_log/feed=<name>`` folder; read
    ``ingest_log`` as one table partitioned by feed. A commit like the batch's other writes,
    so a replayed batch replaces its own row.
    """
    loaded, rejected, parked = int(res["loaded"]), int(res["rejected"]), int(res.get("parked", 0))
    received = int(res.get("received", loaded + rejected + parked))
    row = [(received, loaded, received - loaded - rejected - parked, rejected, parked)]
    log_row = spark.createDataFrame(row, "received long, loaded long, deduped long, rejected long, parked long")
    _commit(log_row.withColumn("logged_at", F.current_timestamp()), f"{out}/ingest_log/feed={feed}", batch_id, stream)


def park_batch(batch: DataFrame, out: str, feed: str, batch_id: int, stream: str = "batch") -> int:
    """Keep a batch that strict loading refused, whole and as text, for a later load."""
    text = [F.col(c).cast("string").alias(c) for c in batch.columns if c != "ordinal"]
    return _commit(batch.select(*text), f"{out}/parked/{feed}", batch_id, stream)


def keep_summaries(spark: SparkSession, out: str, batch_id: int, stream: str) -> None:
    """Summaries of the readings that the batch committed, read back from its own folder."""
    kept = ReadingSummaries(spark, out)
    folder = tables.committed(spark, f"{out}/traffic_readings", "traffic_readings").folder_of(batch_id, stream)
    if folder is None:
        kept.withdraw(batch_id, stream)
    else:
        kept.add(spark.read.parquet(folder), batch_id, stream)


def compact_tables(spark: SparkSession, out: str, feed: str, summaries: bool = True, fan: int = FAN,
                   grace: float = 24 * 3600.0) -> None:
    """Pack the feed's small commits and drop folders that were replaced over ``grace`` seconds ago."""
    for path, name in ((TABLES[feed], TABLES[feed]), (f"quarantine/{feed}", None), (f"ingest_log/feed={feed}", None)):
        table = tables.committed(spark, f"{out}/{path}", name) if name else CommitTable(spark, f"{out}/{path}")
        table.compact(fan=fan)
        table.vacuum(grace)
    if feed == "traffic" and summaries:
        kept = ReadingSummaries(spark, out)
        kept.compact(fan)
        for part in (kept.latest, kept.cells):
            part.table.vacuum(grace)


def stream_identity(spark: SparkSession, checkpoint: str) -> str:
    """The name of a checkpoint as a source of batches, kept with it: a new checkpoint gets a new one."""
    files = Files(spark, checkpoint)
    if not files.exists("corridor-stream"):
        files.put("corridor-stream", uuid.uuid4().hex)
    return files.read("corridor-stream").strip()


def batch_function(feed: str, out: str, strict: bool = False, segments_path: str | None = None,
                   multi_line: bool = True, stream: str = "batch", summaries: bool = True, compact_every: int = 0):
    """The ``foreachBatch`` callback: explode and persist the micro-batch once, then load.

    A batch that strict loading refuses is parked, so it does not fail again on
    every restart. ``segments_path`` names the parent table of the readings' foreign key.
    ``summaries`` keeps the latest readings and the hourly cells next to the readings;
    ``compact_every`` batches the feed's tables are compacted.
    """
    proc = PROCESSORS[feed]

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        extra = {"segments": spark.read.parquet(segments_path)} if segments_path and feed == "traffic" else {}
        records = explode_records(batch, FEEDS[feed], multi_line).persist()
        try:
            # What an earlier attempt with the other outcome wrote is taken back.
            try:
                res = proc(records, batch_id, out, strict=strict, stream=stream, **extra)
                CommitTable(spark, f"{out}/parked/{feed}").withdraw(batch_id, stream)
                if feed == "traffic" and summaries:
                    keep_summaries(spark, out, batch_id, stream)
            except tables.BatchRejected:
                log.exception("feed %s batch %s parked", feed, batch_id)
                res = {"loaded": 0, "rejected": 0, "parked": park_batch(records, out, feed, batch_id, stream)}
                for path in (TABLES[feed], f"quarantine/{feed}"):
                    CommitTable(spark, f"{out}/{path}").withdraw(batch_id, stream)
                if feed == "traffic" and summaries:
                    ReadingSummaries(spark, out).withdraw(batch_id, stream)
            if compact_every and batch_id % compact_every == compact_every - 1:
                compact_tables(spark, out, feed, summaries)
            write_ingest_log(spark, out, feed, batch_id, {**res, "received": records.count()}, stream)
            log.info("feed %s batch %s: %s", feed, batch_id, res)
        finally:
            records.unpersist()
    return run


def start_feed(spark: SparkSession, feed: str, landing: str, out: str, checkpoint: str,
               available_now: bool = False, strict: bool = False, max_files_per_trigger: int | None = None,
               segments_path: str | None = None, multi_line: bool = True, summaries: bool = True,
               compact_every: int = 96) -> StreamingQuery:
    """Start one feed's ingest; ``available_now`` processes what is there and stops.

    ``max_files_per_trigger`` bounds a micro-batch when a backlog of landing
    files has built up (``availableNow`` still drains it, in several batches);
    ``multi_line=False`` reads JSON Lines, one envelope per line. Every ``compact_every``
    batches the feed's tables are compacted (0: never).
    """
    spec = FEEDS[feed]
    envelopes = read_envelope_stream(spark, landing, spec, multi_line, max_files_per_trigger)
    identity = stream_identity(spark, checkpoint)
    w = (envelopes.writeStream.queryName(f"ingest_{feed}")
         .option("checkpointLocation", checkpoint)
         .foreachBatch(batch_function(feed, out, strict, segments_path, multi_line, identity, summaries, compact_every)))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=spec.interval)
    return w.start()


def start_all(spark: SparkSession, landing_root: str, out: str, checkpoint_root: str,
              available_now: bool = False, **options) -> dict[str, StreamingQuery]:
    """All four feeds, independent queries; a feed that fails to start is logged."""
    queries = {}
    for name in FEEDS:
        try:
            queries[name] = start_feed(spark, name, f"{landing_root}/{name}", out,
                                       f"{checkpoint_root}/{name}", available_now, **options)
        except Exception:  # noqa: BLE001 - isolation: other feeds keep running
            log.exception("feed %s failed to start", name)
    return queries


def supervise(start: Callable[[str], StreamingQuery], feeds: Sequence[str] = tuple(FEEDS), max_restarts: int = 5,
              pause: float = 5.0) -> dict[str, str | None]:
    """Run all feeds until each ends; a feed that fails is started again, the others go on.

    Returns the last error of every feed, None for one that ended well. A
    restarted feed goes on from its checkpoint; after ``max_restarts`` failures it
    is given up.
    """
    queries: dict[str, StreamingQuery | None] = {}
    failures = dict.fromkeys(feeds, 0)
    outcome: dict[str, str | None] = {}

    def launch(name: str) -> None:
        try:
            queries[name] = start(name)
        except Exception as e:  # noqa: BLE001 - counted like any other failure
            queries[name], outcome[name] = None, str(e)

    for name in feeds:
        launch(name)
    while queries:
        for name, q in list(queries.items()):
            error = outcome.get(name)
            if q is not None:
                try:
                    if not q.awaitTermination(0.5):
                        continue
                    error = None
                except Exception as e:  # noqa: BLE001 - the feed's own failure
                    error = str(e)
            if error is None:
                outcome[name] = None
                del queries[name]
                continue
            outcome[name] = error
            failures[name] += 1
            log.error("feed %s failed (%s of %s): %s", name, failures[name], max_restarts, error)
            if failures[name] > max_restarts:
                del queries[name]
            else:
                time.sleep(pause)
                launch(name)
    return outcome


def main(argv: list[str] | None = None) -> int:
    """Run all feed ingests: ``python -m corridor.streaming.ingest LANDING OUT CHECKPOINTS``.

    Periodic by default (each feed at its own cadence, until stopped);
    ``--available-now`` drains what has landed and exits. A feed that fails is
    restarted, the others go on. Exit code 1 when a feed was given up.
    """
    import argparse

    from corridor.session import get_session
    p = argparse.ArgumentParser(prog="corridor.streaming.ingest")
    p.add_argument("landing", help="folder with one sub-folder per feed")
    p.add_argument("out", help="folder for the tables")
    p.add_argument("checkpoints", help="folder for the per-feed streaming checkpoints")
    p.add_argument("--available-now", action="store_true")
    p.add_argument("--max-files-per-trigger", type=int, default=None)
    p.add_argument("--segments", default=None, help="road segment table: readings of other segments are rejected")
    p.add_argument("--json-lines", action="store_true", help="landing files hold one envelope per line")
    p.add_argument("--strict", action="store_true", help="park a batch that has any rejected record")
    p.add_argument("--max-restarts", type=int, default=5)
    a = p.parse_args(argv)
    spark = get_session()

    def start(name: str) -> StreamingQuery:
        return start_feed(spark, name, f"{a.landing}/{name}", a.out, f"{a.checkpoints}/{name}",
                          available_now=a.available_now, strict=a.strict,
                          max_files_per_trigger=a.max_files_per_trigger, segments_path=a.segments,
                          multi_line=not a.json_lines)

    outcome = supervise(start, max_restarts=a.max_restarts)
    return 1 if any(outcome.values()) else 0


if __name__ == "__main__":
    raise SystemExit(main())

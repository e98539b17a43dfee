"""Keyed tables that are rewritten in place: versions over hash buckets of the key.

A version is one manifest that names the folders of every bucket; the one with the
highest number is the table. A merge reads and rewrites only the buckets its batch has keys in, writes them
to a folder of its own and puts the next manifest in place in one step: a
reader sees the old table or the new one, and one that has begun goes on with the
folders it planned, which stay until ``vacuum``. So a table can be merged with a
frame read from itself. Of two writers that start from one version the second
gets ``ConcurrentChange``.

``insert`` enforces UNIQUE: a batch probes the stored keys of its own buckets only (their
key column, nothing else) and adds folders to them without rewriting any.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corridor.operators.segments import upsert
from corridor.sinks.commits import ConcurrentChange
from corridor.sinks.files import Files
from corridor.sinks.tables import upsert_touch

BUCKETS = 64            # of a new table; at 100 TB choose so that a bucket is some GB
_LOG = "_versions"
_BUCKET, _VERSION = "bucket", "version"


class KeyIsNull(ValueError):
    """Rows without a key cannot be stored in a keyed table."""


class VersionedTable:
    """The table at ``path`` with unique key ``key``; ``buckets`` counts when it is created."""

    def __init__(self, spark: SparkSession, path: str, key: str, buckets: int = BUCKETS):
        self.spark, self.path, self.key, self.buckets = spark, path.rstrip("/"), key, buckets
        self.files = Files(spark, self.path)

    def version(self) -> int:
        """The newest version; 0 before the first."""
        return max((int(n[:-5]) for n in self.files.names(f"{_LOG}/*.json")), default=0)

    def manifest(self, version: int | None = None) -> dict:
        version = version or self.version()
        if not version:
            raise LookupError(f"{self.path} has no version")
        return json.loads(self.files.read(f"{_LOG}/{version:012d}.json"))

    def read(self, version: int | None = None) -> DataFrame:
        return self._frame(self.manifest(version))

    def _frame(self, m: dict, only: set[int] | None = None, columns: list[str] | None = None) -> DataFrame:
        schema = T.StructType.fromJson(m["schema"])
        folders = [f for b, some in m["buckets"].items() if only is None or int(b) in only for f in some]
        if not folders:
            df = self.spark.createDataFrame([], schema)
        else:
            stored = T.StructType([*schema.fields, T.StructField(_VERSION, T.StringType()), T.StructField(_BUCKET, T.IntegerType())])
            df = self.spark.read.schema(stored).option("basePath", self.path).parquet(*[f"{self.path}/{f}" for f in folders])
        return df.select(*[F.col(f"`{c}`") for c in columns or schema.names])

    def _bucket(self, buckets: int) -> Column:
        return F.pmod(F.xxhash64(F.col(f"`{self.key}`")), F.lit(buckets)).cast("int")

    def _write(self, df: DataFrame, version: int, buckets: int) -> dict[str, list[str]]:
        """Write rows by bucket to a new folder; returns the folder of every bucket that got some."""
        folder = f"{_VERSION}={version}~{uuid.uuid4().hex[:12]}"
        dealt = df.withColumn(_BUCKET, self._bucket(buckets)).hint("rebalance", _BUCKET)
        dealt.sortWithinPartitions(_BUCKET, self.key).write.partitionBy(_BUCKET).parquet(f"{self.path}/{folder}")
        return {n[len(_BUCKET) + 1:]: [f"{folder}/{n}"] for n in self.files.names(f"{folder}/{_BUCKET}=*")}

    def _publish(self, m: dict) -> int:
        if not self.files.put(f"{_LOG}/{m['version']:012d}.json", json.dumps(m)):
            raise ConcurrentChange(f"{self.path}: version {m['version']} was made by another writer")
        return m["version"]

    def _touched(self, df: DataFrame, buckets: int) -> set[int]:
        """Buckets in which the frame has keys: at most as many small numbers as there are buckets."""
        found = df.groupBy(self._bucket(buckets).alias("b")).agg(F.count_if(F.col(f"`{self.key}`").isNull()).alias("nulls")).collect()
        if any(r.nulls for r in found):
            raise KeyIsNull(f"{self.path}: rows without {self.key}")
        return {r.b for r in found}

    def reload(self, df: DataFrame) -> int:
        """Replace the whole table (it is created where there is none); returns the new version."""
        last = self.version()
        buckets = self.manifest(last)["n_buckets"] if last else self.buckets
        self._touched(df, buckets)
        return self._publish({"version": last + 1, "n_buckets": buckets, "schema": df.schema.jsonValue(),
                              "buckets": self._write(df, last + 1, buckets)})

    def merge(self, incoming: DataFrame, combine: Callable[[DataFrame, DataFrame], DataFrame]) -> int:
        """Replace the buckets that ``incoming`` has keys in by ``combine(their rows, incoming)``.

        ``combine`` must keep each key in its bucket, that is, not change keys.
        """
        m = self.manifest()
        touched = self._touched(incoming, m["n_buckets"])
        if not touched:
            return m["version"]
        schema = T.StructType.fromJson(m["schema"])
        rows = combine(self._frame(m, touched), incoming).select(*[F.col(f"`{c}`").cast(schema[c].dataType).alias(c) for c in schema.names])
        new = self._write(rows, m["version"] + 1, m["n_buckets"])
        kept = {b: f for b, f in m["buckets"].items() if int(b) not in touched}
        return self._publish({**m, "version": m["version"] + 1, "buckets": {**kept, **new}})

    def upsert(self, incoming: DataFrame, id_col: str = "segment_id", ordinal: str | None = "ordinal") -> int:
        """Insert or update by key, as ``operators.segments.upsert``."""
        return self.merge(incoming, lambda base, new: upsert(base, new, self.key, id_col, ordinal))

    def upsert_touch(self, incoming: DataFrame, touch: str = "updated_at", now: Column | None = None, **options) -> int:
        """Insert or update by key; an updated row is stamped, as ``tables.upsert_touch``."""
        return self.merge(incoming, lambda base, new: upsert_touch(base, new, self.key, touch, now=now, **options))

    def delete(self, keys: DataFrame) -> int:
        """Delete the rows whose key is among ``keys``."""
        return self.merge(keys, lambda base, gone: base.join(gone.select(self.key), self.key, "left_anti"))

    def insert(self, incoming: DataFrame, ordinal: str = "ordinal") -> tuple[int, DataFrame]:
        """Add rows with new keys; returns the version and the rejected rows with their ``reason``.

        Of rows of the batch with one key the one of the smallest ``ordinal`` counts. A stored key is
        looked for in its own bucket only.
        """
        m = self.manifest()
        touched = self._touched(incoming, m["n_buckets"])
        if not touched:
            return m["version"], incoming.limit(0).withColumn("reason", F.lit(""))
        stored = self._frame(m, touched, [self.key]).withColumn("_stored", F.lit(True))
        first = F.row_number().over(Window.partitionBy(self.key).orderBy(ordinal))
        told = (incoming.withColumn("_nth", first).join(stored, self.key, "left")
                .withColumn("reason", F.when(F.col("_stored"), f"{self.key}_stored").when(F.col("_nth") > 1, f"{self.key}_repeated")))
        schema = T.StructType.fromJson(m["schema"])
        fresh = told.where("reason IS NULL").select(*[F.col(f"`{c}`").cast(schema[c].dataType).alias(c) for c in schema.names])
        buckets = dict(m["buckets"])
        for b, folders in self._write(fresh, m["version"] + 1, m["n_buckets"]).items():
            buckets[b] = buckets.get(b, []) + folders
        version = self._publish({**m, "version": m["version"] + 1, "buckets": buckets})
        return version, told.where("reason IS NOT NULL").select(*incoming.columns, "reason")

    def vacuum(self, keep: int = 2, grace: float = 24 * 3600.0) -> int:
        """Forget all but the newest ``keep`` versions; delete folders of no version last written over ``grace`` s ago."""
        numbers = sorted(int(n[:-5]) for n in self.files.names(f"{_LOG}/*.json"))
        for v in numbers[:-keep]:
            self.files.delete(f"{_LOG}/{v:012d}.json")
        used = {f.split("/")[0] for v in numbers[-keep:] for some in self.manifest(v)["buckets"].values() for f in some}
        now, n = time.time(), 0
        for folder in self.files.names(f"{_VERSION}=*"):
            if folder not in used and self.files.age(folder, now) >= grace:
                self.files.delete(folder)
                n += 1
        return n

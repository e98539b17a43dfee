"""Tables made of commits: a Parquet folder and one small manifest per (stream, batch).

A commit is known by its stream and its batch number. A stream is one
checkpoint's identity (``streaming.ingest.stream_identity``), so a new
checkpoint, whose batches start at 0 again, never meets the commits of an old one.
Each attempt writes a folder of its own and becomes visible when its manifest is
put in place in one step; a replay puts its manifest over that of the earlier attempt,
whose files are dropped, so nothing of it stays, also for days or reasons the replay
does not write.

``compact`` packs many small commits into one folder, sorted and with a file per
day, and puts one manifest in place that covers them. It leaves the last commit of each stream
alone, the only one that may be replayed, so ingest goes on meanwhile. Packs are
packed again by tiers, so a row is rewritten a logarithmic number of times. With
``fold`` the rows of the packed commits are merged to fewer, which is what the tables
in ``streaming.kept`` are built on. Folders that no manifest names are kept for readers that have
begun until ``vacuum``.

``CommitTable.read`` follows the manifests. Reading the folder as plain Parquet
gives the same rows as long as no attempt has failed and nothing was compacted.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Sequence
from datetime import date
from urllib.parse import quote

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corridor.sinks.files import Files

FAN = 8                 # commits, or packs of one tier, that are packed together
_LOG = "_commits"
_ONCE = "once"


class AlreadyPacked(RuntimeError):
    """A commit that compaction has merged with others can no longer be replaced."""


class ConcurrentChange(RuntimeError):
    """Another writer changed the table first; nothing was changed by this one."""


def arranged(df: DataFrame, days: bool, sort: Sequence[str] = ()) -> DataFrame:
    """One task (or several, where a day is large) writes a day; sorted, so that row groups have narrow ranges."""
    if days:
        return df.hint("rebalance", "dt").sortWithinPartitions("dt", *sort)
    return df.sortWithinPartitions(*sort) if sort else df


class CommitTable:
    """A table at ``path``; with ``days`` it is partitioned by its column ``dt``, within which rows are sorted by ``sort``."""

    def __init__(self, spark: SparkSession, path: str, days: bool = False, sort: Sequence[str] = ()):
        self.spark, self.path, self.days, self.sort = spark, path.rstrip("/"), days, tuple(sort)
        self.files = Files(spark, self.path)

    def manifests(self) -> list[dict]:
        """Manifests of the commits and packs that make up the table."""
        every = [json.loads(self.files.read(f"{_LOG}/{n}")) for n in sorted(self.files.names(f"{_LOG}/*.json"))]
        packs = [m for m in every if m["kind"] == "pack"]
        gone = {name for p in packs for name in p["packs"]}
        single = {name for p in packs for name in p["once"]}
        return [m for m in every if (
            m["name"] not in gone if m["kind"] == "pack" else m["name"] not in single and not _covered(packs, m))]

    def _write(self, df: DataFrame, name: str) -> dict:
        """Write rows to a folder of their own: the manifest's part that tells what is in it."""
        sort = [c for c in self.sort if c in df.columns]
        out = arranged(df, self.days, sort)
        obs = Observation(f"commit-{uuid.uuid4().hex}")
        folder = f"commit={name}~{uuid.uuid4().hex[:12]}"
        writer = out.observe(obs, F.count(F.lit(1)).alias("rows")).write
        (writer.partitionBy("dt") if self.days else writer).parquet(f"{self.path}/{folder}")
        rows = int(obs.get.get("rows", 0) or 0)
        days = sorted(n[3:] for n in self.files.names(f"{folder}/dt=*")) if self.days else []
        if not rows:
            self.files.delete(folder)
        return {"folder": folder if rows else None, "rows": rows, "days": days, "schema": df.schema.json()}

    def write(self, df: DataFrame, batch: int | None = None, stream: str = "batch") -> int:
        """Commit the rows as batch ``batch`` of ``stream``, in place of any earlier attempt; returns their number.

        Without a batch number the rows are added once more on every call.
        """
        if batch is None:
            name = f"{_ONCE}~{uuid.uuid4().hex}"
            m = {"kind": "commit", "name": name, "stream": None, "batch": 0}
            before = None
        else:
            name = f"{quote(stream, safe='')}~{int(batch)}"
            m = {"kind": "commit", "name": name, "stream": stream, "batch": int(batch)}
            if _covered([json.loads(self.files.read(f"{_LOG}/{n}")) for n in self.files.names(f"{_LOG}/pack~*.json")], m):
                raise AlreadyPacked(f"{self.path}: batch {batch} of {stream} has been compacted")
            before = json.loads(self.files.read(f"{_LOG}/{name}.json")) if self.files.exists(f"{_LOG}/{name}.json") else None
            for left in self.files.names(f"commit={name}~*"):
                if before is None or left != before["folder"]:
                    self.files.delete(left)         # of an attempt that never became visible
        m |= self._write(df, name)
        if m["folder"] or before:
            self.files.put(f"{_LOG}/{name}.json", json.dumps(m), replace=True)
        if before and before["folder"]:
            self.files.delete(before["folder"])
        return m["rows"]

    def withdraw(self, batch: int, stream: str = "batch") -> bool:
        """Take a commit back, where an earlier attempt of the batch made one."""
        name = f"{quote(stream, safe='')}~{int(batch)}"
        if not self.files.exists(f"{_LOG}/{name}.json"):
            return False
        folder = json.loads(self.files.read(f"{_LOG}/{name}.json"))["folder"]
        self.files.delete(f"{_LOG}/{name}.json")
        if folder:
            self.files.delete(folder)
        return True

    def folder_of(self, batch: int, stream: str = "batch") -> str | None:
        """Where the rows of a commit are, if it has any."""
        name = f"{_LOG}/{quote(stream, safe='')}~{int(batch)}.json"
        folder = json.loads(self.files.read(name))["folder"] if self.files.exists(name) else None
        return folder and f"{self.path}/{folder}"

    def read(self, first_day: date | None = None, last_day: date | None = None) -> DataFrame:
        """The committed rows; a range of days opens only folders that have some of them."""
        return self._frame(self.manifests(), first_day, last_day)

    def _frame(self, live: list[dict], first_day: date | None = None, last_day: date | None = None) -> DataFrame:
        if not live:
            raise LookupError(f"{self.path} has no commits")
        schema = T.StructType.fromJson(json.loads(live[-1]["schema"]))
        low, high = (str(d) if d else None for d in (first_day, last_day))
        some = [m for m in live if m["folder"] and (not (low or high) or any(
            (not low or d >= low) and (not high or d <= high) for d in m["days"]))]
        if not some:
            return self.spark.createDataFrame([], schema)
        # The schema is known, so no footer is read to plan; basePath gives the partition columns their names.
        found = self.spark.read.schema(T.StructType([*schema.fields, T.StructField("commit", T.StringType())]))
        df = found.option("basePath", self.path).parquet(*[f"{self.path}/{m['folder']}" for m in some])
        df = df.select(*[F.col(f"`{c}`") for c in schema.names])
        if low:
            df = df.where(F.col("dt") >= F.lit(first_day))
        return df.where(F.col("dt") <= F.lit(last_day)) if high else df

    def compact(self, fold: Callable[[DataFrame], DataFrame] | None = None, fan: int = FAN) -> int:
        """Pack commits that cannot be replayed, then packs by tier; returns the number of folders packed."""
        live, packed = self.manifests(), 0
        last: dict = {}
        for m in live:
            if m["kind"] == "commit" and m["stream"] is not None:
                last[m["stream"]] = max(m["batch"], last.get(m["stream"], m["batch"]))
        done = [m for m in live if m["kind"] == "commit" and (m["stream"] is None or m["batch"] < last[m["stream"]])]
        tier = 0
        while len(done) >= fan:
            self._pack(done, tier, fold)
            packed += len(done)
            done = [m for m in self.manifests() if m["kind"] == "pack" and m["tier"] == tier]
            tier += 1
        return packed

    def _pack(self, parts: list[dict], tier: int, fold: Callable[[DataFrame], DataFrame] | None) -> None:
        numbers = [int(n[5:-5]) for n in self.files.names(f"{_LOG}/pack~*.json")]
        name = f"pack~{max(numbers, default=0) + 1:012d}"
        covers: dict[str, list[int]] = {}
        for m in parts:
            ranges = m["covers"] if m["kind"] == "pack" else {m["stream"]: [m["batch"]] * 2} if m["stream"] is not None else {}
            for stream, (low, high) in ranges.items():
                old = covers.get(stream, [low, high])
                covers[stream] = [min(old[0], low), max(old[1], high)]
        rows = self._frame(parts)
        manifest = {"kind": "pack", "name": name, "tier": tier, "covers": covers,
                    "once": [m["name"] for m in parts if m["kind"] == "commit" and m["stream"] is None],
                    "packs": [m["name"] for m in parts if m["kind"] == "pack"],
                    **self._write(fold(rows) if fold else rows, name)}
        # The number is taken once: of two writers that packed the same folders, the second changes nothing.
        if not self.files.put(f"{_LOG}/{name}.json", json.dumps(manifest)):
            if manifest["folder"]:
                self.files.delete(manifest["folder"])
            raise ConcurrentChange(f"{self.path} was compacted by another writer")
        for m in parts:
            self.files.delete(f"{_LOG}/{m['name']}.json")

    def vacuum(self, grace: float = 24 * 3600.0) -> int:
        """Delete folders that no manifest names and that were last written over ``grace`` seconds ago."""
        used, now, n = {m["folder"] for m in self.manifests()}, time.time(), 0
        for folder in self.files.names("commit=*"):
            if folder not in used and self.files.age(folder, now) >= grace:
                self.files.delete(folder)
                n += 1
        return n


def _covered(packs: list[dict], m: dict) -> bool:
    """Whether a pack holds the commit; a stream's commits are packed in rising order, so ranges are enough."""
    return any(low <= m["batch"] <= high for p in packs for low, high in [p["covers"].get(m["stream"], (0, -1))])

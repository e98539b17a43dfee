"""WARC archives of pages, read back through an index merged from sorted runs.

Writing: every page is a WARC/1.1 record. Of pages with equal payloads of at least
``MIN_REVISIT`` bytes the one with the smallest id is the response and the
others are revisits that refer to it. Spark's text writer puts the records into
archive files (its line separator is the last line end of a record), so writing
is committed per task on whatever storage the path names.

Reading: each archive is parsed by its headers and lengths into captures, and
its captures, sorted by URL key and timestamp, form one run. Boundaries from a
bounded sample of the runs cut the key space; the slices of all runs between two
boundaries meet in one task, where a loser tree merges them. A URL with very
many captures is cut by timestamp as well.

Defined results: null HTML is an empty payload; a null url is an empty target; a
page with a null id is written as a response unless a page with an id has its
payload, and is read back with a null id; repeated rows of one id are equal
captures; an empty table gives an empty result.
"""

from __future__ import annotations

import bisect
import hashlib
from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corridor.llm.storage import materialise, scratch_path, small_side

MIN_REVISIT = 100
ARCHIVE_BYTES = 16 << 20       # aimed at per archive file; a task's input bounds it in any case
EPOCH = "2024-01-01 00:00:00"  # capture time of page 0 where no column gives one; one second per id
RANGE_ROWS, MAX_RANGES = 20_000, 10_000
SAMPLE_PER_RANGE = 20

_CRLF = "\r\n"
CAPTURE = ("url_key string, captured string, page_id long, record_type string, refers_to long, "
           "payload_bytes long, payload_digest string, archive string, offset long, length long")
_FIELDS = [c.split()[0] for c in CAPTURE.split(", ")]
_ARROW = pa.schema([(n, pa.int64() if t == "long" else pa.string())
                    for n, t in (c.split() for c in CAPTURE.split(", "))])


def plan_records(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html",
                 captured: str | None = None) -> DataFrame:
    """Pages with their digest, size, time, record type and the page a revisit refers to."""
    default = F.timestamp_add("SECOND", F.pmod(F.coalesce(F.col(page_id), F.lit(0)), F.lit(1_000_000_000)),
                              F.lit(EPOCH).cast("timestamp"))
    p = pages.select(F.col(page_id).cast("long").alias("page_id"), F.coalesce(F.col(url), F.lit("")).alias("url"),
                     F.coalesce(F.col(html), F.lit("")).alias("html"),
                     F.date_format(F.col(captured) if captured else default, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("captured"))
    p = p.withColumns({"digest": F.sha2("html", 256), "bytes": F.octet_length("html").cast("long")})
    firsts = (p.where(F.col("bytes") >= MIN_REVISIT).groupBy(F.col("digest").alias("d"))
              .agg(F.min("page_id").alias("first"), F.count("*").alias("copies")).where("copies > 1").select("d", "first"))
    firsts = materialise(firsts, "firsts")
    p = p.join(small_side(firsts, firsts.count()), F.col("digest") == F.col("d"), "left")
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return p.select("page_id", "url", "html", "captured", "digest", "bytes",
                    F.when(revisit, "revisit").otherwise("response").alias("record_type"),
                    F.when(revisit, F.col("first")).alias("refers_to"))


def record_text(planned: DataFrame) -> DataFrame:
    """One column ``value``: the WARC record without its last line end."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("null"))
    line = lambda name, *value: F.concat(F.lit(f"{name}: "), *value, F.lit(_CRLF))
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{_CRLF}Content-Type: text/html; charset=utf-8{_CRLF}Content-Length: "),
                    F.col("bytes").cast("string"), F.lit(_CRLF * 2))
    is_revisit = F.col("record_type") == "revisit"
    block_bytes = F.octet_length(http) + F.when(is_revisit, 0).otherwise(F.col("bytes"))
    # White space and control characters cannot stand in a header line.
    uri = F.regexp_replace(F.regexp_replace("url", "%", "%25"), r"[\x00-\x20\x7F]", "%20")
    return planned.select(F.concat(
        F.lit(f"WARC/1.1{_CRLF}"), line("WARC-Type", F.col("record_type")),
        line("WARC-Record-ID", F.lit("<urn:page:"), text("page_id"), F.lit(">")),
        line("WARC-Date", F.col("captured")), line("WARC-Target-URI", uri),
        line("WARC-Payload-Digest", F.lit("sha256:"), F.col("digest")),
        F.when(is_revisit, F.concat(
            line("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
            line("WARC-Refers-To", F.lit("<urn:page:"), text("refers_to"), F.lit(">")))).otherwise(""),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", block_bytes.cast("string")), F.lit(_CRLF), http,
        F.when(is_revisit, "").otherwise(F.col("html")), F.lit(_CRLF)).alias("value"))


def write_archives(planned: DataFrame, path: str) -> None:
    """Write the records to archive files of about ARCHIVE_BYTES under ``path``."""
    mean = planned.agg(F.avg("bytes")).first()[0] or 0
    per_file = max(1, int(ARCHIVE_BYTES / (mean + 600)))
    (record_text(planned).write.option("lineSep", _CRLF).option("maxRecordsPerFile", per_file).text(path))


def url_key(url: str) -> str:
    """Sort-friendly URL: host labels reversed, then port, path and query; scheme and fragment left out."""
    try:
        u = urlsplit(url)
        host, port = u.hostname or "", u.port
    except ValueError:
        return url
    if not host:
        return url
    tail = (u.path or "/") + (f"?{u.query}" if u.query else "")
    return ",".join(reversed(host.split("."))) + (f":{port}" if port else "") + ")" + tail


def parse_archive(content: bytes) -> Iterator[tuple[dict[str, str], int, int, bytes]]:
    """(headers, offset, length, block) of each record, by the declared lengths."""
    at = 0
    while at < len(content):
        cut = content.index(b"\r\n\r\n", at)
        lines = content[at:cut].decode("utf-8").split(_CRLF)
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no record at byte {at}")
        headers = {k.lower(): v for k, _, v in (x.partition(": ") for x in lines[1:])}
        start = cut + 4
        end = start + int(headers["content-length"])
        if content[end:end + 4] != b"\r\n\r\n":
            raise ValueError(f"record at byte {at} does not end where its length says")
        yield headers, at, end + 4 - at, content[start:end]
        at = end + 4


def _page(urn: str | None) -> int | None:
    digits = urn[len("<urn:page:"):-1] if urn else "null"
    return None if digits == "null" else int(digits)


def captures_of(archive: str, content: bytes) -> list[tuple]:
    """The sorted run of one archive; payloads of responses are digested again."""
    run = []
    for h, offset, length, block in parse_archive(content):
        head, _, payload = block.partition(b"\r\n\r\n")
        declared = h["warc-payload-digest"].removeprefix("sha256:")
        size = int(head.rpartition(b"Content-Length: ")[2])
        if h["warc-type"] == "response":
            digest = hashlib.sha256(payload).hexdigest()
            if digest != declared or len(payload) != size:
                raise ValueError(f"{archive}: payload at byte {offset} does not match its digest")
        uri = h["warc-target-uri"].replace("%25", "%")
        run.append((url_key(uri), h["warc-date"], _page(h["warc-record-id"]), h["warc-type"],
                    _page(h.get("warc-refers-to")), size, declared, archive, offset, length))
    return sorted(run, key=_order)


def _order(c: tuple) -> tuple:
    """URL key, timestamp, page id (null first), archive, offset."""
    return c[0], c[1], -1 if c[2] is None else c[2], c[7], c[8]


def read_runs(archives: DataFrame) -> DataFrame:
    """Captures of all archives (path, content), each archive's in key order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, content in zip(b.column(0), b.column(1)):
                rows = captures_of(path.as_py().rpartition("/")[2], content.as_py())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * len(_FIELDS), _ARROW.types)],
                    schema=_ARROW)

    return archives.select("path", "content").mapInArrow(run, CAPTURE)


class LoserTree:
    """k-way merge of sorted lists: an inner node keeps the loser of its match, the winner goes up."""

    def __init__(self, runs: list[list]):
        self.runs = runs
        self.at = [0] * len(runs)
        self.k = max(1, len(runs))
        self.losers = [-1] * self.k
        self.winner = self._play(1) if runs else -1

    def _beats(self, a: int, b: int) -> bool:
        if b < 0 or self.at[b] >= len(self.runs[b]):
            return True
        if a < 0 or self.at[a] >= len(self.runs[a]):
            return False
        return self.runs[a][self.at[a]] <= self.runs[b][self.at[b]]

    def _play(self, node: int) -> int:
        if node >= self.k:
            return node - self.k
        a, b = self._play(2 * node), self._play(2 * node + 1)
        won, lost = (a, b) if self._beats(a, b) else (b, a)
        self.losers[node] = lost
        return won

    def __iter__(self) -> Iterator:
        while self.winner >= 0 and self.at[self.winner] < len(self.runs[self.winner]):
            won = self.winner
            yield self.runs[won][self.at[won]]
            self.at[won] += 1
            node = (won + self.k) // 2
            while node:
                if not self._beats(won, self.losers[node]):
                    won, self.losers[node] = self.losers[node], won
                node //= 2
            self.winner = won


def merge_index(runs: DataFrame) -> DataFrame:
    """Captures in global order: range_no and place (within the range) number the capture histories."""
    n = runs.count()
    ranges = max(1, min(MAX_RANGES, -(-n // RANGE_ROWS)))
    share = min(1.0, ranges * SAMPLE_PER_RANGE / max(1, n))
    bounds: list[tuple] = []
    if ranges > 1:
        picked = runs.where(F.pmod(F.xxhash64("archive", "offset"), F.lit(1_000_003)) < int(share * 1_000_003) + 1)
        keys = sorted(_order(r) for r in picked.select(*_FIELDS).toLocalIterator())
        bounds = [keys[i * len(keys) // ranges] for i in range(1, ranges)] if keys else []
    shared = runs.sparkSession.sparkContext.broadcast(bounds)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = zip(*(c.to_pylist() for c in b.columns))
            numbers = [bisect.bisect_right(shared.value, _order(r)) for r in rows]
            yield pa.RecordBatch.from_arrays([pa.array(numbers, pa.int64()), *b.columns], ["range_no", *_FIELDS])

    def merge(key: tuple, t: pa.Table) -> pa.Table:
        by_run: dict[str, list] = {}
        for r in zip(*(t.column(c).to_pylist() for c in _FIELDS)):
            by_run.setdefault(r[7], []).append((_order(r), r))
        # A slice arrives in its run's order or nearly so; sorting it restores the run.
        lists = [sorted(x, key=lambda y: y[0]) for _, x in sorted(by_run.items())]
        rows = [r for _, r in LoserTree(lists)]
        return pa.table([pa.array([key[0].as_py()] * len(rows), pa.int64()), pa.array(range(len(rows)), pa.int64()),
                         *(pa.array(c, ty) for c, ty in zip(zip(*rows), _ARROW.types))],
                        names=["range_no", "place", *_FIELDS])

    return (runs.select(*_FIELDS).mapInArrow(cut, f"range_no long, {CAPTURE}")
            .groupBy("range_no").applyInArrow(merge, f"range_no long, place long, {CAPTURE}"))


def round_trip(pages: DataFrame, path: str | None = None, **columns: str) -> DataFrame:
    """Write ``pages`` as archives under ``path`` (default: the shared folder) and read the merged captures back."""
    spark = pages.sparkSession
    path = path or scratch_path(spark, "warc")
    write_archives(plan_records(pages, **columns), path)
    archives = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return merge_index(materialise(read_runs(archives), "runs"))

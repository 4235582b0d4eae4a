"""WARC archives of pages, and an index of their captures in global order.

Pages are written as WARC records by Spark's text writer: a record is a line
that ends with the two line ends which close a record, so any store that Spark
writes to will do. Archives have a bounded size and are read back whole, one at a time.

The index is an external merge. Each archive gives a run of captures sorted by
URL key and time, cut at common boundaries. For every range between two
boundaries the pieces of all runs meet in one task, which merges them with a loser
tree. The ranges follow each other, so the parts of the index are in global order.
A URL with very many captures is cut by time like any other stretch of the index.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
from collections.abc import Iterable, Iterator
from datetime import datetime, timezone
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from framestore.llm.batches import id_type
from framestore.llm.registry import query, table
from framestore.session import shared_folder, stage

ARCHIVE_BYTES = 32 << 20
RANGE_ROWS = 200_000
_END = "\r\n"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Time of the page with id 0; each id is one second later than the one before (modulo 2 ** 30).
_FIRST = 1577836800


def base32(sha1_hex: Column) -> Column:
    """Upper-case base32 of 20 bytes given as 40 hex digits: 4 digits for each 5."""
    four = [F.lpad(F.conv(F.substring(sha1_hex, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*four), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def write_archives(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", revisit_bytes: int = 0
) -> str:
    """Write a record per row of `pages` and return the folder of the archives.

    Of records with equal payloads of at least `revisit_bytes` bytes the one with the
    smallest id is a response, the others are revisits of it. A null payload is
    empty, a null id is larger than all others, a null URL is empty.
    """
    spark = pages.sparkSession
    payload = F.coalesce(F.col(f"`{payload_col}`"), F.lit(""))
    rows = pages.select(
        F.col(f"`{id_col}`").alias("id"),
        F.regexp_replace(F.coalesce(F.col(f"`{url_col}`"), F.lit("")), r"[\x00-\x20]", "").alias("url"),
        payload.alias("payload"),
        F.sha1(payload).alias("sha"),
        F.octet_length(payload).alias("bytes"),
        F.monotonically_increasing_id().alias("row"),
    )
    order = F.struct(F.col("id").isNull().alias("none"), "id", "row")
    firsts = rows.groupBy("sha").agg(F.min(order).alias("first"), F.sum("bytes").alias("bytes"), F.count("*").alias("n"))
    firsts, _ = stage(firsts, "payloads")
    total = firsts.agg(F.sum("bytes").alias("bytes"), F.sum("n").alias("n")).first()
    per_file = max(1, ARCHIVE_BYTES * (total["n"] or 1) // ((total["bytes"] or 0) + 700 * (total["n"] or 1)))
    rows = rows.join(firsts.select("sha", "first"), "sha")
    again = (F.col("bytes") >= revisit_bytes) & (F.col("row") != F.col("first.row"))
    name = lambda i, row: F.coalesce(i.cast("string"), F.concat(F.lit("none-"), row.cast("string")))
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{_END}Content-Type: text/html; charset=utf-8{_END}Content-Length: "), F.col("bytes"),
        F.lit(_END + _END),
    )
    block = F.when(again, http).otherwise(F.concat(http, "payload"))
    date = F.date_format(F.timestamp_seconds(_FIRST + F.pmod(F.coalesce(F.expr("try_cast(id AS bigint)"), F.lit(0)), F.lit(1 << 30))), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    lines = [
        F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), F.when(again, "revisit").otherwise("response")),
        F.concat(F.lit("WARC-Record-ID: <urn:page:"), name(F.col("id"), F.col("row")), F.lit(">")),
        F.concat(F.lit("WARC-Target-URI: "), "url"),
        F.concat(F.lit("WARC-Date: "), date),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), base32(F.col("sha"))),
        F.when(again, F.concat(
            F.lit(f"WARC-Profile: {_PROFILE}{_END}WARC-Refers-To: <urn:page:"), name(F.col("first.id"), F.col("first.row")), F.lit(">")
        )),
        F.lit("Content-Type: application/http;msgtype=response"),
        F.concat(F.lit("Content-Length: "), F.octet_length("block")),
    ]
    folder = f"{shared_folder(spark)}/framestore/warc-{uuid.uuid4().hex}"
    record = rows.withColumn("block", block).select(F.concat(F.concat_ws(_END, *lines), F.lit(_END + _END), "block"))
    record.write.option("lineSep", _END + _END).option("compression", "gzip").option("maxRecordsPerFile", per_file).text(folder)
    return folder


def url_key(url: str) -> str:
    """The host's parts in reverse, then path and query, all in lower case and without fragment: com,example)/a?b."""
    try:
        parts = urlsplit(url.lower())
        host, port = parts.hostname or "", parts.port
    except ValueError:
        return url.lower()
    key = ",".join(reversed(host.removeprefix("www.").split(".")))
    port = f":{port}" if port and port != {"http": 80, "https": 443}.get(parts.scheme) else ""
    return f"{key}{port}){parts.path or '/'}{'?' + parts.query if parts.query else ''}"


def records(archive: bytes) -> Iterator[tuple[int, int, dict[str, str], bytes]]:
    """(offset, length, headers, block) of every record of an archive without its compression."""
    at = 0
    while at < len(archive):
        head_end = archive.index(b"\r\n\r\n", at)
        version, *lines = archive[at:head_end].decode().split(_END)
        if not version.startswith("WARC/"):
            raise ValueError(f"No record begins at byte {at}")
        headers = {k.lower(): v for k, _, v in (line.partition(": ") for line in lines)}
        end = head_end + 4 + int(headers["content-length"])
        if archive[end : end + 4] != b"\r\n\r\n":
            raise ValueError(f"The record at byte {at} does not end where its length says")
        yield at, end + 4 - at, headers, archive[head_end + 4 : end]
        at = end + 4


_FIELDS = [
    ("url_key", pa.string()), ("time", pa.int64()), ("id", pa.string()), ("record_type", pa.string()),
    ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.string()), ("url", pa.string()),
    ("archive", pa.string()), ("offset", pa.int64()), ("length", pa.int64()),
]
_SCHEMA = pa.schema(_FIELDS)
_DDL = ", ".join(f"{n} {'bigint' if t == pa.int64() else 'string'}" for n, t in _FIELDS)


def _capture(path: str, offset: int, length: int, headers: dict[str, str], block: bytes) -> tuple:
    http, _, payload = block.partition(b"\r\n\r\n")
    fields = dict(line.partition(": ")[::2] for line in http.decode().split(_END)[1:])
    digest = headers["warc-payload-digest"].removeprefix("sha1:")
    kind, size = headers["warc-type"], int(fields["Content-Length"])
    if kind == "response" and (len(payload) != size or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest):
        raise ValueError(f"The payload at byte {offset} of {path} is not what its digest says")
    time = int(datetime.strptime(headers["warc-date"], "%Y-%m-%dT%H:%M:%SZ").replace(tzinfo=timezone.utc).timestamp())
    name = lambda key: headers[key][len("<urn:page:") : -1] if key in headers else None
    uri = headers.get("warc-target-uri", "")
    return url_key(uri), time, name("warc-record-id"), kind, size, digest, name("warc-refers-to"), uri, path, offset, length


def _place(capture: tuple) -> tuple:
    """Order of captures: URL key, time, then id (numbers by size) and where the record is."""
    key, time, page = capture[:3]
    return key, time, not page.isdigit(), len(page), page, capture[8], capture[9]


def _batch(rows: list[tuple], schema: pa.Schema = _SCHEMA) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """The captures of all archives, as one run per archive sorted by URL key and time."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                path, data = batch.column("path")[i].as_py(), gzip.decompress(batch.column("content")[i].as_py())
                run = sorted((_capture(path, *r) for r in records(data)), key=_place)
                for a in range(0, len(run), 5000):
                    yield _batch(run[a : a + 5000])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder)
    return files.select("path", "content").mapInArrow(read, _DDL)


class LoserTree:
    """Merge of sorted runs. Inner nodes hold the loser of the match below, so the
    next winner is found by one match per level, along the path of the last one."""

    def __init__(self, runs: list[list], key):
        self.runs, self.key = [iter(r) for r in runs], key
        self.size = max(1, len(runs))
        self.heads = [self._next(i) for i in range(len(runs))] or [None]
        self.losers = [0] * self.size
        self.winner = self._play(1) if self.size > 1 else 0

    def _next(self, run: int):
        item = next(self.runs[run], None)
        return None if item is None else (self.key(item), item)

    def _first(self, a: int, b: int) -> bool:
        """True if the head of run a comes before that of run b; a finished run comes last."""
        x, y = self.heads[a], self.heads[b]
        return x is not None and (y is None or (x[0], a) < (y[0], b))

    def _play(self, node: int) -> int:
        if node >= self.size:
            return node - self.size
        a, b = self._play(2 * node), self._play(2 * node + 1)
        won, self.losers[node] = (a, b) if self._first(a, b) else (b, a)
        return won

    def __iter__(self) -> Iterator:
        while (head := self.heads[self.winner]) is not None:
            yield head[1]
            run = self.winner
            self.heads[run] = self._next(run)
            node = (run + self.size) // 2
            while node:
                if self._first(self.losers[node], run):
                    run, self.losers[node] = self.losers[node], run
                node //= 2
            self.winner = run


def merge_runs(pieces: Iterable[list[tuple]]) -> Iterator[tuple]:
    """All captures of the pieces of runs in order. A piece that arrives out of order is put right first."""
    return iter(LoserTree([sorted(p, key=_place) for p in pieces], _place))


def index(captures: DataFrame) -> DataFrame:
    """The captures with `index_part` and `index_pos`: sorted by them, they are in order of URL key and time."""
    captures, _ = stage(captures, "captures")
    spark = captures.sparkSession
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-captures.count() // RANGE_ROWS))
    names = [f for f, _ in _FIELDS]
    out = pa.schema([("index_part", pa.int32()), ("index_pos", pa.int64()), *_FIELDS])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, runs = TaskContext.get().partitionId(), {}
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in names)):
                runs.setdefault(row[8], []).append(row)
        rows: list[tuple] = []
        for at, row in enumerate(merge_runs(runs.values())):
            rows.append((part, at, *row))
            if len(rows) == 5000:
                yield _batch(rows, out)
                rows = []
        if rows:
            yield _batch(rows, out)

    # Numbers as numbers, then names; the same order as `_place`.
    order = ["url_key", "time", ~F.col("id").rlike("^[0-9]+$"), F.length("id"), "id", "archive", "offset"]
    ranged = captures.repartitionByRange(n, *order)
    return ranged.mapInArrow(merge, f"index_part int, index_pos bigint, {_DDL}")


def captures_of(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", revisit_bytes: int = 0
) -> DataFrame:
    """Write `pages` to archives, read them back, and return the index of their captures.

    One row per row of `pages`: the columns of `index`, with id and `refers_to` in the type of
    `id_col` (a null id stays null). An empty table gives no rows.
    """
    folder = write_archives(pages, id_col, url_col, payload_col, revisit_bytes)
    kind = id_type(pages, id_col)
    found = index(read_archives(pages.sparkSession, folder))
    real = lambda c: F.when(~F.col(c).startswith("none-"), F.col(c)).cast(kind)
    return found.withColumns({"id": real("id"), "refers_to": real("refers_to")}).withColumnRenamed("id", id_col)


@query()
def op4_warc(spark, sf_dir):
    return captures_of(table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url_key", "time"
    )

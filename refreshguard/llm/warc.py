"""Web archives: written once, read back, and indexed by an external merge.

Each page is a WARC record.  Pages with equal payloads are stored once: the one
with the largest ``page_id`` is a response, the others revisit it and carry the
HTTP headers of their payload only.  Spark's text writer makes the files (its
line separator is the blank lines that end a record), so they go to any file
system that Spark reaches; they are read back as binary files and parsed by
their Content-Length.

A file is a capture run: its index entries are sorted by URL key and time.
Runs meet in ranges of (URL key, time, page), as many as the data need, and a
range merges its slices of the runs through a loser tree, so the ranges in
their order are the capture histories of all URLs.  A URL with very many
captures is spread over ranges by their time.

Defined cases: a null html is an empty payload; empty payloads are equal
payloads; a null ``url`` is the empty URL; repeated rows with the same page id
and payload are all responses if it is the largest; a null page id revisits the
largest id of its payload, and is a response if there is none; an empty table
gives an empty archive; further columns may have any name.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
from collections.abc import Iterator
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.shared import shared_folder, stored

#: Records in a file at most; with a mean page of some kB a file is some 10 MB.
RECORDS = 2000
EPOCH = "2024-01-01T00:00:00"  # time of page 0; pages follow by the second
END = "\r\n\r\n"
ENTRY = "url_key string, captured_at long, page_id long, run string, place long, kind string, " \
        "refers_to long, payload_bytes long, payload_digest string"


def url_key(url: str) -> str:
    """Host labels in reverse order, then the path and query, in lower case and without the scheme."""
    bare = re.sub(r"^[a-z][a-z0-9+.-]*://", "", (url or "").strip().lower())
    bare = bare.partition("#")[0]
    host, slash, rest = bare.partition("/")
    host = re.sub(r"^(www\d*|m)\.|:(80|443)$", "", host.rpartition("@")[2])
    return ",".join(reversed(host.split("."))) + ")" + slash + rest


# -- payloads and decisions -------------------------------------------------

def payloads(pages: DataFrame) -> DataFrame:
    """(page_id, url, html, digest): the payload and the base-32 SHA-1 of its bytes."""
    text = pages.select("page_id", F.coalesce("url", F.lit("")).alias("url"),
                        F.coalesce("html", F.lit("")).alias("html"))
    return text.withColumn("digest", base32(F.sha1(F.col("html").cast("binary"))))


def base32(sha1_hex):
    """The 40 hexadecimal digits as 32 base-32 digits: five of one are twenty bits, four of the other."""
    alphabet = F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")

    def four(k):
        bits = F.conv(F.substr(sha1_hex, k * 5 + 1, F.lit(5)), 16, 10).cast("int")
        return F.concat(*[F.substr(alphabet, F.shiftright(bits, shift).bitwiseAND(F.lit(31)) + 1,
                                   F.lit(1)) for shift in (15, 10, 5, 0)])

    return F.concat(*[four(F.lit(k)) for k in range(8)])


def decided(pages: DataFrame) -> DataFrame:
    """The payloads with ``refers_to``: null for responses, else the page that has the payload."""
    rows = payloads(pages)
    # Numbers and digests only; the largest id of a digest is found on each side of the shuffle.
    largest = rows.select("digest", "page_id").groupBy("digest").agg(
        F.max("page_id").alias("first"), F.count("*").alias("copies")).filter("copies > 1")
    largest = stored(largest, "payloads")
    known = F.broadcast(largest) if largest.count() <= 500_000 else largest
    return rows.join(known, "digest", "left").select(
        "page_id", "url", "html", "digest",
        F.when((F.col("page_id") == F.col("first")) | F.col("first").isNull(), None)
        .otherwise(F.col("first")).alias("refers_to"))


def records(pages: DataFrame) -> DataFrame:
    """One string a page: a WARC record without the blank lines at its end."""
    rows = decided(pages)
    html = F.col("html")
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
                          "Content-Length: "), F.octet_length(html).cast("string"), F.lit(END))
    block = F.when(F.col("refers_to").isNull(), F.concat(http, html)).otherwise(http)
    kind = F.when(F.col("refers_to").isNull(), "response").otherwise("revisit")
    number = F.coalesce(F.col("page_id").cast("string"), F.lit(""))
    time = F.date_format(F.timestamp_seconds(
        F.unix_timestamp(F.lit(EPOCH), "yyyy-MM-dd'T'HH:mm:ss") + F.coalesce("page_id", F.lit(0))),
        "yyyy-MM-dd'T'HH:mm:ss'Z'")
    url = F.regexp_replace("url", r"[\r\n]", "")
    refers = F.when(F.col("refers_to").isNull(), F.lit("")).otherwise(F.concat(
        F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\n"
              "WARC-Refers-To: <urn:page:"), F.col("refers_to").cast("string"), F.lit(">\r\n")))
    head = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "), kind, F.lit("\r\nWARC-Record-ID: <urn:page:"), number,
        F.lit(">\r\nWARC-Date: "), time, F.lit("\r\nWARC-Target-URI: "), url,
        F.lit("\r\nWARC-Payload-Digest: sha1:"), F.col("digest"), F.lit("\r\n"), refers,
        F.lit("Content-Type: application/http; msgtype=response\r\nContent-Length: "),
        F.octet_length(block).cast("string"), F.lit(END))
    return rows.select(F.concat(head, block).alias("value"))


def write_archives(pages: DataFrame, path: str) -> None:
    """Gzipped WARC files of at most ``RECORDS`` records, below a folder."""
    (records(pages).write.option("lineSep", END).option("compression", "gzip")
     .option("maxRecordsPerFile", RECORDS).text(path))


# -- reading ----------------------------------------------------------------

def parse(data: bytes) -> Iterator[tuple[dict[str, str], bytes, int]]:
    """(headers, block, offset) of each record."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].decode("utf-8", "surrogatepass").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no record at {at}: {lines[0][:40]!r}")
        headers = dict(line.split(": ", 1) for line in lines[1:])
        length = int(headers["Content-Length"])
        yield headers, data[end + 4:end + 4 + length], at
        at = end + 4 + length + 4


def _page(urn: str | None) -> int | None:
    number = urn[len("<urn:page:"):-1] if urn else ""
    return int(number) if number else None


def read_archives(spark, path: str) -> DataFrame:
    """The index entries of all records (``ENTRY``), those of a file sorted by key and time.

    Digest and length come from the payload that was read; of a revisit, which
    has none, from its headers.
    """
    def entries(batches):
        for batch in batches:
            for name, content in zip(batch["path"], batch["content"]):
                rows = []
                for headers, block, at in parse(gzip.decompress(content)):
                    http, _, body = block.partition(b"\r\n\r\n")
                    length = int(re.search(rb"Content-Length: (\d+)", http)[1])
                    digest = headers["WARC-Payload-Digest"].removeprefix("sha1:")
                    if headers["WARC-Type"] == "response":
                        length = len(body)
                        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
                    time = pd.Timestamp(headers["WARC-Date"]).timestamp()
                    rows.append((url_key(headers["WARC-Target-URI"]), int(time),
                                 _page(headers["WARC-Record-ID"]), name, at, headers["WARC-Type"],
                                 _page(headers.get("WARC-Refers-To")), length, digest))
                rows.sort(key=order)
                frame = pd.DataFrame(rows, columns=[c.split()[0] for c in ENTRY.split(", ")])
                yield frame.astype({"page_id": "Int64", "refers_to": "Int64"})

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path)
    return files.select("path", "content").mapInPandas(entries, ENTRY)


# -- the index --------------------------------------------------------------

class Entry(NamedTuple):
    url_key: str
    captured_at: int
    page_id: int | None


def order(row) -> tuple:
    """Sort key of an entry: URL key, time, page; a null page first."""
    page = row[2]
    return (row[0], row[1], page is not None and page == page, page or 0, row[3], row[4])


class LoserTree:
    """k-way merge: each inner place keeps the loser of its match, so one path decides the next winner."""

    def __init__(self, runs: list[Iterator[tuple]]):
        self.runs = runs
        self.k = len(runs)
        self.heads = [self._next(i) for i in range(self.k)]
        self.losers = [-1] * self.k
        self.winner = -1
        for i in range(self.k):
            self._enter(i)

    def _next(self, i: int):
        row = next(self.runs[i], None)
        return None if row is None else (order(row), row)

    def _before(self, a: int, b: int) -> bool:
        x, y = self.heads[a], self.heads[b]
        return y is None or x is not None and (x[0], a) <= (y[0], b)

    def _enter(self, i: int) -> None:
        """First matches: a run waits at the first empty place on its way up."""
        at = (i + self.k) // 2
        while at:
            if self.losers[at] < 0:
                self.losers[at] = i
                return
            if self._before(self.losers[at], i):
                self.losers[at], i = i, self.losers[at]
            at //= 2
        self.winner = i

    def __iter__(self) -> Iterator[tuple]:
        while self.k and self.heads[self.winner] is not None:
            i = self.winner
            yield self.heads[i][1]
            self.heads[i] = self._next(i)
            at = (i + self.k) // 2
            while at:
                if self._before(self.losers[at], i):
                    self.losers[at], i = i, self.losers[at]
                at //= 2
            self.winner = i


def merge_index(entries: DataFrame, ranges: int) -> DataFrame:
    """The entries in global order over ``ranges`` partitions, with ``history_range``, the place of a range.

    Rows of a range arrive sorted by run, so each run is one stretch of them.
    A range holds its entries, not their records, in memory.
    """
    keys = ["url_key", "captured_at", "page_id"]
    dealt = entries.repartitionByRange(ranges, *keys, "run", "place").sortWithinPartitions(
        "run", *keys, "place")
    names = entries.columns

    def merge(batches):
        runs: dict[str, list[tuple]] = {}
        for batch in batches:
            for row in batch.astype(object).where(batch.notna(), None).itertuples(
                    index=False, name=None):
                runs.setdefault(row[3], []).append(row)
        merged = list(LoserTree([iter(r) for r in runs.values()]))
        for k in range(0, len(merged), 10_000):
            part = pd.DataFrame(merged[k:k + 10_000], columns=names)
            yield part.astype({"page_id": "Int64", "refers_to": "Int64"})

    return dealt.mapInPandas(merge, ENTRY).withColumn("history_range", F.spark_partition_id())


def archive_report(pages: DataFrame) -> DataFrame:
    """Per page what the archive says of its record; the rows come from the merged index."""
    spark = pages.sparkSession
    path = shared_folder(spark, "archives")
    write_archives(pages, path)
    entries = stored(read_archives(spark, path), "entries")
    ranges = max(1, entries.count() // 50_000)
    index = merge_index(entries, max(ranges, 8))
    return index.select("page_id", "payload_bytes", "payload_digest",
                        F.col("kind").alias("record_type"), "refers_to", "url_key",
                        F.timestamp_seconds("captured_at").alias("captured_at"))

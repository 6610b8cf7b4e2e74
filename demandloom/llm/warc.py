"""WARC archives: written as whole gzip streams, normalised to one gzip member a record, read back.

Writing: one record a page, its payload the html in UTF-8 (null as empty). Of pages with equal
payloads the one with the largest page_id is a response record, the others revisit it and carry its
id, the payload's digest and its length in their header. Spark's text writer makes each task's
records one gzip stream, which is what many crawls hand out and what cannot be read from the middle.

Normalising: each archive is inflated once, as a stream; every record is compressed as a member of
its own and the member's offset, length and header go to a sidecar index (a Parquet table).

Reading: the index's rows of an archive are read member by member from their offsets. A response's
digest is computed from its payload again; one that differs from the header's stops the job.

Pages whose html is shorter than `least` bytes are always responses. Rows with the same page_id and
payload are alike: all of them are responses if that id is the largest. A null page_id is smaller
than any other. Null urls give records without a target URI.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from demandloom.llm import shared

LEAST = 0
READ = 1 << 20
CRLF = "\r\n"
DATE = "2024-01-01T00:00:00Z"
INDEX = "archive string, offset long, length long, record_id string, record_type string, target_uri string, payload_digest string, refers_to string, payload_bytes long"
_HEX, _BASE32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32_sha1(data: Column) -> Column:
    """The SHA-1 of bytes in upper-case base32: five bytes at a time are eight digits."""
    digest = F.sha1(data)
    eight = [F.translate(F.lpad(F.conv(F.substring(digest, 1 + 10 * k, 10), 16, 32), 8, "0"), _HEX, _BASE32) for k in range(4)]
    return F.concat(*eight)


def _line(name: str, value: Column) -> Column:
    """A header line, or nothing for a null value; line ends inside a value become spaces."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), F.translate(value, CRLF, "  "), F.lit(CRLF)), F.lit(""))


def _urn(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("null")), F.lit(">"))


def write_archives(pages: DataFrame, folder: str, least: int = LEAST) -> None:
    """pages(page_id, url, html, ...) as whole-stream gzip archives in `folder`, one a task.

    Which rows revisit which page is settled on ids and digests alone; the html is shuffled once,
    by page, so that pages with one and the same payload do not meet in a task.
    """
    html = F.coalesce("html", F.lit(""))
    base = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), html.alias("html"))
    base = base.select("*", base32_sha1(F.col("html").cast("binary")).alias("digest"), F.octet_length("html").cast("long").alias("bytes"))
    digests = shared.stored(base.select("page_id", "digest", "bytes").filter(F.col("bytes") >= least), f"{folder}-digests")
    first = digests.groupBy("digest").agg(F.max("page_id").alias("original"), F.count("*").alias("n")).filter("n > 1 AND original IS NOT NULL")
    later = (digests.join(first.select("digest", "original").hint("merge"), "digest").filter(~F.col("page_id").eqNullSafe(F.col("original")))
             .select(F.col("page_id").alias("later_id"), F.col("digest").alias("later_digest"), "original").distinct())
    known = base.join(later.hint("merge"), F.col("page_id").eqNullSafe(F.col("later_id")) & (F.col("digest") == F.col("later_digest")), "left")
    again = F.col("original").isNotNull()
    http = F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}{CRLF}")
    block = F.when(again, F.lit("")).otherwise(F.concat(http, "html"))
    record = F.concat(
        F.lit(f"WARC/1.1{CRLF}"),
        _line("WARC-Type", F.when(again, "revisit").otherwise("response")),
        _line("WARC-Record-ID", _urn(F.col("page_id"))),
        _line("WARC-Date", F.lit(DATE)),
        _line("WARC-Target-URI", F.col("url")),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "digest")),
        _line("WARC-Refers-To", F.when(again, _urn(F.col("original")))),
        _line("WARC-Profile", F.when(again, "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
        _line("X-Payload-Length", F.col("bytes").cast("string")),
        _line("Content-Type", F.lit("application/http; msgtype=response")),
        _line("Content-Length", F.octet_length(block).cast("string")),
        F.lit(CRLF), block)
    (known.select(record.alias("value")).write.option("lineSep", CRLF + CRLF)
     .option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED").text(folder))


def _open(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)


class Stream:
    """Bytes of a gzip file (one member or many), inflated as they are asked for."""

    def __init__(self, raw) -> None:
        self.raw, self.inflate, self.have = raw, zlib.decompressobj(31), bytearray()

    def more(self) -> bool:
        if self.inflate.eof:
            rest = self.inflate.unused_data or self.raw.read(READ)
            if not rest:
                return False
            self.inflate = zlib.decompressobj(31)
        else:
            rest = self.inflate.unconsumed_tail or self.raw.read(READ)
            if not rest:
                return False
        self.have += self.inflate.decompress(rest, READ * 4)
        return True

    def until(self, mark: bytes) -> bytes | None:
        """Up to and with the mark; None at the end of the stream."""
        seen = 0
        while (at := self.have.find(mark, seen)) < 0:
            seen = max(0, len(self.have) - len(mark))
            if not self.more():
                return None
        return self.take(at + len(mark))

    def take(self, n: int) -> bytes:
        while len(self.have) < n:
            if not self.more():
                raise ValueError("the archive ends within a record")
        out = bytes(self.have[:n])
        del self.have[:n]
        return out


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split(CRLF)[1:]
    return {name.strip().lower(): value.strip() for name, _, value in (line.partition(":") for line in lines) if value}


def _records(stream: Stream) -> Iterator[tuple[bytes, dict[str, str], bytes]]:
    while (head := stream.until(b"\r\n\r\n")) is not None:
        head = head.lstrip(b"\r\n")
        if not head:
            continue
        if not head.startswith(b"WARC/"):
            raise ValueError(f"no WARC record begins with {head[:20]!r}")
        fields = _fields(head)
        body = stream.take(int(fields["content-length"]))
        yield head, fields, body


def _rewrite(out_folder: str):
    """For each archive path: a file with one member a record, and its index rows."""
    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                source, where = _open(path)
                name = re.sub(r"[^A-Za-z0-9.-]", "_", path.rsplit("/", 1)[-1].removesuffix(".txt.gz").removesuffix(".gz")) + ".warc.gz"
                target, place = _open(f"{out_folder}/{name}")
                target.create_dir(place.rsplit("/", 1)[0], recursive=True)
                # a second attempt at the same archive writes the same bytes; the last rename stays
                draft = f"{place}.{uuid.uuid4().hex}.part"
                rows, offset = [], 0
                with source.open_input_stream(where, compression=None) as raw, target.open_output_stream(draft, compression=None) as out:
                    for head, fields, body in _records(Stream(raw)):
                        pack = zlib.compressobj(4, zlib.DEFLATED, 31)
                        member = pack.compress(head + body + b"\r\n\r\n") + pack.flush()
                        out.write(member)
                        rows.append({"archive": f"{out_folder}/{name}", "offset": offset, "length": len(member),
                                     "record_id": fields["warc-record-id"], "record_type": fields["warc-type"],
                                     "target_uri": fields.get("warc-target-uri"), "payload_digest": fields.get("warc-payload-digest"),
                                     "refers_to": fields.get("warc-refers-to"), "payload_bytes": int(fields.get("x-payload-length", -1))})
                        offset += len(member)
                        if len(rows) == 10_000:
                            yield _index_rows(rows)
                            rows = []
                target.move(draft, place)
                yield _index_rows(rows)
    return rewrite


def _index_rows(rows: list[dict]) -> pa.RecordBatch:
    kinds = {"string": pa.string(), "long": pa.int64()}
    names = [f.split() for f in INDEX.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], kinds[k]) for n, k in names], [n for n, _ in names])


def normalise(spark: SparkSession, folder: str, out_folder: str) -> DataFrame:
    """Rewrites the gzip archives of a folder; returns the index, written beside them."""
    paths = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(folder).select("path")
    n = max(1, shared.partitions(spark))
    index = paths.repartition(n, "path").mapInArrow(_rewrite(out_folder), INDEX)
    return shared.stored(index, f"{out_folder}-index")


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The records at the index's offsets; rows of one archive follow each other."""
    opened, at = None, None
    for batch in batches:
        sizes, digests = [], []
        for row in batch.select(["archive", "offset", "length", "record_type", "payload_digest", "payload_bytes"]).to_pylist():
            if row["archive"] != opened:
                if at:
                    at.close()
                system, place = _open(row["archive"])
                opened, at = row["archive"], system.open_input_file(place)
            record = zlib.decompress(at.read_at(row["length"], row["offset"]), 31)
            head, _, rest = record.partition(b"\r\n\r\n")
            body = rest[:int(_fields(head)["content-length"])]
            if row["record_type"] == "revisit":
                size, digest = row["payload_bytes"], row["payload_digest"].removeprefix("sha1:")
            else:
                payload = body.partition(b"\r\n\r\n")[2]
                size, digest = len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode()
                if row["payload_digest"] not in (None, f"sha1:{digest}"):
                    raise ValueError(f"{row['archive']} at {row['offset']}: the payload does not have its digest")
            sizes.append(size)
            digests.append(digest)
        yield pa.RecordBatch.from_arrays(
            [batch.column("record_id"), pa.array(sizes, pa.int64()), pa.array(digests, pa.string()), batch.column("record_type"), batch.column("refers_to")],
            ["record_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])
    if at:
        at.close()


def read_archives(index: DataFrame) -> DataFrame:
    """record_id, payload_bytes, payload_digest, record_type and refers_to of every indexed record."""
    n = shared.partitions(index.sparkSession)
    rows = index.repartition(n, "archive").sortWithinPartitions("archive", "offset")
    return rows.mapInArrow(_read, "record_id string, payload_bytes long, payload_digest string, record_type string, refers_to string")


def round_trip(pages: DataFrame, least: int = LEAST) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type and refers_to of every page, from archives."""
    spark = pages.sparkSession
    folder = shared.workspace(spark, "warc")
    write_archives(pages, f"{folder}/streams", least)
    index = normalise(spark, f"{folder}/streams", f"{folder}/members")
    def page(urn: str) -> Column:
        return F.expr(f"try_cast(regexp_extract({urn}, '<urn:page:(.*)>', 1) AS long)")
    return read_archives(index).select(
        page("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", page("refers_to").alias("refers_to"))

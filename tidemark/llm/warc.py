"""WARC archives: writing pages as records, and reading records back with segments reassembled.

A response's block is an HTTP message whose body has chunked transfer framing. A block longer than a segment is written
as a first record and continuation records, which name their origin and their number; the last one also states the
total length. The reader groups continuations by origin, orders them by number, checks the total length and decodes the
chunked body by an incremental state machine, so that it holds one segment at a time.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import shared_folder

VERSION = b"WARC/1.1"
HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
#: Records in a file: with the segment size this bounds a file, which is read as a whole.
RECORDS_PER_FILE = 512


def chunked(payload: bytes, size: int) -> bytes:
    """Chunked transfer framing of a payload."""
    parts = [b"%x\r\n%s\r\n" % (len(p := payload[i : i + size]), p) for i in range(0, len(payload), size)]
    return b"".join(parts) + b"0\r\n\r\n"


class ChunkedBody:
    """Incremental decoder of an HTTP message with chunked framing: feed bytes, get payload bytes."""

    def __init__(self):
        self.state, self.rest, self.left = "head", b"", 0

    def feed(self, data: bytes) -> Iterator[bytes]:
        self.rest += data
        while True:
            if self.state == "head":
                head, found, rest = self.rest.partition(b"\r\n\r\n")
                if not found:
                    return
                framed = b"transfer-encoding: chunked" in head.lower()
                self.rest, self.state = rest, "size" if framed else "plain"
            elif self.state == "plain":
                out, self.rest = self.rest, b""
                if out:
                    yield out
                return
            elif self.state == "size":
                line, found, rest = self.rest.partition(b"\r\n")
                if not found:
                    return
                self.left, self.rest = int(line.split(b";")[0], 16), rest
                self.state = "data" if self.left else "trailer"
            elif self.state == "data":
                out, self.rest = self.rest[: self.left], self.rest[self.left :]
                self.left -= len(out)
                if out:
                    yield out
                if self.left:
                    return
                self.state = "gap"
            elif self.state == "gap":
                if len(self.rest) < 2:
                    return
                if self.rest[:2] != b"\r\n":
                    raise ValueError("a chunk is longer than its size says")
                self.rest, self.state = self.rest[2:], "size"
            else:  # trailer: header lines up to an empty one
                line, found, rest = self.rest.partition(b"\r\n")
                if not found:
                    return
                self.rest = rest
                if not line:
                    self.state = "end"
                    self.rest = b""
                    return
            if self.state == "end":
                return

    def close(self) -> None:
        if self.state not in ("end", "plain"):
            raise ValueError("the message ends inside its framing")


def record(headers: dict[str, str], block: bytes) -> bytes:
    """One record without its final empty lines, which the file writer adds."""
    lines = [VERSION] + [f"{k}: {v}".encode() for k, v in headers.items()] + [b"Content-Length: %d" % len(block)]
    return b"\r\n".join(lines) + b"\r\n\r\n" + block


def records_of(page_id, url, payload: bytes, refers_to, revisit: bool, segment: int, chunk: int) -> Iterator[bytes]:
    """The records of one page: a revisit, a response, or a response and its continuations."""
    name = f"<urn:uuid:{uuid.uuid4()}>"
    headers = {
        "WARC-Type": "revisit" if revisit else "response", "WARC-Record-ID": name, "WARC-Date": "1970-01-01T00:00:00Z",
        "WARC-Payload-Digest": "sha1:" + hashlib.sha1(payload).hexdigest(),
        "Page-Id": "" if page_id is None else str(page_id),
    }
    if url:
        headers["WARC-Target-URI"] = "".join(c if c > " " else f"%{ord(c):02X}" for c in url)
    if revisit:
        headers |= {"WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", "Refers-To-Page-Id": str(refers_to), "Payload-Length": str(len(payload))}
        yield record(headers, b"")
        return
    headers["Content-Type"] = "application/http; msgtype=response"
    block = HEAD + chunked(payload, chunk)
    if len(block) <= segment:
        yield record(headers, block)
        return
    pieces = [block[i : i + segment] for i in range(0, len(block), segment)]
    yield record(headers | {"WARC-Segment-Number": "1"}, pieces[0])
    for n, piece in enumerate(pieces[1:], 2):
        more = {"WARC-Type": "continuation", "WARC-Record-ID": f"<urn:uuid:{uuid.uuid4()}>", "WARC-Date": headers["WARC-Date"], "WARC-Segment-Origin-ID": name, "WARC-Segment-Number": str(n)}
        if n == len(pieces):
            more["WARC-Segment-Total-Length"] = str(len(block))
        yield record(more, piece)


def write_archives(pages: DataFrame, folder: str, least: int = 1_000, segment: int = 16_384, chunk: int = 4_096, page_id: str = "page_id", url: str = "url", html: str = "html") -> None:
    """Write a record for each row of pages into WARC files (gzip) in a folder.

    Of rows with equal payloads of `least` bytes or more, those with the largest page_id become responses and the
    others revisits of it; shorter ones are all responses. Null payloads are empty, null page_ids are left blank and
    are never revisits. Payloads are compared by SHA-256 and length, on short rows; the pages themselves are shuffled
    once, to meet what they refer to.
    """
    payload = F.coalesce(F.col(html), F.lit("")).cast("binary")
    own = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), payload.alias("payload"))
    keys = own.where("page_id is not null").where(F.octet_length("payload") >= least).select("page_id", F.sha2("payload", 256).alias("digest")).distinct()
    last = keys.groupBy("digest").agg(F.max("page_id").alias("last"), F.count("*").alias("n")).where("n > 1").select("digest", "last")
    revisits = keys.join(last, "digest").where("page_id < last").select(F.col("page_id").alias("own_id"), F.col("digest").alias("own_digest"), "last")
    full = own.withColumn("digest", F.when(F.octet_length("payload") >= least, F.sha2("payload", 256)))
    dealt = full.join(revisits, (F.col("page_id") == F.col("own_id")) & (F.col("digest") == F.col("own_digest")), "left").select("page_id", "url", "payload", "last")

    def run(batches):
        for batch in batches:
            found, size = [], 0
            for key, at, data, refers in zip(*(c.to_pylist() for c in batch.columns)):
                for x in records_of(key, at, data, refers, refers is not None, segment, chunk):
                    found.append(x)
                    size += len(x)
                if size > 8 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary())], names=["value"])
                    found, size = [], 0
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary())], names=["value"])

    # The text writer puts each record's bytes down as they are and ends each with the two empty lines of the format.
    lines = dealt.mapInArrow(run, "value binary").select(F.col("value").cast("string").alias("value"))
    lines.write.option("lineSep", "\r\n\r\n").option("compression", "gzip").option("maxRecordsPerFile", RECORDS_PER_FILE).text(folder)


def parsed(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (names in lower case) and block of each record of an archive, plain or gzip, one record at a time."""
    if data[:2] == b"\x1f\x8b":
        buffer, feed = b"", _inflated(data)
    else:
        buffer, feed = data, iter(())
    at = 0

    def more() -> bool:
        nonlocal buffer, at
        part = next(feed, None)
        if part is None:
            return False
        buffer, at = buffer[at:] + part, 0
        return True

    while True:
        while (end := buffer.find(b"\r\n\r\n", at)) < 0 or end == at:
            if end == at:
                at += 4
            elif not more():
                if buffer[at:].strip():
                    raise ValueError("an archive ends inside a record's headers")
                return
        version, *lines = buffer[at:end].split(b"\r\n")
        if not version.startswith(b"WARC/"):
            raise ValueError(f"no record begins with {version[:40]!r}")
        headers = {k.strip().lower().decode(): v.strip().decode() for k, _, v in (x.partition(b":") for x in lines)}
        at = end + 4
        length = int(headers["content-length"])
        while len(buffer) - at < length:
            if not more():
                raise ValueError("an archive ends inside a record's block")
        yield headers, buffer[at : at + length]
        at += length


def _inflated(data: bytes, step: int = 1 << 18) -> Iterator[bytes]:
    """The members of a gzip file, decompressed step by step."""
    while data:
        member = zlib.decompressobj(31)
        part = member.decompress(data, step)
        while part or not member.eof:
            yield part
            if not member.unconsumed_tail and not part:
                raise ValueError("an archive's compressed data ends early")
            part = member.decompress(member.unconsumed_tail, step)
        data = member.unused_data


RECORD = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
PIECE = "origin string, number int, headers map<string,string>, block binary"


def _result(headers: dict[str, str], size: int, digest: str) -> tuple:
    claimed = headers["warc-payload-digest"].partition(":")[2]
    if claimed != digest:
        raise ValueError(f"payload of page {headers['page-id']} has digest {digest}, not {claimed}")
    return int(headers["page-id"]) if headers["page-id"] else None, size, digest, headers["warc-type"], None


def _rows(found: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], t) for k, t in enumerate(kinds)], names=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """A row for each page in a folder of archives: page_id, payload_bytes, payload_digest, record_type, refers_to.

    Whole records are decoded where they are read. Segments meet by their origin, in the order of their numbers; a
    missing segment, a wrong total length, broken framing or a wrong digest is an error. An empty folder gives no rows.
    """
    files = spark.read.format("binaryFile").load(folder).where("length > 0").select("content")

    def parse(batches):
        for batch in batches:
            for data in batch.column(0).to_pylist():
                origin, number, headers, blocks, size = [], [], [], [], 0
                for head, block in parsed(data):
                    segment = head.get("warc-segment-number")
                    origin.append(head.get("warc-segment-origin-id", head["warc-record-id"]))
                    number.append(0 if segment is None else int(segment))
                    if segment is None:  # whole records go on as their result
                        head = head | _whole(head, block)
                        block = b""
                    headers.append(list(head.items()))
                    blocks.append(block)
                    size += len(block)
                    if size > 8 << 20:
                        yield _pieces(origin, number, headers, blocks)
                        origin, number, headers, blocks, size = [], [], [], [], 0
                yield _pieces(origin, number, headers, blocks)

    pieces = files.mapInArrow(parse, PIECE)
    # Whole records pass the exchange as a few header fields; only segments carry their bytes.
    dealt = pieces.repartition("origin").sortWithinPartitions("origin", "number")
    return dealt.mapInArrow(reassembled, RECORD)


def _whole(head: dict[str, str], block: bytes) -> dict[str, str]:
    if head["warc-type"] == "revisit":
        return {"size": head["payload-length"], "digest": head["warc-payload-digest"].partition(":")[2]}
    body, digest, size = ChunkedBody(), hashlib.sha1(), 0
    for part in body.feed(block):
        digest.update(part)
        size += len(part)
    body.close()
    return {"size": str(size), "digest": digest.hexdigest()}


#: Header fields that the result needs.
NEEDED = {"warc-type", "warc-payload-digest", "page-id", "refers-to-page-id", "warc-segment-total-length", "size", "digest"}


def _pieces(origin, number, headers, blocks) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array(origin, pa.string()), pa.array(number, pa.int32()),
            pa.array([[(k, v) for k, v in h if k in NEEDED] for h in headers], pa.map_(pa.string(), pa.string())), pa.array(blocks, pa.binary()),
        ],
        names=["origin", "number", "headers", "block"],
    )


def reassembled(batches) -> Iterator[pa.RecordBatch]:
    """Results from pieces in the order of origin and segment number."""
    first: dict | None = None
    name, expected, length, total = None, 0, 0, None
    body, digest, size = ChunkedBody(), hashlib.sha1(), 0

    def finished():
        if first is None:
            return []
        if total is None or total != length:
            raise ValueError(f"segments of {name} have {length} bytes of {total}")
        body.close()
        return [_result(first, size, digest.hexdigest())]

    for batch in batches:
        found = []
        for origin, number, headers, block in zip(*(c.to_pylist() for c in batch.columns)):
            headers = dict(headers)
            if number == 0:
                if headers["warc-type"] in ("response", "revisit"):
                    key, _, sha, kind, _ = _result(headers, 0, headers["digest"])
                    found.append((key, int(headers["size"]), sha, kind, int(headers["refers-to-page-id"]) if kind == "revisit" else None))
                continue
            if origin != name:
                found += finished()
                first, name, expected, length, total = headers, origin, 1, 0, None
                body, digest, size = ChunkedBody(), hashlib.sha1(), 0
            if number != expected:
                raise ValueError(f"segment {expected} of {origin} is missing")
            expected += 1
            length += len(block)
            if "warc-segment-total-length" in headers:
                total = int(headers["warc-segment-total-length"])
            for part in body.feed(block):
                digest.update(part)
                size += len(part)
        yield _rows(found)
    yield _rows(finished())


def round_trip(pages: DataFrame, least: int = 1_000, segment: int = 16_384) -> DataFrame:
    """Pages written as archives into the shared folder and read back."""
    folder = shared_folder(pages.sparkSession, "warc")
    write_archives(pages, folder, least, segment)
    return read_archives(pages.sparkSession, folder)

"""WARC archives of pages and a two-level capture index over them.

Tasks write records, one gzip member each, to files in a folder all machines share. The index sorts captures by
reversed-host key into compressed blocks; a sparse directory lists the first key of each block. A look-up bisects the list
of index parts, the part's directory and the block, and then reads one range of one archive.
"""

from __future__ import annotations

import gzip
import hashlib
import uuid
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import Scratch, find_package

#: Payloads of at least so many bytes are stored once.
REVISIT_BYTES = 1000
#: Captures in a block of the index; bytes after which a task begins another archive.
BLOCK_LINES = 2000
ARCHIVE_BYTES = 1 << 30
#: A page has no time of capture, so all records bear this date.
DATE = "2000-01-01T00:00:00Z"


def _open(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, with Spark's short form file:/x."""
    if path.startswith("file:") or "://" not in path:
        return fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(path)


def _create(path: str) -> pa.NativeFile:
    system, place = _open(path)
    system.create_dir(place.rsplit("/", 1)[0], recursive=True)
    return system.open_output_stream(place, compression=None)


class _Ranges:
    """Range reads; the file read last stays open."""

    def __init__(self):
        self.path, self.file = None, None

    def read(self, path: str, offset: int, length: int) -> bytes:
        if path != self.path:
            system, place = _open(path)
            self.path, self.file = path, system.open_input_file(place)
        return self.file.read_at(length, offset)


def url_key(url: Column) -> Column:
    """host labels in reverse, then path and query: org,example)/a?b. A null url has the empty key."""
    rest = F.regexp_replace(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#@]*@)?(?i:www\.)?|#.*$|[\t\r\n]", "")
    host = F.regexp_extract(rest, r"^([^/?:]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?:]*(?::[0-9]+)?(.*)$", 1)
    return F.when(rest == "", "").otherwise(F.concat(F.array_join(F.reverse(F.split(F.lower(host), r"\.")), ","), F.lit(")"), path))


def _record(page_id: int | None, url: str | None, payload: str | None, digest: str, size: int, revisit: bool, refers_to: int | None) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: {size}\r\n\r\n".encode()
    body = http if revisit else http + (payload or "").encode()
    target = "".join(c if "!" <= c <= "~" else "".join(f"%{b:02X}" for b in c.encode()) for c in url or "")
    lines = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>", f"WARC-Date: {DATE}",
        *([f"WARC-Target-URI: {target}"] if url is not None else []), f"WARC-Payload-Digest: sha1:{digest}",
        *([f"WARC-Refers-To: <urn:page:{refers_to}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"] if revisit else []),
        "Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}",
    ]
    return gzip.compress("\r\n".join(lines).encode() + b"\r\n\r\n" + body + b"\r\n\r\n", 6, mtime=0)


def _write(folder: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Captures (page_id, key, file, offset, length). A file's name is this attempt's own; only those of the attempt whose
    rows Spark keeps are ever read."""
    out, path, at = None, "", 0
    for batch in batches:
        rows = []
        for r in batch.to_pylist():
            if out is None or at >= ARCHIVE_BYTES:
                if out is not None:
                    out.close()
                path, at = f"{folder}/{uuid.uuid4().hex}.warc.gz", 0
                out = _create(path)
            data = _record(r["page_id"], r["url"], r["payload"], r["digest"], r["size"], r["revisit"], r["response"])
            out.write(data)
            rows.append((path, at, len(data)))
            at += len(data)
        if out is not None:
            out.flush()
        files, offsets, lengths = zip(*rows) if rows else ((), (), ())
        yield pa.RecordBatch.from_arrays(
            [batch["page_id"], batch["key"], pa.array(files, pa.string()), pa.array(offsets, pa.int64()), pa.array(lengths, pa.int64())],
            ["page_id", "key", "file", "offset", "length"],
        )
    if out is not None:
        out.close()


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> DataFrame:
    """Writes a record per row; gives the captures (page_id, key, file, offset, length), which must be kept in a table.

    Of records with equal payloads of REVISIT_BYTES or more, the one with the largest page_id is a response and the others
    revisit it; all others are responses. Payloads are told apart by SHA-1 and length. A null payload is empty; a null id
    is smaller than any; rows that repeat an id with its payload are responses each. Many copies of one payload meet
    the row that names their response in a join whose large keys Spark splits.
    """
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), url_key(F.col(url_col)).alias("key"),
        F.coalesce(payload_col, F.lit("")).alias("payload"),
    )
    rows = rows.withColumns({"digest": F.sha1("payload"), "size": F.octet_length("payload").cast("long")})
    large = F.col("size") >= REVISIT_BYTES
    responses = rows.filter(large).groupBy("digest", "size").agg(F.max("page_id").alias("response"))
    responses = Scratch(pages.sparkSession, "warc").table(responses)
    rows = rows.join(responses, ["digest", "size"], "left")
    revisit = F.col("response").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("response"))
    rows = rows.withColumn("revisit", revisit).withColumn("payload", F.when(~F.col("revisit"), F.col("payload")))
    return rows.select("page_id", "url", "key", "payload", "digest", "size", "revisit", "response").mapInArrow(
        lambda it: _write(folder, it), "page_id long, key string, file string, offset long, length long"
    )


#: A null id in the index: smaller than any id, as Spark sorts nulls first.
NO_ID = -(1 << 63) - 1


def _number(page_id: int | None) -> int:
    return NO_ID if page_id is None else page_id


def _line(r: dict) -> tuple[str, int, str, int, int]:
    return (r["key"], _number(r["page_id"]), r["file"], r["offset"], r["length"])


def _write_index(folder: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One index part of the sorted captures of a task: blocks in one file, their directory in another."""
    path, block, at, directory = f"{folder}/{uuid.uuid4().hex}", [], 0, []
    out = None

    def send():
        nonlocal at
        data = gzip.compress("".join("\t".join(map(str, x)) + "\n" for x in block).encode(), 6, mtime=0)
        directory.append((*block[0][:2], at, len(data)))
        out.write(data)
        at += len(data)
        block.clear()

    for batch in batches:
        for r in batch.to_pylist():
            out = out or _create(f"{path}.blocks")
            block.append(_line(r))
            if len(block) == BLOCK_LINES:
                send()
    if out is not None:
        if block:
            send()
        out.close()
        with _create(f"{path}.directory") as f:
            f.write("".join("\t".join(map(str, x)) + "\n" for x in directory).encode())
        key, page, *_ = directory[0]
        page = pa.array([None if page == NO_ID else page], pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array([key]), page, pa.array([path])], ["key", "page", "path"])


def write_index(captures: DataFrame, folder: str) -> list[tuple[str, int, str]]:
    """Writes the index; gives its parts in order: first key, first page_id, path. There is one part per sort partition."""
    parts = captures.repartitionByRange("key", "page_id").sortWithinPartitions("key", "page_id").mapInArrow(
        lambda it: _write_index(folder, it), "key string, page long, path string"
    )
    # the rows of the attempts that Spark kept; sorted by bytes, as Spark sorts
    return sorted(((r.key, _number(r.page), r.path) for r in parts.collect()), key=lambda p: (p[0].encode(), p[1]))


class _Index:
    """Bisects parts, directory and block. Look-ups come sorted, so each block is read and unpacked once."""

    def __init__(self, parts: list[tuple[str, int, str]]):
        self.parts, self.starts, self.ranges = parts, [(k.encode(), p) for k, p, _ in parts], _Ranges()
        self.directory, self.block = (None, [], []), (None, [], [])

    def find(self, key: str, page: int) -> list[tuple[str, int, int]]:
        """All captures of the page under the key."""
        goal, found = (key.encode(), page), []
        part = max(0, bisect_right(self.starts, goal) - 1)
        # equal captures may begin in the part or block before
        while part > 0 and self.starts[part] == goal:
            part -= 1
        while part < len(self.parts) and self.starts[part] <= goal:
            rows, firsts = self._directory(part)
            i = max(0, bisect_right(firsts, goal) - 1)
            while i > 0 and firsts[i] == goal:
                i -= 1
            while i < len(rows) and firsts[i] <= goal:
                keys, lines = self._block(part, i, rows[i])
                j = bisect_right(keys, goal)
                while j > 0 and keys[j - 1] == goal:
                    j -= 1
                    found.append((lines[j][2], int(lines[j][3]), int(lines[j][4])))
                i += 1
            part += 1
        return found

    def _directory(self, part: int):
        if self.directory[0] != part:
            system, place = _open(f"{self.parts[part][2]}.directory")
            with system.open_input_stream(place, compression=None) as f:
                rows = [x.split("\t") for x in f.read().decode().split("\n")[:-1]]
            self.directory = (part, rows, [(x[0].encode(), int(x[1])) for x in rows])
        return self.directory[1:]

    def _block(self, part: int, i: int, row: list[str]):
        if self.block[0] != (part, i):
            data = self.ranges.read(f"{self.parts[part][2]}.blocks", int(row[2]), int(row[3]))
            lines = [x.split("\t") for x in gzip.decompress(data).decode().split("\n")[:-1]]
            self.block = ((part, i), [(x[0].encode(), int(x[1])) for x in lines], lines)
        return self.block[1:]


def look_up(wanted: DataFrame, parts: list[tuple[str, int, str]]) -> DataFrame:
    """Captures (file, offset, length) of the pages in `wanted` (key, page_id), each once, however often it is wanted."""
    find_package(wanted.sparkSession)
    held = wanted.sparkSession.sparkContext.broadcast(parts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = _Index(held.value)
        for batch in batches:
            pages = map(_number, batch["page_id"].to_pylist())
            rows = [x for k, p in zip(batch["key"].to_pylist(), pages) for x in index.find(k, p)]
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows) if rows else ((),) * 3, (pa.string(), pa.int64(), pa.int64()))], ["file", "offset", "length"])

    ordered = wanted.select("key", "page_id").distinct().repartitionByRange("key", "page_id").sortWithinPartitions("key", "page_id")
    return ordered.mapInArrow(run, "file string, offset long, length long")


def parse_record(data: bytes) -> dict:
    """A record's page_id, url, type, payload, payload size and digest; a response whose digest is wrong is an error."""
    head, _, body = gzip.decompress(data).partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
    body = body[: int(fields["Content-Length"])]
    http, _, payload = body.partition(b"\r\n\r\n")
    size = int(dict(x.split(": ", 1) for x in http.decode().split("\r\n")[1:])["Content-Length"])
    digest, kind = fields["WARC-Payload-Digest"].removeprefix("sha1:"), fields["WARC-Type"]
    if kind == "response" and (len(payload), hashlib.sha1(payload).hexdigest()) != (size, digest):
        raise ValueError(f"the payload of {fields['WARC-Record-ID']} is damaged")

    def page(name: str) -> int | None:
        digits = fields.get(name, "").removeprefix("<urn:page:").removesuffix(">")
        return int(digits) if digits else None

    return {
        "page_id": page("WARC-Record-ID"), "url": fields.get("WARC-Target-URI"), "record_type": kind, "payload": payload if kind == "response" else None,
        "payload_bytes": size, "payload_digest": digest, "refers_to": page("WARC-Refers-To"),
    }


def read_records(captures: DataFrame) -> DataFrame:
    """The records at the given ranges (file, offset, length): page_id, url, record_type, payload (null for a revisit),
    payload_bytes and payload_digest of the full payload, refers_to. Ranges of one archive are read in order."""
    schema = "page_id long, url string, record_type string, payload binary, payload_bytes long, payload_digest string, refers_to long"
    types = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload", pa.binary()),
                       ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranges = _Ranges()
        for batch in batches:
            for a in range(0, len(batch), 500):
                part = batch.slice(a, 500).to_pylist()
                yield pa.RecordBatch.from_pylist([parse_record(ranges.read(r["file"], r["offset"], r["length"])) for r in part], types)

    # a number of its own: a range is a few bytes here, and tasks joined by those would each read far too much
    parts = int(captures.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return captures.repartitionByRange(parts, "file", "offset").sortWithinPartitions("file", "offset").mapInArrow(run, schema)

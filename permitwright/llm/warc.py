"""WARC archives: records written by Spark tasks, and a sequential reader.

An archive is a file of gzip members, one per record. The reader inflates as it goes, takes a record's block by its
content length, and checks digests; a record that breaks a rule comes out as such instead of ending the job.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from typing import BinaryIO

import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from permitwright.llm.common import saved
from permitwright.session import fresh_dir

# Payloads of at least so many bytes may be stored once for several pages.
REVISIT_BYTES = 1000
ARCHIVE_BYTES = 64 << 20
_READ = 1 << 20
# How a gzip member begins, and bytes that show what one inflates to.
_GZIP, _ENOUGH = b"\x1f\x8b\x08", 4096
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _store(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def _digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def _record(fields: list[tuple[str, str]], block: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in [*fields, ("Content-Length", str(len(block)))])
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    data = b"WARC/1.1\r\n" + head.encode("utf-8") + b"\r\n" + block + b"\r\n\r\n"
    return packer.compress(data) + packer.flush()


def _one_line(text: str | None) -> str:
    return " ".join((text or "").split())


def page_record(name: str, url: str | None, payload: bytes, same_as: str | None, date: str) -> bytes:
    """A response record, or a revisit record that names the response with the same payload and leaves it out.

    Either block starts with the HTTP head, whose content length is that of the full payload.
    """
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if same_as else http + payload
    fields = [
        ("WARC-Type", "revisit" if same_as else "response"), ("WARC-Record-ID", f"<{name}>"), ("WARC-Date", date),
        *[("WARC-Target-URI", _one_line(url))] * (url is not None), ("WARC-Payload-Digest", _digest(payload)),
        ("WARC-Block-Digest", _digest(block)), ("Content-Type", "application/http; msgtype=response"),
    ]
    if same_as:
        fields += [("WARC-Profile", _PROFILE), ("WARC-Refers-To", f"<{same_as}>")]
    return _record(fields, block)


def page_name(page_id: int | None) -> str:
    return f"urn:page:{'' if page_id is None else page_id}"


def with_revisits(pages: DataFrame, id_col: str, url_col: str, payload_col: str) -> DataFrame:
    """(page_id, url, payload, refers_to): refers_to is the page whose response a page's record points to.

    Among equal payloads of REVISIT_BYTES or more that is the largest id, found by digest and length; the page with that
    id itself, and every smaller payload, has null. Pages without an id come last in that order, and rows that repeat
    the largest id are responses both. The largest ids combine in the map tasks, and only digests that occur twice meet the pages
    again, in a join that Spark splits on a hot digest.
    """
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
        F.encode(F.coalesce(F.col(payload_col), F.lit("")), "UTF-8").alias("payload"))
    keyed = rows.withColumn("size", F.octet_length("payload")).withColumn(
        "digest", F.when(F.col("size") >= REVISIT_BYTES, F.concat(F.sha1("payload"), F.col("size").cast("string"))))
    newest = keyed.where("digest is not null").groupBy("digest").agg(F.max("page_id").alias("last"), F.count("*").alias("n"))
    newest = saved(newest.where("n > 1").select("digest", "last"), "equal-payloads")
    joined = keyed.join(newest, "digest", "left")
    other = F.col("last").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("last"))
    return joined.select("page_id", "url", "payload", F.when(other, F.col("last")).alias("refers_to"))


def write_archives(rows: DataFrame, folder: str | None = None, limit: int = ARCHIVE_BYTES,
                   date: str = "2000-01-01T00:00:00Z") -> DataFrame:
    """Write the rows of `with_revisits` as archives of about `limit` bytes; returns (path, records, bytes) per archive.

    The archives go to `folder`, or to a new one in the cluster's shared folder, under names no other attempt uses; the
    list holds what finished tasks wrote and is itself written down, so a task that runs twice leaves a file that
    nobody reads. A record is in memory by itself. An empty table gives an empty list.
    """
    folder = folder or fresh_dir(rows.sparkSession, "archives")
    _store(folder)[0].create_dir(_store(folder)[1], recursive=True)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, base = _store(folder)
        out, name, records, size = None, "", 0, 0
        for frame in frames:
            for page_id, url, payload, same in frame.itertuples(index=False):
                if out is None:
                    name, records, size = f"{base}/{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = store.open_output_stream(name, compression=None)
                member = page_record(page_name(None if pd.isna(page_id) else int(page_id)), url, payload,
                                     None if pd.isna(same) else page_name(int(same)), date)
                out.write(member)
                records, size = records + 1, size + len(member)
                if size >= limit:
                    out.close()
                    out = None
                    yield pd.DataFrame({"path": [name], "records": [records], "bytes": [size]})
        if out is not None:
            out.close()
            yield pd.DataFrame({"path": [name], "records": [records], "bytes": [size]})

    done = rows.select("page_id", "url", "payload", "refers_to").mapInPandas(run, "path string, records long, bytes long")
    scheme = folder.split("://")[0] + "://" if "://" in folder else ("file:" if folder.startswith("file:") else "")
    return saved(done.withColumn("path", F.concat(F.lit(scheme or "file://"), F.col("path"))), "archive-list")


class _Member:
    """The inflated bytes of one gzip member after another, from a stream that is read in blocks."""

    def __init__(self, stream: BinaryIO) -> None:
        self.stream, self.rest, self.inflate, self.ready = stream, b"", None, b""

    def start(self) -> bool:
        """Go to the next member; false at the end of the file."""
        self.ready = b""
        self.rest = self.rest or self.stream.read(_READ)
        self.inflate = zlib.decompressobj(31)
        return bool(self.rest)

    def more(self) -> bytes:
        """The next inflated bytes, empty at the end of the member."""
        while not self.inflate.eof:
            data = self.rest or self.stream.read(_READ)
            if not data:
                raise ValueError("the archive ends inside a record")
            self.rest = data  # where to look for the next member, should these bytes be broken
            out = self.inflate.decompress(data, _READ)
            self.rest = self.inflate.unused_data if self.inflate.eof else self.inflate.unconsumed_tail
            if out:
                return out
        return b""

    def resume(self) -> None:
        """After bytes that do not inflate: go to the next gzip header that begins a record, or to the end of the file."""
        rest = self.rest[1:]
        while True:
            at = rest.find(_GZIP)
            if at < 0:
                part = self.stream.read(_READ)
                if not part:
                    self.rest = b""
                    return
                rest = rest[-2:] + part
                continue
            rest = rest[at:]
            while len(rest) < _ENOUGH and (part := self.stream.read(_READ)):
                rest += part
            try:
                if zlib.decompressobj(31).decompress(rest[:_ENOUGH], 5) == b"WARC/":
                    self.rest = rest
                    return
            except zlib.error:
                pass
            rest = rest[1:]

    def until(self, mark: bytes) -> bytes:
        """What stands before the mark, however long; only new bytes are searched."""
        ready, seen = bytearray(self.ready), 0
        while (at := ready.find(mark, seen)) < 0:
            seen = max(0, len(ready) - len(mark) + 1)
            part = self.more()
            if not part:
                raise ValueError("a record's head does not end")
            ready += part
        self.ready = bytes(ready[at + len(mark) :])
        return bytes(ready[:at])

    def exactly(self, size: int) -> bytes:
        parts, have = [self.ready], len(self.ready)
        while have < size and (part := self.more()):
            parts.append(part)
            have += len(part)
        data = b"".join(parts)
        if have < size:
            raise ValueError("a record's block is shorter than its content length")
        self.ready = data[size:]
        return data[:size]

    def close(self) -> None:
        tail = self.ready
        while part := self.more():
            tail += part
        if tail != b"\r\n\r\n":
            raise ValueError("a record does not end after its block")


def _fields(lines: str) -> dict[str, str]:
    pairs = (line.partition(":") for line in lines.split("\r\n")[1:])
    return {k.strip().lower(): v.strip() for k, sep, v in pairs if sep}


def records(stream: BinaryIO) -> Iterator[dict]:
    """The records of an archive in order. A broken one has its `error`; the next one that begins as a record should follows."""
    members = _Member(stream)
    while members.start():
        found = {"error": None}
        try:
            head = members.until(b"\r\n\r\n").decode("utf-8", "replace")
            if not head.startswith("WARC/"):
                raise ValueError("not a WARC record")
            fields = _fields(head)
            block = members.exactly(int(fields.get("content-length", "-1")))
            members.close()
            found |= {"fields": fields, "block": block}
            claimed = fields.get("warc-block-digest", "")
            if claimed.startswith("sha1:") and claimed != _digest(block):
                found["error"] = "the block's digest differs"
        except (ValueError, zlib.error) as problem:
            found["error"] = str(problem)
            yield found
            try:  # the rest of a broken record, up to the next one
                if isinstance(problem, zlib.error):
                    raise problem
                while members.more():
                    pass
            except zlib.error:
                members.resume()
            except ValueError:
                return
            continue
        yield found


def _row(path: str, found: dict) -> dict:
    """A record's columns. A field that breaks its own rules makes the row's `error` and stays null."""
    row = {"path": path, "error": found["error"]}
    if "block" not in found:
        return row
    fields, block = found["fields"], found["block"]
    kind = fields.get("warc-type")
    carries = kind in ("response", "revisit")
    head, _, payload = block.partition(b"\r\n\r\n") if carries else (b"", b"", block)
    http = _fields(head.decode("utf-8", "replace"))
    claimed = fields.get("warc-payload-digest", "")

    def told(problem: str) -> None:
        row["error"] = row["error"] or problem

    def named(key: str) -> int | None:
        name = fields.get(key, "").strip("<>").removeprefix("urn:page:")
        return int(name) if re.fullmatch("-?[0-9]{1,18}", name) else None

    length = http.get("content-length", str(len(payload)))
    if not re.fullmatch("[0-9]{1,18}", length):
        told("the payload's length is no number")
        length = None
    digest = None
    if claimed.startswith("sha1:"):
        try:
            digest = base64.b32decode(claimed.removeprefix("sha1:")).hex()
        except binascii.Error:
            told("the payload's digest cannot be read")
    if kind == "response" and claimed and digest and claimed != _digest(payload):
        told("the payload's digest differs")
    # What is coded for the way has another length than what was sent.
    if kind == "response" and length is not None and "transfer-encoding" not in http and int(length) != len(payload):
        told("the payload's length differs")
    return row | {
        "page_id": named("warc-record-id"), "record_id": fields.get("warc-record-id"), "url": fields.get("warc-target-uri"),
        "record_type": kind, "payload_bytes": int(length) if length is not None else None,
        "payload_digest": digest, "refers_to": named("warc-refers-to"), "payload": payload if kind != "revisit" else None,
    }


_COLUMNS = {
    "page_id": "long", "url": "string", "record_type": "string", "payload_bytes": "long", "payload_digest": "string",
    "refers_to": "long", "payload": "binary", "path": "string", "error": "string", "record_id": "string",
}


def read_archives(spark: SparkSession, paths: DataFrame, payloads: bool = True) -> DataFrame:
    """One row per record of the archives in `paths` (column path), each archive read front to back by one task.

    payload_bytes and payload_digest (SHA-1, hexadecimal) describe the full payload, also for a revisit record, whose
    payload is null. Records of other types come with their block as payload, foreign ids in record_id alone; a record that
    breaks a rule has its `error`, and what follows it is read. Null paths are skipped; no paths give no rows. `payloads=False` leaves the payloads out, after
    they have been read and checked.
    """
    names = [c for c in _COLUMNS if payloads or c != "payload"]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for path in frame["path"]:
                store, place = _store(path)
                with store.open_input_stream(place, compression=None) as stream:
                    rows, size = [], 0
                    for found in records(stream):
                        rows.append(_row(path, found))
                        size += len(found.get("block", b""))
                        if size > 8 << 20 or len(rows) >= 2000:
                            yield _frame(rows, names)
                            rows, size = [], 0
                    yield _frame(rows, names)

    one_each = paths.where("path is not null").select("path").repartition(
        max(1, int(spark.conf.get("spark.sql.shuffle.partitions"))), "path")
    return one_each.mapInPandas(run, ", ".join(f"{c} {_COLUMNS[c]}" for c in names))


def _frame(rows: list[dict], names: list[str]) -> pd.DataFrame:
    frame = pd.DataFrame(rows, columns=names, dtype=object)
    whole = {c: "Int64" for c in ("page_id", "payload_bytes", "refers_to")}
    return frame.astype(whole)

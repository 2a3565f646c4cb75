"""WARC archives with a two-level capture index.

Archives hold one gzip member per record. The index has a line per record, ordered by reversed-host
url key and record key, in compressed blocks; a directory keeps the first key of each block. A look-up
bisects the directory, reads and unpacks one block by its range, bisects its lines, and reads the
record by its range. Archives, blocks and directories are files in the shared folder, one each per
task, written under names no other task attempt uses; only files that a finished task has told of are read.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyarrow.fs import FileSystem
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataprop.functions.runtime import shared_folder, shuffle_partitions, stage
from strataprop.llm.batches import bound_batches
from strataprop.operators.joins import equi_join

RESPONSE, REVISIT = "response", "revisit"
#: Index lines in one compressed block.
BLOCK_LINES = 3000
#: Fixed values of the WARC 1.1 format.
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {}\r\n\r\n"


class Archive(NamedTuple):
    """Where the records lie, and the index over them: one row per index part."""

    records: DataFrame
    parts: DataFrame


def url_key(url: Column) -> Column:
    """The url with its host's labels backwards, lower-cased, and without scheme: sorts by site."""
    whole = F.coalesce(url, F.lit(""))
    host = F.lower(F.regexp_extract(whole, r"(?s)^(?:.*?://)?([^/?#]*)", 1))
    rest = F.regexp_extract(whole, r"(?s)^(?:.*?://)?[^/?#]*(.*)$", 1)
    back = F.array_join(F.reverse(F.split(host, r"\.", -1)), ",")
    # control characters would break an index line
    return F.regexp_replace(F.concat(back, F.lit(")"), rest), r"[\x00-\x20]", "%20")


def with_roles(pages: DataFrame, key: str, url: str, payload: str, min_bytes: int) -> DataFrame:
    """Each page with its payload, and ``refers_to``: the smallest key of its payload if another's.

    Pages of a payload that very many share, and small pages, are spread over the join's tasks.
    """
    body = F.coalesce(F.col(payload), F.lit("")).cast("binary")
    rows = pages.select(F.col(key).alias("key"), F.col(url).alias("url"), body.alias("payload")).withColumn(
        "sha1", F.when(F.octet_length("payload") >= min_bytes, F.sha1("payload")))
    first = stage(rows.filter("sha1 is not null").groupBy("sha1").agg(
        F.min("key").alias("first"), F.count(F.lit(1)).alias("copies")).filter("copies > 1").select("sha1", "first"))
    joined = equi_join(rows, first, "sha1", spread_by=["key", "url"])
    refers = F.when(F.col("first").isNotNull() & ~F.col("first").eqNullSafe(F.col("key")), F.col("first"))
    return joined.select("key", "url", "payload", refers.alias("refers_to"))


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record_id(key: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, 'record:' + key)}>"


def record(key: str | None, url: str | None, payload: bytes, refers_to: str | None) -> bytes:
    """One record as a gzip member of its own."""
    head = HTTP_HEAD.format(len(payload)).encode()
    body = head if refers_to is not None else head + payload
    uri = "".join(c if " " < c != "\x7f" else f"%{ord(c):02X}" for c in url or "urn:unknown")
    fields = [("WARC-Type", RESPONSE if refers_to is None else REVISIT),
              ("WARC-Record-ID", _record_id(key if key is not None else uuid.uuid4().hex)),
              ("WARC-Date", "1970-01-01T00:00:00Z"), ("WARC-Target-URI", uri),
              ("WARC-Payload-Digest", "sha1:" + payload_digest(payload)),
              ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(body)))]
    if key is not None:
        fields.append(("X-Record-Key", key))
    if refers_to is not None:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", _record_id(refers_to)),
                   ("X-Refers-To-Key", refers_to)]
    lines = VERSION + "\r\n" + "".join(f"{name}: {value}\r\n" for name, value in fields) + "\r\n"
    return gzip.compress(lines.encode() + body + b"\r\n\r\n", 6, mtime=0)


def parse(member: bytes) -> dict:
    """The fields of one record; the digest of a response is taken from its payload anew."""
    raw = gzip.decompress(member)
    head, _, rest = raw.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if version != VERSION:
        raise ValueError(f"not a {VERSION} record")
    fields = dict(line.split(": ", 1) for line in lines)
    http, _, payload = rest[: int(fields["Content-Length"])].partition(b"\r\n\r\n")
    size = int(http.decode().rsplit("Content-Length: ", 1)[1])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if fields["WARC-Type"] == RESPONSE and (len(payload) != size or payload_digest(payload) != digest):
        raise ValueError(f"payload of {fields['WARC-Record-ID']} does not fit its digest")
    return {"key": fields.get("X-Record-Key"), "uri": fields["WARC-Target-URI"], "payload_bytes": size,
            "payload_digest": digest, "record_type": fields["WARC-Type"],
            "refers_to": fields.get("X-Refers-To-Key"), "payload": payload}


def write_archive(rows: DataFrame, folder: str) -> Archive:
    """Write rows of key, url, payload and refers_to as archives under ``folder``, and index them."""
    bound_batches(rows.sparkSession)
    files, root = FileSystem.from_uri(folder)
    files.create_dir(root, recursive=True)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, out, at = TaskContext.get(), None, 0
        name = f"part-{task.partitionId():05d}-{task.taskAttemptId()}.warc.gz"
        files, root = FileSystem.from_uri(folder)
        for batch in batches:
            offsets, sizes = [], []
            for key, url, payload, refers_to in zip(*[batch.column(k) for k in range(1, 5)]):
                out = out or files.open_output_stream(f"{root}/{name}", compression=None)
                member = record(key.as_py(), url.as_py(), payload.as_py(), refers_to.as_py())
                out.write(member)
                offsets.append(at)
                sizes.append(len(member))
                at += len(member)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([k or "" for k in batch.column(1).to_pylist()], pa.string()),
                 pa.array([name] * len(sizes)), pa.array(offsets, pa.int64()), pa.array(sizes, pa.int64())],
                ["url_key", "key", "file", "start", "length"])
        if out:
            out.close()

    text = rows.select(url_key(F.col("url")).alias("url_key"), F.col("key").cast("string").alias("key"),
                       "url", "payload", F.col("refers_to").cast("string").alias("refers_to"))
    records = stage(text.mapInArrow(write, "url_key string, key string, file string, start long, length long"))
    return Archive(records, _index(records, folder))


def _index(records: DataFrame, folder: str) -> DataFrame:
    """Write blocks and directories of the sorted lines; a row per part: its first key and its file."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        name = f"index-{task.partitionId():05d}-{task.taskAttemptId()}"
        files, root = FileSystem.from_uri(folder)
        out, lines, directory, at = None, [], [], 0

        def close_block() -> None:
            nonlocal out, at
            out = out or files.open_output_stream(f"{root}/{name}.blocks", compression=None)
            block = zlib.compress("\n".join(lines).encode())
            out.write(block)
            directory.append("\t".join([*lines[0].split("\t")[:2], str(at), str(len(block))]))
            at += len(block)
            lines.clear()

        for batch in batches:
            for row in zip(*[c.to_pylist() for c in batch.columns]):
                lines.append("\t".join(map(str, row)))
                if len(lines) == BLOCK_LINES:
                    close_block()
        if lines:
            close_block()
        if out:
            out.close()
            with files.open_output_stream(f"{root}/{name}.directory", compression=None) as listing:
                listing.write("\n".join(directory).encode())
            url, key = directory[0].split("\t")[:2]
            yield pa.RecordBatch.from_pydict({"url_key": [url], "key": [key], "name": [name]})

    return stage(records.repartitionByRange(shuffle_partitions(records.sparkSession), "url_key", "key")
                 .sortWithinPartitions("url_key", "key").mapInArrow(write, "url_key string, key string, name string"))


class _Part:
    """One index part, read by ranges: its directory stays in memory, and the last block."""

    def __init__(self, files: FileSystem, root: str, name: str):
        with files.open_input_stream(f"{root}/{name}.directory", compression=None) as listing:
            rows = [line.split("\t") for line in listing.read().decode().split("\n")]
        self.firsts = [(url, key) for url, key, _, _ in rows]
        self.ranges = [(int(at), int(size)) for _, _, at, size in rows]
        self.blocks = files.open_input_file(f"{root}/{name}.blocks")
        self.held, self.lines, self.keys = -1, [], []

    def _load(self, number: int) -> None:
        if number != self.held:
            at, size = self.ranges[number]
            self.blocks.seek(at)
            text = zlib.decompress(self.blocks.read(size)).decode()
            self.lines = [line.split("\t") for line in text.split("\n")]
            self.keys = [(line[0], line[1]) for line in self.lines]
            self.held = number

    def find(self, wanted: tuple[str, str]) -> Iterator[list[str]]:
        """All lines with that url key and record key, which may go over several blocks."""
        number = max(0, bisect_left(self.firsts, wanted) - 1)
        while number < len(self.firsts) and self.firsts[number] <= wanted:
            self._load(number)
            yield from self.lines[bisect_left(self.keys, wanted) : bisect_right(self.keys, wanted)]
            number += 1


def look_up(archive: Archive, wanted: DataFrame, folder: str) -> DataFrame:
    """File, start and length of every record with a ``url_key`` and ``key`` of ``wanted``."""
    # one row per index part: as many as shuffle partitions, whatever the input
    parts = sorted((row["url_key"], row["key"], row["name"]) for row in archive.parts.collect())
    firsts, names = [p[:2] for p in parts], [p[2] for p in parts]

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
            part = [max(0, bisect_right(firsts, key) - 1) for key in keys]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(part, pa.int64())], ["url_key", "key", "part"])

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = FileSystem.from_uri(folder)
        number, part = -1, None
        for batch in batches:
            found = []
            for url, key, own in zip(*[c.to_pylist() for c in batch.columns]):
                if own != number:
                    number, part = own, _Part(files, root, names[own])
                found += part.find((url, key))
            yield pa.RecordBatch.from_pydict({
                "file": pa.array([x[2] for x in found], pa.string()),
                "start": pa.array([int(x[3]) for x in found], pa.int64()),
                "length": pa.array([int(x[4]) for x in found], pa.int64())})

    if not names:
        return archive.records.select("file", "start", "length").limit(0)
    keys = wanted.select("url_key", "key").distinct()
    placed = keys.mapInArrow(assign, "url_key string, key string, part long")
    return (placed.repartitionByRange(shuffle_partitions(wanted.sparkSession), "part", "url_key", "key")
            .sortWithinPartitions("part", "url_key", "key")
            .mapInArrow(find, "file string, start long, length long"))


READ_SCHEMA = ("key string, uri string, payload_bytes long, payload_digest string, record_type string, "
               "refers_to string")


def read_records(places: DataFrame, folder: str, payload: bool = False) -> DataFrame:
    """Read records by their ranges, in the order of the files; with ``payload`` the body too."""
    schema = READ_SCHEMA + (", payload binary" if payload else "")
    names = [c.split()[0] for c in schema.split(", ")]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = FileSystem.from_uri(folder)
        name, source = None, None
        for batch in batches:
            found = []
            for file, start, length in zip(*[c.to_pylist() for c in batch.columns]):
                if file != name:
                    name, source = file, files.open_input_file(f"{root}/{file}")
                source.seek(start)
                fields = parse(source.read(length))
                found.append({c: fields[c] for c in names})
                if len(found) == 1000:
                    yield pa.RecordBatch.from_pylist(found, arrow)
                    found = []
            yield pa.RecordBatch.from_pylist(found, arrow)

    kinds = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
    arrow = pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in schema.split(", ")])
    spark = places.sparkSession
    return (places.repartitionByRange(shuffle_partitions(spark), "file", "start")
            .sortWithinPartitions("file", "start").mapInArrow(read, schema))


def archive_round_trip(
    pages: DataFrame, key: str = "page_id", url: str = "url", payload: str = "html", min_bytes: int = 0,
) -> DataFrame:
    """Archive every page, find every record through the index, and return what was read back.

    Columns: the key, ``payload_bytes``, ``payload_digest`` (base32 SHA-1), ``record_type``, ``refers_to``.
    Of pages with equal payloads of ``min_bytes`` or more the one with the smallest key is a response
    and the others revisit it; rows that repeat the smallest key are responses too. A null payload
    is empty; a null url is archived as ``urn:unknown``; a page with a null key revisits if a page
    with a key has its payload, and else is a response. Every row gets a record, repeated ones too.
    An empty table gives no rows; other columns are not archived.
    """
    kind = pages.schema[key].dataType
    folder = f"{shared_folder(pages.sparkSession).rstrip('/')}/warc-{uuid.uuid4().hex}"
    rows = with_roles(pages, key, url, payload, min_bytes)
    archive = write_archive(rows, folder)
    wanted = pages.select(url_key(F.col(url)).alias("url_key"),
                          F.coalesce(F.col(key).cast("string"), F.lit("")).alias("key"))
    back = read_records(look_up(archive, wanted, folder), folder)
    return back.select(F.col("key").cast(kind).alias(key), "payload_bytes", "payload_digest", "record_type",
                       F.col("refers_to").cast(kind).alias("refers_to"))

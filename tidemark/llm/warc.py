"""WARC archives with a two-level capture index.

Captures are dealt and sorted by reversed-host key; a task writes one gzip member per record, in that
order, into archives of its own, and packs the captures into compressed blocks of its index file. Each
index file ends with a sparse directory, one entry per block, and a footer that says where it is. A
look-up finds the file by the files' first keys, the block by binary search in the directory, and the
record by a range read of its archive; records that are neighbours by key are neighbours there too, and
are read together.

Keys end in the page, so that a host or url that holds a third of the captures still spreads
over many blocks and files. Which page a revisit refers to is settled among digests, and travels to
the page's place as a small row ahead of it, so equal payloads never meet. What the driver sees is one
entry per index file.
"""

import gzip
import hashlib
import json
import posixpath
import struct
import uuid
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import new_folder, stored

MIN_PAYLOAD = 100
BLOCK_ENTRIES = 512
FILE_ENTRIES = 1_000_000
# One entry per index file is held by the driver and sent to tasks, 200 bytes or so each.
INDEX_FILES = 100_000
ARCHIVE_BYTES = 1 << 30
# What is read at a time where records follow on one another.
READ_BYTES = 1 << 20
DATE = "2026-01-01T00:00:00Z"
FOOTER, FOOTER_BYTES = "<QQ", 16
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

FILES = "key string, page_id long, file string"
RECORDS = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def file_system(root: str) -> tuple["pa.fs.FileSystem", str]:
    from pyarrow import fs

    if "://" in root or root.startswith("file:"):
        # Arrow knows Hadoop's `s3a` as `s3`.
        return fs.FileSystem.from_uri(root.replace("s3a://", "s3://", 1))
    return fs.LocalFileSystem(), root


def capture_key(url: str | None) -> str:
    """`https://m.example.org/a?b` as `org,example,m)/a?b`; empty for null."""
    _, _, rest = (url or "").partition("://")
    rest = (rest or url or "").partition("#")[0]
    host = rest.replace("?", "/", 1).partition("/")[0]
    return ",".join(reversed(host.lower().split("."))) + ")" + rest[len(host) :] if rest else ""


def order_of(key: str, page_id: int | None) -> tuple:
    """Sorts as Spark does: by code points, a null page first."""
    return key, page_id is not None, page_id or 0


def _clean(value: str) -> str:
    return "".join(c if c.isprintable() else "".join(f"%{b:02X}" for b in c.encode("utf-8", "surrogatepass")) for c in value)


def _record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}:{digest}')}>"


def pack(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, date: str) -> bytes:
    """One record as a gzip member: a response with its payload, or a revisit without."""
    status = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    revisit = refers_to is not None
    block = status if revisit else status + payload
    headers = {
        "WARC-Type": "revisit" if revisit else "response",
        "WARC-Record-ID": _record_id(page_id, digest),
        "WARC-Target-URI": _clean(url or ""),
        "WARC-Date": date,
        "WARC-Payload-Digest": f"sha256:{digest}",
        "Page-ID": "" if page_id is None else str(page_id),
        "Payload-Length": str(len(payload)),
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": str(len(block)),
    }
    if revisit:
        headers |= {
            "WARC-Profile": REVISIT_PROFILE,
            "WARC-Refers-To": _record_id(refers_to, digest),
            "Refers-To-Page-ID": str(refers_to),
        }
    head = "WARC/1.1\r\n" + "".join(f"{name}: {value}\r\n" for name, value in headers.items()) + "\r\n"
    return gzip.compress(head.encode("utf-8", "surrogatepass") + block + b"\r\n\r\n", 6, mtime=0)


def unpack(member: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and payload of a record; raises if a response's payload has another digest."""
    head, _, rest = gzip.decompress(member).partition(b"\r\n\r\n")
    headers = dict(line.split(": ", 1) for line in head.decode("utf-8", "surrogatepass").split("\r\n")[1:])
    block = rest[: int(headers["Content-Length"])]
    payload = block.partition(b"\r\n\r\n")[2]
    if headers["WARC-Type"] == "response":
        digest = hashlib.sha256(payload).hexdigest()
        if headers["WARC-Payload-Digest"] != f"sha256:{digest}":
            raise ValueError(f"damaged record {headers['WARC-Record-ID']}")
    return headers, payload


class _Archives:
    """The archives of a task, one after another, under names of their own for each attempt."""

    def __init__(self, root: str):
        self.target, self.base = file_system(root)
        self.target.create_dir(self.base, recursive=True)
        self.name, self.out, self.offset = "", None, 0

    def add(self, member: bytes) -> tuple[str, int, int]:
        if self.out is None or self.offset >= ARCHIVE_BYTES:
            self.close()
            self.name, self.offset = f"{uuid.uuid4().hex}.warc.gz", 0
            self.out = self.target.open_output_stream(posixpath.join(self.base, self.name), compression=None)
        self.out.write(member)
        self.offset += len(member)
        return self.name, self.offset - len(member), len(member)

    def close(self) -> None:
        if self.out is not None:
            self.out.close()


class _IndexFile:
    """The index file of a task: blocks of captures, then the directory, then where that is."""

    def __init__(self, root: str):
        self.target, self.base = file_system(root)
        self.target.create_dir(self.base, recursive=True)
        self.name, self.out, self.offset = f"{uuid.uuid4().hex}.idx", None, 0
        self.held, self.directory = [], []

    def add(self, entry: tuple) -> None:
        self.held.append(entry)
        if len(self.held) == BLOCK_ENTRIES:
            self._flush()

    def _flush(self) -> None:
        if self.out is None:
            self.out = self.target.open_output_stream(posixpath.join(self.base, self.name), compression=None)
        block = gzip.compress("\n".join(json.dumps(entry) for entry in self.held).encode(), 6, mtime=0)
        self.directory.append([*self.held[0][:2], self.offset, len(block)])
        self.out.write(block)
        self.offset += len(block)
        self.held = []

    def close(self) -> list[tuple]:
        """The first capture and the name of the file, if there are any."""
        if self.held:
            self._flush()
        if self.out is None:
            return []
        block = gzip.compress(json.dumps(self.directory).encode(), 6, mtime=0)
        self.out.write(block)
        self.out.write(struct.pack(FOOTER, self.offset, len(block)))
        self.out.close()
        return [(*self.directory[0][:2], self.name)]


def _write_captures(root: str, date: str):
    """Reads captures by key, before each revisit what it refers to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archives, index = _Archives(f"{root}/archives"), _IndexFile(f"{root}/index")
        told, refers_to = None, None
        for batch in batches:
            for row in batch.to_pylist():
                place = row["key"], row["page_id"], row["digest"]
                if row["is_page"]:
                    payload = row["payload"].encode("utf-8", "surrogatepass")
                    refers = refers_to if place == told else None
                    member = pack(row["page_id"], row["url"], payload, row["digest"], refers, date)
                    index.add((row["key"], row["page_id"], *archives.add(member)))
                else:
                    told, refers_to = place, row["refers_to"]
        archives.close()
        for key, page_id, file in index.close():
            arrays = [pa.array([key], pa.string()), pa.array([page_id], pa.int64()), pa.array([file], pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, names=["key", "page_id", "file"])

    return run


def _keys(urls: pd.Series) -> pd.Series:
    return pd.Series([capture_key(url) for url in urls], dtype=object)


@dataclass(frozen=True)
class CaptureIndex:
    """Where archives and index files lie, and each index file with its first capture, in order."""

    archives: str
    files_root: str
    firsts: tuple[tuple, ...]
    files: tuple[str, ...]


def write(pages: DataFrame, root: str, date: str = DATE) -> CaptureIndex:
    """Archives `page_id, url, html` below `root` and indexes the captures.

    Of equal payloads of at least 100 bytes the smallest page_id is a response, the others
    are revisits of it. A null html is an empty payload. Rows that repeat the smallest
    page_id are all responses; a null page_id revisits, unless all of its copies are null.
    """
    spark = pages.sparkSession
    payload = F.coalesce("html", F.lit(""))
    digest = F.sha2(payload.cast("binary"), 256).alias("digest")
    key = F.pandas_udf(_keys, "string")("url").alias("key")
    digests = stored(pages.select("page_id", key, digest, F.octet_length(payload).alias("bytes")), "warc-digests")
    copies = digests.filter(F.col("bytes") >= MIN_PAYLOAD).groupBy("digest")
    first = copies.agg(F.min("page_id").alias("refers_to"), F.count("*").alias("n")).filter("n > 1 and refers_to is not null")
    revisits = digests.join(first.drop("n"), "digest").filter(~F.col("refers_to").eqNullSafe(F.col("page_id")))
    known = revisits.select(
        "key", "page_id", "digest", F.lit(False).alias("is_page"), F.lit(None).cast("string").alias("url"),
        F.lit(None).cast("string").alias("payload"), "refers_to",
    ).distinct()
    captures = pages.select(
        key, "page_id", digest, F.lit(True).alias("is_page"), "url", payload.alias("payload"), F.lit(None).cast("long").alias("refers_to")
    )
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-digests.count() // FILE_ENTRIES))
    if tasks > INDEX_FILES:
        raise ValueError("more index files than the driver may list; raise FILE_ENTRIES")
    place = ["key", "page_id", "digest"]
    ordered = captures.unionByName(known).repartitionByRange(tasks, *place).sortWithinPartitions(*place, "is_page")
    listed = stored(ordered.mapInArrow(_write_captures(root, date), FILES), "warc-files")
    files = sorted((order_of(row["key"], row["page_id"]), row["file"]) for row in listed.collect())
    return CaptureIndex(f"{root}/archives", f"{root}/index", tuple(f for f, _ in files), tuple(f for _, f in files))


def _look_up(index: CaptureIndex):
    """Reads wanted captures in order of file and key; yields the records found."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archives, archive_base = file_system(index.archives)
        indexes, index_base = file_system(index.files_root)
        file, source, starts, directory, block_number, block = None, None, [], [], None, []
        opened, archive_file, buffer, buffer_at, last_end = None, None, b"", 0, -1

        def open_file(number: int) -> None:
            nonlocal file, source, starts, directory, block_number
            if source is not None:
                source.close()
            source = indexes.open_input_file(posixpath.join(index_base, index.files[number]))
            end = source.size() - FOOTER_BYTES
            offset, length = struct.unpack(FOOTER, source.read_at(FOOTER_BYTES, end))
            directory = json.loads(gzip.decompress(source.read_at(length, offset)))
            starts = [order_of(key, page_id) for key, page_id, _, _ in directory]
            file, block_number = number, None

        def open_block(number: int) -> None:
            nonlocal block_number, block
            _, _, offset, length = directory[number]
            lines = gzip.decompress(source.read_at(length, offset)).decode().split("\n")
            block = [json.loads(line) for line in lines]
            block_number = number

        def read_record(archive: str, offset: int, length: int) -> bytes:
            nonlocal opened, archive_file, buffer, buffer_at, last_end
            if archive != opened:
                if archive_file is not None:
                    archive_file.close()
                archive_file = archives.open_input_file(posixpath.join(archive_base, archive))
                opened, buffer, last_end = archive, b"", -1
            if not buffer_at <= offset <= offset + length <= buffer_at + len(buffer):
                # A neighbour of the last record is followed by others.
                ahead = READ_BYTES if 0 <= offset - last_end < READ_BYTES and last_end >= 0 else 0
                buffer, buffer_at = archive_file.read_at(max(length, ahead), offset), offset
            last_end = offset + length
            return buffer[offset - buffer_at : offset - buffer_at + length]

        def captures(wanted: tuple) -> Iterator[list]:
            # Equal captures may begin at the end of the block before.
            at = max(0, bisect_left(starts, wanted) - 1)
            while at < len(starts) and starts[at] <= wanted:
                if at != block_number:
                    open_block(at)
                place = bisect_left(block, wanted, key=lambda entry: order_of(entry[0], entry[1]))
                while place < len(block) and order_of(block[place][0], block[place][1]) == wanted:
                    yield block[place]
                    place += 1
                at += 1

        for batch in batches:
            found = []
            for number, key, page_id in zip(*[column.to_pylist() for column in batch.columns], strict=True):
                if number != file:
                    open_file(number)
                for _, _, archive, offset, length in captures(order_of(key, page_id)):
                    headers, _ = unpack(read_record(archive, offset, length))
                    refers = headers.get("Refers-To-Page-ID")
                    found.append(
                        (
                            int(headers["Page-ID"]) if headers["Page-ID"] else None,
                            int(headers["Payload-Length"]),
                            headers["WARC-Payload-Digest"].removeprefix("sha256:"),
                            headers["WARC-Type"],
                            int(refers) if refers else None,
                        )
                    )
            if found:
                types = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
                arrays = [pa.array(column, kind) for column, kind in zip(zip(*found, strict=True), types, strict=True)]
                names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
                yield pa.RecordBatch.from_arrays(arrays, names=names)
        for handle in (source, archive_file):
            if handle is not None:
                handle.close()

    return run


def look_up(wanted: DataFrame, index: CaptureIndex) -> DataFrame:
    """The records of the captures of `page_id, url`, each found through both index levels.

    A pair asked for repeatedly is looked up once and gives every capture there is of it.
    """
    spark = wanted.sparkSession
    if not index.files:
        return spark.createDataFrame([], RECORDS)
    firsts = index.firsts

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pages = batch.column(0).to_pylist()
            keys = [capture_key(url) for url in batch.column(1).to_pylist()]
            numbers = [max(0, bisect_right(firsts, order_of(k, p)) - 1) for k, p in zip(keys, pages, strict=True)]
            arrays = [pa.array(numbers, pa.int32()), pa.array(keys, pa.string()), batch.column(0)]
            yield pa.RecordBatch.from_arrays(arrays, names=["file", "key", "page_id"])

    placed = wanted.select("page_id", "url").mapInArrow(place, "file int, key string, page_id long").distinct()
    # A task per index file: numbers are dealt as they are.
    dealt = placed.repartitionById(len(index.files), F.col("file")).sortWithinPartitions("file", "key", "page_id")
    return dealt.mapInArrow(_look_up(index), RECORDS)


def archive(pages: DataFrame, root: str | None = None) -> DataFrame:
    """Writes every page below `root` (a new shared folder unless given) and reads all back by look-up."""
    root = root or new_folder(pages.sparkSession, "warc")
    return look_up(pages, write(pages, root))

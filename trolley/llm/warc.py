"""WARC archives of web pages, and a two-level capture index over them.

Every task writes the records of its rows to archive files of its own in the
shared folder, one gzip member per record, and returns where each lies. Files of
failed attempts are never referred to. The captures are then sorted by their
reversed-host key and stored as compressed blocks; a sparse directory holds the
first key of every block. A look-up finds the index file and the block by binary
search, reads just that block, and then just the record.
"""

from __future__ import annotations

import bisect
import hashlib
import json
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trolley.sources.storage import new_shared_folder, settled

LEAST_REVISIT = 100
ARCHIVE_BYTES = 1 << 30
BLOCK_CAPTURES = 3000
DATE = "2024-01-01T00:00:00Z"
GZIP_LEVEL = 3
READ_CHUNK = 1 << 26
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

CAPTURE = "page_id long, url string, digest string, record_type string, file string, offset long, length long"


def url_key(url: Column) -> Column:
    """A sortable key: the host's labels from the last to the first, then the path and query.

    Scheme, user, default port and fragment are left out; a null url has an empty key.
    """
    text = F.coalesce(url, F.lit(""))
    bare = F.regexp_replace(F.regexp_replace(text, "#.*$", ""), "^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.lower(F.regexp_replace(F.regexp_extract(bare, "^[^/?]*", 0), "^[^@]*@|:(80|443)?$", ""))
    rest = F.regexp_replace(bare, "^[^/?]*", "")
    reversed_host = F.concat_ws(",", F.reverse(F.split(host, r"\.")))
    return F.when(text == "", F.lit("")).otherwise(F.concat(reversed_host, F.lit(")"), rest))


def _header(name: str, value) -> str:
    # Header values stay on one line.
    return f"{name}: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", str(value)) + "\r\n"


def record(page_id, url: str | None, payload: bytes, digest: str, refers_to, date: str = DATE) -> bytes:
    """One WARC record: a response with its payload, or a revisit without it."""
    revisit = refers_to is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    name = uuid.uuid5(uuid.NAMESPACE_URL, f"page:{page_id}:{digest}")
    head = "WARC/1.1\r\n" + _header("WARC-Type", "revisit" if revisit else "response")
    head += _header("WARC-Record-ID", f"<urn:uuid:{name}>") + _header("WARC-Date", date)
    if url is not None:
        head += _header("WARC-Target-URI", url)
    if page_id is not None:
        head += _header("Page-Id", page_id)
    head += _header("WARC-Payload-Digest", f"sha256:{digest}")
    if revisit:
        original = uuid.uuid5(uuid.NAMESPACE_URL, f"page:{refers_to}:{digest}")
        head += _header("WARC-Refers-To", f"<urn:uuid:{original}>") + _header("Refers-To-Page-Id", refers_to)
        head += _header("WARC-Profile", PROFILE)
    head += "Content-Type: application/http;msgtype=response\r\n" + f"Content-Length: {len(block)}\r\n\r\n"
    return head.encode("utf-8", "surrogatepass") + block + b"\r\n\r\n"


def parse_record(data: bytes) -> dict:
    """The headers and payload of a record, checked against its lengths and digest."""
    head, _, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) for line in lines)
    length = int(fields["Content-Length"])
    if rest[length:] != b"\r\n\r\n":
        raise ValueError("the record does not end where its length says")
    http, _, payload = rest[:length].partition(b"\r\n\r\n")
    size = int(re.search(rb"\r\nContent-Length: (\d+)", http)[1])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
    revisit = fields["WARC-Type"] == "revisit"
    if not revisit and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError("the payload is not the one that was stored")
    return {
        "page_id": _number(fields.get("Page-Id")),
        "payload_bytes": size,
        "payload_digest": digest,
        "record_type": fields["WARC-Type"],
        "refers_to": _number(fields.get("Refers-To-Page-Id")),
        "url": fields.get("WARC-Target-URI"),
        "payload": payload,
    }


def _number(text: str | None) -> int | None:
    return None if text is None else int(text)


def _gzipped(data: bytes) -> bytes:
    packer = zlib.compressobj(GZIP_LEVEL, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def _opened(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder)


def _decided(pages: DataFrame, least_revisit: int) -> DataFrame:
    """The pages with payload digest and the page that they revisit, if any."""
    html = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    facts = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.octet_length(html).alias("_bytes"), F.sha2(html, 256).alias("digest")
    )
    repeated = settled(
        facts.filter(F.col("_bytes") >= least_revisit)
        .groupBy(F.col("digest").alias("_same"))
        .agg(F.min("page_id").alias("_first"), F.count(F.lit(1)).alias("_n"))
        .filter("_n > 1")
        .drop("_n"),
        "repeated-payloads",
    )
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        html.alias("payload"),
        F.sha2(html, 256).alias("digest"),
    )
    other = F.when(~F.col("page_id").eqNullSafe(F.col("_first")), F.col("_first"))
    return rows.join(repeated, rows["digest"] == repeated["_same"], "left").select(
        "page_id",
        "url",
        F.when(other.isNull(), F.col("payload")).alias("payload"),
        F.octet_length("payload").alias("payload_bytes"),
        "digest",
        other.alias("refers_to"),
    )


def write_archives(pages: DataFrame, folder: str, least_revisit: int = LEAST_REVISIT, date: str = DATE) -> DataFrame:
    """Write a record for every row of ``pages`` (page_id, url, html) and return the captures.

    Of rows with one payload of ``least_revisit`` bytes or more, those with the
    smallest page_id become responses and the others revisits of it. A null html
    counts as empty, a null url gives a record without one, and rows with a null
    page_id revisit any other page. No rows give no archive.
    """

    def write(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, root = _opened(folder)
        out, name, at = None, "", 0
        for frame in frames:
            rows = []
            for page_id, url, payload, size, digest, refers_to in frame.itertuples(index=False, name=None):
                page_id, refers_to = _whole(page_id), _whole(refers_to)
                if out is None or at >= ARCHIVE_BYTES:
                    if out is not None:
                        out.close()
                    name, at = f"pages-{uuid.uuid4().hex}.warc.gz", 0
                    out = system.open_output_stream(f"{root}/{name}", compression=None)
                body = payload if refers_to is None else bytes(int(size))
                data = _gzipped(record(page_id, url, body, digest, refers_to, date))
                out.write(data)
                kind = "response" if refers_to is None else "revisit"
                rows.append((page_id, url, digest, kind, name, at, len(data)))
                at += len(data)
            yield _frame(rows, ["page_id", "url", "digest", "record_type", "file", "offset", "length"], ["page_id"])
        if out is not None:
            out.close()

    decided = _decided(pages, least_revisit).withColumn("page_id", F.col("page_id").cast("string"))
    decided = decided.withColumn("refers_to", F.col("refers_to").cast("string"))
    _make(folder)
    return settled(decided.mapInPandas(write, CAPTURE), "captures")


def _make(folder: str) -> None:
    system, root = _opened(folder)
    system.create_dir(root, recursive=True)


def _whole(text: str | None) -> int | None:
    """Numbers come as text, since pandas has no null among whole numbers."""
    return None if text is None or text != text else int(text)


def _frame(rows: list[tuple], columns: list[str], numbers: list[str]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=columns).astype(dict.fromkeys(numbers, "Int64"))


@dataclass
class CaptureIndex:
    """Where the index lies: its folder, and the first key and name of every index file in key order."""

    folder: str
    files: list[tuple[tuple[str, int], str]]


def _key_of(url_key: str, page_id: int | None) -> tuple[bytes, int]:
    # Spark sorts text by its bytes and nulls first.
    return url_key.encode("utf-8", "surrogatepass"), -(2**63) - 1 if page_id is None else page_id


def build_index(captures: DataFrame, folder: str, block_captures: int = BLOCK_CAPTURES) -> CaptureIndex:
    """Store the captures as sorted compressed blocks with a sparse directory.

    The first level of the index, one entry per index file, is read by the driver;
    the directory of a file's blocks lies at the end of the file.
    """
    spark = captures.sparkSession

    def write(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, root = _opened(folder)
        out, name, at, blocks, waiting = None, f"index-{uuid.uuid4().hex}.cdxz", 0, [], []

        def store() -> None:
            nonlocal at, waiting
            data = zlib.compress("\n".join(json.dumps(c) for c in waiting).encode("utf-8", "surrogatepass"), GZIP_LEVEL)
            out.write(data)
            blocks.append((waiting[0][0], waiting[0][1], at, len(data)))
            at += len(data)
            waiting = []

        for frame in frames:
            if out is None and len(frame):
                out = system.open_output_stream(f"{root}/{name}", compression=None)
            for key, page_id, digest, kind, file, offset, length in frame.itertuples(index=False, name=None):
                waiting.append((key, _whole(page_id), digest, kind, file, int(offset), int(length)))
                if len(waiting) >= block_captures:
                    store()
        if out is not None:
            if waiting:
                store()
            directory = zlib.compress(json.dumps(blocks).encode("utf-8", "surrogatepass"), GZIP_LEVEL)
            out.write(directory)
            out.close()
            yield _frame([(blocks[0][0], blocks[0][1], name, at, len(directory))], ["key", "page_id", "name", "at", "size"], ["page_id"])

    keyed = captures.select(
        url_key(F.col("url")).alias("key"), "page_id", "digest", "record_type", "file", "offset", "length"
    )
    _make(folder)
    files = settled(
        keyed.repartitionByRange("key", "page_id", "file", "offset")
        .sortWithinPartitions("key", "page_id", "file", "offset")
        .withColumn("page_id", F.col("page_id").cast("string"))
        .mapInPandas(write, "key string, page_id long, name string, at long, size long"),
        "index-files",
    ).collect()
    return CaptureIndex(
        folder, sorted(((_key_of(r["key"], r["page_id"]), (r["name"], r["at"], r["size"])) for r in files))
    )


class _Reader:
    """Binary search in one index; keeps the last directory and block it read."""

    def __init__(self, index: CaptureIndex):
        self.index = index
        self.system, self.root = _opened(index.folder)
        self.first = [key for key, _ in index.files]
        self.file, self.block = None, None

    def _open(self, number: int) -> None:
        if self.file != number:
            name, at, size = self.index.files[number][1]
            self.handle = self.system.open_input_file(f"{self.root}/{name}")
            blocks = json.loads(zlib.decompress(self.handle.read_at(size, at)).decode("utf-8", "surrogatepass"))
            self.blocks = [(_key_of(key, page_id), at, size) for key, page_id, at, size in blocks]
            self.block_first = [b[0] for b in self.blocks]
            self.file, self.block = number, None

    def find(self, key: str, page_id: int | None) -> list[tuple]:
        """Captures of a key and page, from the one block, or the few, that can hold them."""
        wanted, found = _key_of(key, page_id), []
        number = max(0, bisect.bisect_left(self.first, wanted) - 1)
        while number < len(self.first) and self.first[number] <= wanted:
            self._open(number)
            block = max(0, bisect.bisect_left(self.block_first, wanted) - 1)
            while block < len(self.blocks) and self.block_first[block] <= wanted:
                if self.block != block:
                    _, at, size = self.blocks[block]
                    lines = zlib.decompress(self.handle.read_at(size, at)).decode("utf-8", "surrogatepass").split("\n")
                    self.captures = [json.loads(line) for line in lines]
                    self.keys = [_key_of(c[0], c[1]) for c in self.captures]
                    self.block = block
                a, b = bisect.bisect_left(self.keys, wanted), bisect.bisect_right(self.keys, wanted)
                found += self.captures[a:b]
                block += 1
            number += 1
        return found


def look_up(index: CaptureIndex, wanted: DataFrame) -> DataFrame:
    """The captures of the pages in ``wanted`` (url, page_id), each distinct pair looked up once.

    Pages that were never captured give no row.
    """

    def find(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reader = _Reader(index)
        for frame in frames:
            rows = []
            for key, page_id in frame.itertuples(index=False, name=None):
                for capture in reader.find(key, _whole(page_id)):
                    rows.append((capture[1], capture[2], capture[3], capture[4], capture[5], capture[6]))
            yield _frame(rows, ["page_id", "digest", "record_type", "file", "offset", "length"], ["page_id", "offset", "length"])

    keys = wanted.select(url_key(F.col("url")).alias("key"), F.col("page_id").cast("long").alias("page_id")).distinct()
    return (
        keys.repartitionByRange("key", "page_id")
        .sortWithinPartitions("key", "page_id")
        .withColumn("page_id", F.col("page_id").cast("string"))
        .mapInPandas(find, "page_id long, digest string, record_type string, file string, offset long, length long")
    )


RECORD = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def read_records(captures: DataFrame, folder: str, with_payload: bool = False, parts: int | None = None) -> DataFrame:
    """Read the records that ``captures`` point to, each by its range, and check their payloads.

    ``parts`` is the number of tasks. It should follow the bytes of the records: to
    Spark a pointer is a few bytes, whatever it points to.
    """
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    columns += ["url", "payload"] * with_payload

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, root = _opened(folder)
        name, handle = None, None
        for frame in frames:
            rows = []
            for file, offset, length in frame.itertuples(index=False, name=None):
                if file != name:
                    name, handle = file, system.open_input_file(f"{root}/{file}")
                found = parse_record(zlib.decompress(handle.read_at(int(length), int(offset)), 31))
                rows.append(tuple(found[c] for c in columns))
            yield _frame(rows, columns, ["page_id", "refers_to"])

    # Records that lie together are read by one task, in order.
    near = captures.select("file", "offset", "length").withColumn("_part", F.expr(f"offset div {READ_CHUNK}"))
    return (
        (near.repartition("file", "_part") if parts is None else near.repartition(parts, "file", "_part"))
        .sortWithinPartitions("file", "offset")
        .select("file", "offset", "length")
        .mapInPandas(read, RECORD + ", url string, payload binary" * with_payload)
    )


def archived(pages: DataFrame, spark: SparkSession | None = None) -> DataFrame:
    """Archive ``pages``, then look every page up in the index and read its record back.

    Returns one row per row of ``pages``: page_id, payload_bytes, payload_digest,
    record_type, refers_to. Nulls and repeated rows as in ``write_archives``.
    """
    spark = spark or pages.sparkSession
    archives = new_shared_folder(spark, "archives")
    captures = write_archives(pages, archives)
    index = build_index(captures, new_shared_folder(spark, "capture-index"))
    size = captures.agg(F.sum("length")).first()[0] or 0
    parts = max(2 * spark.sparkContext.defaultParallelism, size // READ_CHUNK)
    return read_records(look_up(index, pages.select("url", "page_id")), archives, parts=parts)

"""A deterministic sharded writer of WARC archives, and their reader.

Records are ordered by page and payload. Shards are ranges of that order of about
equal size: their boundaries come from exact cumulative sums over keys and
sizes, not from a sample, so the same pages give the same files, byte for byte,
however they are partitioned. A shard is written by one task, a gzip member for
each record; a file that reaches the roll size is closed and the next begun.
Headers and digests are made anew. Tasks write under temporary names; the
commit renames the files of those attempts that succeeded and then puts the manifest in place, and only what it names is read.

Both sides are a Spark data source, `warc`. Folders may be anything that pyarrow.fs opens: file, hdfs, s3, gs.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import json
import re
import uuid
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from .common import cut, in_order, sums_before

#: Bytes of a shard's records before compression, at least, and shards at most: their boundaries are broadcast.
SHARD_BYTES, MOST_SHARDS = 16 << 20, 100_000
#: Compressed bytes at which a file is closed and the next begun.
ROLL_BYTES = 128 << 20
#: What a record's headers take, about.
HEADER_BYTES = 600
#: The date of all records, as pages have none.
DATE = "1970-01-01T00:00:00Z"
MANIFEST = "manifest.json"

# Fixed values of the WARC 1.1 format.
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_TYPE = "application/http;msgtype=response"

ROWS = "file string, offset long, record_type string, record_id string, page_id long, target_uri string, payload_digest string, payload_bytes long, refers_to long, payload binary"


def open_folder(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a folder, and the folder's path in it."""
    if "://" in path and not path.startswith("file:"):
        return pafs.FileSystem.from_uri(path)
    return pafs.LocalFileSystem(), re.sub(r"^file:/*", "/", path)


# --- records -------------------------------------------------------------------


class Record(NamedTuple):
    page_id: int | None
    url: str | None
    payload: bytes
    digest: bytes  # SHA-256, which tells payloads apart
    nth: int  # among rows of one page and payload
    original: tuple[int | None] | None  # of a revisit, the page of the response


def record_id(page_id: int | None, digest: bytes, nth: int) -> str:
    made = hashlib.sha1(f"{page_id}/{digest.hex()}/{nth}".encode()).digest()[:16]
    return f"<urn:uuid:{uuid.UUID(bytes=made, version=5)}>"


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _header(fields: list[tuple[str, str | None]], first: str) -> bytes:
    return "".join([first, "\r\n", *(f"{n}: {v}\r\n" for n, v in fields if v is not None), "\r\n"]).encode()


def _uri(url: str | None) -> str | None:
    """A URL that fits in a header line: controls and spaces are escaped."""
    return None if url is None else re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)


def record_bytes(r: Record) -> bytes:
    """One record, uncompressed. A revisit keeps the HTTP header, with the payload's length, and not the payload."""
    http = _header([("Content-Type", "text/html; charset=utf-8"), ("Content-Length", str(len(r.payload)))], "HTTP/1.1 200 OK")
    block = http if r.original else http + r.payload
    fields = [
        ("WARC-Type", "revisit" if r.original else "response"), ("WARC-Record-ID", record_id(r.page_id, r.digest, r.nth)), ("WARC-Date", DATE), ("WARC-Target-URI", _uri(r.url)),
        ("WARC-Payload-Digest", f"sha1:{base32_sha1(r.payload)}"), ("WARC-Block-Digest", f"sha1:{base32_sha1(block)}"), ("WARC-Profile", PROFILE if r.original else None), ("WARC-Refers-To", record_id(r.original[0], r.digest, 0) if r.original else None),
        ("X-Page-Id", None if r.page_id is None else str(r.page_id)), ("X-Refers-To-Page-Id", None if not r.original or r.original[0] is None else str(r.original[0])), ("Content-Type", HTTP_TYPE), ("Content-Length", str(len(block))),
    ]
    return _header(fields, VERSION) + block + b"\r\n\r\n"


def info_bytes(name: str) -> bytes:
    """The record that a file begins with."""
    block = b"software: turnloom\r\nformat: WARC File Format 1.1\r\n"
    fields = [("WARC-Type", "warcinfo"), ("WARC-Record-ID", record_id(None, name.encode(), 0)), ("WARC-Date", DATE), ("WARC-Filename", name), ("Content-Type", "application/warc-fields"), ("Content-Length", str(len(block)))]
    return _header(fields, VERSION) + block + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    """data as a gzip member of its own, without a time."""
    made = zlib.compressobj(6, zlib.DEFLATED, 31)
    return made.compress(data) + made.flush()


def members(stream) -> Iterator[tuple[int, bytes]]:
    """(offset, data) of each gzip member; one at a time is held."""
    offset, held, ended = 0, b"", False
    while True:
        reader, out, taken = zlib.decompressobj(31), [], 0
        while not reader.eof:
            if not held:
                held = stream.read(1 << 20)
                if not held:
                    ended = True
                    break
            out.append(reader.decompress(held))
            taken += len(held) - len(reader.unused_data)
            held = reader.unused_data
        if ended:
            if taken:
                raise ValueError(f"the archive is cut off in the record at {offset}")
            return
        yield offset, b"".join(out)
        offset += taken


def parsed(data: bytes) -> tuple[dict[str, str], bytes]:
    """A record's header fields, names in lower case, and its block."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")
    fields = {n.strip().lower(): v.strip() for n, _, v in (x.partition(":") for x in lines[1:])}
    return fields, rest[: int(fields["content-length"])]


def opened(file: str, offset: int, data: bytes, payloads: bool) -> tuple | None:
    """A row of ROWS; None for a file's first record. Digests are made anew and compared."""
    fields, block = parsed(data)
    kind = fields["warc-type"]
    if kind == "warcinfo":
        return None
    http, _, body = block.partition(b"\r\n\r\n")
    digest = fields["warc-payload-digest"].removeprefix("sha1:")
    whole = lambda n: int(fields[n]) if n in fields else None
    if base32_sha1(block) != fields["warc-block-digest"].removeprefix("sha1:") or kind == "response" and base32_sha1(body) != digest:
        raise ValueError(f"{file}, record at {offset}: its digest differs")
    size = len(body) if kind == "response" else int(re.search(rb"(?im)^content-length:\s*(\d+)", http)[1])
    return file, offset, kind, fields["warc-record-id"], whole("x-page-id"), fields.get("warc-target-uri"), digest, size, whole("x-refers-to-page-id"), body if payloads and kind == "response" else None


# --- the data source -------------------------------------------------------------


class Written(WriterCommitMessage):
    def __init__(self, files: list[dict]):
        self.files = files


class Archive(InputPartition):
    def __init__(self, name: str, size: int):
        super().__init__((name, size))
        self.name, self.size = name, size


class WarcSource(DataSource):
    """Options: path; payloads (true: the reader gives them); rollBytes."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return ROWS

    def reader(self, schema) -> WarcReader:
        return WarcReader(self.options)

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        return WarcWriter(self.options)


class WarcReader(DataSourceReader):
    def __init__(self, options):
        self.path, self.payloads = options["path"], options.get("payloads", "true") == "true"

    def partitions(self) -> list[Archive]:
        fs, root = open_folder(self.path)
        with fs.open_input_stream(f"{root}/{MANIFEST}") as f:
            return [Archive(x["name"], x["bytes"]) for x in json.loads(f.read())["files"]] or [Archive("", 0)]

    def read(self, partition: Archive) -> Iterator[pa.RecordBatch]:
        if not partition.name:
            return
        fs, root = open_folder(self.path)
        path = f"{root}/{partition.name}"
        if (size := fs.get_file_info(path).size) != partition.size:
            raise ValueError(f"{path} has {size} bytes, the manifest says {partition.size}")
        names = [c.split()[0] for c in ROWS.split(", ")]
        kinds = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
        schema = pa.schema([(n, kinds[c.split()[1]]) for n, c in zip(names, ROWS.split(", "), strict=True)])
        held: list[tuple] = []
        size = 0
        with fs.open_input_stream(path, compression=None) as stream:
            for offset, data in members(stream):
                row = opened(partition.name, offset, data, self.payloads)
                if row:
                    held.append(row)
                    size += 300 + len(row[-1] or b"")
                if size > 1 << 22:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), schema.types, strict=True)], schema=schema)
                    held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), schema.types, strict=True)], schema=schema)


class WarcWriter(DataSourceArrowWriter):
    """Writes rows of write_archives, which come sorted by shard, key and page.

    A key's row with page false comes before those of its pages, and tells that more rows have their payload.
    """

    def __init__(self, options):
        self.path, self.roll = options["path"], int(options.get("rollBytes", ROLL_BYTES))

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        fs, root = open_folder(self.path)
        files: list[dict] = []
        out = Files(fs, f"{root}/_temporary/{uuid.uuid4().hex}", self.roll, files)
        key = told = None
        nth = 0
        try:
            for batch in iterator:
                for row in batch.to_pylist():
                    if row["key"] != key:
                        key, told, nth = row["key"], None, 0
                    if not row["page"]:
                        told = (row["original"], row["first"])
                        continue
                    digest, payload = key[-32:], (row["html"] or "").encode()
                    # the first row of the response's key is the response
                    repeats = told is not None and (nth > 0 or not told[1])
                    source = (told[0],) if repeats else None
                    out.add(row["shard"], record_bytes(Record(row["page_id"], row["url"], payload, digest, nth, source)))
                    nth += 1
            out.close()
        except BaseException:
            out.abandon()
            raise
        return Written(files)

    def commit(self, messages: list[Written | None]) -> None:
        fs, root = open_folder(self.path)
        files = sorted((x for m in messages if m for x in m.files), key=lambda x: x["name"])
        fs.create_dir(root, recursive=True)
        for x in files:
            fs.move(x.pop("at"), f"{root}/{x['name']}")
        made = f"{root}/_temporary/{MANIFEST}"
        fs.create_dir(f"{root}/_temporary", recursive=True)
        with fs.open_output_stream(made) as f:
            f.write(json.dumps({"files": files, "records": sum(x["records"] for x in files)}, indent=1).encode())
        fs.move(made, f"{root}/{MANIFEST}")
        self.abort(messages)

    def abort(self, messages: list[Written | None]) -> None:
        fs, root = open_folder(self.path)
        if fs.get_file_info(f"{root}/_temporary").type == pafs.FileType.Directory:
            fs.delete_dir(f"{root}/_temporary")


class Files:
    """The files that a task writes: one after another, closed as they reach the roll size or a shard ends."""

    def __init__(self, fs: pafs.FileSystem, folder: str, roll: int, done: list[dict]):
        self.fs, self.folder, self.roll, self.done = fs, folder, roll, done
        self.shard = self.stream = None

    def add(self, shard: int, record: bytes) -> None:
        if shard != self.shard:
            self.close()
            self.shard, self.nth = shard, 0
        if self.stream is None:
            self.name = f"pages-{shard:06d}-{self.nth:04d}.warc.gz"
            self.fs.create_dir(self.folder, recursive=True)
            self.stream, self.sha, self.bytes, self.records = self.fs.open_output_stream(f"{self.folder}/{self.name}", compression=None), hashlib.sha256(), 0, 0
            self._put(member(info_bytes(self.name)))
        self._put(member(record))
        self.records += 1
        if self.bytes >= self.roll:
            self.close()
            self.nth += 1

    def _put(self, data: bytes) -> None:
        self.stream.write(data)
        self.sha.update(data)
        self.bytes += len(data)

    def close(self) -> None:
        if self.stream is not None:
            self.stream.close()
            self.done.append({"at": f"{self.folder}/{self.name}", "name": self.name, "records": self.records, "bytes": self.bytes, "sha256": self.sha.hexdigest()})
            self.stream = None

    def abandon(self) -> None:
        if self.stream is not None:
            self.stream.close()
        if self.fs.get_file_info(self.folder).type == pafs.FileType.Directory:
            self.fs.delete_dir(self.folder)


# --- jobs ------------------------------------------------------------------------


def _order_key(page_id: Column, payload: Column) -> Column:
    """Bytes in the order of page ids, null last, then of the payload's SHA-256."""
    id_ = F.lpad(F.hex(page_id.bitwiseXOR(F.lit(-(1 << 63)))), 16, "0")
    return F.concat(F.when(page_id.isNull(), F.unhex(F.lit("010000000000000000"))).otherwise(F.unhex(F.concat(F.lit("00"), id_))), F.unhex(F.sha2(payload, 256)))


def repeated(slim: DataFrame, min_bytes: int) -> DataFrame:
    """(key, first, original): for keys whose payload more rows have: whether theirs is the response, and its page."""
    digest = F.substring("key", 10, 32)
    rows = slim.where(F.col("bytes") >= min_bytes).groupBy("key").agg(F.count("*").alias("n"), F.min("page_id").alias("page_id")).withColumn("digest", digest)
    groups = rows.groupBy("digest").agg(F.sum("n").alias("n"), F.min(F.struct("key", "page_id")).alias("z")).where("n > 1")
    return rows.select("key", "digest").join(groups, "digest").select("key", (F.col("key") == F.col("z.key")).alias("first"), F.col("z.page_id").alias("original"))


def boundaries(slim: DataFrame, shard_bytes: int) -> list[bytes]:
    """The least key of each shard but the first; a shard has about shard_bytes."""
    rows = in_order(slim.select("key", (F.col("bytes") + HEADER_BYTES).alias("size")), [F.col("key")], "warc-keys")
    total = rows.agg(F.sum("size")).first()[0] or 0
    each = max(shard_bytes, -(-total // MOST_SHARDS))
    placed = sums_before(rows, ["part"], [F.col("at")], "size", "before")
    return [bytes(r.key) for r in placed.groupBy(F.floor(F.col("before") / each).alias("shard")).agg(F.min("key").alias("key")).orderBy("shard").collect()[1:]]


def write_archives(pages: DataFrame, folder: str, min_bytes: int = 0, shard_bytes: int = SHARD_BYTES, roll_bytes: int = ROLL_BYTES, id_column: str = "page_id", url_column: str = "url", html_column: str = "html") -> str:
    """Writes a record for each row of pages under folder, and gives folder.

    The payload is the html in UTF-8, empty for a null one. Of rows with equal payloads of at least min_bytes,
    the one with the smallest page is a response, the others are revisits that refer to it; smaller payloads
    are all responses. Rows that repeat a page are told apart by payload, and if that is equal too the first is
    taken for the smaller. A null page comes after all others. A null url leaves its header out. The html is shuffled once.
    """
    spark = pages.sparkSession
    spark.dataSource.register(WarcSource)
    html = F.coalesce(F.col(html_column), F.lit(""))
    id_ = F.col(id_column).cast("long")
    rows = pages.select(_order_key(id_, html).alias("key"), id_.alias("page_id"), F.col(url_column).cast("string").alias("url"), html.alias("html"))
    slim = cut(rows.select("key", "page_id", F.octet_length("html").alias("bytes")))
    bounds = spark.sparkContext.broadcast(boundaries(slim, shard_bytes))

    @F.pandas_udf("int")
    def shard_of(keys: pd.Series) -> pd.Series:
        known = bounds.value
        return keys.map(lambda k: bisect.bisect_right(known, bytes(k))).astype("int32")

    told = repeated(slim, min_bytes).select("key", F.lit(None).cast("long").alias("page_id"), F.lit(None).cast("string").alias("url"), F.lit(None).cast("string").alias("html"), F.lit(False).alias("page"), "first", "original")
    both = rows.withColumns({"page": F.lit(True), "first": F.lit(None).cast("boolean"), "original": F.lit(None).cast("long")}).unionByName(told)
    dealt = both.withColumn("shard", shard_of("key")).repartitionById(len(bounds.value) + 1, F.col("shard")).sortWithinPartitions("shard", "key", "page", F.col("url").asc_nulls_first())
    dealt.write.format("warc").option("path", folder).option("rollBytes", str(roll_bytes)).mode("append").save()
    return folder


def read_archives(spark: SparkSession, folder: str, payloads: bool = False) -> DataFrame:
    """A row for each record that the folder's manifest names, as ROWS says; payload only if payloads, and not for revisits."""
    spark.dataSource.register(WarcSource)
    return spark.read.format("warc").option("path", folder).option("payloads", str(payloads).lower()).load()

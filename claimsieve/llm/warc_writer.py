"""Deterministic sharded WARC archives, and reading them back.

1. A record's payload is the html in UTF-8; its SHA-1 is the digest. Of equal payloads of at least `REVISIT_BYTES`
   the largest page id is the response, the others become revisit records that name it.
2. Records are sorted by (page id, hash of the row) and cut into shards of about `SHARD_BYTES` of payload. Shard bounds
   come from exact byte counts of at most `SPANS` equal spans of the sort key, so they depend on the rows alone, never
   on partitioning, sampling or retries. A span that is too heavy (one repeated id) is cut further by the row hash.
3. A task writes whole shards. It starts a new file once the compressed bytes pass `FILE_BYTES`; every record is a gzip
   member of its own, as the format asks, with fresh headers and a digest taken from the bytes written.
4. A file is written under a temporary name and renamed when complete, so a lost or repeated task leaves no half file:
   equal rows give equal bytes under an equal name. The manifest lists the committed files; readers open these only.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimsieve.llm.shared import marked, stored

REVISIT_BYTES = 1000
FILE_BYTES = 8 << 20
SHARD_BYTES = 64 << 20
READ_BYTES = 64 << 10
SPANS = 4096
DATE = "2000-01-01T00:00:00Z"  # the pages carry no time; a fixed one keeps the bytes the same
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = "file string, shard long, records long, bytes long, sha1 string"


def with_revisits(pages: DataFrame) -> DataFrame:
    """page_id, url, payload, payload_bytes, payload_digest, record_type, refers_to.

    A null html is an empty payload. Among equal payloads a null page id counts as the smallest; repeated rows of the
    largest id are all responses. Only (digest, largest id) of long payloads that occur more than once travels to the
    join, and a digest shared by a third of all pages is summed up on the map side first.
    """
    digested = pages.select(
        "page_id",
        F.coalesce("url", F.lit("")).alias("url"),
        F.encode(F.coalesce("html", F.lit("")), "UTF-8").alias("payload"),
    ).withColumns(
        {"payload_bytes": F.octet_length("payload").cast("long"), "payload_digest": F.sha1("payload")}
    )
    long = digested.filter(F.col("payload_bytes") >= REVISIT_BYTES)
    largest = (
        long.groupBy(F.col("payload_digest").alias("digest"))
        .agg(F.max("page_id").alias("kept"), F.count("*").alias("rows"))
        .filter((F.col("rows") > 1) & F.col("kept").isNotNull())
        .select("digest", "kept")
    )
    # payloads that no other page shares hit no mark of a repeated digest and stay out of the join, as short ones do
    near, hit = marked(digested, F.xxhash64("payload_digest"), largest, F.xxhash64("digest"))
    shared = hit & (F.col("payload_bytes") >= REVISIT_BYTES)
    columns = digested.columns
    joined = near.filter(shared).select(*columns).join(largest, F.col("payload_digest") == F.col("digest"), "left")
    alone = near.filter(~shared).select(*columns).withColumn("kept", F.lit(None).cast("long"))
    older = F.col("kept").isNotNull() & F.coalesce(F.col("page_id") < F.col("kept"), F.lit(True))
    typed = joined.drop("digest").unionByName(alone).withColumns(
        {
            "record_type": F.when(older, F.lit("revisit")).otherwise(F.lit("response")),
            "refers_to": F.when(older, F.col("kept")),
        }
    )
    return typed.drop("kept")


def with_shards(records: DataFrame, shard_bytes: int = SHARD_BYTES) -> tuple[DataFrame, int]:
    """The records with `shard` and `row_hash`, and how many shards there may be; shards follow each other in the order
    of (page id, row hash).

    The ids between the smallest and the largest are cut into equal spans, null ids being a span of their own. The
    driver sees a count of bytes per span and lays neighbouring spans together. There are SPANS spans, or four per shard
    if that is more, so what it sees is as long as the list of files.
    """
    hashed = records.withColumn("row_hash", F.xxhash64("page_id", "url", "payload_digest"))
    low, high, total = hashed.agg(F.min("page_id"), F.max("page_id"), F.sum("payload_bytes")).first()
    spans = max(SPANS, 4 * int((total or 0) // shard_bytes))
    low, width = low or 0, ((high or 0) - (low or 0)) // spans + 1
    spanned = hashed.withColumn("span", F.coalesce(F.expr(f"(page_id - {low}L) div {width}L"), F.lit(-1)))
    weights = spanned.groupBy("span").agg(F.sum("payload_bytes").alias("bytes")).orderBy("span").collect()
    layout, shard, filled = [], 0, 0
    for span, weight in weights:
        if filled and filled + weight > shard_bytes:
            shard, filled = shard + 1, 0
        parts = max(1, -(-weight // shard_bytes))
        layout.append((span, shard, parts))
        filled += weight
        if parts > 1:
            shard, filled = shard + parts, 0
    spark = records.sparkSession
    table = spark.createDataFrame(layout, "span long, first_shard long, parts long")
    # the upper 31 bits of the hash, as a share of their range, keep the order of the hash
    share = (F.shiftright("row_hash", 33) + (1 << 30)) * F.col("parts")
    placed = spanned.join(F.broadcast(table), "span")
    shard_of = F.col("first_shard") + F.shiftright(share, 31)
    return placed.withColumn("shard", shard_of).drop("span", "first_shard", "parts"), shard + 1


def _member(kind: str, headers: list[tuple[str, str]], block: bytes) -> bytes:
    """One record as a gzip member; the same record gives the same bytes."""
    lines = ["WARC/1.1", f"WARC-Type: {kind}", *(f"{name}: {value}" for name, value in headers)]
    digest = base64.b32encode(hashlib.sha1(block).digest()).decode()
    lines += [f"WARC-Date: {DATE}", f"WARC-Block-Digest: sha1:{digest}", f"Content-Length: {len(block)}", "", ""]
    return gzip.compress("\r\n".join(lines).encode() + block + b"\r\n\r\n", 6, mtime=0)


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}/{digest}')}>"


def page_record(row) -> bytes:
    """The WARC record of a page: headers are made anew and the digest is taken from the payload in hand."""
    payload = bytes(row.payload)
    sha1 = hashlib.sha1(payload)
    page_id = None if pd.isna(row.page_id) else int(row.page_id)
    headers = [
        ("WARC-Record-ID", record_id(page_id, sha1.hexdigest())),
        ("WARC-Target-URI", quote(row.url, safe="/:?#[]@!$&'()*+,;=%-._~")),
        ("WARC-Payload-Digest", f"sha1:{base64.b32encode(sha1.digest()).decode()}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("X-Payload-Length", str(len(payload))),
    ]
    if page_id is not None:
        headers.append(("X-Page-Id", str(page_id)))
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    if row.record_type == "response":
        return _member("response", headers, http.encode() + payload)
    refers_to = int(row.refers_to)
    headers += [
        ("WARC-Profile", REVISIT_PROFILE),
        ("WARC-Refers-To", record_id(refers_to, sha1.hexdigest())),
        ("X-Refers-To-Page", str(refers_to)),
    ]
    return _member("revisit", headers, http.encode())


class ShardFiles:
    """The files of one shard: written under temporary names, renamed when full or when the shard ends."""

    def __init__(self, folder: str, shard: int, file_bytes: int):
        self.store, self.path = fs.FileSystem.from_uri(folder)
        self.shard, self.file_bytes, self.number, self.out = shard, file_bytes, 0, None

    def add(self, record: bytes) -> tuple | None:
        """Append a record; the manifest row of the file that it filled, if any."""
        if self.out is None:
            self.name = f"part-{self.shard:07d}-{self.number:05d}.warc.gz"
            self.temporary = f"{self.path}/_{self.name}.{uuid.uuid4().hex}"
            self.out, self.sha1, self.bytes, self.records = self.store.open_output_stream(self.temporary), hashlib.sha1(), 0, 0
            info = [("WARC-Record-ID", record_id(None, self.name)), ("WARC-Filename", self.name)]
            self._write(_member("warcinfo", [*info, ("Content-Type", "application/warc-fields")], b"format: WARC 1.1\r\n"))
        self._write(record)
        self.records += 1
        return self.close() if self.bytes >= self.file_bytes else None

    def _write(self, data: bytes) -> None:
        self.out.write(data)
        self.sha1.update(data)
        self.bytes += len(data)

    def close(self) -> tuple | None:
        if self.out is None:
            return None
        self.out.close()
        self.out = None
        final = f"{self.path}/{self.name}"
        if self.store.get_file_info(final).size == self.bytes:
            self.store.delete_file(self.temporary)  # an earlier attempt of this task has committed the same bytes
        else:
            self.store.move(self.temporary, final)
        self.number += 1
        return self.name, self.shard, self.records, self.bytes, self.sha1.hexdigest()


def write_archives(
    pages: DataFrame, folder: str, shard_bytes: int = SHARD_BYTES, file_bytes: int = FILE_BYTES
) -> DataFrame:
    """Write the archives below `folder` (a URI every executor reaches) and return the stored manifest, a row per file.

    Without pages there is no file and the manifest is empty.
    """
    store, path = fs.FileSystem.from_uri(folder)
    store.create_dir(path, recursive=True)

    def write(pdfs: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        files, done = None, []
        for pdf in pdfs:
            for row in pdf.itertuples(index=False):
                if files is None or files.shard != row.shard:
                    done += [files.close()] if files else []
                    files = ShardFiles(folder, row.shard, file_bytes)
                done.append(files.add(page_record(row)))
        done += [files.close()] if files else []
        names = [field.split(" ")[0] for field in MANIFEST.split(", ")]
        yield pd.DataFrame([row for row in done if row], columns=names)

    records, shards = with_shards(with_revisits(pages), shard_bytes)
    sharded = records.withColumn("page_id", F.col("page_id").cast("string"))
    numeric = F.col("page_id").cast("long")
    # a task per shard
    by_shard = sharded.repartitionById(shards, F.col("shard").cast("int"))
    ordered = by_shard.sortWithinPartitions("shard", numeric, "row_hash", "url")
    wanted = "shard", "page_id", "url", "payload", "record_type", F.col("refers_to").cast("string").alias("refers_to")
    return stored(ordered.select(*wanted).mapInPandas(write, MANIFEST))


def _members(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record of an archive, one member at a time."""
    view, at = memoryview(content), 0
    while at < len(view):
        unpack, parts = zlib.decompressobj(wbits=31), []
        while not unpack.eof:
            if at >= len(view):
                raise ValueError("an archive ends inside a record")
            parts.append(unpack.decompress(view[at : at + READ_BYTES]))
            at = min(at + READ_BYTES, len(view)) - len(unpack.unused_data)
        head, _, rest = b"".join(parts).partition(b"\r\n\r\n")
        headers = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
        yield headers, rest[: int(headers["Content-Length"])]


def read_archives(spark: SparkSession, folder: str, manifest: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of every record in the committed files.

    Digests and lengths of responses are taken from the payload read; one that differs from its headers ends the job.
    The driver holds the names of the files, as it does for any folder that it reads.
    """
    # ids travel as text: pandas would turn long ids beside a null into inexact doubles
    fields = "page_id string, payload_bytes long, payload_digest string, record_type string, refers_to string"

    def parse(pdfs: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in pdfs:
            for content in pdf["content"]:
                rows = []
                for headers, block in _members(content):
                    if headers["WARC-Type"] == "warcinfo":
                        continue
                    digest = base64.b32decode(headers["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
                    size = int(headers["X-Payload-Length"])
                    if headers["WARC-Type"] == "response":
                        payload = block.partition(b"\r\n\r\n")[2]
                        if (len(payload), hashlib.sha1(payload).hexdigest()) != (size, digest):
                            raise ValueError("a record differs from its headers")
                    page_id, refers_to = headers.get("X-Page-Id"), headers.get("X-Refers-To-Page")
                    rows.append((page_id, size, digest, headers["WARC-Type"], refers_to))
                yield pd.DataFrame(rows, columns=[field.split(" ")[0] for field in fields.split(", ")])

    files = [f"{folder}/{row['file']}" for row in manifest.select("file").collect()]
    if not files:
        records = spark.createDataFrame([], fields)
    else:
        records = spark.read.format("binaryFile").load(files).select("content").mapInPandas(parse, fields)
    return records.withColumns({name: F.col(name).cast("long") for name in ("page_id", "refers_to")})


def archive_round_trip(pages: DataFrame, folder: str) -> DataFrame:
    """Write every page, then read the archives back.

    Repeated rows are written as often as they occur; null ids, urls and texts are kept apart from empty ones only for
    the id. Further columns of `pages` are ignored whatever their names.
    """
    manifest = write_archives(pages, folder)
    return read_archives(pages.sparkSession, folder, manifest)

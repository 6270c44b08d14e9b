"""Web archives with a two-level capture index.

Captures are written in the order of their keys (host labels reversed, then the rest of the
URL), each as a gzip member of its own.  The first index level is lines sorted by key in
compressed blocks; the second is a sparse directory with one row per block: its first and
last key and the byte ranges of the block and of its captures.  A look-up bisects the
directory, reads one block by its range, bisects its lines, and reads one capture by its range.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import json
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievework.llm.store import attempt_name, open_store, read_range
from sievework.session import scratch_path, through_storage

#: A block ends after so many captures, or so many bytes of archive.
BLOCK_LINES, BLOCK_BYTES = 1000, 4 << 20
#: Blocks that one task reads back on large tables.
BLOCKS_A_TASK = 16
#: Archive dates are part of the record format; the pages have none.
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DIRECTORY = ("part int, block int, first_key string, last_key string, n int, warc string, warc_start long, warc_end long, "
             "index string, index_start long, index_end long")


def capture_key(url: Column) -> Column:
    """``com,example,www)/path?query``: reversed host, then path and query; a text without a host keeps its form after ``)``."""
    pattern = r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)(?::\d*)?([^#]*)"
    url = F.coalesce(url, F.lit(""))
    host, rest = F.lower(F.regexp_extract(url, pattern, 1)), F.regexp_extract(url, pattern, 2)
    reversed_host = F.array_join(F.reverse(F.split(host, r"\.", -1)), ",")
    return F.when(host == "", F.concat(F.lit(")"), url)).otherwise(
        F.concat(reversed_host, F.lit(")"), F.when(rest == "", F.lit("/")).otherwise(rest)))


def _uri(url: str | None, page_id: int | None) -> str:
    """A header value without white space, control characters or characters beyond ASCII."""
    return quote(url, safe="!#$%&'()*+,/:;=?@[]~-._") if url else f"urn:page:{page_id}"


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> tuple[bytes, str]:
    """One WARC/1.1 record and its payload digest; a revisit has the HTTP header and no payload."""
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + (payload if refers_to is None else b"")
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <urn:page:{page_id}>",
            f"WARC-Target-URI: {_uri(url, page_id)}", f"WARC-Date: {DATE}", f"WARC-Payload-Digest: sha1:{digest}"]
    if refers_to is not None:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {PROFILE}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n", digest


def parse_record(data: bytes) -> dict:
    """Headers (lower-case names), HTTP headers and payload of one record; the payload's digest is checked."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    named = {k.lower(): v for k, v in (x.split(": ", 1) for x in lines[1:])}
    block = rest[:int(named["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    http_named = {k.lower(): v for k, v in (x.split(": ", 1) for x in http.decode().split("\r\n")[1:])}
    if named["warc-type"] == "response":
        actual = "sha1:" + base64.b32encode(hashlib.sha1(payload).digest()).decode()
        if actual != named["warc-payload-digest"] or len(payload) != int(http_named["content-length"]):
            raise ValueError(f"damaged payload of {named['warc-record-id']}")
    return {"headers": named, "http": http_named, "payload": payload}


def _compressed(data: bytes, level: int = 6) -> bytes:
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def _page_number(value: str) -> int | None:
    number = value.removeprefix("<urn:page:").removesuffix(">")
    return None if number == "None" else int(number)


class _ShardWriter:
    """One archive, one index file and the directory rows of one sorted partition."""

    def __init__(self, folder: str, part: int):
        fs, root = open_store(folder)
        fs.create_dir(root, recursive=True)
        stem = attempt_name(folder, f"part-{part:06d}")
        self.part, self.warc, self.index = part, stem + ".warc.gz", stem + ".index.gz"
        self.warc_out = fs.open_output_stream(open_store(self.warc)[1], compression=None)
        self.index_out = fs.open_output_stream(open_store(self.index)[1], compression=None)
        self.at = self.index_at = self.block_at = self.n_blocks = 0
        self.lines: list[tuple[str, str]] = []

    def add(self, key: str, page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> dict | None:
        data, digest = record(page_id, url, payload, refers_to)
        member = _compressed(data)
        self.warc_out.write(member)
        self.lines.append((key, json.dumps([key, page_id, digest, self.at - self.block_at, len(member)], ensure_ascii=False)))
        self.at += len(member)
        return self.cut() if len(self.lines) >= BLOCK_LINES or self.at - self.block_at >= BLOCK_BYTES else None

    def cut(self) -> dict | None:
        if not self.lines:
            return None
        packed = _compressed("\n".join(x for _, x in self.lines).encode())
        self.index_out.write(packed)
        row = {"part": self.part, "block": self.n_blocks, "first_key": self.lines[0][0], "last_key": self.lines[-1][0],
               "n": len(self.lines), "warc": self.warc, "warc_start": self.block_at, "warc_end": self.at,
               "index": self.index, "index_start": self.index_at, "index_end": self.index_at + len(packed)}
        self.index_at, self.block_at, self.n_blocks, self.lines = row["index_end"], self.at, self.n_blocks + 1, []
        return row

    def close(self) -> dict | None:
        row = self.cut()
        self.warc_out.close()
        self.index_out.close()
        return row


_DIRECTORY_ARROW = pa.schema([("part", pa.int32()), ("block", pa.int32()), ("first_key", pa.string()), ("last_key", pa.string()),
                              ("n", pa.int32()), ("warc", pa.string()), ("warc_start", pa.int64()), ("warc_end", pa.int64()),
                              ("index", pa.string()), ("index_start", pa.int64()), ("index_end", pa.int64())])


def write_archives(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Write all pages as archives and index blocks; returns the block directory.

    Needs page_id, url and html.  The payload is the html in UTF-8; NULL html is an empty
    payload.  Of equal payloads the smallest page_id is a response, the others are revisits
    of it; repeated rows of that smallest page are responses too, and a page without an id
    only is a response if no page with an id has its payload.  NULL urls are archived under
    ``urn:page:ID`` and the empty key.  Extra columns are not read; an empty table gives an
    empty directory.

    Revisits are found on (page_id, key, digest) rows and travel to the writers as rows of their
    own, sorted before the page they speak of, so pages are shuffled once, by key, and an
    often repeated payload or host is spread over many writers.
    """
    spark = pages.sparkSession
    folder = folder or scratch_path(spark, "archives")
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        html.alias("html"), capture_key(F.col("url").cast("string")).alias("key"), F.sha1(html).alias("sha1"))
    light = through_storage(rows.select("page_id", "key", "sha1"), "payload-digests")
    first = light.groupBy("sha1").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    revisits = (light.join(first, "sha1").where("first is not null and not (page_id <=> first)")
                .select("page_id", "key", "sha1", F.col("first").alias("refers_to")).distinct())
    none = F.lit(None).cast("string")
    both = (rows.select("key", "page_id", "sha1", F.lit(1).alias("kind"), "url", "html", F.lit(None).cast("long").alias("refers_to"))
            .unionByName(revisits.select("key", "page_id", "sha1", F.lit(0).alias("kind"), none.alias("url"), none.alias("html"), "refers_to")))
    # A decision and its page have equal range keys, so they are in one partition.
    ordered = both.repartitionByRange("key", "page_id", "sha1").sortWithinPartitions("key", "page_id", "sha1", "kind")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        shard, decided, refers_to = None, None, None
        for batch in batches:
            shard = shard or _ShardWriter(folder, TaskContext.get().partitionId())
            out = []
            columns = [batch.column(i).to_pylist() for i in range(5)]
            payloads = batch.column(5).cast(pa.large_binary())
            refer = batch.column(6).to_pylist()
            for i, (key, page_id, sha1, kind, url) in enumerate(zip(*columns)):
                if kind == 0:
                    decided, refers_to = (key, page_id, sha1), refer[i]
                    continue
                found = refers_to if decided == (key, page_id, sha1) else None
                out.append(shard.add(key, page_id, url, payloads[i].as_py(), found))
            yield pa.RecordBatch.from_pylist([x for x in out if x], schema=_DIRECTORY_ARROW)
        if shard is not None:
            yield pa.RecordBatch.from_pylist([x for x in [shard.close()] if x], schema=_DIRECTORY_ARROW)

    return through_storage(ordered.mapInArrow(write, DIRECTORY), "archive-directory")


def _block_lines(row: dict) -> list[list]:
    packed = read_range(row["index"], row["index_start"], row["index_end"])
    return [json.loads(x) for x in zlib.decompress(packed, 31).decode().split("\n")]


def read_captures(directory: DataFrame) -> DataFrame:
    """Every capture of the archives, read through the index: page_id, payload_bytes, payload_digest, record_type, refers_to.

    A task reads a block of the index by its range, the captures of the block by theirs, and parses each
    capture on its own; a response's payload is checked against its digest.
    """
    schema = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                        ("record_type", pa.string()), ("refers_to", pa.int64())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                stored = read_range(row["warc"], row["warc_start"], row["warc_end"])
                out = []
                for _, page_id, digest, at, length in _block_lines(row):
                    capture = parse_record(zlib.decompress(stored[at:at + length], 31))
                    head = capture["headers"]
                    if head["warc-payload-digest"] != f"sha1:{digest}" or _page_number(head["warc-record-id"]) != page_id:
                        raise ValueError(f"the index does not fit the archive at {row['warc']}:{at}")
                    refers = head.get("warc-refers-to")
                    out.append({"page_id": page_id, "payload_bytes": int(capture["http"]["content-length"]), "payload_digest": digest,
                                "record_type": head["warc-type"], "refers_to": _page_number(refers) if refers else None})
                yield pa.RecordBatch.from_pylist(out, schema=schema)

    # Few small rows, each of which stands for a block of captures: with a number given, Spark does not put them together.
    blocks, least = directory.count(), directory.sparkSession.sparkContext.defaultParallelism
    tasks = max(1, min(blocks, least), blocks // BLOCKS_A_TASK)
    return directory.repartition(tasks, "part", "block").mapInArrow(
        read, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")


def look_up(directory: DataFrame, url: str) -> list[dict]:
    """All captures of one URL, as parsed records with page_id; reads only the blocks that can hold its key.

    The directory of the parts whose key range meets the key comes to the driver: one row per 1,000
    captures, of one part, or of those parts that captures of this one key fill.
    """
    spark = directory.sparkSession
    key = spark.createDataFrame([(url,)], "url string").select(capture_key(F.col("url"))).first()[0]
    ends = directory.groupBy("part").agg(F.min("first_key").alias("lo"), F.max("last_key").alias("hi"))
    parts = [r["part"] for r in ends.where((F.col("lo") <= F.lit(key)) & (F.col("hi") >= F.lit(key))).collect()]
    rows = [r.asDict() for r in directory.where(F.col("part").isin(parts)).orderBy("part", "block").collect()] if parts else []
    # Spark compares text by its UTF-8 bytes.
    code, lasts = key.encode(), [r["last_key"].encode() for r in rows]
    found = []
    for row in rows[bisect.bisect_left(lasts, code):]:
        if row["first_key"].encode() > code:
            break
        lines = _block_lines(row)
        keys = [x[0].encode() for x in lines]
        for _, page_id, _, at, length in lines[bisect.bisect_left(keys, code):bisect.bisect_right(keys, code)]:
            data = read_range(row["warc"], row["warc_start"] + at, row["warc_start"] + at + length)
            found.append({"page_id": page_id, **parse_record(zlib.decompress(data, 31))})
    return found

"""Deterministic sharded WARC files: ranges of pages, rolled by compressed size, committed by rename and manifest.

Pages are cut into ranges of their id with about equal bytes, found from
histograms of the ids, so that the cuts depend on the data alone. A task sorts a range
and writes its records as gzip members into numbered files; headers, record ids and
digests are made anew. Files get their final names by rename, and only files
listed in the manifest count, so that a task that is run twice does no harm.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, SparkSession, functions as F

from leadtime.llm.common import cut_lineage
from leadtime.llm.files import opened

#: Payload bytes of a range, compressed bytes after which a file is closed, and the date in all headers.
RANGE_BYTES, ROLL_BYTES, DATE = 24 << 20, 8 << 20, "2024-01-01T00:00:00Z"
#: Buckets of one histogram of ids.
CELLS = 1 << 16
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def range_cuts(sized: DataFrame, key: str, size: str, target: int) -> list[int]:
    """Keys at which a new range begins, so that ranges have about ``target`` bytes.

    A histogram of at most CELLS buckets of equal width comes to the driver; a
    bucket heavier than a range is split by another histogram of its own.
    """
    span = sized.agg(F.min(key).alias("a"), F.max(key).alias("b")).first()
    if span["a"] is None:
        return []

    def cells(low: int, high: int) -> list[tuple[int, int]]:
        width = max(1, -(-(high - low + 1) // CELLS))
        cell = F.expr(f"({key} - {low}) div {width}")
        rows = (sized.where(F.col(key).between(low, high)).groupBy(cell.cast("long").alias("c"))
                .agg(F.sum(size).alias("n")).orderBy("c").collect())
        out = []
        for r in rows:
            at = low + r["c"] * width
            out += cells(at, min(high, at + width - 1)) if width > 1 and r["n"] > 2 * target else [(at, r["n"])]
        return out

    cuts, held = [], 0
    for at, n in cells(span["a"], span["b"]):
        if held and held + n > target:
            cuts.append(at)
            held = 0
        held += n
    return cuts


def payload_digest(sha1_hex: str) -> str:
    return base64.b32encode(bytes.fromhex(sha1_hex)).decode()


def roles(pages: DataFrame, key: str = "page_id", payload: str = "html", least: int = 0) -> DataFrame:
    """(key, sha1, refers_to) of rows whose payload stands in a record with a larger key.

    The digest's largest key is found by an aggregate that combines before the
    shuffle; the join back to a digest of many rows is left to Spark's splitting of skewed joins.
    """
    keyed = pages.select(key, F.sha1(_bytes(payload)).alias("sha1"), F.length(_bytes(payload)).alias("_n")).where(F.col("_n") >= least)
    best = keyed.groupBy("sha1").agg(F.max(key).alias("refers_to"), F.count("*").alias("_rows")).where("_rows > 1")
    return keyed.join(best, "sha1").where(F.col(key) < F.col("refers_to")).select(key, "sha1", "refers_to").distinct()


def _bytes(payload: str):
    return F.encode(F.coalesce(F.col(payload), F.lit("")), "UTF-8")


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One record; a revisit keeps the HTTP header and leaves the payload to the record it refers to."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    name = lambda i, d: f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'{i} {d}')}>"
    head = {"WARC-Type": "response" if refers_to is None else "revisit", "WARC-Record-ID": name(page_id, digest), "WARC-Date": DATE}
    if url is not None:
        head["WARC-Target-URI"] = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)
    if page_id is not None:
        head["X-Page-Id"] = str(page_id)
    if refers_to is not None:
        head |= {"WARC-Profile": REVISIT, "WARC-Refers-To": name(refers_to, digest), "X-Refers-To-Page": str(refers_to)}
    head |= {"WARC-Payload-Digest": f"sha1:{digest}", "WARC-Block-Digest": "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode(),
             "Content-Type": "application/http; msgtype=response", "Content-Length": str(len(block))}
    return ("WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head.items()) + "\r\n").encode() + block + b"\r\n\r\n"


class RollingWriter:
    """Writes the numbered files of one range."""

    def __init__(self, folder: str, shard: int, roll: int):
        self.system, self.folder = opened(folder)
        self.shard, self.roll, self.number, self.out = shard, roll, 0, None
        self.done: list[tuple] = []

    def add(self, data: bytes) -> None:
        packer = zlib.compressobj(6, zlib.DEFLATED, 31)
        member = packer.compress(data) + packer.flush()
        if self.out is None:
            self.name = f"pages-{self.shard:06d}-{self.number:05d}.warc.gz"
            self.temporary = f"{self.folder}/_tmp/{self.name}-{uuid.uuid4().hex}"
            self.out, self.size, self.records, self.sum = self.system.open_output_stream(self.temporary, compression=None), 0, 0, hashlib.sha1()
        self.out.write(member)
        self.sum.update(member)
        self.size, self.records = self.size + len(member), self.records + 1
        if self.size >= self.roll:
            self.close()

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.system.move(self.temporary, f"{self.folder}/{self.name}")
            self.done.append((self.name, self.shard, self.number, self.records, self.size, self.sum.hexdigest()))
            self.number, self.out = self.number + 1, None


MANIFEST = "file string, shard int, number int, records long, bytes long, sha1 string"


def write(pages: DataFrame, folder: str, key: str = "page_id", url: str = "url", payload: str = "html", least: int = 0,
          range_bytes: int = RANGE_BYTES, roll_bytes: int = ROLL_BYTES) -> DataFrame:
    """Write one record per row and return the manifest, which is stored beside the files.

    A NULL payload is empty; a NULL key comes first and refers to nothing. Of rows with equal keys and
    payloads the first in order of url may be a response, the others revisit it. Each page crosses the network once, together with its role.
    """
    spark = pages.sparkSession
    system, place = opened(folder)
    system.create_dir(f"{place}/_tmp", recursive=True)
    sized = pages.select(F.col(key).alias("_k"), (F.coalesce(F.octet_length(payload), F.lit(0)) + 200).cast("long").alias("_n"))
    cuts = range_cuts(sized, "_k", "_n", range_bytes)
    rows = pages.select(F.col(key).alias("id"), F.col(url).alias("url"), _bytes(payload).alias("payload"),
                        F.sha1(_bytes(payload)).alias("sha1"), F.lit(None).cast("long").alias("refers_to"))
    marks = roles(pages, key, payload, least).select(F.col(key).alias("id"), F.lit(None).cast("string").alias("url"),
                                                     F.lit(None).cast("binary").alias("payload"), "sha1", "refers_to")
    both = rows.unionByName(marks).withColumn("_at", F.coalesce(F.col("id").cast("double"), F.lit(-1e300)))
    if cuts:
        both = Bucketizer(splits=[float("-inf"), *sorted({float(c) for c in cuts}), float("inf")], inputCol="_at", outputCol="_b").transform(both)
    else:
        both = both.withColumn("_b", F.lit(0.0))
    ranged = (both.withColumn("shard", F.col("_b").cast("int")).select("shard", "id", "url", "payload", "sha1", "refers_to")
              .repartition(max(1, len(cuts) + 1), "shard").sortWithinPartitions("shard", "id", "sha1", F.col("refers_to").desc_nulls_last(), "url"))

    def store(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer, mark, last, done = None, (None, None, None), None, []
        for batch in it:
            for shard, page, at, body, sha1, refers_to in zip(*(c.to_pylist() for c in batch.columns)):
                if writer is None or writer.shard != shard:
                    if writer is not None:
                        writer.close()
                        done += writer.done
                    writer = RollingWriter(folder, shard, roll_bytes)
                if body is None:
                    mark = (page, sha1, refers_to)  # the role of the rows that follow
                    continue
                known = mark[2] if mark[:2] == (page, sha1) else page if last == (page, sha1) and len(body) >= least else None
                last = (page, sha1)
                writer.add(record(page, at, body, payload_digest(sha1), known))
        if writer is not None:
            writer.close()
            done += writer.done
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), (pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.string()))],
                                             ["file", "shard", "number", "records", "bytes", "sha1"])

    ranged.mapInArrow(store, MANIFEST).write.mode("overwrite").parquet(f"{folder}/_manifest")
    return spark.read.schema(MANIFEST).parquet(f"{folder}/_manifest")


def members(stream, chunk: int = 1 << 20) -> Iterator[bytes]:
    """The records of a gzip file of many members, one at a time."""
    unpack, parts, rest = zlib.decompressobj(31), [], b""
    while data := rest or stream.read(chunk):
        parts.append(unpack.decompress(data))
        rest = b""
        if unpack.eof:
            yield b"".join(parts)
            rest, unpack, parts = unpack.unused_data, zlib.decompressobj(31), []


def parse(data: bytes) -> dict:
    """Headers, type and payload of a record; the payload of a revisit is None."""
    head, _, block = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = block[:int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"Content-Length: (\d+)", http)[1])
    return {"fields": fields, "payload": payload if fields["WARC-Type"] == "response" else None, "payload_bytes": size}


RECORDS = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"


def read_back(spark: SparkSession, folder: str, manifest: DataFrame, payloads: bool = False) -> DataFrame:
    """The records of all files of the manifest; digests of responses are worked out from what the file holds."""
    schema = RECORDS + (", payload binary" if payloads else "")
    files = manifest.select("file").repartition(max(1, manifest.count()), "file")

    def load(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, place = opened(folder)
        for batch in it:
            for name in batch.column(0).to_pylist():
                rows, held = [], 0
                with system.open_input_stream(f"{place}/{name}", compression=None) as stream:
                    for data in members(stream):
                        r = parse(data)
                        f, body = r["fields"], r["payload"]
                        digest = f["WARC-Payload-Digest"].removeprefix("sha1:") if body is None else base64.b32encode(hashlib.sha1(body).digest()).decode()
                        page, other = f.get("X-Page-Id"), f.get("X-Refers-To-Page")
                        rows.append((page and int(page), f.get("WARC-Target-URI"), r["payload_bytes"], digest, f["WARC-Type"], other and int(other), body)[:6 + payloads])
                        held += len(data)
                        if held > 4 << 20:
                            yield _batch(rows, payloads)
                            rows, held = [], 0
                if rows:
                    yield _batch(rows, payloads)

    return files.mapInArrow(load, schema)


def _batch(rows: list[tuple], payloads: bool) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()][:6 + payloads]
    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"][:6 + payloads]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

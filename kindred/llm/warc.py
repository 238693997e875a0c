"""WARC archives: a deterministic sharded writer and its reader.

Records are in the order of page ids and digests. A first pass compresses every record and keeps
its size only; sums of sizes along the order say where files of ``file_bytes`` begin, whatever the
partitions were. A second pass sends every page to its file, compresses it and appends it: a
file is written whole by one task, as record-wise gzipped WARC/1.1 under a temporary name until it
is complete. The manifest, one row per file, is written last into the same folder, also under a
temporary name first; only files that it lists count. Headers and digests are made from the payload,
ids and dates from the input, so any run over the same pages writes the same bytes.

Of pages with equal payloads of ``least_bytes`` or more, the one with the smallest id holds
the payload; the others are revisit records that refer to it. Equal payloads are counted
per digest before the shuffle; payloads are moved once, to their file.

The first key of every file reaches the driver: choose ``file_bytes`` by the size of the input.
A null html is an empty payload, a null url gives no target. Rows without an id are sorted
first and refer to the page with the smallest id like others; where no page with that
payload has an id, they refer to none. Of repeated rows the first in order is the response, and
rows with equal ids and payloads lie in one file. An empty table gives no file and no row.
"""

from __future__ import annotations

import base64
import hashlib
import io
import json
import re
import urllib.parse
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kindred.llm import common
from kindred.session import stage, work_path

FILE_BYTES = 16 << 20  # of compressed records, after which a file begins
DATE = "1970-01-01T00:00:00Z"  # the tables hold no time of capture
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

MANIFEST = "file long, path string, records long, file_bytes long"
LISTED = "manifest.jsonl"
PAGES = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}/{digest}')}>"


def _target(url: str | None) -> str | None:
    """A url fit for a header line."""
    return urllib.parse.quote(url, safe="%/:=&?~#+!$,;'@()*[]") if url else None


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    digest = payload_digest(payload)
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    block = http if revisit else http + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {_record_id(page_id, digest)}",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"WARC-Block-Digest: sha1:{payload_digest(block)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if target := _target(url):
        lines.append(f"WARC-Target-URI: {target}")
    if page_id is not None:
        lines.append(f"Page-Id: {page_id}")
    if revisit:
        lines.append(f"WARC-Profile: {PROFILE}")
        if refers_to is not None:
            lines += [f"WARC-Refers-To: {_record_id(refers_to, digest)}", f"Refers-To-Page-Id: {refers_to}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def gzipped(data: bytes) -> bytes:
    """One gzip member without a time or a name."""
    member = zlib.compressobj(6, zlib.DEFLATED, 31)
    return member.compress(data) + member.flush()


class Shard:
    """An archive under its temporary name."""

    def __init__(self, uri: str):
        self.uri, self.temporary = uri, f"{uri}.{uuid.uuid4().hex}.tmp"
        files, path = common.shared_file(self.temporary)
        files.create_dir(path.rpartition("/")[0], recursive=True)
        self.out, self.records, self.size = files.open_output_stream(path), 0, 0

    def add(self, data: bytes) -> None:
        member = gzipped(data)
        self.out.write(member)
        self.records += 1
        self.size += len(member)

    def close(self) -> None:
        self.out.close()
        common.commit_file(self.uri, self.temporary)


def _payload() -> F.Column:
    return F.coalesce(F.col("html").cast("string"), F.lit(""))


def _flagged(pages: DataFrame, least_bytes: int) -> DataFrame:
    """Pages with the digest of their payload, ``first``, the id of the page that holds it, and
    whether other pages do, too."""
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), _payload().alias("html")
    )
    sums = rows.select("page_id", F.sha1("html").alias("sum"), F.octet_length("html").alias("n"))
    repeated = stage(
        sums.where(F.col("n") >= least_bytes).groupBy("sum")
        .agg(F.min("page_id").alias("first"), F.count("*").alias("rows")).where("rows > 1").select("sum", "first"),
        "payloads",
    )
    # A revisit needs its page's first holder only: ids are joined, not payloads.
    holders = stage(
        sums.where(F.col("n") >= least_bytes).join(repeated, "sum")
        .select(F.col("page_id").alias("id"), F.col("sum").alias("own"), "first").distinct(),
        "holders",
    )
    return (
        rows.withColumn("sum", F.sha1("html"))
        .join(holders, F.col("page_id").eqNullSafe(F.col("id")) & (F.col("sum") == F.col("own")), "left")
        .select("page_id", "url", "html", "sum", "first", F.col("own").isNotNull().alias("shared"))
    )


def _sizes(flagged: DataFrame) -> DataFrame:
    """The compressed bytes of the records of every id and digest. Repeated rows count as their
    first, whichever that will be."""
    schema = pa.schema([("page_id", pa.int64()), ("sum", pa.string()), ("size", pa.int64())])

    def run(batches):
        for batch in common.slices(batches, "html"):
            columns = [batch.column(c).to_pylist() for c in ("page_id", "url", "html", "sum", "first", "shared")]
            sizes = []
            for page_id, url, html, _, first, shared in zip(*columns):
                revisit = bool(shared and page_id != first)
                sizes.append(len(gzipped(record(page_id, url, html.encode(), first if revisit else None, revisit))))
            yield common.batch_of(schema, {"page_id": columns[0], "sum": columns[3], "size": sizes})

    sizes = flagged.mapInArrow(run, "page_id long, sum string, size long")
    return sizes.groupBy("page_id", "sum").agg(F.sum("size").alias("size"))


def _file_starts(sizes: DataFrame, file_bytes: int) -> list[tuple]:
    """The first id and digest of every file: where sums of sizes along the order pass a multiple
    of ``file_bytes``. The sums start anew in each range partition and are shifted by the totals of
    those before it, of which there is one for each task."""

    def run(batches):
        part, before = TaskContext.get().partitionId(), 0
        for batch in batches:
            size = batch.column("size").to_numpy()
            sums = np.cumsum(size) - size + before
            before += int(size.sum())
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(size), part)), *batch.columns, pa.array(sums)],
                names=["part", "page_id", "sum", "size", "before"],
            )

    order = ["page_id", "sum"]
    placed = stage(
        sizes.repartitionByRange(*order).sortWithinPartitions(*order)
        .mapInArrow(run, "part long, page_id long, sum string, size long, before long"),
        "record-sizes",
    )
    totals = {r["part"]: r["n"] for r in placed.groupBy("part").agg(F.sum("size").alias("n")).collect()}
    if not totals:
        return []
    starts, total = {}, 0
    for part in sorted(totals):
        starts[part], total = total, total + totals[part]
    shift = F.create_map(*[F.lit(x) for item in starts.items() for x in item])[F.col("part")]
    number = F.floor((F.col("before") + shift) / F.lit(file_bytes))
    firsts = placed.groupBy(number.alias("file")).agg(F.min(F.struct(*order)).alias("key")).orderBy("file").collect()
    return [tuple(r["key"]) for r in firsts]


def _file_of(rows: DataFrame, starts: list[tuple]) -> DataFrame:
    """``rows`` with the number of their file, by a binary search of the starts."""
    spark = rows.sparkSession
    held = spark.createDataFrame([(starts,)], "starts array<struct<page_id:long,sum:string>>")
    steps = max(1, len(starts)).bit_length()
    key = F.struct("page_id", "sum")

    def step(low, power):
        middle = low + power
        return F.when((middle < len(starts)) & (key >= F.get("_starts", middle)), middle).otherwise(low)

    powers = F.array(*[F.lit(1 << k) for k in range(steps - 1, -1, -1)])
    with_starts = rows.select("*", held.select("starts").scalar().alias("_starts"))
    return with_starts.withColumn("file", F.aggregate(powers, F.lit(0), step)).drop("_starts")


def write(pages: DataFrame, folder: str | None = None, least_bytes: int = 0, file_bytes: int = FILE_BYTES) -> str:
    """Write every page as a record and return the folder, which the manifest completes."""
    spark = pages.sparkSession
    folder = folder or work_path(spark, "warc")
    flagged = _flagged(pages, least_bytes)
    starts = _file_starts(_sizes(flagged), file_bytes)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = _file_of(flagged, starts).repartition(max(1, min(parts, 4 * len(starts))), "file")
    sorted_rows = dealt.sortWithinPartitions("file", "page_id", "sum", "url")
    schema = pa.schema([("file", pa.int64()), ("path", pa.string()), ("records", pa.int64()), ("file_bytes", pa.int64())])

    def run(batches):
        shard, number, last = None, None, None

        def done():
            shard.close()
            return pa.RecordBatch.from_pylist(
                [dict(file=number, path=shard.uri, records=shard.records, file_bytes=shard.size)], schema
            )

        for batch in common.slices(batches, "html"):
            columns = [batch.column(c).to_pylist() for c in ("file", "page_id", "url", "html", "sum", "first", "shared")]
            for file, page_id, url, html, own, first, shared in zip(*columns):
                if file != number:
                    if shard is not None:
                        yield done()
                    shard, number = Shard(f"{folder}/part-{file:06d}.warc.gz"), file
                revisit = bool(shared and (page_id != first or last == (page_id, own)))
                last = (page_id, own)
                shard.add(record(page_id, url, html.encode(), first if revisit else None, revisit))
        if shard is not None:
            yield done()

    listed = stage(sorted_rows.mapInArrow(run, MANIFEST), "warc-files")
    _write_manifest(listed, folder)
    return folder


def _write_manifest(listed: DataFrame, folder: str) -> None:
    """One line per file, in order; the name is given last."""
    uri = f"{folder}/{LISTED}"
    temporary = f"{uri}.{uuid.uuid4().hex}.tmp"
    files, path = common.shared_file(temporary)
    files.create_dir(path.rpartition("/")[0], recursive=True)
    with files.open_output_stream(path) as out:
        for r in listed.orderBy("file").toLocalIterator():
            line = dict(file=r["file"], path=r["path"].rpartition("/")[2], records=r["records"], file_bytes=r["file_bytes"])
            out.write(json.dumps(line).encode() + b"\n")
    common.commit_file(uri, temporary)


def _members(stream, chunk: int = 1 << 20):
    """The gzip members of a file, one after another."""
    held = b""
    while True:
        member, out = zlib.decompressobj(31), io.BytesIO()
        while not member.eof:
            held = held or stream.read(chunk)
            if not held:
                return
            out.write(member.decompress(held))
            held = member.unused_data
        yield out.getvalue()


_FIELD = re.compile(rb"^([A-Za-z-]+): (.*)$", re.M)


def parse(data: bytes) -> dict:
    """A record's page id, payload length, digest, type and the id it refers to. A response's
    length and digest are those of the payload that was read."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = {k.decode(): v.strip().decode() for k, v in _FIELD.findall(head.replace(b"\r\n", b"\n"))}
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    if payload_digest(block) != fields["WARC-Block-Digest"].removeprefix("sha1:"):
        raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
    response = fields["WARC-Type"] == "response"
    number = lambda name: int(fields[name]) if name in fields else None
    return {
        "page_id": number("Page-Id"),
        "payload_bytes": len(payload) if response else int(re.search(rb"Content-Length: (\d+)", http)[1]),
        "payload_digest": payload_digest(payload) if response else fields["WARC-Payload-Digest"].removeprefix("sha1:"),
        "record_type": fields["WARC-Type"],
        "refers_to": number("Refers-To-Page-Id"),
    }


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    """The files that count, with their paths."""
    rows = spark.read.schema(MANIFEST).json(f"{folder}/{LISTED}")
    return rows.withColumn("path", F.concat(F.lit(f"{folder}/"), "path"))


def read(spark: SparkSession, folder: str) -> DataFrame:
    """One row per record of the archives that the manifest lists."""
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    schema = pa.schema(
        [("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
         ("record_type", pa.string()), ("refers_to", pa.int64())]
    )

    def run(batches):
        for batch in batches:
            for uri in batch.column("path").to_pylist():
                files, path = common.shared_file(uri)
                rows = []
                with files.open_input_stream(path, compression=None) as stream:
                    for data in _members(stream):
                        rows.append(parse(data))
                        if len(rows) == 4096:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows = []
                yield pa.RecordBatch.from_pylist(rows, schema)

    return manifest(spark, folder).select("path").repartition(parts, "path").mapInArrow(run, PAGES)


def op6_warc(spark, sf_dir: str) -> DataFrame:
    return read(spark, write(common.table(spark, sf_dir, "pages")))


# SHA-1 in base 32: five hexadecimal digits make four characters.
ORACLE = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages
), d AS (
  SELECT page_id, strlen(html) AS payload_bytes, hex,
         min(page_id) OVER (PARTITION BY hex) AS first,
         list_transform(range(0, 8), lambda i: CAST('0x' || substr(hex, 5 * i + 1, 5) AS BIGINT)) AS groups
  FROM p
)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes,
       list_aggregate(list_transform(range(0, 32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         CAST((groups[CAST(k // 4 AS INTEGER) + 1] >> (5 * (3 - k % 4))) & 31 AS INTEGER) + 1, 1)), 'string_agg', '') AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
FROM d
"""

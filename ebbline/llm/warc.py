"""WARC archives: a deterministic sharded writer, and a reader that checks what it reads.

Records are sorted by page id and cut into shards of about equal raw size, of which there are at most
``MAX_SHARDS``. The cuts come from exact sums over ranges of ids, not from a sample, so the same pages always
give the same files, byte for byte, whatever the cluster. An id heavier than a shard, or all rows without an id,
are cut by digest into parts. A task writes one shard, or one part, a record at a time and starts a new file when
the compressed size passes ``roll_bytes``; every record is a gzip member of its own. Headers, record
ids and digests are made from the rows alone. Payloads may be of any length that a row holds; a file has one record
beyond ``roll_bytes`` at most, and is read back whole, so payloads should stay below a gigabyte.

Of the pages with equal payloads the one with the largest id is the response and the others revisit it.

Commit: tasks write under temporary names of their own and report their files. The report is
written as a table; then the files it names are moved to their final names, which can be repeated
after a failure, and last the manifest is written. Files without a line in the manifest, left by a
task that was run twice, are never read.

Null payloads are empty. Null ids come first, in a shard of their own; a page without an id is the response only if no page
with the same payload has one. Rows that agree in id and payload share their fate and are told
apart by a number in their record id. Null URLs are written as ``urn:none``. Empty tables give a
manifest without files. Other columns are not looked at.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import math
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, functions as F

from ebbline.session import shared_folder, stage

# Fixed values of the format.
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NO_URI = "urn:none"
# Raw size that a record has besides its payload, roughly.
RECORD_BYTES = 512
BROADCAST_BYTES = 32_000_000
# A range of ids that a cut falls into is counted in so many narrower ones.
FANOUT = 64
# Tables that ask for more shards get larger ones.
MAX_SHARDS = 20_000


@dataclass(frozen=True)
class WarcOptions:
    shard_bytes: int = 32_000_000
    roll_bytes: int = 16_000_000
    # Pages with equal payloads shorter than this are all responses.
    min_revisit_bytes: int = 0
    date: str = "2026-01-01T00:00:00Z"
    level: int = 6


def _small(df: DataFrame, rows: int, row_bytes: int) -> DataFrame:
    return F.broadcast(df) if rows * row_bytes <= BROADCAST_BYTES else df


def _with_originals(rows: DataFrame, options: WarcOptions) -> DataFrame:
    """Add ``refers_to``, the page that a revisit stands for, and ``revisit``."""
    hashed = rows.select("page_id", "digest", "size").where(F.col("size") >= options.min_revisit_bytes)
    originals = hashed.groupBy("digest", "size").agg(F.max("page_id").alias("original"), F.count(F.lit(1)).alias("n"))
    originals = stage(originals.where("n > 1").select("digest", "size", "original"), "warc-originals")
    joined = rows.join(_small(originals, originals.count(), 64), ["digest", "size"], "left")
    revisit = F.col("original").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("original"))
    return joined.withColumn("revisit", revisit).withColumn("refers_to", F.when(F.col("revisit"), F.col("original")))


@dataclass(frozen=True)
class Cuts:
    """Where shards begin. Ids from ``starts[k]`` on are in shard k + 1 or a later one.

    ``parts`` has the ids that fill several shards' room by themselves, null among them; they are cut by digest.
    """

    starts: tuple[int, ...]
    parts: tuple[tuple[int | None, int], ...]

    @property
    def shards(self) -> int:
        return len(self.starts) + 1


def find_cuts(rows: DataFrame, options: WarcOptions) -> Cuts:
    """Cuts of (page_id, size) into shards of about equal raw size.

    Ids are counted in ranges of one width; ranges that a cut falls into are counted again in narrower ones, until
    they are light or a single id. Rows without an id come first and are a shard of their own. At most ``MAX_SHARDS``
    shards are made, larger ones where the table asks for more, so that the counts that reach the driver are
    bounded: 8 per shard at first, then ``FANOUT`` for each cut.
    """
    sized = rows.select("page_id", (F.col("size") + RECORD_BYTES).alias("weight"))
    known = sized.where("page_id IS NOT NULL")
    low, high, total, unknown = sized.agg(
        F.min("page_id"), F.max("page_id"), F.sum(F.when(F.col("page_id").isNotNull(), F.col("weight"))),
        F.sum(F.when(F.col("page_id").isNull(), F.col("weight"))),
    ).first()
    total, unknown = total or 0, unknown or 0
    shards = min(MAX_SHARDS, max(1, math.ceil(total / options.shard_bytes)))
    room = max(options.shard_bytes, total / shards)
    parts: dict[int | None, int] = {None: min(MAX_SHARDS, math.ceil(unknown / room))} if unknown else {}
    # What shards end with, as weight from the smallest id on: the cuts that are not placed yet.
    ends = np.array([-(-k * total // shards) for k in range(1, shards)], np.int64)
    starts: list[int] = [low] if unknown and low is not None else []
    width, outer = 1 << min(62, max(0, (((high or 0) - (low or 0)) // (8 * shards)).bit_length())), None
    while len(ends):
        place, weight = _ranges(known, width, outer)
        before = np.cumsum(weight) - weight
        if outer is not None:
            # Ranges within one outer range are neighbours, and the first of them begins where that does.
            first = np.searchsorted(place - place % outer.width, outer.starts)
            before += np.repeat(outer.before - before[first], np.diff(np.append(first, len(place))))
        at = np.searchsorted(before, ends) - 1
        heavy = (weight[at] > room / 8) & (width > 1)
        for k in np.flatnonzero(~heavy):
            # A light range, or a single id, goes to the shard that its middle is in.
            upper = before[at[k]] + weight[at[k]] / 2 >= ends[k]
            starts.append(int(place[at[k]]) + (0 if upper else width))
            if width == 1 and weight[at[k]] > room:
                parts[int(place[at[k]])] = math.ceil(weight[at[k]] / room)
        again = np.unique(at[heavy])
        outer, ends = _Outer(width, place[again], before[again]), ends[heavy]
        width = max(1, width // FANOUT)
    # No id is beyond the largest.
    return Cuts(tuple(sorted(start for start in starts if start <= high)), tuple(parts.items()))


@dataclass(frozen=True)
class _Outer:
    """Ranges to be counted again: their width, their starts in order and the weight before each."""

    width: int
    starts: np.ndarray
    before: np.ndarray


def _ranges(known: DataFrame, width: int, outer: _Outer | None) -> tuple[np.ndarray, np.ndarray]:
    """Starts and weights of the ranges of ``width``, in order; only those inside the outer ranges, if given."""
    if outer is not None:
        table = known.sparkSession.createDataFrame(pa.table({"outer": pa.array(outer.starts)}))
        match = F.expr(f"page_id - pmod(page_id, {outer.width}L)") == F.col("outer")
        known = known.join(_small(table, len(outer.starts), 8), match, "left_semi")
    start = F.expr(f"page_id - pmod(page_id, {width}L)").alias("start")
    found = known.groupBy(start).agg(F.sum("weight").alias("weight")).toArrow()
    order = np.argsort(found.column("start").to_numpy(), kind="stable")
    return found.column("start").to_numpy()[order], found.column("weight").to_numpy()[order]


def _with_shards(rows: DataFrame, options: WarcOptions) -> tuple[DataFrame, int]:
    """Add ``shard``, ``part`` and ``slot``, the number of the task that writes them; and the number of slots."""
    cuts = find_cuts(rows, options)
    middle = "CAST((s.low + s.high) div 2 AS INT)"
    later = f"named_struct('low', {middle} + 1, 'high', s.high)"
    step = f"IF(s.low >= s.high, s, IF(_starts[{middle}] <= page_id, {later}, named_struct('low', s.low, 'high', {middle})))"
    begin = f"named_struct('low', 0, 'high', {len(cuts.starts)})"
    shard = f"aggregate(sequence(1, {cuts.shards.bit_length()}), {begin}, (s, turn) -> {step}, s -> s.low)"
    # A row per heavy id, fewer than there are shards. Their parts but the first have slots after all shards.
    after = accumulate((parts - 1 for _, parts in cuts.parts), initial=cuts.shards)
    table = [(page_id, parts, slot) for (page_id, parts), slot in zip(cuts.parts, after)]
    slots = cuts.shards + sum(parts - 1 for _, parts in cuts.parts)
    heavy = F.broadcast(rows.sparkSession.createDataFrame(table, "heavy long, _parts long, _slot long"))
    share = F.conv(F.substring("digest", 1, 6), 16, 10).cast("long")
    placed = (
        rows.withColumn("_starts", F.lit(list(cuts.starts)).cast("array<bigint>"))
        .withColumn("shard", F.expr(f"CAST(IF(page_id IS NULL, 0, {shard}) AS INT)"))
        .join(heavy, F.col("page_id").eqNullSafe(F.col("heavy")), "left")
        .withColumn("part", F.shiftright(share * F.coalesce("_parts", F.lit(1)), 24).cast("int"))
        .withColumn("slot", F.expr("CAST(IF(part = 0, shard, _slot + part - 1) AS INT)"))
    )
    return placed.drop("_starts", "heavy", "_parts", "_slot"), slots


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(page_id: int | None, digest: str, number: int = 0) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}/{digest}/{number}')}>"


def _record(headers: list[tuple[str, object]], block: bytes) -> bytes:
    headers = [*headers, ("WARC-Block-Digest", "sha1:" + base32_sha1(block)), ("Content-Length", len(block))]
    return f"{VERSION}\r\n{''.join(f'{k}: {v}\r\n' for k, v in headers)}\r\n".encode() + block + b"\r\n\r\n"


def _uri(url: str | None) -> str:
    """The URL with white space and control characters percent-encoded, so it stays on its line."""
    return re.sub(r"[\x00-\x20\x7f]", lambda c: f"%{ord(c[0]):02X}", url) if url else NO_URI


def page_record(row: dict, number: int, date: str) -> bytes:
    payload, revisit = row["payload"], row["revisit"]
    digest = base32_sha1(payload)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    headers = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", record_id(row["page_id"], digest, number)),
        ("WARC-Date", date),
        ("WARC-Target-URI", _uri(row["url"])),
        ("Content-Type", "application/http; msgtype=response"),
        ("WARC-Payload-Digest", "sha1:" + digest),
        ("X-Payload-Length", len(payload)),
    ]
    if row["page_id"] is not None:
        headers.append(("X-Page-Id", row["page_id"]))
    if revisit:
        headers.append(("WARC-Profile", PROFILE))
        headers.append(("WARC-Refers-To", record_id(row["refers_to"], digest)))
        headers.append(("X-Refers-To-Page-Id", row["refers_to"]))
    return _record(headers, http if revisit else http + payload)


class _File:
    """A file under a temporary name, and what its line in the manifest will say."""

    def __init__(self, folder: str, shard: tuple[int, int], number: int, options: WarcOptions):
        self.options, self.shard = options, shard
        self.name = f"shard-{shard[0]:06d}-{shard[1]:04d}-{number:04d}.warc.gz"
        self.temporary = f"_temporary/{uuid.uuid4().hex}-{self.name}"
        system, path = fs.FileSystem.from_uri(f"{folder}/{self.temporary}")
        self.stream = system.open_output_stream(path, compression=None)
        self.records = self.bytes = 0
        self.first = self.last = None
        self.sum = hashlib.sha256()
        info = f"software: ebbline\r\nformat: {VERSION}\r\n".encode()
        self._add([("WARC-Type", "warcinfo"), ("WARC-Record-ID", record_id(None, self.name)), ("WARC-Date", options.date),
                   ("WARC-Filename", self.name), ("Content-Type", "application/warc-fields")], info)

    def _add(self, headers: list, block: bytes) -> None:
        self.write(_record(headers, block))

    def write(self, record: bytes) -> None:
        member = gzip.compress(record, self.options.level, mtime=0)
        self.sum.update(member)
        self.bytes += len(member)
        self.stream.write(member)

    def add(self, row: dict, number: int) -> None:
        self.write(page_record(row, number, self.options.date))
        self.first = row["page_id"] if not self.records else self.first
        self.records, self.last = self.records + 1, row["page_id"]

    def close(self) -> dict:
        self.stream.close()
        return {
            "name": self.name, "temporary": self.temporary, "shard": self.shard[0], "records": self.records,
            "bytes": self.bytes, "sha256": self.sum.hexdigest(), "first_id": self.first, "last_id": self.last,
        }


MANIFEST = pa.schema(
    [("name", pa.string()), ("temporary", pa.string()), ("shard", pa.int32()), ("records", pa.int64()),
     ("bytes", pa.int64()), ("sha256", pa.string()), ("first_id", pa.int64()), ("last_id", pa.int64())]
)
MANIFEST_DDL = (
    "name string, temporary string, shard int, records long, bytes long, sha256 string, first_id long, last_id long"
)


def _writer(folder: str, options: WarcOptions):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, number, same, before, done = None, 0, 0, None, []
        for batch in batches:
            for index in range(batch.num_rows):
                row = {name: batch.column(name)[index].as_py() for name in batch.schema.names}
                shard = (row["shard"], row["part"])
                if out and (shard != out.shard or out.bytes >= options.roll_bytes):
                    number = number + 1 if shard == out.shard else 0
                    done.append(out.close())
                    out = None
                out = out or _File(folder, shard, number, options)
                # Equal rows are neighbours; they are numbered so that their record ids differ.
                this = (row["page_id"], row["digest"])
                same = same + 1 if this == before else 0
                out.add(row, same)
                before = this
        if out:
            done.append(out.close())
        yield pa.RecordBatch.from_pylist(done, MANIFEST)

    return run


def _mover(folder: str):
    """Moves reported files to their final names; a file that is there already was moved before."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                system, target = fs.FileSystem.from_uri(f"{folder}/{row['name']}")
                if system.get_file_info(target).size != row["bytes"]:
                    system.move(fs.FileSystem.from_uri(f"{folder}/{row['temporary']}")[1], target)
            yield batch

    return run


def write(pages: DataFrame, folder: str, options: WarcOptions = WarcOptions()) -> DataFrame:
    """Write page_id, url and html of all rows under ``folder`` and return the manifest."""
    spark = pages.sparkSession
    payload = F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "UTF-8")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload")).withColumn("size", F.octet_length("payload").cast("long"))
    sharded, slots = _with_shards(rows, options)
    placed = _with_originals(sharded, options).drop("original", "size")
    order = ["shard", "part", "page_id", "digest", "url"]
    # A task for every shard, or part of one.
    sorted_rows = placed.repartitionById(slots, F.col("slot")).drop("slot").sortWithinPartitions(*order)
    system, path = fs.FileSystem.from_uri(f"{folder}/_temporary")
    system.create_dir(path, recursive=True)
    report = stage(sorted_rows.mapInArrow(_writer(folder, options), MANIFEST_DDL), "warc-report")
    report.mapInArrow(_mover(folder), MANIFEST_DDL).drop("temporary").write.parquet(f"{folder}/_manifest")
    system.delete_dir(path)
    return spark.read.parquet(f"{folder}/_manifest")


def parse(data: bytes) -> Iterator[dict]:
    """The page records of one file; a digest or length that does not fit raises."""
    stream = gzip.GzipFile(fileobj=io.BytesIO(data))
    while version := stream.readline():
        if version.strip().decode() != VERSION:
            raise ValueError(f"not a WARC record: {version[:40]!r}")
        headers = {}
        while (line := stream.readline().rstrip(b"\r\n")) != b"":
            name, _, value = line.decode().partition(": ")
            headers[name] = value
        block = stream.read(int(headers["Content-Length"]))
        if stream.read(4) != b"\r\n\r\n" or "sha1:" + base32_sha1(block) != headers["WARC-Block-Digest"]:
            raise ValueError(f"damaged record {headers.get('WARC-Record-ID')}")
        kind = headers["WARC-Type"]
        if kind not in ("response", "revisit"):
            continue
        payload = block.partition(b"\r\n\r\n")[2]
        digest = headers["WARC-Payload-Digest"].removeprefix("sha1:")
        if kind == "response" and (base32_sha1(payload) != digest or len(payload) != int(headers["X-Payload-Length"])):
            raise ValueError(f"damaged payload {headers.get('WARC-Record-ID')}")
        number = lambda name: int(headers[name]) if name in headers else None
        yield {
            "page_id": number("X-Page-Id"), "url": headers["WARC-Target-URI"], "record_type": kind,
            "payload_bytes": number("X-Payload-Length"), "payload_digest": digest,
            "refers_to": number("X-Refers-To-Page-Id"), "payload": payload if kind == "response" else None,
        }


RECORDS = pa.schema(
    [("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload_bytes", pa.int64()),
     ("payload_digest", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())]
)
RECORDS_DDL = (
    "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, payload binary"
)
BATCH_BYTES = 16_000_000


def read(spark: SparkSession, folder: str) -> DataFrame:
    """The records of all files in the manifest, checked against it and against their own digests."""
    manifest = spark.read.parquet(f"{folder}/_manifest").select("name", "sha256", "records")
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.gz").load(folder)
    named = files.select(F.regexp_extract("path", "([^/]*)$", 1).alias("name"), "content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, sha256, records, content in zip(*(batch.column(c) for c in ("name", "sha256", "records", "content"))):
                data, rows, size, count = content.as_py(), [], 0, 0
                if hashlib.sha256(data).hexdigest() != sha256.as_py():
                    raise ValueError(f"{name} is not the file that was committed")
                for row in parse(data):
                    rows.append(row)
                    size, count = size + len(row["payload"] or b""), count + 1
                    if size > BATCH_BYTES:
                        yield pa.RecordBatch.from_pylist(rows, RECORDS)
                        rows, size = [], 0
                if count != records.as_py():
                    raise ValueError(f"{name} has {count} records")
                yield pa.RecordBatch.from_pylist(rows, RECORDS)

    # The manifest goes to the files: contents stay where they are read.
    return named.join(_small(manifest, manifest.count(), 120), "name").mapInArrow(run, RECORDS_DDL)


def write_and_read(pages: DataFrame, options: WarcOptions = WarcOptions()) -> DataFrame:
    """Pages as archives in a new folder of the shared one, read back."""
    spark = pages.sparkSession
    folder = f"{shared_folder(spark).rstrip('/')}/warc-{uuid.uuid4().hex}"
    write(pages, folder, options)
    return read(spark, folder)

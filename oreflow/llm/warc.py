"""Web archives: writing pages as WARC records, and finding captures by a two-level index.

Every task writes its pages to one archive file in a shared folder, each record compressed for itself, and reports
where its records lie. The file names are new for each attempt, and only the reports of attempts that Spark
counts are stored, so a task that runs twice leaves at most a file that nothing points to.

The index lists captures by their key, the address with its host reversed. It is sorted by ranges of keys, one
part per range; each part is cut into compressed blocks of lines, and a sparse directory has the first key of
each block. A look-up finds the part by the parts' bounds, the block by binary search in the part's directory, the
capture by binary search in the block, and then reads only the record's bytes from the archive.
"""

from __future__ import annotations

import bisect
import gzip
import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator
from datetime import datetime, timezone

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oreflow.llm.common import stored
from oreflow.session import scratch

#: Payloads with fewer bytes are never written as revisits.
REVISIT_BYTES = 1000
#: Captures to a block of the index, and to a part of it.
BLOCK_LINES = 500
PART_LINES = 20_000
#: Records to an archive file.
FILE_RECORDS = 20_000
DATE = datetime(2024, 1, 1, tzinfo=timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")


def capture_key(url: Column) -> Column:
    """Sort key of an address: host parts from the last to the first, then what follows the host."""
    rest = F.regexp_replace(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.lower(F.regexp_extract(rest, r"^([^/?#]*)", 1))
    path = F.regexp_replace(rest, r"^[^/?#]*", "")
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), path)


def filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def record(kind: str, page: str, url: str, digest: str, size: int, refers: str | None, payload: bytes) -> bytes:
    """One WARC 1.1 record. A revisit has no payload of its own; it names the record that has."""
    body = b"" if kind == "revisit" else payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <urn:page:{page}>",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {url}",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"X-Payload-Length: {size}",
        f"Content-Length: {len(body)}",
    ]
    if refers is not None:
        head.append(f"WARC-Refers-To: <urn:page:{refers}>")
        head.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def parse(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and body of one record; raises if it is cut short."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    first, *lines = head.decode().split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines)
    n = int(fields["Content-Length"])
    if not first.startswith("WARC/") or rest[n:] != b"\r\n\r\n":
        raise ValueError("not a whole record")
    return fields, rest[:n]


def _clean(url: str | None) -> str:
    return (url or "").replace("\r", "%0D").replace("\n", "%0A")


def write_archives(pages: DataFrame, id: str = "page_id", url: str = "url", payload: str = "html") -> DataFrame:
    """Write a record for every page; returns the stored captures: key, page, file, offset, length.

    Of the records with equal payloads of at least ``REVISIT_BYTES`` the one with the largest id is the response,
    the others revisit it.
    """
    spark = pages.sparkSession
    folder = scratch(spark, "archives")
    raw = F.encode(F.coalesce(F.col(payload), F.lit("")), "UTF-8")
    own = pages.select(F.col(id).alias("page"), F.col(url).alias("url"), raw.alias("raw"))
    own = own.withColumns({"digest": F.sha1("raw"), "size": F.octet_length("raw").cast("long")})
    # by digest without payloads; pre-aggregated, so a payload that a third of the pages have is no burden
    held = own.where(F.col("size") >= REVISIT_BYTES).groupBy("digest", "size")
    held = held.agg(F.max("page").alias("response"), F.count("*").alias("n")).where("n > 1").drop("n")
    held = stored(held, "responses")
    own = own.join(held, ["digest", "size"], "left")
    revisit = F.col("response").isNotNull() & ~F.col("page").eqNullSafe(F.col("response"))
    own = own.select(
        F.col("page").cast("string").alias("page"),
        "url",
        "digest",
        "size",
        F.when(revisit, F.col("response").cast("string")).alias("refers"),
        F.when(~revisit, F.col("raw")).alias("raw"),  # what a revisit doesn't carry isn't shuffled
        capture_key(F.col("url")).alias("key"),
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, name, count, at = None, "", 0, 0
        fs, root = filesystem(folder)
        fs.create_dir(root)
        for batch in batches:
            rows = batch.to_pylist()
            places = []
            for r in rows:
                if out is None or count >= FILE_RECORDS:
                    if out is not None:
                        out.close()
                    name, count, at = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = fs.open_output_stream(f"{root}/{name}", compression=None)
                kind = "response" if r["refers"] is None else "revisit"
                raw = record(kind, r["page"] or "", _clean(r["url"]), r["digest"], r["size"], r["refers"], r["raw"] or b"")
                member = gzip.compress(raw, 6, mtime=0)
                out.write(member)
                places.append((name, at, len(member)))
                at += len(member)
                count += 1
            columns = [batch.column("key"), batch.column("page")]
            columns += [pa.array([p[k] for p in places], t) for k, t in enumerate((pa.string(), pa.int64(), pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["key", "page", "file", "offset", "length"])
        if out is not None:
            out.close()

    captures = own.mapInArrow(write, "key string, page string, file string, offset long, length long")
    captures = stored(captures, "captures")
    captures.archives = folder
    return captures


class CaptureIndex:
    """Two-level index of captures in a shared folder."""

    def __init__(self, parts: DataFrame, bounds: list[tuple[str, int]], archives: str):
        self.parts, self.bounds, self.archives = parts, bounds, archives

    @classmethod
    def build(cls, captures: DataFrame, block_lines: int = BLOCK_LINES, part_lines: int = PART_LINES) -> CaptureIndex:
        """Sort captures by key into parts of blocks; equal keys of one part stay in order of page and place."""
        parts = max(1, -(-captures.count() // part_lines))
        ordered = captures.repartitionByRange(parts, "key", "page", "file", "offset").sortWithinPartitions(
            "key", "page", "file", "offset"
        )

        def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            part, number, lines = uuid.uuid4().int >> 66, 0, []

            def block() -> pa.RecordBatch:
                raw = "\n".join(json.dumps(x, ensure_ascii=False) for x in lines).encode()
                return pa.RecordBatch.from_pydict(
                    {
                        "part": pa.array([part], pa.int64()),
                        "block": pa.array([number], pa.int64()),
                        "first": [lines[0][0]],
                        "last": [lines[-1][0]],
                        "n": pa.array([len(lines)], pa.int64()),
                        "data": pa.array([zlib.compress(raw, 6)], pa.binary()),
                    }
                )

            for batch in batches:
                for row in zip(*(c.to_pylist() for c in batch.columns)):
                    lines.append(row)
                    if len(lines) == block_lines:
                        yield block()
                        number, lines = number + 1, []
            if lines:
                yield block()

        schema = "part long, block long, first string, last string, n long, data binary"
        index = stored(ordered.mapInArrow(blocks, schema), "index")
        # one row per part, a bounded number of captures each
        bounds = index.groupBy("part").agg(F.min("first").alias("first"), F.max("last").alias("last")).collect()
        return cls(index, sorted((r["first"], r["last"], r["part"]) for r in bounds), captures.archives)

    def lookup(self, urls: DataFrame, url: str = "url") -> DataFrame:
        """(key, fields, body) of the captures of the different addresses in ``urls``.

        Every address goes to the parts whose range holds its key, as rows beside the part's blocks; each part is
        searched by one task, which holds a directory of first keys and one open block.
        """
        bounds, folder = self.bounds, self.archives
        firsts, lasts = [b[0] for b in bounds], [b[1] for b in bounds]

        def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                part, key = [], []
                for k in batch.column(0).to_pylist():
                    # ranges are sorted; equal keys may go on in the next ones
                    for p in range(bisect.bisect_left(lasts, k), bisect.bisect_right(firsts, k)):
                        part.append(bounds[p][2])
                        key.append(k)
                yield pa.RecordBatch.from_arrays([pa.array(part, pa.int64()), pa.array(key, pa.string())], names=["part", "key"])

        def search(part: pa.Table, asked: pa.Table) -> pa.Table:
            part = part.sort_by("block")
            directory, data = part["first"].to_pylist(), part["data"]
            found: list[tuple] = []
            opened: tuple[int, list] = (-1, [])
            for key in sorted(set(asked["key"].to_pylist())):
                at = max(bisect.bisect_left(directory, key) - 1, 0)  # the block before may end with the key
                while at < len(directory) and directory[at] <= key:
                    if opened[0] != at:
                        lines = zlib.decompress(data[at].as_py()).decode().split("\n")
                        opened = at, [json.loads(x) for x in lines]
                    lo = bisect.bisect_left(opened[1], key, key=lambda x: x[0])
                    while lo < len(opened[1]) and opened[1][lo][0] == key:
                        found.append(tuple(opened[1][lo]))
                        lo += 1
                    at += 1
            columns = list(zip(*found)) or [[]] * 5
            types = (pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64())
            names = ["key", "page", "file", "offset", "length"]
            return pa.table([pa.array(c, t) for c, t in zip(columns, types)], names=names)

        keys = urls.select(capture_key(F.col(url)).alias("key")).distinct().mapInArrow(route, "part long, key string")
        found = self.parts.groupBy("part").cogroup(keys.groupBy("part")).applyInArrow(
            search, "key string, page string, file string, offset long, length long"
        )
        return read_records(found, folder)


def read_records(captures: DataFrame, folder: str) -> DataFrame:
    """(key, page, kind, digest, size, refers, body) of captures, by range reads of the archives."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = filesystem(folder)
        name, file = "", None
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                rows = []
                part = batch.slice(at, 500)
                for key, path, offset, length in zip(*(c.to_pylist() for c in part.columns)):
                    if path != name:
                        if file is not None:
                            file.close()
                        name, file = path, fs.open_input_file(f"{root}/{path}")
                    fields, body = parse(gzip.decompress(file.read_at(length, offset)))
                    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                    kind = fields["WARC-Type"]
                    if kind == "response" and hashlib.sha1(body).hexdigest() != digest:
                        raise ValueError(f"payload at {path}:{offset} is damaged")
                    refers = fields.get("WARC-Refers-To")
                    inner = lambda x: x.removeprefix("<urn:page:").removesuffix(">")
                    rows.append(
                        (key, inner(fields["WARC-Record-ID"]), kind, digest, int(fields["X-Payload-Length"]),
                         refers and inner(refers), body)
                    )
                columns = [pa.array(c, t) for c, t in zip(zip(*rows), schema.types)]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)
        if file is not None:
            file.close()

    schema = pa.schema(
        [("key", pa.string()), ("page", pa.string()), ("kind", pa.string()), ("digest", pa.string()),
         ("size", pa.int64()), ("refers", pa.string()), ("body", pa.binary())]
    )
    ordered = captures.select("key", "file", "offset", "length").repartition("file").sortWithinPartitions("file", "offset")
    ddl = "key string, page string, kind string, digest string, size long, refers string, body binary"
    return ordered.mapInArrow(read, ddl)


def round_trip(pages: DataFrame, id: str = "page_id", url: str = "url", payload: str = "html") -> DataFrame:
    """Archive all pages, index them, and read every capture back through the index.

    Returns (id, payload_bytes, payload_digest, record_type, refers_to, url_key). Defined cases. A null payload is
    empty. A null address has the key of an empty one. Of equal payloads long enough, every row with the largest id
    is a response, so rows that repeat that id are all responses. A null id is smaller than any other and comes back
    null. An empty table gives an empty result. Other columns are not read.
    """
    kind = pages.schema[id].dataType
    index = CaptureIndex.build(write_archives(pages, id, url, payload))
    records = index.lookup(pages, url)
    return records.select(
        F.nullif(F.col("page"), F.lit("")).cast(kind).alias(id),
        F.col("size").alias("payload_bytes"),
        F.col("digest").alias("payload_digest"),
        F.col("kind").alias("record_type"),
        F.col("refers").cast(kind).alias("refers_to"),
        F.col("key").alias("url_key"),
    )

"""WARC records in ZIP packages: written by partition, read back by range.

A package holds stored members: ``archive/data.warc.gz`` with one gzip member per
record, and ``indexes/index.cdxj`` with a line per record that names its range.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import json
import urllib.parse
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from innsight.llm.common import cut
from innsight.llm.ziparchive import Archive

#: A payload under so many bytes is stored again rather than referred to.
MIN_SHARED_BYTES = 100
#: Compressed bytes after which a package is closed, and records that a task reads at a time.
PACKAGE_BYTES = 32 << 20
LEVEL = 4
#: Bytes of packages that a task reads records of, about.
RANGE_BYTES = 16 << 20
#: Pages carry no time of capture.
CAPTURED = "1970-01-01T00:00:00Z"
ARCHIVE, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
ID = "urn:x-page:"

INDEXED = "uri string, at long, size long"
READ = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string"


def payload(html: Column) -> Column:
    return F.encode(F.coalesce(html, F.lit("")), "utf-8")


def with_revisits(pages: DataFrame) -> DataFrame:
    """page_id, url, html, digest and refers_to, which is null for responses.

    Digests alone are grouped; the pages themselves are joined to the revisits by
    page_id, so a payload that a third of the pages share is no hot key. Rows
    that repeat id and payload are of one type; a null id is greater than others,
    and pages of null ids alone are all responses.
    """
    hashed = pages.select("page_id", "url", "html", F.sha2(payload(F.col("html")), 256).alias("digest"))
    narrow = hashed.filter(F.octet_length(payload(F.col("html"))) >= MIN_SHARED_BYTES).select("page_id", "digest")
    shared = (
        narrow.groupBy("digest")
        .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
        .filter((F.col("n") > 1) & F.col("first").isNotNull())
    )
    revisits = (
        narrow.join(shared, "digest")
        .filter(~F.col("page_id").eqNullSafe(F.col("first")))
        .select(F.col("page_id").alias("_id"), F.col("digest").alias("_digest"), F.col("first").alias("refers_to"))
        .distinct()
    )
    return hashed.join(
        revisits, hashed.page_id.eqNullSafe(F.col("_id")) & (hashed.digest == F.col("_digest")), "left"
    ).select("page_id", "url", "html", "digest", "refers_to")


def record(page_id, url, html, digest, refers_to) -> bytes:
    """One WARC record. A revisit has the HTTP head of the full payload and no body."""
    body = (html or "").encode()
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(body)}\r\n\r\n".encode()
    block = head + (body if refers_to is None else b"")
    named = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", f"<{ID}{'none' if page_id is None else page_id}>"),
        ("WARC-Date", CAPTURED),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if url is not None:
        named.append(("WARC-Target-URI", urllib.parse.quote(url, safe="%/:?#[]@!$&'()*+,;=~-._")))
    if refers_to is not None:
        named.append(("WARC-Refers-To", f"<{ID}{refers_to}>"))
        named.append(("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))
    top = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in named) + "\r\n"
    return top.encode() + block + b"\r\n\r\n"


def _headers(data: bytes) -> tuple[dict[str, str], bytes]:
    top, _, rest = data.partition(b"\r\n\r\n")
    lines = top.decode().split("\r\n")[1:]
    return {k.lower(): v for k, _, v in (line.partition(": ") for line in lines)}, rest


def parse(packed: bytes) -> tuple:
    """The fields of ``READ`` of one compressed record; a payload that isn't its digest's is an error."""
    named, rest = _headers(gzip.decompress(packed))
    block = rest[: int(named["content-length"])]
    http, body = _headers(block)
    digest = named["warc-payload-digest"].removeprefix("sha256:")
    own = lambda uri: None if uri.endswith(":none>") else int(uri[len(ID) + 1 : -1])
    if named["warc-type"] == "response" and hashlib.sha256(body).hexdigest() != digest:
        raise ValueError(f"payload of {named['warc-record-id']} differs from its digest")
    size = len(body) if named["warc-type"] == "response" else int(http["content-length"])
    refers = named.get("warc-refers-to")
    return (
        own(named["warc-record-id"]), size, digest, named["warc-type"],
        own(refers) if refers else None, named.get("warc-target-uri"),
    )


def _package(rows: Iterator[dict], limit: int) -> Iterator[tuple[bytes, int]]:
    """Packages of the rows, in memory one at a time, with their numbers of records."""
    data, index = io.BytesIO(), []

    def close() -> tuple[bytes, int]:
        whole = io.BytesIO()
        with zipfile.ZipFile(whole, "w", zipfile.ZIP_STORED) as packed:
            # A fixed time: a task that runs again writes the same bytes.
            for name, content in ((ARCHIVE, data.getvalue()), (INDEX, "".join(sorted(index)).encode())):
                packed.writestr(zipfile.ZipInfo(name), content)
        return whole.getvalue(), len(index)

    for row in rows:
        at, one = data.tell(), gzip.compress(record(**row), LEVEL, mtime=0)
        data.write(one)
        where = {"digest": f"sha256:{row['digest']}", "offset": at, "length": len(one), "filename": ARCHIVE}
        url = urllib.parse.quote(row["url"] or "-", safe="/:")
        index.append(f"{url} {CAPTURED} {json.dumps(where)}\n")
        if data.tell() >= limit:
            yield close()
            data, index = io.BytesIO(), []
    if index:
        yield close()


def write(pages: DataFrame, folder: str, package_bytes: int = PACKAGE_BYTES) -> DataFrame:
    """Write pages into packages below ``folder``, a place that all executors see; returns (uri, bytes, records).

    A package is written under a name of its attempt and then renamed, so a task
    that is repeated leaves one whole file of the same bytes.
    """
    ready = with_revisits(pages).sortWithinPartitions("page_id", "digest", "url")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        context = TaskContext.get()
        system, path = fs.FileSystem.from_uri(folder)
        system.create_dir(path, recursive=True)
        rows = (row for batch in batches for part in range(0, batch.num_rows, 256) for row in batch.slice(part, 256).to_pylist())
        for k, (content, count) in enumerate(_package(rows, package_bytes)):
            name = f"part-{context.partitionId():06d}-{k:06d}.zip"
            draft = f"{path}/.{name}.{context.taskAttemptId()}"
            with system.open_output_stream(draft) as out:
                out.write(content)
            system.move(draft, f"{path}/{name}")
            yield pa.RecordBatch.from_pydict(
                {"uri": [f"{folder}/{name}"], "bytes": [len(content)], "records": [count]}
            )

    # Eager, and kept: the files are written once and their list outlives the tasks.
    return cut(ready.mapInArrow(run, "uri string, bytes long, records long"))


def _open(uri: str) -> Archive:
    system, path = fs.FileSystem.from_uri(uri)
    file = system.open_input_file(path)

    def read(at: int, size: int) -> bytes:
        file.seek(at)
        return file.read(size)

    return Archive(read, file.size())


def _ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for uri in batch.column("uri").to_pylist():
            package = _open(uri)
            members = {m.name: m for m in package.members()}
            starts = {}
            found = {"uri": [], "at": [], "size": []}
            for name, member in members.items():
                if not name.startswith("indexes/"):
                    continue
                for line in package.content(member).decode().splitlines():
                    where = json.loads(line.split(" ", 2)[2])
                    target = where["filename"]
                    if target not in starts:
                        starts[target] = package.stored_start(members[target])
                    found["uri"].append(uri)
                    found["at"].append(starts[target] + where["offset"])
                    found["size"].append(where["length"])
            yield pa.RecordBatch.from_pydict(found)


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    package, opened = None, None
    for batch in batches:
        for part in range(0, batch.num_rows, 1024):
            rows = []
            for where in batch.slice(part, 1024).to_pylist():
                if where["uri"] != opened:
                    package, opened = _open(where["uri"]), where["uri"]
                rows.append(parse(package.read(where["at"], where["size"])))
            names = [column.split()[0] for column in READ.split(", ")]
            kinds = [pa.int64() if column.endswith("long") else pa.string() for column in READ.split(", ")]
            columns = list(zip(*rows, strict=True)) or [[] for _ in names]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def read(packages: DataFrame) -> DataFrame:
    """The records of packages (uri, bytes), with the fields of ``READ``.

    Directories and indexes are read first; the ranges are then dealt out anew, so
    that one large package is read by many tasks. Their number follows the bytes to
    be read, which the few bytes of the ranges themselves don't show.
    """
    total = packages.agg(F.sum("bytes")).first()[0] or 0
    ranges = packages.select("uri").mapInArrow(_ranges, INDEXED)
    dealt = ranges.repartition(
        1 + total // RANGE_BYTES, "uri", F.floor(F.col("at") / (RANGE_BYTES // 16))
    ).sortWithinPartitions("uri", "at")
    return dealt.mapInArrow(_records, READ)


def round_trip(pages: DataFrame, folder: str) -> DataFrame:
    """Write all pages (page_id, url, html; other columns are ignored), then read the packages back."""
    return read(write(pages, folder))


#: DuckDB: what ``round_trip`` gives, by digests of the payloads. One statement over ``pages``.
ROUND_TRIP_SQL = f"""
with hashed as (
  select page_id, strlen(coalesce(html, '')) as payload_bytes, sha256(coalesce(html, '')) as payload_digest from pages
), firsts as (
  select payload_digest, min(page_id) as first_id from hashed
  where payload_bytes >= {MIN_SHARED_BYTES} group by payload_digest
)
select h.page_id, cast(h.payload_bytes as bigint) as payload_bytes, h.payload_digest,
  case when f.first_id is null or f.first_id = h.page_id then 'response' else 'revisit' end as record_type,
  case when f.first_id <> h.page_id then f.first_id end as refers_to
from hashed h left join firsts f using (payload_digest)
"""

"""WARC archives with payload de-duplication, and an external merge of their index runs.

Writing: each task appends gzip members to archives of its own in a shared folder and returns
its capture run, sorted by (URL key, timestamp, page). A run names only files that its own
attempt finished, so a lost or repeated attempt leaves nothing that anybody reads.

Merging: the runs are cut by key range, a range of all runs goes to one task, and a loser tree
merges the k runs there. Ranges are cut by the full key, so one busy URL or host spreads over
many ranges. Ranges follow each other, hence the result is globally ordered.

Reading: the merged index is dealt out by archive; a task opens an archive once and reads the
records at their offsets, in bounded memory.

Nulls: a null html is an empty payload, a null URL becomes ``urn:x-page:<id>``, a null page id
never is the larger one and stays null. Repeated rows of the page that holds the response all
are responses. There is no crawl time in the tables, so the date is a fixed start plus the page
id in seconds, unless a timestamp column is named.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterable, Iterator
from datetime import datetime, timedelta, timezone
from urllib.parse import quote, urlsplit

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txgraph.llm.common import freeze, partitions_for, scratch_uri

# --- fixed values -----------------------------------------------------------
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
# --- end of fixed values ----------------------------------------------------

FIRST_CAPTURE = datetime(2020, 1, 1, tzinfo=timezone.utc)
ROLL_BYTES = 64 << 20
INDEX_SCHEMA = (
    "urlkey string, ts string, page_id long, run string, file string, offset long, length long"
)
RECORD_SCHEMA = (
    "page_id long, payload_bytes long, payload_digest string, record_type string, "
    "refers_to long, url string, ts string"
)


class LoserTree:
    """Merge k sorted iterators: one comparison for each level on the way up from a leaf.

    ``nodes[0]`` holds the winner, the others the loser of the match played there.
    """

    _END = (1,)

    def __init__(self, runs: Iterable[Iterable]):
        self.runs = [iter(run) for run in runs]
        self.k = len(self.runs)
        self.heads = [self._next(i) for i in range(self.k)]
        self.nodes = [-1] * max(1, self.k)
        for leaf in range(self.k):
            self._enter(leaf)

    def _next(self, run: int) -> tuple:
        for item in self.runs[run]:
            return (0, item)
        return self._END

    def _before(self, a: int, b: int) -> bool:
        return (self.heads[a], a) < (self.heads[b], b)

    def _enter(self, leaf: int) -> None:
        """While the tree is built: wait at the first free node, else play on."""
        at = (leaf + self.k) // 2
        while at > 0:
            if self.nodes[at] < 0:
                self.nodes[at] = leaf
                return
            if self._before(self.nodes[at], leaf):
                self.nodes[at], leaf = leaf, self.nodes[at]
            at //= 2
        self.nodes[0] = leaf

    def __iter__(self) -> Iterator:
        while self.k:
            winner = self.nodes[0]
            head = self.heads[winner]
            if head is self._END:
                return
            yield head[1]
            self.heads[winner] = self._next(winner)
            at, leaf = (winner + self.k) // 2, winner
            while at > 0:
                if self._before(self.nodes[at], leaf):
                    self.nodes[at], leaf = leaf, self.nodes[at]
                at //= 2
            self.nodes[0] = leaf


def url_key(url: str) -> str:
    """Host labels reversed, then path and query, lower case: pages of a site sort together."""
    try:
        parts = urlsplit(url.strip())
        host = parts.hostname or ""
    except ValueError:
        return url.lower()
    if not host:
        return url.lower()
    port = f":{parts.netloc.rsplit(':', 1)[1]}" if parts.netloc.rsplit(":", 1)[-1].isdigit() and ":" in parts.netloc else ""
    labels = ",".join(reversed(host.removeprefix("www.").split(".")))
    query = f"?{parts.query}" if parts.query else ""
    return f"{labels}{port}){parts.path or '/'}{query}".lower()


def _target(url: str | None, page_id: int | None) -> str:
    return quote(url, safe="!#$%&'()*+,/:;=?@[]~ -._") if url else f"urn:x-page:{page_id}"


def record(
    page_id: int | None,
    url: str,
    when: datetime,
    payload: bytes,
    length: int,
    digest: str,
    refers_to: int | None,
) -> bytes:
    """One record as a gzip member; a revisit keeps the HTTP header and no payload."""
    revisit = refers_to is not None
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {length}\r\n\r\n"
    ).encode()
    body = http if revisit else http + payload
    head = [
        VERSION,
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:x-page:{page_id}>",
        f"WARC-Target-URI: {url}",
        f"WARC-Date: {when:%Y-%m-%dT%H:%M:%SZ}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(body)}",
    ]
    if revisit:
        head[-2:-2] = [
            f"WARC-Profile: {REVISIT_PROFILE}",
            f"WARC-Refers-To: <urn:x-page:{refers_to}>",
        ]
    data = "\r\n".join(head).encode("utf-8") + b"\r\n\r\n" + body + b"\r\n\r\n"
    packer = zlib.compressobj(1, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def _page_number(urn: str | None) -> int | None:
    value = urn.strip("<>").rsplit(":", 1)[-1] if urn else "None"
    return None if value == "None" else int(value)


def parse(member: bytes) -> dict:
    """Fields of a record; a response's payload is checked against its digest."""
    data = zlib.decompress(member, 31)
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    if lines[0] != VERSION:
        raise ValueError(f"not a record: {lines[0][:40]!r}")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    body = rest[: int(fields["Content-Length"])]
    http, _, payload = body.partition(b"\r\n\r\n")
    stated = dict(line.split(": ", 1) for line in http.decode("utf-8").split("\r\n")[1:])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    kind = fields["WARC-Type"]
    if kind == "response":
        if base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
            raise ValueError(f"payload of {fields['WARC-Record-ID']} differs from its digest")
        if len(payload) != int(stated["Content-Length"]):
            raise ValueError(f"payload of {fields['WARC-Record-ID']} is cut")
    return {
        "page_id": _page_number(fields["WARC-Record-ID"]),
        "payload_bytes": int(stated["Content-Length"]),
        "payload_digest": digest,
        "record_type": kind,
        "refers_to": _page_number(fields.get("WARC-Refers-To")),
        "url": fields["WARC-Target-URI"],
        "ts": "".join(c for c in fields["WARC-Date"] if c.isdigit()),
        "payload": payload,
    }


def with_roles(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """(page_id, url, payload, hash, length, keeper): keeper is the page that holds the response.

    The page of largest id among equal payloads of at least ``min_bytes``; shorter payloads
    keep themselves. Largest ids are pre-aggregated; the join on the hash may split busy ones.
    """
    given = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.coalesce(F.encode(F.col("html").cast("string"), "UTF-8"), F.lit(b"")).alias("payload"),
    ).select("*", F.sha1("payload").alias("hash"), F.octet_length("payload").cast("long").alias("length"))
    keepers = freeze(
        given.where(F.col("length") >= min_bytes).groupBy("hash").agg(F.max("page_id").alias("keeper"))
    )
    return given.join(keepers.hint("shuffle_hash"), "hash", "left")


def write_archives(records: DataFrame, uri: str) -> DataFrame:
    """Write records as archives below ``uri``; returns the capture runs (see INDEX_SCHEMA)."""
    schema = pa.schema(
        [("urlkey", pa.string()), ("ts", pa.string()), ("page_id", pa.int64()), ("run", pa.string())]
        + [("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pafs.FileSystem.from_uri(uri)
        fs.create_dir(root, recursive=True)
        name, captures, out, size, count = uuid.uuid4().hex, [], None, 0, 0
        try:
            for batch in batches:
                columns = [batch.column(i) for i in range(batch.num_columns)]
                for page_id, url, payload, digest, length, keeper in zip(
                    *(map(lambda x: x.as_py(), c) for c in columns), strict=True
                ):
                    if out is None or size >= ROLL_BYTES:
                        if out is not None:
                            out.close()
                        file = f"{name}-{count:05d}.warc.gz"
                        out, size, count = fs.open_output_stream(f"{root}/{file}", compression=None), 0, count + 1
                    when = FIRST_CAPTURE + timedelta(seconds=(page_id or 0) % 3_000_000_000)
                    refers = keeper if keeper is not None and keeper != page_id else None
                    base32 = base64.b32encode(bytes.fromhex(digest)).decode()
                    target = _target(url, page_id)
                    member = record(page_id, target, when, payload, length, base32, refers)
                    out.write(member)
                    captures.append((url_key(target), f"{when:%Y%m%d%H%M%S}", page_id, name, file, size, len(member)))
                    size += len(member)
        finally:
            if out is not None:
                out.close()
        captures.sort(key=_order)
        for at in range(0, len(captures), 10_000):
            rows = captures[at : at + 10_000]
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r, strict=True)) for r in rows], schema)

    given = records.select("page_id", "url", "payload", "hash", "length", "keeper")
    return freeze(given.mapInArrow(run, INDEX_SCHEMA))


def _order(capture: tuple) -> tuple:
    """(URL key, timestamp, page with null first, file, offset)."""
    key, ts, page_id, _, file, offset, _ = capture
    return (key, ts, page_id is not None, page_id or 0, file, offset)


def merge_index(runs: DataFrame, rows_per_range: int = 50_000) -> DataFrame:
    """All runs as one ordered index: columns of INDEX_SCHEMA, range_no and its position there.

    (range_no, position) is the global order by (URL key, timestamp, page).
    """
    spark = runs.sparkSession
    ranges = partitions_for(spark, runs.count(), rows_per_range)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId()
        by_run: dict[str, list[tuple]] = {}
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                by_run.setdefault(row[3], []).append((_order(row), row))
        for captures in by_run.values():  # blocks of one run may arrive out of order
            if any(a[0] > b[0] for a, b in zip(captures, captures[1:])):
                captures.sort(key=lambda x: x[0])
        buffer, position = [], 0
        for _, row in LoserTree(by_run.values()):
            buffer.append((*row, number, position))
            position += 1
            if len(buffer) == 10_000:
                yield _index_batch(buffer)
                buffer = []
        if buffer:
            yield _index_batch(buffer)

    cut = runs.repartitionByRange(ranges, "urlkey", "ts", "page_id", "file", "offset")
    return cut.mapInArrow(merge, f"{INDEX_SCHEMA}, range_no long, position long")


def _index_batch(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.string()] + [pa.int64()] * 4
    names = ["urlkey", "ts", "page_id", "run", "file", "offset", "length", "range_no", "position"]
    columns = [pa.array(values, kind) for values, kind in zip(zip(*rows, strict=True), types, strict=True)]
    return pa.RecordBatch.from_arrays(columns, names=names)


def read_archives(
    index: DataFrame,
    uri: str,
    payload: bool = False,
    archive_bytes: int | None = None,
    task_bytes: int = 32 << 20,
) -> DataFrame:
    """Records at the index's places; payloads on request.

    Stretches of archives of ``task_bytes`` are dealt to tasks, which read them by offset; the
    number of tasks follows from the bytes of all records (summed up where not given).
    """
    names = [part.strip().split(" ")[0] for part in RECORD_SCHEMA.split(",")]
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string()]
    extra = [("urlkey", pa.string()), ("range_no", pa.int64()), ("position", pa.int64())]
    schema = pa.schema([*zip(names, types, strict=True), *extra] + [("payload", pa.binary())] * payload)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pafs.FileSystem.from_uri(uri)
        current, source = None, None
        try:
            for batch in batches:
                rows, held = [], 0
                for place in batch.to_pylist():
                    if place["file"] != current:
                        if source is not None:
                            source.close()
                        current = place["file"]
                        source = fs.open_input_file(f"{root}/{current}")
                    found = parse(source.read_at(place["length"], place["offset"]))
                    rows.append({n: place[n] if n in ("urlkey", "range_no", "position") else found[n] for n in schema.names})
                    held += len(found["payload"]) if payload else 200
                    if held > 8 << 20:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)
        finally:
            if source is not None:
                source.close()

    out = f"{RECORD_SCHEMA}, urlkey string, range_no long, position long" + ", payload binary" * payload
    if archive_bytes is None:
        archive_bytes = index.agg(F.sum("length")).first()[0]
    tasks = partitions_for(index.sparkSession, archive_bytes or 0, task_bytes)
    stretch = F.floor(F.col("offset") / task_bytes)
    places = index.select("urlkey", "range_no", "position", "file", "offset", "length")
    dealt = places.repartition(tasks, "file", stretch)
    return dealt.sortWithinPartitions("file", "offset").mapInArrow(run, out)


def archive(pages: DataFrame, min_bytes: int = 0, uri: str | None = None) -> DataFrame:
    """Write all pages, merge the index, read everything back: one row per page."""
    uri = uri or scratch_uri(pages.sparkSession, "warc")
    runs = write_archives(with_roles(pages, min_bytes), uri)
    archive_bytes = runs.agg(F.sum("length")).first()[0] or 0
    return read_archives(merge_index(runs), uri, archive_bytes=archive_bytes)

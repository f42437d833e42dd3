"""WARC archives: writing, turning whole-file gzip into one member per record, reading by offset.

Archives from elsewhere are often one gzip stream from end to end, so nothing in them can be reached
without inflating all before it. ``normalise`` inflates such a file once, in chunks, and writes every
record as a gzip member of its own, with an index of offsets beside it. Files lie in the shared
folder; each task writes under a name of its own and renames when done, and only files named in the
stored manifest count, so a task that runs twice does no harm.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loantape.llm.store import new_path, prepare, qualified, stored

DATE = "2024-01-01T00:00:00Z"
ARCHIVE_BYTES = 16 << 20
CHUNK = 1 << 18
LEVEL = 4
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = "path string, records bigint, bytes bigint"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _open(folder: str) -> tuple[pafs.FileSystem, str]:
    if re.match(r"file:/+", folder):
        folder = "/" + folder[5:].lstrip("/")
    return pafs.FileSystem.from_uri(folder) if "://" in folder else (pafs.LocalFileSystem(), folder)


def head(fields: dict[str, str | None]) -> bytes:
    lines = [f"{k}: {v}" for k, v in fields.items() if v is not None]
    return ("WARC/1.1\r\n" + "\r\n".join(lines) + "\r\n\r\n").encode()


def record(page_id, url: str | None, payload: bytes, refers_to=None) -> bytes:
    """One record with its block and end; a revisit carries digest and length, not the payload."""
    revisit = refers_to is not None
    block = HTTP if revisit else HTTP + payload
    fields = {
        "WARC-Type": "revisit" if revisit else "response",
        "WARC-Record-ID": f"<urn:page:{page_id}>" if page_id is not None else None,
        "WARC-Date": DATE,
        "WARC-Target-URI": quote(url, safe=":/?#[]@!$&'()*+,;=%~-._") if url else None,
        "WARC-Refers-To": f"<urn:page:{refers_to}>" if revisit else None,
        "WARC-Profile": REVISIT if revisit else None,
        "WARC-Payload-Digest": f"sha1:{digest(payload)}",
        "WARC-Payload-Length": str(len(payload)),
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": str(len(block)),
    }
    return head(fields) + block + b"\r\n\r\n"


def payload_sum(html_col: str) -> Column:
    """SHA-1 and length of a page's payload: equal payloads are those of equal sums."""
    payload = F.encode(F.coalesce(F.col(html_col), F.lit("")), "utf-8")
    return F.concat(F.unhex(F.sha1(payload)), F.unhex(F.lpad(F.hex(F.length(payload).cast("bigint")), 16, "0")))


def resolve(pages: DataFrame, id_col="page_id", html_col="html") -> DataFrame:
    """``page_id``, ``sum``, ``refers_to`` of every page that repeats the payload of a page with a
    larger id, once for each id and payload.

    Only ids and sums are shuffled; the largest id is taken before the shuffle, and the join back is
    a plain one that Spark can split.
    """
    keys = stored(pages.select(F.col(id_col).alias("page_id"), payload_sum(html_col).alias("sum")), "payloads")
    top = stored(
        keys.groupBy("sum").agg(F.max("page_id").alias("last"), F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col("sum").alias("same"), "last"),
        "repeated",
    )
    found = keys.join(top, F.col("sum") == F.col("same")).where("page_id < last")
    return found.select("page_id", "sum", F.col("last").alias("refers_to")).distinct()


def write(pages: DataFrame, folder: str, id_col="page_id", url_col="url", html_col="html") -> DataFrame:
    """Write a record per row into archives of one gzip stream each; the stored manifest.

    A null html is an empty payload, a null url leaves its header out. Of equal payloads the row
    with the largest id is the response and all smaller ones revisit it; rows that repeat that id
    are responses too, and so is a row without an id. Pages of one id may have different payloads,
    each of which is resolved by itself. A folder without a scheme lies in Hadoop's default file
    system, here and below.
    """
    spark = prepare(pages.sparkSession)
    folder = qualified(spark, folder)
    links = resolve(pages, id_col, html_col).toDF("id", "same", "refers_to")
    rows = pages.select(
        F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"), payload_sum(html_col).alias("sum")
    )
    joined = rows.join(links, (F.col("page_id") == F.col("id")) & (F.col("sum") == F.col("same")), "left").select(
        "page_id", "url", "html", "refers_to"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, top = _open(folder)
        files.create_dir(top, recursive=True)
        state: dict = {}

        def close() -> pa.RecordBatch:
            state["gzip"].write(state["pack"].flush())
            state["gzip"].close()
            done = (f"{state['name']}.warc.gz", state["n"], state["size"])
            files.move(f"{top}/{state['name']}.tmp", f"{top}/{done[0]}")
            state.clear()
            return pa.record_batch([[done[0]], [done[1]], [done[2]]], ["path", "records", "bytes"])

        for batch in batches:
            for page_id, url, html, refers_to in zip(*batch.columns):
                if not state:
                    name = uuid.uuid4().hex
                    out = files.open_output_stream(f"{top}/{name}.tmp", compression=None)
                    pack = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
                    state.update(name=name, gzip=out, pack=pack, n=0, size=0)
                payload = (html.as_py() or "").encode()
                raw = record(page_id.as_py(), url.as_py(), payload, refers_to.as_py())
                state["gzip"].write(state["pack"].compress(raw))
                state["n"] += 1
                state["size"] += len(raw)
                if state["size"] >= ARCHIVE_BYTES:
                    yield close()
        if state:
            yield close()

    return stored(joined.mapInArrow(run, MANIFEST), "archives")


class Stream:
    """The inflated bytes of a gzip file of any number of members, read forward in chunks."""

    def __init__(self, file) -> None:
        self.file, self.buffer, self.over = file, bytearray(), False
        self.unpack, self.begun = zlib.decompressobj(31), False

    def _more(self) -> bool:
        if self.over:
            return False
        raw = self.unpack.unconsumed_tail or self.unpack.unused_data or self.file.read(CHUNK)
        if self.unpack.eof and raw:
            self.unpack, self.begun = zlib.decompressobj(31), False
        # Without input, what the inflater still holds back.
        out = b"" if self.unpack.eof else self.unpack.decompress(raw, CHUNK)
        self.begun = self.begun or bool(raw)
        self.buffer += out
        if not raw and not out:
            self.over = True
            if self.begun and not self.unpack.eof:
                raise EOFError("the gzip stream ends too early")
            return False
        return True

    def until(self, mark: bytes) -> bytes:
        """Up to and with ``mark``; nothing at the end of the file."""
        seen = 0
        while (at := self.buffer.find(mark, seen)) < 0:
            seen = max(0, len(self.buffer) - len(mark))
            if not self._more():
                if bytes(self.buffer).strip():
                    raise EOFError("the archive ends inside a record")
                return b""
        return self._take(at + len(mark))

    def exactly(self, n: int) -> bytes:
        while len(self.buffer) < n:
            if not self._more():
                raise EOFError("the archive ends inside a record")
        return self._take(n)

    def _take(self, n: int) -> bytes:
        out = bytes(self.buffer[:n])
        del self.buffer[:n]
        return out


def fields_of(header: bytes) -> dict[str, str]:
    lines = header.decode("utf-8", "replace").strip().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"not a record: {lines[0][:40]!r}")
    return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}


def records(stream: Stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields and all bytes of each record."""
    while header := stream.until(b"\r\n\r\n"):
        header = header.lstrip(b"\r\n")
        fields = fields_of(header)
        yield fields, header + stream.exactly(int(fields["content-length"])) + stream.exactly(4)


def normalise(archives: DataFrame, folder: str, out_folder: str) -> DataFrame:
    """Rewrite each archive with a member per record; the stored manifest of the new files.

    Beside ``x.warc.gz`` lies ``x.index``: per record offset, length, type and id, one line each.
    """
    spark = prepare(archives.sparkSession)
    folder, out_folder = qualified(spark, folder), qualified(spark, out_folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        source, top = _open(folder)
        target, out_top = _open(out_folder)
        target.create_dir(out_top, recursive=True)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                stem = f"{name.removesuffix('.warc.gz')}-{uuid.uuid4().hex[:8]}"
                offset, n = 0, 0
                with (
                    source.open_input_stream(f"{top}/{name}", compression=None) as file,
                    target.open_output_stream(f"{out_top}/{stem}.tmp", compression=None) as out,
                    target.open_output_stream(f"{out_top}/{stem}.idx.tmp", compression=None) as index,
                ):
                    for fields, raw in records(Stream(file)):
                        member = gzip.compress(raw, LEVEL, mtime=0)
                        out.write(member)
                        line = (offset, len(member), fields["warc-type"], fields.get("warc-record-id", "-"))
                        index.write(("\t".join(map(str, line)) + "\n").encode())
                        offset += len(member)
                        n += 1
                target.move(f"{out_top}/{stem}.idx.tmp", f"{out_top}/{stem}.index")
                target.move(f"{out_top}/{stem}.tmp", f"{out_top}/{stem}.warc.gz")
                yield pa.record_batch([[f"{stem}.warc.gz"], [n], [offset]], ["path", "records", "bytes"])

    parts = max(1, min(archives.count(), spark.sparkContext.defaultParallelism * 64))
    return stored(archives.repartition(parts).mapInArrow(run, MANIFEST), "members")


def _page(urn: str | None) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?\d+)>", urn or "")
    return int(found[1]) if found else None


def read(archives: DataFrame, folder: str) -> DataFrame:
    """A row per record, found by offset: ``page_id``, ``url``, ``record_type``, ``refers_to``,
    ``payload`` (null for a revisit), ``payload_bytes`` and ``payload_digest`` of the full payload.

    The digest in the header is checked against the payload wherever there is one.
    """
    spark = prepare(archives.sparkSession)
    folder = qualified(spark, folder)
    schema = (
        "page_id bigint, url string, record_type string, refers_to bigint, payload binary, "
        "payload_bytes bigint, payload_digest string"
    )
    names = [part.split()[0] for part in schema.split(", ")]
    types = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary(), pa.int64(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, top = _open(folder)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                with files.open_input_stream(f"{top}/{name.removesuffix('.warc.gz')}.index", compression=None) as index:
                    lines = index.read().decode().splitlines()
                with files.open_input_file(f"{top}/{name}") as file:
                    rows, held = [], 0
                    for line in lines:
                        offset, length = map(int, line.split("\t")[:2])
                        file.seek(offset)
                        raw = gzip.decompress(file.read(length))
                        header, _, rest = raw.partition(b"\r\n\r\n")
                        fields = fields_of(header)
                        block = rest[: int(fields["content-length"])]
                        payload = None
                        named = fields["warc-payload-digest"].removeprefix("sha1:")
                        if fields["warc-type"] == "response":
                            payload = block.partition(b"\r\n\r\n")[2]
                            if digest(payload) != named:
                                raise ValueError(f"{name}: record at {offset} is damaged")
                        rows.append((
                            _page(fields.get("warc-record-id")), fields.get("warc-target-uri"),
                            fields["warc-type"], _page(fields.get("warc-refers-to")), payload,
                            int(fields["warc-payload-length"]) if payload is None else len(payload), named,
                        ))
                        held += len(payload or b"")
                        if held > ARCHIVE_BYTES // 4:
                            yield _batch(rows, names, types)
                            rows, held = [], 0
                    if rows:
                        yield _batch(rows, names, types)

    parts = max(1, min(archives.count(), spark.sparkContext.defaultParallelism * 64))
    return archives.repartition(parts).mapInArrow(run, schema)


def _batch(rows: list[tuple], names: list[str], types: list) -> pa.RecordBatch:
    return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)


def round_trip(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Write, normalise and read back: what ``read`` gives for every row of ``pages``."""
    folder = new_path(spark, "warc")
    written = write(pages, f"{folder}/whole")
    return read(normalise(written, f"{folder}/whole", f"{folder}/members"), f"{folder}/members")

"""WARC archives and the chunked record table.

``write_archives`` streams one record per page into gzip archives (a member per record)
in the shared folder. Payloads go out in chunks through one compressor, so no second copy
of a record is made. ``read_chunks`` streams the archives back as rows
(record_id, chunk_no): each row holds at most ``chunk_bytes`` of payload and the SHA-1 of
the payload up to its end, so the last chunk's digest is that of the whole payload and a
reader never needs the whole record in memory.

Equal payloads (same SHA-1 and length) of at least ``min_revisit_bytes`` are stored once,
by the row with the largest page_id; the others become revisit records that refer to it.

Defined results: null html is an empty payload; among rows of one page_id that tie for
the response, exactly one is the response; a null page_id sorts below all others; an
empty table gives no archives and an empty frame. A retried task writes new files, and
only files named in the manifest of successful tasks are read.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.common import as_bytes
from quarry.session import shared_path

HTTP_OK = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
CHUNKS = ("record_id string, chunk_no long, start long, n_bytes long, data binary, digest string, is_last boolean, "
          "record_type string, refers_to string, stated_digest string")
_DATE = "1970-01-01T00:00:00Z"


def base32_digest(raw: bytes) -> str:
    return base64.b32encode(raw).decode("ascii")


def records(pages: DataFrame, min_revisit_bytes: int = 0) -> DataFrame:
    """(record_id, html, url, record_type, refers_to, sha) of pages with columns page_id, html, url.

    Payloads move once: equal ones meet in their response row, with a partial aggregation
    before the shuffle. Revisits are counted by page and digest without the payloads.
    """
    body = F.coalesce(F.col("html"), F.lit(""))
    full = pages.select("page_id", "url", body.alias("html"), F.sha1(body.cast("binary")).alias("sha"), F.octet_length(body).alias("n"))
    shared, own = full.where(F.col("n") >= min_revisit_bytes), full.where(F.col("n") < min_revisit_bytes)
    responses = (shared.groupBy("sha", "n").agg(F.max("page_id").alias("page_id"), F.first("html").alias("html"),
                                                F.max_by("url", "page_id").alias("url"))
                 .select(record_id("page_id", "sha", F.lit(0)).alias("record_id"), "html", "url", F.lit("response").alias("record_type"),
                         F.lit(None).cast("string").alias("refers_to"), "sha"))
    heads = shared.groupBy("sha", "n").agg(F.max("page_id").alias("head"))
    copies = F.col("k") - F.col("page_id").eqNullSafe(F.col("head")).cast("long")
    counts = shared.groupBy("page_id", "sha", "n").agg(F.count(F.lit(1)).alias("k"), F.max("url").alias("url"))
    again = (counts.join(heads, ["sha", "n"]).withColumn("copies", copies).where("copies > 0")
             .withColumn("no", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))))
    revisits = again.select(record_id("page_id", "sha", F.col("no")).alias("record_id"), F.lit("").alias("html"), "url",
                            F.lit("revisit").alias("record_type"), record_id("head", "sha", F.lit(0)).alias("refers_to"), "sha")
    small = own.groupBy("page_id", "sha", "n").agg(F.count(F.lit(1)).alias("k"), F.max("url").alias("url"), F.first("html").alias("html"))
    small = small.withColumn("no", F.explode(F.sequence(F.lit(1), F.col("k").cast("int"))))
    alone = small.select(record_id("page_id", "sha", F.col("no")).alias("record_id"), "html", "url", F.lit("response").alias("record_type"),
                         F.lit(None).cast("string").alias("refers_to"), "sha")
    return responses.unionByName(revisits).unionByName(alone)


def record_id(page_id: str, sha: str, no: Column) -> Column:
    """The WARC-Record-ID of a page: its id, payload digest and number among equal rows (0: the shared response)."""
    return F.concat_ws(":", F.lit("urn:page"), F.coalesce(F.col(page_id).cast("string"), F.lit("")), F.col(sha), no.cast("string"))


def page_of(col):
    """The page id inside a record id (null for none)."""
    inner = F.substring_index(F.substring_index(col, ":", 3), ":", -1)
    return F.when(inner != "", inner)


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", html_col: str = "html",
                   url_col: str | None = "url", min_revisit_bytes: int = 0, archive_bytes: int = 256 << 20,
                   chunk_bytes: int = 256 << 10) -> DataFrame:
    """Write the archives below ``folder``; returns the manifest (path, records, n_bytes).

    The manifest itself is a written table, so the archives are made once.
    """
    spark = pages.sparkSession
    url = F.col(url_col).cast("string") if url_col and url_col in pages.columns else F.lit(None).cast("string")
    full = records(pages.select(F.col(id_col).alias("page_id"), F.col(html_col).cast("string").alias("html"), url.alias("url")),
                   min_revisit_bytes)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = pafs.FileSystem.from_uri(folder)
        out, path, records, size = None, "", 0, 0

        def done() -> pa.RecordBatch:
            out.close()
            return pa.RecordBatch.from_pydict({"path": [path], "records": [records], "n_bytes": [size]},
                                              schema=pa.schema([("path", pa.string()), ("records", pa.int64()), ("n_bytes", pa.int64())]))

        for b in batches:
            ids, bodies, urls, kinds, refs, shas = b.column(0).to_pylist(), as_bytes(b, 1), *(b.column(i).to_pylist() for i in (2, 3, 4, 5))
            for i, body in enumerate(bodies):
                if out is None:
                    path, records, size = f"{base}/pages-{uuid.uuid4().hex}.warc.gz", 0, 0
                    fs.create_dir(base, recursive=True)
                    out = fs.open_output_stream(path, compression=None)  # members are compressed here
                for piece in _record(ids[i], kinds[i], refs[i], urls[i], shas[i], body or b"", chunk_bytes):
                    out.write(piece)
                    size += len(piece)
                records += 1
                if size >= archive_bytes:
                    yield done()
                    out = None
        if out is not None:
            yield done()

    listing = f"{folder}/manifest"
    full.mapInArrow(write, "path string, records long, n_bytes long").write.mode("overwrite").parquet(listing)
    return spark.read.schema("path string, records long, n_bytes long").parquet(listing)


def _record(rid: str, kind: str, refers: str | None, url: str | None, sha: str, body: bytes, chunk_bytes: int) -> Iterator[bytes]:
    """One gzip member, in pieces of a chunk at most; ``sha``: the full payload's SHA-1 in hex."""
    view = memoryview(body)
    http = (HTTP_OK % len(body)).encode("ascii")
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <{rid}>", f"WARC-Date: {_DATE}",
            f"WARC-Payload-Digest: sha1:{base32_digest(bytes.fromhex(sha))}"]
    if url:
        head.append("WARC-Target-URI: " + "".join(c for c in url if c > " "))
    if refers is not None:
        head += [f"WARC-Refers-To: <{refers}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    head += ["Content-Type: application/http; msgtype=response",
             f"Content-Length: {len(http) + (len(body) if kind == 'response' else 0)}"]
    z = zlib.compressobj(1, zlib.DEFLATED, 31)
    yield z.compress(("\r\n".join(head) + "\r\n\r\n").encode("utf-8") + http)
    if kind == "response":
        for at in range(0, len(body), chunk_bytes):
            yield z.compress(view[at:at + chunk_bytes])
    yield z.compress(b"\r\n\r\n") + z.flush()


class _Inflated:
    """The decompressed bytes of an archive, read in bounded blocks."""

    def __init__(self, source, block: int = 1 << 16):
        self.source, self.block, self.buffer, self.raw = source, block, b"", b""
        self.z = zlib.decompressobj(31)

    def more(self) -> bool:
        while True:
            if self.z.eof:
                self.raw, self.z = self.z.unused_data, zlib.decompressobj(31)
            data = self.raw or self.source.read(self.block)
            self.raw = b""
            if not data:
                return False
            out = self.z.decompress(data, self.block)
            self.raw = self.z.unconsumed_tail
            if out:
                self.buffer += out
                return True

    def head(self) -> list[str] | None:
        """Header lines up to the empty line; None at the end of the archive."""
        while (end := self.buffer.find(b"\r\n\r\n")) < 0:
            if not self.more():
                if self.buffer.strip():
                    raise ValueError("archive ends inside a record header")
                return None
        lines, self.buffer = self.buffer[:end].decode("utf-8").split("\r\n"), self.buffer[end + 4:]
        return lines

    def take(self, n: int) -> bytes:
        """At most ``n`` bytes, at least one."""
        if not self.buffer and not self.more():
            raise ValueError("archive ends inside a record")
        out, self.buffer = self.buffer[:n], self.buffer[n:]
        return out


def _fields(lines: list[str]) -> dict[str, str]:
    return {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}


def record_chunks(source, chunk_bytes: int) -> Iterator[tuple]:
    """Chunk rows of one archive, in order; checks each stated digest."""
    z = _Inflated(source)
    while (lines := z.head()) is not None:
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"not a record: {lines[0][:40]!r}")
        f = _fields(lines)
        rid, kind = f["warc-record-id"].strip("<>"), f["warc-type"]
        refers, stated = f.get("warc-refers-to", "").strip("<>") or None, f["warc-payload-digest"].partition(":")[2]
        http = z.head()
        left = int(f["content-length"]) - len(("\r\n".join(http) + "\r\n\r\n").encode("utf-8"))
        digest, start, no = hashlib.sha1(), 0, 0
        while True:
            want, parts = min(left, chunk_bytes), []
            while want:
                got = z.take(want)
                parts.append(got)
                want -= len(got)
            data = b"".join(parts)
            left -= len(data)
            digest.update(data)
            sofar = base32_digest(digest.digest())
            if not left and kind == "response" and sofar != stated:
                raise ValueError(f"{rid}: payload digest {sofar}, stated {stated}")
            yield rid, no, start, len(data), data, sofar, not left, kind, refers, stated
            start, no = start + len(data), no + 1
            if not left:
                break
        end = b""
        while len(end) < 4:
            end += z.take(4 - len(end))
        if end != b"\r\n\r\n":
            raise ValueError(f"{rid}: record doesn't end where it says")


def read_chunks(spark: SparkSession, manifest: DataFrame, folder: str, chunk_bytes: int = 256 << 10,
                with_data: bool = True, batch_bytes: int = 8 << 20) -> DataFrame:
    """The chunked record table of the archives in ``manifest`` (see the module's text)."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType
    schema = to_arrow_schema(StructType.fromDDL(CHUNKS))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, _ = pafs.FileSystem.from_uri(folder)
        for b in batches:
            for path in b.column(0).to_pylist():
                with fs.open_input_stream(path, compression=None) as source:
                    rows, held = [], 0
                    for r in record_chunks(source, chunk_bytes):
                        rows.append(r if with_data else (*r[:4], None, *r[5:]))
                        held += r[3] + 200 if with_data else 200
                        if held >= batch_bytes:
                            yield _batch(rows, schema)
                            rows, held = [], 0
                    if rows:
                        yield _batch(rows, schema)

    # one archive to a task: a stated number of partitions is not coalesced, paths being a few bytes
    paths = manifest.select("path")
    return paths.repartition(max(1, paths.count())).mapInArrow(read, CHUNKS)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def last_chunks(chunks: DataFrame, path: str) -> DataFrame:
    """The last chunk of every record, written below ``path``: archives are read once for both kinds of record."""
    last = chunks.where("is_last").select(
        "record_id", (F.col("start") + F.col("n_bytes")).alias("n"), "digest", "record_type", "refers_to", "stated_digest")
    last.write.mode("overwrite").parquet(path)
    return chunks.sparkSession.read.schema(last.schema).parquet(path)


def archived_pages(last: DataFrame) -> DataFrame:
    """One row per record of its last chunk, with a revisit's length taken from its response.

    A revisit whose response is not there, or has another digest, is an error.
    """
    held = last.where("record_type = 'response'")
    responses = held.select(F.col("record_id").alias("refers_to"), F.col("n").alias("_n"), F.col("digest").alias("_d"))
    revisits = last.where("record_type = 'revisit'").drop("n", "digest").join(responses.hint("merge"), "refers_to", "left")
    sound = F.when(F.col("_d").eqNullSafe(F.col("stated_digest")), F.col("_n")).otherwise(
        F.raise_error(F.concat(F.lit("no response with this payload: "), F.col("record_id"))).cast("long"))
    return held.select("record_id", "n", "digest", "record_type", "refers_to").unionByName(
        revisits.select("record_id", sound.alias("n"), F.col("stated_digest").alias("digest"), "record_type", "refers_to"))


def warc_round_trip(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", url_col: str | None = "url",
                    min_revisit_bytes: int = 0, chunk_bytes: int = 256 << 10, folder: str | None = None) -> DataFrame:
    """Write the archives and read them back: a row per page."""
    spark = pages.sparkSession
    folder = folder or shared_path(spark, "warc")
    manifest = write_archives(pages, folder, id_col, html_col, url_col, min_revisit_bytes, chunk_bytes=chunk_bytes)
    back = archived_pages(last_chunks(read_chunks(spark, manifest, folder, chunk_bytes, with_data=False), f"{folder}/last"))
    t = pages.schema[id_col].dataType
    return back.select(page_of(F.col("record_id")).cast(t).alias("page_id"), F.col("n").cast("long").alias("payload_bytes"),
                       F.col("digest").alias("payload_digest"), "record_type",
                       page_of(F.col("refers_to")).cast(t).alias("refers_to"))

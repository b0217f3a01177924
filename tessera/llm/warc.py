"""WARC archives and the monolithic gzip normaliser (operator 1).

``write_monolithic`` writes one record per page, each file as a single gzip
stream over all its records (plain Spark text output, committed by Spark). Such
a file can't be read at an offset. ``normalise`` inflates every file once, as a
stream, rewrites each record as a gzip member of its own and writes a sidecar
index (``.idx``, tab-separated: offset, length, record id, type) next to it.
``read_records`` then reads any set of records by seeking.

Of pages with equal payloads of at least ``least`` bytes, the one with the
smallest page_id is stored as a response and the others as revisits: the HTTP
head without the payload, ``WARC-Refers-To`` the stored one. Equal payloads are
found by SHA-256 over one pre-aggregated row per digest.

Defined cases: a null payload is empty; a null url is written empty, and line
breaks in a url are percent-encoded; a null page_id is the largest, so it never
takes a revisit target from a real one; rows that repeat a page_id and payload
are the same record type; an empty table gives archives without records; other
columns are not read. A record is streamed in pieces of at most ``CHUNK``
bytes when it is rewritten, whatever its size; reading it back holds one record.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import AtomicFile, filesystem, join_classes, quoted, shared_path, stage

CHUNK = 1 << 20
LEAST = 100
BREAK = b"\r\n\r\n"
LONGEST_HEAD = 1 << 16
INDEX = "offset long, length long, record_id string, record_type string, archive string"


def page_records(pages: DataFrame, least: int = LEAST, date: str = "2000-01-01T00:00:00Z", id_col: str = "page_id",
                 url_col: str = "url", payload_col: str = "html") -> DataFrame:
    """(record): the bytes of one WARC record per page, up to the closing blank lines."""
    payload = F.coalesce(F.col(quoted(payload_col)).cast("string"), F.lit(""))
    rows = pages.select(F.col(quoted(id_col)).cast("long").alias("page_id"), F.col(quoted(url_col)).cast("string").alias("url"),
                        payload.alias("payload"), F.sha2(payload.cast("binary"), 256).alias("digest"),
                        F.octet_length(payload).alias("size"))
    heads = stage(rows.select("page_id", "digest", "size"), "page-digests")
    firsts = (heads.groupBy("digest").agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
              .filter("n > 1"))
    # only what repeats has to be looked up
    again = join_classes(heads, stage(firsts, "page-firsts"), "digest", "n", ["page_id"]).filter(
        (F.col("size") >= least) & F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id")))
    revisits = again.select(F.col("page_id").alias("r_id"), F.col("digest").alias("r_digest"), "first_id").distinct()
    rows = rows.join(revisits, F.col("page_id").eqNullSafe(F.col("r_id")) & (F.col("digest") == F.col("r_digest")), "left")
    revisit = F.col("first_id").isNotNull()
    urn = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("null")), F.lit(">"))
    url = F.replace(F.replace(F.coalesce("url", F.lit("")), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    F.col("size").cast("string"), F.lit("\r\n\r\n"))
    body = F.when(revisit, F.lit("")).otherwise(F.col("payload"))
    head = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "), F.when(revisit, F.lit("revisit")).otherwise(F.lit("response")),
        F.lit("\r\nWARC-Record-ID: "), urn(F.col("page_id")), F.lit(f"\r\nWARC-Date: {date}\r\nWARC-Target-URI: "), url,
        F.when(revisit, F.concat(F.lit("\r\nWARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
                                       "\r\nWARC-Refers-To: "), urn(F.col("first_id")))).otherwise(F.lit("")),
        F.lit("\r\nWARC-Payload-Digest: sha256:"), F.col("digest"),
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "),
        (F.octet_length(http) + F.octet_length(body)).cast("string"), F.lit("\r\n\r\n"))
    return rows.select(F.concat(head, http, body).alias("record"))


def write_monolithic(records: DataFrame, path: str) -> None:
    """One gzip stream per partition; the line separator closes each record."""
    records.write.option("lineSep", BREAK.decode()).option("compression", "gzip").text(path)


def _length(head: bytes) -> int:
    for line in head.split(b"\r\n")[1:]:
        name, _, value = line.partition(b":")
        if name.strip().lower() == b"content-length":
            return int(value)
    raise ValueError("a record without a length")


def headers(head: bytes) -> dict[str, str]:
    out = {}
    for line in head.split(b"\r\n")[1:]:
        name, _, value = line.partition(b":")
        out[name.strip().decode().lower()] = value.strip().decode()
    return out


def _inflated(stream) -> Iterator[bytes]:
    """The bytes of a gzip file of one or more members, in bounded pieces."""
    data = zlib.decompressobj(31)
    while piece := stream.read(CHUNK):
        while piece:
            out = data.decompress(piece, CHUNK)
            if out:
                yield out
            piece = data.unconsumed_tail
            if data.eof:
                piece = data.unused_data
                data = zlib.decompressobj(31)
    out = data.flush()
    if out:
        yield out


class _Reader:
    """Reads exact counts from a sequence of pieces."""

    def __init__(self, pieces: Iterator[bytes]):
        self.pieces, self.held = pieces, b""

    def head(self) -> bytes | None:
        """Up to the next blank line, or None at the end of the file."""
        while BREAK not in self.held:
            piece = next(self.pieces, None)
            if piece is None:
                if self.held.strip():
                    raise ValueError("the file ends inside a record")
                return None
            self.held += piece
            if len(self.held) > LONGEST_HEAD + CHUNK:
                raise ValueError("a record head without an end")
        head, _, self.held = self.held.partition(BREAK)
        return head

    def take(self, n: int) -> Iterator[bytes]:
        while n:
            if not self.held:
                self.held = next(self.pieces, b"")
                if not self.held:
                    raise ValueError("the file ends inside a record")
            piece, self.held = self.held[:n], self.held[n:]
            n -= len(piece)
            yield piece


def rewrite(stream, out) -> Iterator[tuple[int, int, str, str]]:
    """Copy a gzip stream of records to one member per record; yields (offset,
    length, record id, type)."""
    reader, at = _Reader(_inflated(stream)), 0
    while (head := reader.head()) is not None:
        named, size, zipped = headers(head), 0, zlib.compressobj(6, zlib.DEFLATED, 31)
        size += out.write(zipped.compress(head + BREAK))
        for piece in reader.take(_length(head)):
            if got := zipped.compress(piece):
                size += out.write(got)
        if b"".join(reader.take(len(BREAK))) != BREAK:
            raise ValueError("a record whose length is wrong")
        size += out.write(zipped.compress(BREAK) + zipped.flush())
        yield at, size, named.get("warc-record-id", ""), named.get("warc-type", "")
        at += size


class _Counted:
    def __init__(self, out):
        self.out = out

    def write(self, data: bytes) -> int:
        self.out.write(data)
        return len(data)


def _normalise(target: str):
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                name = uri.rsplit("/", 1)[-1].split(".", 1)[0]
                fs, path = filesystem(uri)
                n = 0
                with fs.open_input_stream(path, compression=None) as stream, \
                        AtomicFile(f"{target}/{name}.warc.gz") as out, AtomicFile(f"{target}/{name}.warc.gz.idx") as index:
                    for entry in rewrite(stream, _Counted(out)):
                        index.write(("\t".join(map(str, entry)) + "\n").encode())
                        n += 1
                yield pa.RecordBatch.from_pydict({"archive": [f"{target}/{name}.warc.gz"], "n_records": pa.array([n], pa.int64())})
    return run


def normalise(spark: SparkSession, source: str, target: str) -> DataFrame:
    """Rewrite every ``.gz`` file under ``source``; returns the archives written."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(source).select("path")
    count = max(1, files.count())
    return stage(files.repartition(count).mapInArrow(_normalise(target), "archive string, n_records long"), "archives")


def read_index(spark: SparkSession, target: str) -> DataFrame:
    """The sidecar entries of all archives of a folder."""
    rows = (spark.read.option("pathGlobFilter", "*.idx").text(target)
            .select(F.split("value", "\t").alias("f"), F.input_file_name().alias("file")))
    return rows.select(F.col("f")[0].cast("long").alias("offset"), F.col("f")[1].cast("long").alias("length"),
                       F.col("f")[2].alias("record_id"), F.col("f")[3].alias("record_type"),
                       F.regexp_replace("file", r"\.idx$", "").alias("archive"))


def parse(member: bytes) -> tuple[dict[str, str], bytes]:
    """(headers, block) of one gzip member."""
    data = zlib.decompress(member, 31)
    head, _, rest = data.partition(BREAK)
    block = rest[:_length(head)]
    if rest[len(block):] != BREAK:
        raise ValueError("a record whose length is wrong")
    return headers(head), block


def _page(urn: str | None) -> int | None:
    text = (urn or "").removeprefix("<urn:page:").removesuffix(">")
    return None if text in ("", "null") else int(text)


def _read(batches: Iterator) -> Iterator:
    import pyarrow as pa
    name, file = None, None
    for batch in batches:
        rows = []
        for archive, offset, length in zip(*(batch.column(c).to_pylist() for c in ("archive", "offset", "length"))):
            if archive != name:
                fs, path = filesystem(archive)
                name, file = archive, fs.open_input_file(path)
            file.seek(offset)
            head, block = parse(file.read(length))
            http, _, payload = block.partition(BREAK)
            digest, size = head["warc-payload-digest"].removeprefix("sha256:"), _length(http)
            revisit = head["warc-type"] == "revisit"
            if not revisit and (hashlib.sha256(payload).hexdigest() != digest or len(payload) != size):
                raise ValueError(f"{archive}: the record at {offset} does not match its digest")
            rows.append((_page(head["warc-record-id"]), size, digest, head["warc-type"],
                         _page(head.get("warc-refers-to")) if revisit else None))
        columns = list(zip(*rows)) or [()] * 5
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                         names=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])


def read_records(index: DataFrame, bytes_per_task: int = 32 << 20) -> DataFrame:
    """Read the indexed records by seeking, in the order of the files."""
    total = index.agg(F.sum("length")).first()[0] or 0
    tasks = max(1, -(-total // bytes_per_task))
    return (index.select("archive", "offset", "length").repartitionByRange(tasks, "archive", "offset")
            .sortWithinPartitions("archive", "offset")
            .mapInArrow(_read, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"))


def archive_pages(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Write, normalise and read back."""
    spark = pages.sparkSession
    folder = folder or shared_path(spark, "warc")
    write_monolithic(page_records(pages), f"{folder}/monolithic")
    normalise(spark, f"{folder}/monolithic", f"{folder}/records")
    return read_records(read_index(spark, f"{folder}/records"))

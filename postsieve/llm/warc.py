"""WARC archives: written as one gzip stream a file, then rewritten with every record as a gzip member of its own.

``write_archives`` lets Spark's text writer make the archives: a line is a record and the line end is the blank lines that close a
record, so a compressed file is a whole-file gzip stream, committed like any table. ``normalise`` inflates each such stream once,
from front to back, compresses every record by itself and writes an index of where each begins. ``read_records`` then reads
stretches of an archive in parallel, by that index.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postsieve.operators.skew import ROWS_PER_TASK, skew_join
from postsieve.session import cut_lineage

END = "\r\n\r\n"
HTTP_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
LEAST_BYTES = 100  # shorter payloads are stored each time
CHUNK = 1 << 16
STRETCH = 4 << 20  # bytes of an archive that a task reads in one go
ARCHIVE_BYTES = 64 << 20  # about the bytes of archives that one task rewrites

INDEX = "archive string, offset bigint, length bigint, record_type string, record_id string, uri string"
RECORD = "archive string, offset bigint, record_type string, page_id bigint, refers_to bigint, url string, payload_bytes bigint, payload_digest string, payload binary"


def with_revisits(pages: DataFrame) -> DataFrame:
    """Rows of (page_id, url, payload, payload_digest, refers_to): the last is the id of the record that holds an equal payload, if another does.

    Of rows with equal payloads of at least ``LEAST_BYTES`` bytes, the least page_id holds it (ids that are null come last); rows that
    repeat this id hold it, too. Equal payloads are told by their SHA-256; only digests and ids are grouped. Digests of many
    rows are split over tasks, and where few digests repeat by the measured size of their table, Spark sends it to the payloads.
    """
    spark = pages.sparkSession
    payload = F.coalesce(F.col("html").cast("string"), F.lit(""))
    read = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"),
        F.sha2(payload, 256).alias("payload_digest"),
    )
    long = read.where(F.octet_length("payload") >= LEAST_BYTES)
    groups = long.groupBy("payload_digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    held = cut_lineage(groups, "payloads")
    hot = held.where(F.col("n") > ROWS_PER_TASK)
    hot = cut_lineage(hot.select(F.xxhash64("payload_digest").alias("_key_hash"), F.ceil(F.col("n") / ROWS_PER_TASK).cast("int").alias("_fan")), "hot")
    met = skew_join(read, held.drop("n"), ["payload_digest"], "left", ["page_id", "url"], hot)
    other = ~F.col("first").eqNullSafe(F.col("page_id")) & F.col("first").isNotNull()
    return met.select(*read.columns, F.when(other, F.col("first")).alias("refers_to"))


def record_text(date: str) -> Column:
    """A row as WARC record, without the blank lines that close it. A revisit has the head of the answer only, with the payload's size."""
    held = F.col("refers_to").isNull()
    head = F.concat(F.lit(HTTP_HEAD), F.octet_length("payload").cast("string"), F.lit(END))
    line = lambda name, value: F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))
    name = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit(">"))
    uri = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")
    size = F.octet_length(head) + F.when(held, F.octet_length("payload")).otherwise(0)
    return F.concat(
        F.lit("WARC/1.1\r\n"),
        line("WARC-Type", F.when(held, F.lit("response")).otherwise(F.lit("revisit"))),
        line("WARC-Record-ID", name("page_id")), line("WARC-Date", F.lit(date)), line("WARC-Target-URI", uri),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), "payload_digest")),
        F.when(held, F.lit("")).otherwise(F.concat(F.lit(f"WARC-Profile: {SAME_PAYLOAD}\r\nWARC-Refers-To: "), name("refers_to"), F.lit("\r\n"))),
        F.lit("Content-Type: application/http;msgtype=response\r\n"), line("Content-Length", size.cast("string")), F.lit("\r\n"),
        head, F.when(held, F.col("payload")).otherwise(F.lit("")),
    )


def write_archives(pages: DataFrame, path: str, date: str = "1970-01-01T00:00:00Z") -> None:
    """One record per page, in whole-file gzip archives below ``path``.

    A null html is an empty payload; null ids give a record id without a number, null addresses no address line; line ends in
    an address are written as %0D and %0A. Other columns do not enter. No page, no archive with records.
    """
    with_revisits(pages).select(record_text(date).alias("value")).write.option("compression", "gzip").option("lineSep", END).text(path)


class Inflated:
    """Bytes of a gzip file, read from front to back in pieces; the file may have one member or many."""

    def __init__(self, source, name: str):
        self.source, self.name = source, name
        self.member, self.packed, self.held, self.at = None, b"", b"", 0

    def _more(self) -> bool:
        """Inflate a little more, if there is more; a piece of ``CHUNK`` bytes grows to a thousand times that at most."""
        while True:
            self.packed = self.packed or self.source.read(CHUNK)
            if not self.packed:
                if self.member:
                    raise ValueError(f"{self.name}: the gzip stream ends too early")
                return False
            self.member = self.member or zlib.decompressobj(31)
            out = self.member.decompress(self.packed)
            self.packed = self.member.unused_data
            if self.member.eof:
                self.member = None
            if out:
                self.held, self.at = self.held[self.at :] + out, 0
                return True

    def _take(self, size: int) -> bytes:
        out = self.held[self.at : self.at + size]
        self.at += len(out)
        return out

    def until(self, mark: bytes) -> bytes:
        """Everything up to and with a mark; what is left where the stream ends before it."""
        while (found := self.held.find(mark, self.at)) < 0:
            if not self._more():
                return self._take(len(self.held))
        return self._take(found + len(mark) - self.at)

    def pieces(self, size: int) -> Iterator[bytes]:
        """The next ``size`` bytes, a piece at a time."""
        while size:
            if self.at == len(self.held) and not self._more():
                raise ValueError(f"{self.name}: a record ends too early")
            out = self._take(size)
            size -= len(out)
            yield out


def fields_of(head: bytes) -> dict[str, str]:
    """Named fields of a record's head, names in lower case."""
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"no WARC record begins with {lines[0][:40]!r}")
    return {name.strip().lower(): value.strip() for name, sep, value in (x.partition(":") for x in lines[1:]) if sep}


def split_members(source, sink, name: str, level: int = 6) -> Iterator[tuple[int, int, dict[str, str]]]:
    """Copy an archive so that every record is a gzip member: offset, length and fields of each. Memory does not depend on record sizes."""
    stream, at = Inflated(source, name), 0
    while True:
        raw = stream.until(b"\r\n\r\n")
        if not raw:
            return
        head = raw.lstrip(b"\r\n")
        if not head:  # the blank lines behind a record
            continue
        if not head.endswith(b"\r\n\r\n"):
            raise ValueError(f"{name}: the head of a record ends too early")
        fields = fields_of(head)
        deflate = zlib.compressobj(level, zlib.DEFLATED, 31)
        size = sink.write(deflate.compress(head))
        for piece in stream.pieces(int(fields["content-length"])):
            size += sink.write(deflate.compress(piece))
        size += sink.write(deflate.compress(END.encode()) + deflate.flush())
        yield at, size, fields
        at += size


def _opened(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path if "://" in path or path.startswith("/") else path.replace(":/", ":///", 1))


def _rewriter(target: str, level: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    names = ["archive", "offset", "length", "record_type", "record_id", "uri"]
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]

    def listed(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out_fs, folder = _opened(target)
        for path in (p for b in batches for p in b.column("path").to_pylist()):
            in_fs, source = _opened(path)
            final = f"{target}/{source.rsplit('/', 1)[-1].split('.')[0]}.warc.gz"
            place = _opened(final)[1]
            begun = f"{place}.{uuid.uuid4().hex}"  # an attempt's own file takes the final name when it is whole
            out_fs.create_dir(folder, recursive=True)
            rows = []
            with in_fs.open_input_stream(source, compression=None) as r, out_fs.open_output_stream(begun, compression=None) as w:
                for offset, length, f in split_members(r, w, path, level):
                    rows.append((final, offset, length, f.get("warc-type"), f.get("warc-record-id"), f.get("warc-target-uri")))
                    if len(rows) == 10_000:
                        yield listed(rows)
                        rows = []
            out_fs.move(begun, place)
            if rows:
                yield listed(rows)

    return run


def normalise(spark: SparkSession, source: str, target: str, level: int = 6) -> DataFrame:
    """Rewrite all gzip archives below ``source`` with one member per record; the index of the records.

    Archives go to ``target/archives``, the index to ``target/index`` as a table (archive, offset, length, record_type, record_id,
    uri). A file is inflated by one task in a single pass, in pieces, since a gzip stream cannot be entered in its middle. An
    attempt writes a file of its own name and renames it when whole; every attempt yields the same bytes, so the index, which Spark
    commits, holds for whichever came last. A cut or damaged archive is an error that names it. Files without records give no rows.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(source).select("path", "length")
    n, size = files.agg(F.count(F.lit(1)), F.coalesce(F.sum("length"), F.lit(0))).first()
    tasks = max(1, min(n, -(-size // ARCHIVE_BYTES) + spark.sparkContext.defaultParallelism))
    index = files.repartition(tasks).select("path").mapInArrow(_rewriter(f"{target}/archives", level), INDEX)
    index.write.parquet(f"{target}/index")
    return spark.read.schema(index.schema).parquet(f"{target}/index")


def _number(urn: str | None) -> int | None:
    digits = (urn or "").removeprefix("<urn:page:").removesuffix(">")
    return int(digits) if digits else None


def _record(data: bytes) -> tuple:
    head, _, block = data.partition(b"\r\n\r\n")
    f = fields_of(head)
    answer, _, payload = block[: int(f["content-length"])].partition(b"\r\n\r\n")
    kind, uri = f["warc-type"], f.get("warc-target-uri")
    size = int(answer.rsplit(b"Content-Length:", 1)[1].split(b"\r\n", 1)[0])
    url = uri.replace("%0D", "\r").replace("%0A", "\n") if uri is not None else None
    digest = f["warc-payload-digest"].removeprefix("sha256:")
    return kind, _number(f["warc-record-id"]), _number(f.get("warc-refers-to")), url, size, digest, payload if kind == "response" else None


def read_records(index: DataFrame, stretch: int = STRETCH) -> DataFrame:
    """The records that an index names: archive, offset, record_type, page_id, refers_to, url, payload_bytes, payload_digest, payload.

    Only the named members are read. Stretches of an archive are read in parallel, so one large archive is no single task. Size
    and digest are those that the record states; the payload of a revisit is null. Written %0D and %0A in addresses are read as line ends.
    """
    n, size = index.agg(F.count(F.lit(1)), F.coalesce(F.sum("length"), F.lit(0))).first()
    tasks = max(1, min(n, -(-size // ARCHIVE_BYTES) + index.sparkSession.sparkContext.defaultParallelism))  # by bytes to read: the index itself is small
    spread = index.repartition(tasks, "archive", F.floor(F.col("offset") / stretch)).sortWithinPartitions("archive", "offset")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened, file, rows, size = None, None, [], 0
        names = ["archive", "offset", "record_type", "page_id", "refers_to", "url", "payload_bytes", "payload_digest", "payload"]
        kinds = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.binary()]
        listed = lambda: pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)
        for batch in batches:
            for archive, offset, length in zip(*(batch.column(c).to_pylist() for c in ("archive", "offset", "length"))):
                if archive != opened:
                    store, place = _opened(archive)
                    file, opened = store.open_input_file(place), archive
                data = zlib.decompress(file.read_at(length, offset), 31)
                rows.append((archive, offset, *_record(data)))
                size += len(data)
                if size > STRETCH:
                    yield listed()
                    rows, size = [], 0
        if rows:
            yield listed()

    return spread.select("archive", "offset", "length").mapInArrow(run, RECORD)

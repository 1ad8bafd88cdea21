"""WARC archives: a writer of plain DataFrame operations and a Python data source that reads them, compressed or not.

The writer makes each record a string and lets Spark's text sink, with its commit protocol, store the lines; a record's last line break
is the sink's own. Compressed archives have one gzip member a record. The reader plans one partition for each file, parses headers
first, and skips the payloads that no filter or column wants. Pushed down: equality and IN on record_type, page_id and payload_digest.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition

from ._shared import fresh_path, spill

SCHEMA = "page_id long, target_uri string, record_type string, payload_digest string, payload_bytes long, refers_to long, content_length long, payload binary"
#: Digits of base 32 as conv() gives them, and as WARC digests have them.
DIGITS, BASE32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def sha1_base32(payload: Column) -> Column:
    """Bare upper-case base32 SHA-1: five hexadecimal digits make four of base 32."""
    digest = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(digest, i, 5), 16, 32), 4, "0") for i in range(1, 41, 5)]
    return F.translate(F.concat(*parts), DIGITS, BASE32)


def write_archives(pages: DataFrame, path: str, least_bytes: int = 0, salts: int = 16, compress: bool = False) -> None:
    """Write one record per row of pages (page_id, url, html) below path.

    Of the records with equal payloads of at least least_bytes, the one with the largest page_id is the response and the others are
    revisits without payload; smaller ones are all responses. A null html is an empty payload. Rows with a null page_id are responses
    and no revisit refers to them. Of rows that repeat a page_id and payload one is the response: that with the largest hash of its url,
    and of identical rows one. A response that others refer to is named by page and digest, other records by page and a random UUID. Line
    breaks in a url become spaces. An empty table writes no records.
    """
    html = F.coalesce("html", F.lit(""))
    p = pages.select("page_id", F.regexp_replace(F.coalesce("url", F.lit("")), r"[\r\n]+", " ").alias("url"), html.alias("html"), F.encode(html, "UTF-8").alias("payload"))
    p = p.select("page_id", "url", "html", F.octet_length("payload").cast("long").alias("n"), sha1_base32(F.col("payload")).alias("digest"))
    # who responds for a payload: aggregated before the shuffle, and dealt over salts so that a hot payload joins in many tasks
    row = F.xxhash64("page_id", "url")
    thin = p.select("page_id", "n", "digest", row.alias("row"))
    twins = thin.where((F.col("n") >= least_bytes) & F.col("page_id").isNotNull()).groupBy("digest", "n").agg(F.max(F.struct("page_id", "row")).alias("top"), F.count("*").alias("copies")).where("copies > 1")
    twins = spill(twins.select(F.col("digest").alias("d"), F.col("n").alias("m"), F.col("top.page_id").alias("first"), F.col("top.row").alias("first_row")), "warc_twins")
    salted = twins.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    salt = F.pmod(F.xxhash64("page_id", "url"), F.lit(salts)).cast("int")
    r = p.withColumn("row", row).join(salted, (F.col("digest") == F.col("d")) & (F.col("n") == F.col("m")) & (salt == F.col("salt")), "left")
    first = F.col("page_id").isNotNull() & F.col("first").isNotNull() & (F.col("page_id") == F.col("first")) & (F.col("row") == F.col("first_row"))
    r = r.withColumn("is_first", F.coalesce(first, F.lit(False))).withColumn("copy", F.lit(1).cast("long"))
    if thin.groupBy("page_id", "row", "digest").count().where("count > 1").limit(1).count():
        # identical rows: counted, then told apart by a number
        same = r.where("is_first").groupBy("page_id", "url", "n", "digest", "first").agg(F.first("html").alias("html"), F.count("*").alias("copies"))
        same = same.withColumn("is_first", F.lit(True)).withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
        wanted = ["page_id", "url", "html", "n", "digest", "first", "is_first", "copy"]
        r = r.where("NOT is_first").select(*wanted).unionByName(same.select(*wanted))
    referred = F.col("is_first") & (F.col("copy") == 1)
    revisit = F.coalesce(F.col("page_id").isNotNull() & F.col("first").isNotNull() & ~referred, F.lit(False))
    line = lambda name, value: F.when(value.isNotNull(), F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit("\r\n"))).otherwise("")
    urn = lambda c: F.concat(F.lit("<urn:page:"), c.cast("string"), F.lit(">"))
    record = F.concat(
        F.lit("WARC/1.1\r\n"),
        line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        line("WARC-Record-ID", urn(F.concat(F.coalesce(F.col("page_id").cast("string"), F.lit("null")), F.lit(":"), F.when(referred, F.col("digest")).otherwise(F.uuid())))),
        line("WARC-Date", F.lit("1970-01-01T00:00:00Z")),
        line("WARC-Target-URI", F.col("url")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        F.when(revisit, line("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))).otherwise(""),
        F.when(revisit, line("WARC-Refers-To", urn(F.concat(F.col("first").cast("string"), F.lit(":"), F.col("digest"))))).otherwise(""),
        line("X-Payload-Length", F.col("n")),
        line("Content-Type", F.lit("text/html; charset=utf-8")),
        line("Content-Length", F.when(revisit, F.lit(0)).otherwise(F.col("n"))),
        F.lit("\r\n"),
        F.when(revisit, "").otherwise(F.col("html")),
        F.lit("\r\n"),
    )
    records_of = r.select(record.alias("value"))
    if compress:
        store, base = open_folder(path)
        store.create_dir(base, recursive=True)
        spill(records_of.mapInArrow(_gzip_writer(path), "name string, records long"), "warc_files")
    else:
        records_of.write.option("lineSep", "\r\n").text(path)


def _gzip_writer(path: str):
    """Each partition's records as part-00000.warc.gz, one gzip member each; written under a name of the attempt, then renamed."""

    def run(batches):
        part, attempt, n, sink = TaskContext.get().partitionId(), TaskContext.get().taskAttemptId(), 0, None
        store, base = open_folder(path)
        name = f"part-{part:05d}.warc.gz"
        for batch in batches:
            for value in batch.column(0):
                if sink is None:
                    sink = store.open_output_stream(f"{base}/.{name}-{attempt}", compression=None)
                packer = zlib.compressobj(wbits=31)
                sink.write(packer.compress(value.as_py().encode() + b"\r\n") + packer.flush())
                n += 1
        if sink is not None:
            sink.close()
            store.move(f"{base}/.{name}-{attempt}", f"{base}/{name}")
            yield pa.RecordBatch.from_pydict({"name": [name], "records": pa.array([n], pa.int64())})

    return run


class WarcFile(InputPartition):
    def __init__(self, path: str):
        self.path = path


def open_folder(uri: str):
    """(file system, path): any store that pyarrow knows, by its URI; a bare path is local."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if ":" in uri.split("/")[0] else f"file://{uri}")


class WarcReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path = options["path"]
        self.payload = options.get("payload", "true").lower() == "true"
        self.wanted: dict[str, set] = {}

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:  # noqa: N802
        for f in filters:
            values = [f.value] if isinstance(f, EqualTo) else list(f.value) if isinstance(f, In) else None
            if values is not None and len(f.attribute) == 1 and f.attribute[0] in ("record_type", "page_id", "payload_digest"):
                allowed = set(values)
                self.wanted[f.attribute[0]] = self.wanted.get(f.attribute[0], allowed) & allowed
            else:
                yield f

    def partitions(self) -> list[InputPartition]:
        from pyarrow import fs

        store, path = open_folder(self.path)
        if store.get_file_info(path).type == fs.FileType.File:
            return [WarcFile(self.path)]
        files = [f for f in store.get_file_info(fs.FileSelector(path, recursive=True)) if f.type == fs.FileType.File and f.size and not f.base_name.startswith(("_", "."))]
        base = self.path.rstrip("/")
        return [WarcFile(base + f.path[len(path.rstrip("/")) :]) for f in sorted(files, key=lambda f: f.path)] or [WarcFile("")]

    def read(self, partition: WarcFile):
        if not partition.path:
            return
        store, path = open_folder(partition.path)
        with store.open_input_file(path) as raw:
            yield from records(Unpacked(raw) if path.endswith(".gz") else Plain(raw), self.wanted, self.payload)


class Plain:
    """An open archive read in blocks; what is skipped is not read unless it stands in the block."""

    def __init__(self, raw, block: int = 1 << 20):
        self.raw, self.block, self.size, self.base, self.buffer, self.at = raw, block, raw.size(), 0, b"", 0

    def peek(self, n: int) -> bytes:
        """The next n bytes, or those that are left."""
        if self.at < self.base or self.at + n > self.base + len(self.buffer):
            self.raw.seek(self.at)
            self.buffer, self.base = self.raw.read(max(n, self.block)), self.at
        return self.buffer[self.at - self.base : self.at - self.base + n]

    def skip(self, n: int) -> int:
        """Pass over n bytes, or those that are left; returns how many."""
        n = min(n, self.size - self.at)
        self.at += n
        return n


class Unpacked:
    """A gzip archive, of one member a record or otherwise; skipped bytes are unpacked but not kept."""

    def __init__(self, raw, block: int = 1 << 18):
        self.raw, self.block, self.buffer, self.member, self.packed, self.at = raw, block, bytearray(), None, b"", 0

    def more(self) -> bool:
        if not self.packed:
            self.packed = self.raw.read(self.block)
            if not self.packed:
                if self.member is not None:
                    raise ValueError(f"record at byte {self.at} breaks off")
                return False
        self.member = self.member or zlib.decompressobj(31)
        self.buffer += self.member.decompress(self.packed, 1 << 20)
        if self.member.eof:
            self.packed, self.member = self.member.unused_data, None
        else:
            self.packed = self.member.unconsumed_tail
        return True

    def peek(self, n: int) -> bytes:
        while len(self.buffer) < n and self.more():
            pass
        return bytes(self.buffer[:n])

    def skip(self, n: int) -> int:
        left = n
        while left and (self.buffer or self.more()):
            k = min(left, len(self.buffer))
            del self.buffer[:k]
            left -= k
        self.at += n - left
        return n - left


def records(archive, wanted: dict[str, set], payload: bool):
    """The wanted records of an open archive; unwanted payloads are passed over and never decoded.

    A record that breaks off before its headers end or before its content does raises ValueError. Text before a version line is refused too.
    """
    while archive.peek(1):
        at, n = archive.at, 4096
        while (end := (head := archive.peek(n)).find(b"\r\n\r\n")) < 0:
            if len(head) < n:
                raise ValueError(f"record at byte {at} has no end of headers")
            n *= 4
        lines = head[:end].decode().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no WARC record at byte {at}")
        h = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        length = int(h["content-length"])
        archive.skip(end + 4)
        page_of = lambda urn: urn.removeprefix("<urn:page:").removesuffix(">").split(":")[0]
        page = page_of(h.get("warc-record-id", ""))
        row = {"page_id": int(page) if page.lstrip("-").isdigit() else None, "record_type": h.get("warc-type"), "payload_digest": h.get("warc-payload-digest", "").removeprefix("sha1:")}
        take = all(row[k] in v for k, v in wanted.items())
        content = archive.peek(length) if take and payload else None
        if archive.skip(length) < length or (content is not None and len(content) < length):
            raise ValueError(f"record at byte {at} breaks off")
        archive.skip(4)
        if not take:
            continue
        refers = page_of(h.get("warc-refers-to", ""))
        if content is not None and row["record_type"] == "response" and base64.b32encode(hashlib.sha1(content).digest()).decode() != row["payload_digest"]:  # noqa: S324
            raise ValueError(f"payload of page {page} does not match its digest")
        of_payload = length if row["record_type"] == "response" else int(h.get("x-payload-length", length))
        yield (row["page_id"], h.get("warc-target-uri"), row["record_type"], row["payload_digest"], of_payload, int(refers) if refers else None, length, content)


class WarcSource(DataSource):
    """spark.read.format("warc").option("payload", "false").load(path)"""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return WarcReader(self.options)


def read_archives(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """The records below path. payload=False leaves payloads unread, as null."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)
    return spark.read.format("warc").option("payload", str(payload).lower()).load(path)


def round_trip(pages: DataFrame, least_bytes: int = 0, compress: bool = False) -> DataFrame:
    """Archive pages in the shared folder, read the archives back, and return what each record says; digests are checked while reading."""
    path = fresh_path(pages.sparkSession, "warc")
    write_archives(pages, path, least_bytes, compress=compress)
    return read_archives(pages.sparkSession, path)

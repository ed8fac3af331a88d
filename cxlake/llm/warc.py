"""WARC archives: written with revisit records, read back by byte ranges.

Writing. Each record is a gzip member of its own, as WARC asks for. Python
tasks make the members; Spark's text writer puts their bytes into files, so
retried tasks, lost executors and any file system that Spark knows are covered
by its commit protocol. A row of that writer holds the members of about
``CHUNK_BYTES`` of archive, and its line separator is a whole member as well: a
``warcinfo`` record. So the files hold nothing but valid members.

Reading (any gzipped WARC files, not only those written here). Tasks scan byte
ranges of the files for gzip magic: Spark's text reader does that with the magic
as its line separator, and gives each range the stretches that start inside it.
Every stretch is a *candidate member*. It is one if its gzip header decodes and
the first bytes inflated are a WARC header; a magic that compressed data hold by
chance fails this, or lies inside a member that has not ended, and its stretch
goes on with that member. A task owns the records that start inside its ranges.
A member whose rest was cut off by such a chance magic beyond the end of its
range is put together in a second, small step: its start and the stretches
without a member at the head of the next ranges meet, sorted by file and
position, and are read as a stream.

Deduplication. Of pages with equal payloads of at least ``MIN_REVISIT_BYTES``,
the one with the smallest page_id is written in full, the others as revisits.
A hot payload is reduced per (digest, salt) before anything meets per digest, and
rows are joined back per (digest, salt), so its pages never meet in one task.
Payloads are compared by SHA-256.

Defined results: a null html is an empty payload, a null url gives a record
without target, a null page_id counts as the largest; of repeated rows with the
same smallest page_id one is the response; a stretch of a file that is no member
(a truncated or damaged record, foreign bytes) is returned by the reader as a
row with an ``error`` and never dropped in silence. Other columns of the pages
are not read. A record is one row: its payload is held in memory (2 GB at most).
"""

from __future__ import annotations

import gzip
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cxlake.llm.shared import keep_on_disk, small_batches, use_checkpoint_dir

MIN_REVISIT_BYTES, CHUNK_BYTES, SALTS = 100, 4 << 20, 64
# Gzip magic with the method byte, WARC's version and profile, the archive's date.
MAGIC = b"\x1f\x8b\x08"
START = b"WARC/"
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NO_DATE = "1970-01-01T00:00:00Z"
PAGE_ID, REFERS_TO_PAGE = "X-Page-Id", "X-Refers-To-Page-Id"
BYTES_AS_TEXT = "ISO-8859-1"


def _member(fields: list[tuple[str, str | None]], block: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in fields if v is not None)
    return gzip.compress(f"{VERSION}\r\n{head}Content-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n", 6, mtime=0)


def _one_line(url: str | None) -> str | None:
    """A header value: control characters and blanks would end or split it, so they become % codes."""
    if url is None:
        return None
    return "".join(c if ord(c) > 32 and ord(c) != 127 else f"%{ord(c):02X}" for c in url)


def record_types(pages: DataFrame) -> DataFrame:
    """``pages`` rows (uid, page_id, payload_digest, payload_bytes) that revisit another: uid, refers_uid, refers_to."""
    rows = pages.where(F.col("payload_bytes") >= MIN_REVISIT_BYTES).select(
        "uid", "page_id", F.unhex("payload_digest").alias("digest"), F.pmod(F.xxhash64("uid"), F.lit(SALTS)).alias("salt")
    )
    order = F.struct(F.col("page_id").isNull().alias("unknown"), "page_id", "uid")
    parts = rows.groupBy("digest", "salt").agg(F.min(order).alias("low"), F.count(F.lit(1)).alias("n"))
    whole = Window.partitionBy("digest")  # SALTS rows of a digest at most
    firsts = parts.select("digest", "salt", F.min("low").over(whole).alias("first"), F.sum("n").over(whole).alias("all")).where("all > 1")
    found = rows.join(firsts, ["digest", "salt"]).where(F.col("uid") != F.col("first.uid"))
    return found.select("uid", F.col("first.uid").alias("refers_uid"), F.col("first.page_id").alias("refers_to"))


def write_archives(pages: DataFrame, folder: str, date: str = NO_DATE) -> None:
    """Write a record per row of ``pages`` (page_id, url, html) to gzipped WARC files in ``folder``.

    The rows are first kept on disk with a number each, in compressed form, since their digests and
    their payloads are used apart. The revisits are kept as files as well: Spark broadcasts them if
    their size allows it, and only otherwise do payloads move between tasks."""
    spark = pages.sparkSession
    small_batches(spark)
    use_checkpoint_dir(spark)
    staged_at = f"{spark.sparkContext.getCheckpointDir()}/warc-pages-{uuid.uuid4().hex}"
    text = F.coalesce(pages["html"].cast("string"), F.lit(""))
    pages.select(
        F.monotonically_increasing_id().alias("uid"),
        pages["page_id"].cast("long").alias("page_id"),
        pages["url"].cast("string").alias("url"),
        text.cast("binary").alias("html"),
        F.octet_length(text).cast("long").alias("payload_bytes"),
        F.sha2(text, 256).alias("payload_digest"),
    ).write.option("compression", "zstd").parquet(staged_at)
    staged = spark.read.parquet(staged_at)
    # as files, so that their size is known when the join below is planned
    record_types(staged).write.parquet(f"{staged_at}-revisits")
    revisits = spark.read.parquet(f"{staged_at}-revisits")
    rows = staged.join(revisits, "uid", "left").select("uid", "page_id", "url", "html", "payload_digest", "refers_uid", "refers_to")

    run = uuid.uuid4()
    info = _member(
        [("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{run}>"), ("WARC-Date", date), ("Content-Type", "application/warc-fields")],
        b"format: WARC File Format 1.1\r\n",
    )

    def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([b"".join(held)], pa.binary())], ["chunk"])

        def named(uid: int | None) -> str | None:
            return None if uid is None else f"<urn:uuid:{uuid.uuid5(run, str(uid))}>"

        for batch in batches:
            for i in range(batch.num_rows):
                uid, page_id, url, payload, digest, refers_uid, refers_to = (c[i].as_py() for c in batch.columns)
                revisit = refers_uid is not None
                http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
                fields = [
                    ("WARC-Type", "revisit" if revisit else "response"),
                    ("WARC-Record-ID", named(uid)),
                    ("WARC-Date", date),
                    ("WARC-Target-URI", _one_line(url)),
                    ("WARC-Payload-Digest", f"sha256:{digest}"),
                    ("WARC-Refers-To", named(refers_uid)),
                    ("WARC-Profile", REVISIT_PROFILE if revisit else None),
                    (PAGE_ID, None if page_id is None else str(page_id)),
                    (REFERS_TO_PAGE, None if refers_to is None else str(refers_to)),
                    ("Content-Type", "application/http; msgtype=response"),
                ]
                held.append(_member(fields, http if revisit else http + payload))
                size += len(held[-1])
                if size >= CHUNK_BYTES:
                    yield out()
                    held, size = [], 0
        if held:
            yield out()

    chunks = rows.mapInArrow(members, "chunk binary").select(F.col("chunk").cast("string").alias("value"))
    chunks.write.option("encoding", BYTES_AS_TEXT).option("lineSep", info.decode(BYTES_AS_TEXT)).text(folder)
    for path in (staged_at, f"{staged_at}-revisits"):
        remove(spark, path)


def remove(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


# -- reading ------------------------------------------------------------------------


class MemberStream:
    """Stretches between gzip magics, in file order, -> members.

    ``feed`` takes a stretch (with its magic) and gives (kind, bytes) results: ``record`` (an inflated
    member), ``damaged`` (a member that can't be inflated to its end), ``orphan`` (a stretch that
    neither starts a member nor goes on with one). A stretch too short to show a WARC header stays a
    candidate until the next one decides."""

    def __init__(self) -> None:
        self.close()

    def close(self) -> bytes | None:
        """Forget an open member; its compressed bytes so far (None: none is open)."""
        raw = b"".join(self.raw) if getattr(self, "raw", None) else None
        self.raw: list[bytes] = []
        self.text: list[bytes] = []
        self.first = b""
        self.inflate = None
        return raw

    def known(self) -> bool:
        """True while a member is open whose WARC header has shown."""
        return self.first == START

    def feed(self, stretch: bytes) -> Iterator[tuple[str, bytes]]:
        if self.inflate is None:
            self.inflate = zlib.decompressobj(31)
        self.raw.append(stretch)
        try:
            got = self.inflate.decompress(stretch)
            self.first += got[: len(START) - len(self.first)]
            good = START.startswith(self.first)
        except zlib.error:
            got, good = b"", False
        if not good:
            pieces, known = self.raw, self.known()
            self.close()
            # a member that breaks off ends before this stretch; what never showed a header was none
            yield ("damaged", b"".join(pieces[:-1] or pieces)) if known else ("orphan", pieces[0])
            for piece in pieces[-1:] if known and len(pieces) > 1 else [] if known else pieces[1:]:
                yield from self.feed(piece)
            return
        self.text.append(got)
        if self.inflate.eof:
            rest, known = self.inflate.unused_data.strip(b"\0"), self.known()
            yield ("record", b"".join(self.text)) if known else ("orphan", b"".join(self.raw))
            self.close()
            if rest:
                yield "orphan", rest


def parse_record(data: bytes) -> tuple[dict[str, str], bytes, int | None]:
    """(header fields by lower-case name, payload, the HTTP header's Content-Length) of an inflated member."""
    head, _, block = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")[1:]
    fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
    block = block[: int(fields["content-length"])]
    length = None
    if fields.get("content-type", "").startswith("application/http"):
        http, _, block = block.partition(b"\r\n\r\n")
        for line in http.decode("latin-1").split("\r\n"):
            name, _, value = line.partition(":")
            if name.strip().lower() == "content-length" and value.strip().isdigit():
                length = int(value)
    return fields, block, length


PARSED = "file string, start bigint, kind string, fields map<string,string>, payload binary, http_length bigint, raw binary"


class _Rows:
    """Collects result rows and gives them out as Arrow batches of bounded size."""

    def __init__(self) -> None:
        self.rows: list[tuple] = []
        self.size = 0

    def add(self, file: str, start: int, kind: str, data: bytes) -> None:
        fields, payload, length, raw = None, None, None, None
        if kind == "record":
            try:
                fields, payload, length = parse_record(data)
            except (KeyError, ValueError):
                kind = "damaged"
        if kind != "record":
            raw = data
        self.rows.append((file, start, kind, list(fields.items()) if fields is not None else None, payload, length, raw))
        self.size += len(data)

    def full(self) -> bool:
        return self.size >= 2 << 20

    def take(self) -> pa.RecordBatch:
        types = [pa.string(), pa.int64(), pa.string(), pa.map_(pa.string(), pa.string()), pa.binary(), pa.int64(), pa.binary()]
        names = ["file", "start", "kind", "fields", "payload", "http_length", "raw"]
        batch = pa.RecordBatch.from_arrays([pa.array([r[i] for r in self.rows], t) for i, t in enumerate(types)], names)
        self.rows, self.size = [], 0
        return batch


def _parse_ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stretches of whole byte ranges -> records; what a range can't finish comes as ``head`` and ``tail``.

    ``head``: a stretch before the range's first member, or one at its end that is too short to tell;
    ``tail``: a member that the range doesn't end."""
    stream, out, at, started = MemberStream(), _Rows(), None, False

    def finish() -> None:
        pieces = [b"".join(stream.raw)] if stream.known() else stream.raw
        for piece in pieces:
            out.add(*at, "tail" if stream.known() else "head", piece)
        stream.close()

    for batch in batches:
        for i in range(batch.num_rows):
            stretch, file, start = (c[i].as_py() for c in batch.columns)
            if (file, start) != at:
                finish()
                at, started = (file, start), False
                if start == 0:
                    # what lies before the first magic of a file is no member
                    started = True
                    if stretch:
                        out.add(*at, "damaged", stretch)
                    continue
            for kind, data in stream.feed(MAGIC + stretch):
                if kind == "orphan":
                    kind = "damaged" if started else "head"
                else:
                    started = True
                out.add(*at, kind, data)
            started = started or stream.known()
            if out.full():
                yield out.take()
    finish()
    yield out.take()


def _parse_rests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Tails and heads, sorted by file and position -> the records that they make together."""
    stream, out, at, opened = MemberStream(), _Rows(), (None, None), None

    def finish() -> None:
        raw = stream.close()
        if raw is not None:
            out.add(*opened, "damaged", raw)

    for batch in batches:
        for i in range(batch.num_rows):
            file, start, kind, raw = (c[i].as_py() for c in batch.columns)
            if file != at[0]:
                finish()
            if kind == "tail":
                finish()
            at = (file, start)
            if stream.inflate is None:
                opened = (file, start)
            for found, data in stream.feed(raw):
                out.add(*opened, "record" if found == "record" else "damaged", data)
            if out.full():
                yield out.take()
    finish()
    yield out.take()


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """Records of gzipped WARC files: file, record_type, record_id, target_uri, date, fields, payload, http_length, error.

    ``fields`` has the header by lower-case names; ``payload`` the block without HTTP headers;
    ``http_length`` the HTTP header's Content-Length. ``error`` is null for records; a stretch that is
    none has a row with an error and its bytes as payload. One file's unfinished members are few
    (one a range at most) and are sorted, not gathered."""
    small_batches(spark)
    text = spark.read.option("lineSep", MAGIC.decode(BYTES_AS_TEXT)).option("encoding", BYTES_AS_TEXT).text(folder)
    stretches = text.select(F.col("value").cast("binary").alias("stretch"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))
    parsed = stretches.mapInArrow(_parse_ranges, PARSED)
    whole = parsed.where(F.col("kind").isin("record", "damaged"))
    # order inside a range: its heads come first, its tail last; heads keep their order by number
    rests = parsed.where(F.col("kind").isin("head", "tail")).withColumn("nth", F.monotonically_increasing_id())
    rests = rests.repartition("file").sortWithinPartitions("file", "start", "nth").select("file", "start", "kind", "raw")
    both = whole.unionByName(rests.mapInArrow(_parse_rests, PARSED))

    def field(name: str) -> Column:
        return F.col("fields")[name]

    return both.select(
        "file",
        field("warc-type").alias("record_type"),
        field("warc-record-id").alias("record_id"),
        field("warc-target-uri").alias("target_uri"),
        field("warc-date").alias("date"),
        "fields",
        F.coalesce("payload", "raw").alias("payload"),
        "http_length",
        F.when(F.col("kind") != "record", F.lit("no readable WARC member")).alias("error"),
    )


def page_report(records: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of page records as read.

    A response's size and digest come from its payload, and a digest that differs from the recorded one
    is an error; a revisit's come from its headers. Any unreadable stretch is an error as well."""
    sound = F.when(F.col("error").isNotNull(), F.raise_error(F.concat(F.lit("WARC: "), "error", F.lit(" in "), "file")).cast("boolean"))
    records = records.where(sound.otherwise(F.lit(True))).where(F.col("record_type").isin("response", "revisit"))
    recorded = F.regexp_replace(F.col("fields")["warc-payload-digest"], "^sha256:", "")
    found = F.sha2("payload", 256)
    response = F.col("record_type") == "response"
    digest = F.when(~response, recorded).when(found == recorded, found)
    return records.select(
        F.col("fields")[PAGE_ID.lower()].cast("long").alias("page_id"),
        F.when(response, F.octet_length("payload").cast("long")).otherwise(F.col("http_length")).alias("payload_bytes"),
        F.coalesce(digest, F.raise_error(F.lit("WARC: payload differs from its digest")).cast("string")).alias("payload_digest"),
        "record_type",
        F.col("fields")[REFERS_TO_PAGE.lower()].cast("long").alias("refers_to"),
    )


def round_trip(pages: DataFrame) -> DataFrame:
    """Archives of ``pages`` written to the shared folder, read back as a report; the archives go, the report stays on disk."""
    spark = pages.sparkSession
    use_checkpoint_dir(spark)
    folder = f"{spark.sparkContext.getCheckpointDir()}/warc-{uuid.uuid4().hex}"
    write_archives(pages, folder)
    report = keep_on_disk(page_report(read_archives(spark, folder)))
    remove(spark, folder)
    return report

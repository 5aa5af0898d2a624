"""WARC archives written and read as a table of record chunks.

A payload longer than ``chunk_bytes`` becomes several WARC segment records (``continuation``), so that a row
is (record, segment number, bytes) and no task of the reader holds a whole record: digests of segmented
payloads are carried from chunk to chunk. Archives are written by Spark's text writer, one WARC record to a
row, and read by its text reader, which cuts at the start of each record, so both work on any file system
that Spark knows, and a large archive is read by many tasks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salestide.llm.text import text_or_empty
from salestide.session import fits_broadcast, materialize, workspace

CHUNK_BYTES = 32 * 1024
REVISIT_BYTES = 1000
# Copies are looked up by a broadcast up to this many groups, and by a shuffle of the pages beyond.
MAX_BROADCAST_GROUPS = 200_000

_END = "\r\n"
# Records are cut here. Payloads that hold this text are split inside it, so it only starts records.
RECORD_START = "WARC/1.1\r\nWARC-Type: "
_INSIDE_START = r"(?<=WARC/1\.1\r\n)(?=WARC-Type: )"
_SEGMENT_DDL = "page string, row string, payload_bytes bigint, payload_digest string, whole boolean"


def copies(pages: DataFrame) -> DataFrame:
    """Payloads of at least ``REVISIT_BYTES`` that several pages share: ``sha256`` and the page that keeps it."""
    payload = text_or_empty("html").cast("binary")
    return (
        pages.filter(F.octet_length(payload) >= REVISIT_BYTES)
        .groupBy(F.sha2(payload, 256).alias("sha256"))
        .agg(F.max("page_id").alias("keep"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1").select("sha256", "keep")
    )


def records(pages: DataFrame, chunk_bytes: int = CHUNK_BYTES, date: Column | None = None) -> DataFrame:
    """The chunked record table of ``pages`` (page_id, url, html), one row (``value``) for each WARC record."""
    found = materialize(copies(pages), "warc-copies")
    if fits_broadcast(found, MAX_BROADCAST_GROUPS):
        found = F.broadcast(found)
    html = pages.select("page_id", "url", text_or_empty("html").alias("html")).withColumn(
        "sha256", F.when(F.octet_length("html") >= REVISIT_BYTES, F.sha2(F.col("html").cast("binary"), 256))
    )
    shared = F.col("keep").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("keep"))
    dated = F.date_format(date if date is not None else F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    rows = html.join(found, "sha256", "left").select(
        "page_id", "url", "html", "keep", shared.alias("revisit"), dated.alias("date"), F.uuid().alias("row"),
        F.octet_length("html").cast("bigint").alias("n"), F.sha1(F.col("html").cast("binary")).alias("sha1"),
    )
    none = F.array(F.lit("").cast("binary"))
    chunks = F.when(F.col("revisit"), none).otherwise(_chunks(F.col("html"), chunk_bytes))
    cut = rows.withColumn("chunks", chunks).withColumn("of", F.size("chunks"))
    chunked = cut.select("*", F.posexplode("chunks").alias("k", "chunk"))
    return chunked.select(_record().alias("value"))


def _chunks(html: Column, chunk_bytes: int) -> Column:
    pieces = F.when(html.contains(RECORD_START), F.split(html, _INSIDE_START)).otherwise(F.array(html))

    def cut(piece: Column) -> Column:
        data = piece.cast("binary")
        last = F.greatest(F.ceil(F.octet_length(data) / chunk_bytes), F.lit(1)).cast("int") - 1
        return F.transform(
            F.sequence(F.lit(0), last), lambda i: F.substring(data, i * chunk_bytes + 1, F.lit(chunk_bytes))
        )

    return F.flatten(F.transform(pieces, cut))


def _record() -> Column:
    """The text of one record, without the last line end, which the writer adds."""
    page = F.concat(F.lit("urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("")))
    first, last, several = F.col("k") == 0, F.col("k") == F.col("of") - 1, F.col("of") > 1
    head = F.concat(
        F.lit(f"HTTP/1.1 200 OK{_END}Content-Type: text/html; charset=utf-8{_END}Content-Length: "),
        F.col("n").cast("string"), F.lit(_END * 2),
    )
    http = F.when(first, head).otherwise(F.lit(""))
    length = F.octet_length(http) + F.octet_length("chunk")
    # Line ends and spaces in a url would end the header line.
    target = F.regexp_replace(F.regexp_replace(F.col("url"), "\r", "%0D"), "\n", "%0A")
    kind = F.when(~first, F.lit("continuation")).when(F.col("revisit"), F.lit("revisit")).otherwise(F.lit("response"))

    def line(name: str, value: Column, when: Column = F.lit(True)) -> Column:
        return F.when(when & value.isNotNull(), F.concat(F.lit(f"{name}: "), value, F.lit(_END))).otherwise(F.lit(""))

    number = (F.col("k") + 1).cast("string")
    bracketed = F.concat(F.lit("<"), page, F.when(first, F.lit("")).otherwise(F.concat(F.lit(":"), number)), F.lit(">"))
    return F.concat(
        F.lit(RECORD_START), kind, F.lit(_END),
        line("WARC-Record-ID", bracketed), line("WARC-Date", F.col("date")), line("WARC-Target-URI", target, first),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1")), first),
        line("WARC-Refers-To", F.concat(F.lit("<urn:page:"), F.col("keep").cast("string"), F.lit(">")), F.col("revisit")),
        line("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), F.col("revisit")),
        line("WARC-Segment-Number", number, several),
        line("WARC-Segment-Origin-ID", F.concat(F.lit("<"), page, F.lit(">")), ~first),
        line("WARC-Segment-Total-Length", (F.octet_length(head) + F.col("n")).cast("string"), several & last),
        line("X-Segments", F.col("of").cast("string"), several), line("X-Writer-Row", F.col("row"), several),
        F.when(first, F.lit(f"Content-Type: application/http; msgtype=response{_END}")).otherwise(F.lit("")),
        line("Content-Length", length.cast("string")), F.lit(_END), http, F.col("chunk").cast("string"), F.lit(_END),
    )


def write(pages: DataFrame, path: str, chunk_bytes: int = CHUNK_BYTES, compression: str = "none") -> None:
    """Write one WARC record, segmented if it is long, for each row of ``pages``."""
    records(pages, chunk_bytes).write.option("lineSep", _END).option("compression", compression).text(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """The chunked record table of archives that begin each record with its type.

    Columns: ``type``, ``record_id``, ``origin_id`` (of the first segment), ``segment`` (null if not segmented),
    ``segments``, ``row``, ``target``, ``refers_to``, ``digest`` (as the header says), ``http`` (the head of an
    HTTP block), ``chunk`` (payload bytes in this row) and ``whole`` (the block is as long as its header says).
    """
    raw = spark.read.option("lineSep", RECORD_START).text(path).filter(F.col("value") != "")
    head = F.substring_index("value", _END * 2, 1)

    def field(name: str) -> Column:
        found = F.regexp_extract("head", rf"(?:^|\n){name}: <?([^\r\n]*?)>?(?:\r|$)", 1)
        return F.when(found != "", found)

    split = raw.select(head.alias("head"), F.col("value").cast("binary").alias("data")).withColumn(
        "length", field("Content-Length").cast("bigint")
    )
    block = split.withColumn(
        "block", F.substring("data", F.octet_length("head") + 5, F.col("length").cast("int"))
    )
    is_http = F.substring_index("head", _END, 1).isin("response", "revisit") & F.col("block").cast("string").startswith("HTTP/")
    http = F.when(is_http, F.substring_index(F.col("block").cast("string"), _END * 2, 1))
    table = block.withColumn("http", http)
    start = F.when(F.col("http").isNull(), F.lit(1)).otherwise(F.octet_length("http") + 5)
    rest = F.octet_length("block")
    return table.select(
        F.substring_index("head", _END, 1).alias("type"), field("WARC-Record-ID").alias("record_id"),
        F.coalesce(field("WARC-Segment-Origin-ID"), field("WARC-Record-ID")).alias("origin_id"),
        field("WARC-Segment-Number").cast("int").alias("segment"), field("X-Segments").cast("int").alias("segments"),
        field("X-Writer-Row").alias("row"), field("WARC-Target-URI").alias("target"),
        field("WARC-Refers-To").alias("refers_to"),
        F.substring_index(field("WARC-Payload-Digest"), ":", -1).alias("digest"), "http",
        F.substring(F.col("block"), start, rest).alias("chunk"),
        (F.octet_length("block") == F.col("length")).alias("whole"),
    )


def _digest_in_order(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digest of each record from its chunks, which come in order and next to each other."""
    open_key, state, size, seen, whole, of = None, hashlib.sha1(), 0, 0, True, 0
    out: list[tuple] = []

    def closed() -> tuple:
        return (*open_key, size, state.hexdigest(), whole and seen == of)

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows)) if rows else [[]] * 5
        kinds = (pa.string(), pa.string(), pa.int64(), pa.string(), pa.bool_())
        names = ["page", "row", "payload_bytes", "payload_digest", "whole"]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names)

    for rows in batches:
        columns = [rows.column(name) for name in ("origin_id", "row", "segment", "segments", "whole")]
        chunks = rows.column("chunk")
        for i in range(rows.num_rows):
            origin, row, segment, segments, fine = (c[i].as_py() for c in columns)
            if (origin, row) != open_key:
                if open_key is not None:
                    out.append(closed())
                open_key, state, size, seen, whole, of = (origin, row), hashlib.sha1(), 0, 0, True, segments
            data = chunks[i].as_buffer()
            state.update(data)
            size, seen = size + len(data), seen + 1
            whole = whole and fine and segment == seen
        if out:
            yield batch(out)
            out = []
    if open_key is not None:
        yield batch([closed()])


def payloads(spark: SparkSession, path: str) -> DataFrame:
    """One row per record read back: ``page_id`` (text), ``payload_bytes``, ``payload_digest`` (bare hex SHA-1),
    ``record_type``, ``refers_to`` (text), ``intact``.

    Digests of responses are computed from what was read; ``intact`` says whether all segments are there with
    the lengths and the digest that the headers name. A revisit has no payload: its size and digest are those
    its header and HTTP head state.
    """
    table = read(spark, path)
    single = table.filter(F.col("segment").isNull() & (F.col("type") == "response")).select(
        _page("record_id"), F.octet_length("chunk").cast("bigint").alias("payload_bytes"),
        F.sha1("chunk").alias("payload_digest"), F.lit("response").alias("record_type"),
        F.lit(None).cast("string").alias("refers_to"), (F.col("whole") & (F.sha1("chunk") == F.col("digest"))).alias("intact"),
    )
    revisit = table.filter(F.col("type") == "revisit").select(
        _page("record_id"), F.regexp_extract("http", r"Content-Length: (\d+)", 1).cast("bigint").alias("payload_bytes"),
        F.col("digest").alias("payload_digest"), F.lit("revisit").alias("record_type"), _page("refers_to", "refers_to"),
        F.col("whole").alias("intact"),
    )
    parts = table.filter(F.col("segment").isNotNull())
    named = parts.filter("segment = 1").select(F.col("origin_id").alias("page"), "row", "digest")
    joined = (
        parts.select("origin_id", "row", "segment", "segments", "whole", "chunk")
        .repartition("origin_id", "row").sortWithinPartitions("origin_id", "row", "segment")
        .mapInArrow(_digest_in_order, _SEGMENT_DDL)
        .join(named, ["page", "row"], "left")
    )
    several = joined.select(
        _page("page"), "payload_bytes", "payload_digest", F.lit("response").alias("record_type"),
        F.lit(None).cast("string").alias("refers_to"),
        (F.col("whole") & F.col("payload_digest").eqNullSafe(F.col("digest"))).alias("intact"),
    )
    return single.unionByName(revisit).unionByName(several)


def _page(column: str, name: str = "page_id") -> Column:
    number = F.regexp_extract(column, r"^urn:page:(-?\d+)$", 1)
    return F.when(number != "", number).alias(name)


def round_trip(pages: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Write ``pages`` as WARC into the shared folder and read the archives back: one row per page.

    Columns: ``page_id``, ``payload_bytes``, ``payload_digest``, ``record_type``, ``refers_to``, ``intact``.
    A null html is an empty payload, a null url leaves its header out, a null page_id comes back as null. Of
    equal payloads of at least ``REVISIT_BYTES`` the largest page_id is the response; rows that repeat that
    page_id as well are responses too. No pages give no rows. Other columns are not read.
    """
    spark = pages.sparkSession
    path = workspace(spark, "warc")
    write(pages, path, chunk_bytes)
    kind = pages.schema["page_id"].dataType
    back = payloads(spark, path)
    return back.withColumns({name: F.col(name).cast(kind) for name in ("page_id", "refers_to")})

"""WARC archives: writing with revisits, reading back, and transaction assembly.

``write_archives`` turns a table of captures into WARC/1.1 files through Spark's own writer (so any
file system and its commit protocol serve): per row a request, a response or revisit, and a metadata
record that name one another by WARC-Concurrent-To. Record ids follow from the row, so a task that
runs again writes the same ones, and a revisit names its response's record. ``read_records`` frames
the records of the archives by Content-Length. ``assemble`` joins records through their
concurrent-to identifiers, over any number of hops, and emits one nested row per capture.

Files are bounded by bytes: captures are written by size class (``CLASSES``), each with as many rows a
file as keep it under about 256 MB, or with one row. A reader holds one packed file and one record.

Defined results: null html is an empty payload; a payload under ``min_bytes`` is always a response;
of equal payloads the largest page_id is the response (rows that repeat it too, and all rows
where every id is null) and the others revisit it; null urls are written as an empty target; rows that
are the same in all three columns write records of the same ids, and ``copies`` counts them; an
empty table writes no records and assembles to no rows; other columns are ignored. A record that
names no record present is a capture of its own, and so are records that only name one another in a
ring; of request or metadata records of one capture the largest (by record id) is taken, and
malformed bytes raise.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from hashlib import sha1

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .plan import attach, bounded_batches, discard, drop_folder, near, new_folder, staged

MIN_BYTES = 1000
#: Most bytes of a payload in the class (none: any), and rows a file.
CLASSES = ((1 << 16, 3000), (1 << 22, 64), (None, 1))
DATE = "2024-02-29T00:00:00Z"
CRLF = "\r\n"
RECORD = "record_id string, type string, concurrent_to string, target_uri string, page_id long, payload_bytes long, payload_digest string, refers_to string, payload binary"


def _header(kind: Column, record_id: Column, uri: Column, length: Column, media: str, *more: Column) -> Column:
    lines = [F.lit("WARC/1.1"), F.concat(F.lit("WARC-Type: "), kind), F.concat(F.lit("WARC-Record-ID: <"), record_id, F.lit(">")), F.lit(f"WARC-Date: {DATE}"),
             F.concat(F.lit("WARC-Target-URI: "), uri), *more, F.lit(f"Content-Type: {media}"), F.concat(F.lit("Content-Length: "), length.cast("string"))]
    return F.concat(F.concat_ws(CRLF, *lines), F.lit(CRLF + CRLF))  # concat_ws skips null lines


def record_id(own: Column, kind: str) -> Column:
    return F.concat(F.lit("urn:uuid:"), F.regexp_replace(F.md5(F.concat(own, F.lit(kind))), "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5"))


def size_class(size: Column) -> Column:
    return F.coalesce(*[F.when(size <= most, i) for i, (most, _) in enumerate(CLASSES[:-1])], F.lit(len(CLASSES) - 1))


def revisits(pages: DataFrame, min_bytes: int = MIN_BYTES) -> tuple[DataFrame, list[int]]:
    """The captures, and the size classes that they have.

    Columns: page_id, url, html, payload size and digest, ``own`` (an identity of the row), and page and
    identity of the row whose equal payload it revisits.
    """
    html, url = F.coalesce("html", F.lit("")), F.coalesce("url", F.lit(""))
    rows = pages.select("page_id", url.alias("url"), html.alias("html")).withColumns({"bytes": F.octet_length("html").cast("long"), "sha1": F.sha1("html")})
    rows = rows.withColumn("own", F.md5(F.concat_ws("\n", F.col("page_id").cast("string"), F.col("sha1"), F.col("url"))))
    rows = rows.withColumn("key", F.when(F.col("bytes") >= min_bytes, F.sha2("html", 256)))
    seen = rows.groupBy("key").agg(F.max(F.struct("page_id", "own")).alias("top"), F.count("*").alias("copies"), F.collect_set(size_class(F.col("bytes"))).alias("classes"))
    seen = staged(seen, "payloads")
    total = seen.agg(F.sum("copies")).first()[0] or 0
    classes = sorted(r[0] for r in seen.select(F.explode("classes")).distinct().collect())
    # Only payloads with copies matter to a row, and few have any: the others' html is not shuffled.
    copied = seen.filter("key is not null and copies > 1").select("key", "copies", F.col("top.page_id").alias("original"), F.col("top.own").alias("at"))
    none = {"copies": F.lit(None).cast("long"), "original": F.lit(None).cast("long"), "at": F.lit(None).cast("string")}
    alone = near(rows, F.col("key"), copied, F.col("key"), hit=False).withColumns(none)
    shared = attach(near(rows, F.col("key"), copied, F.col("key")), copied, "key", "copies", F.col("own"), total)
    again = ~F.col("original").eqNullSafe(F.col("page_id")) & F.col("original").isNotNull()
    return alone.unionByName(shared).withColumn("at", F.when(again, F.col("at"))).drop("copies", "original"), classes


def write_archives(pages: DataFrame, folder: str, min_bytes: int = MIN_BYTES) -> None:
    rows, classes = revisits(pages, min_bytes)
    ids = {k: record_id(F.col("own"), k) for k in ("request", "response", "metadata")}
    at = F.concat(F.lit("WARC-Concurrent-To: <"), ids["response"], F.lit(">"))
    uri, again = F.regexp_replace("url", r"[\r\n]", ""), F.col("at").isNotNull()
    head = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "), F.col("bytes").cast("string"), F.lit(CRLF + CRLF))
    block = F.when(again, head).otherwise(F.concat(head, "html"))
    ask = F.concat(F.lit("GET "), uri, F.lit(f" HTTP/1.1{CRLF}{CRLF}"))
    about = F.concat(F.lit("page-id: "), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit(CRLF))
    kind = F.when(again, F.lit("revisit")).otherwise(F.lit("response"))
    digest = F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("sha1"))
    refers = F.when(again, F.concat(F.lit("WARC-Refers-To: <"), record_id(F.col("at"), "response"), F.lit(">")))
    profile = F.when(again, F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))
    end = F.lit(CRLF + CRLF)
    text = F.concat(
        _header(F.lit("request"), ids["request"], uri, F.octet_length(ask), "application/http; msgtype=request", at), ask, end,
        _header(kind, ids["response"], uri, F.octet_length(block), "application/http; msgtype=response", digest, refers, profile), block, end,
        _header(F.lit("metadata"), ids["metadata"], uri, F.octet_length(about), "application/warc-fields", at), about,
    )
    for i in classes or [0]:
        # The writer ends each value with lineSep, which is also what ends a WARC record.
        out = rows.filter(size_class(F.col("bytes")) == i).select(text.alias("value")).write
        out.option("lineSep", CRLF + CRLF).option("compression", "gzip").option("maxRecordsPerFile", CLASSES[i][1]).text(f"{folder}/class-{i}")


def _plain(pieces: Iterator[bytes], packed: bool) -> Iterator[bytes]:
    """The archive's bytes, unpacked member by member if it is gzipped."""
    for piece in pieces:
        if not packed:
            yield piece
            continue
        unpack = zlib.decompressobj(31)
        while piece:
            out = unpack.decompress(piece, 1 << 20)
            if out:
                yield out
            if unpack.eof:
                piece = unpack.unused_data
                unpack = zlib.decompressobj(31)
            else:
                piece = unpack.unconsumed_tail


class _Reader:
    """Reads lines and exact lengths from pieces of bytes, holding one record at most."""

    def __init__(self, pieces: Iterator[bytes]):
        self.pieces, self.have, self.at = pieces, b"", 0

    def _more(self) -> bool:
        piece = next(self.pieces, b"")
        self.have, self.at = self.have[self.at :] + piece, 0
        return bool(piece)

    def until(self, mark: bytes) -> bytes:
        while (i := self.have.find(mark, self.at)) < 0:
            if not self._more():
                rest, self.have, self.at = self.have[self.at :], b"", 0
                if rest.strip():
                    raise ValueError("an archive ends inside a record header")
                return b""
        out, self.at = self.have[self.at : i], i + len(mark)
        return out

    def exactly(self, n: int) -> bytes:
        parts, got = [], len(self.have) - self.at
        if got < n:
            parts.append(self.have[self.at :])
            self.have, self.at = b"", 0
            while got < n:
                piece = next(self.pieces, b"")
                if not piece:
                    raise ValueError("an archive ends inside a record")
                parts.append(piece)
                got += len(piece)
            whole = b"".join(parts)
            self.have = whole[n:]
            return whole[:n]
        out, self.at = self.have[self.at : self.at + n], self.at + n
        return out


def _fields(raw: bytes) -> dict[str, str]:
    pairs = (line.partition(":") for line in raw.decode("utf-8", "replace").split("\r\n")[1:])
    return {k.strip().lower(): v.strip() for k, _, v in pairs}


def records(pieces: Iterator[bytes], packed: bool, payloads: bool) -> Iterator[tuple]:
    """The records of one archive as rows of RECORD; digests are taken from the bytes where there are any."""
    source = _Reader(_plain(pieces, packed))
    bare = lambda v: v.strip("<>") if v else None
    while head := source.until(b"\r\n\r\n").lstrip(b"\r\n"):
        h = _fields(head)
        block = source.exactly(int(h["content-length"]))
        if source.exactly(4) != b"\r\n\r\n":
            raise ValueError("a record's length does not match its block")
        kind, body, size, digest, refers, page = h["warc-type"], None, None, None, None, None
        if kind in ("response", "revisit"):
            http, _, body = block.partition(b"\r\n\r\n")
            if kind == "response":
                size, digest = len(body), sha1(body).hexdigest()
                if h.get("warc-payload-digest", f"sha1:{digest}") != f"sha1:{digest}":
                    raise ValueError(f"payload of {h['warc-record-id']} does not match its digest")
            else:
                size, digest = int(_fields(http)["content-length"]), h["warc-payload-digest"].partition(":")[2]
                refers, body = bare(h.get("warc-refers-to")), None
        elif kind == "metadata":
            page = _fields(b"\r\n" + block).get("page-id")
        yield bare(h["warc-record-id"]), kind, bare(h.get("warc-concurrent-to")), h.get("warc-target-uri"), int(page) if page else None, size, digest, refers, body if payloads else None


def read_records(spark: SparkSession, folder: str, payloads: bool = True) -> DataFrame:
    """One row per record of the archives in a folder; without payloads, their digests and sizes only."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    schema = to_arrow_schema(StructType.fromDDL(RECORD))

    def parse(batches):
        for batch in batches:
            for raw in batch.column("content"):
                raw = raw.as_py()
                rows, size = [], 0
                for r in records(iter([raw]), raw[:2] == b"\x1f\x8b", payloads):
                    rows.append(r)
                    size += len(r[-1] or b"")
                    if len(rows) >= 4096 or size > 4 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    files = bounded_batches(spark).read.format("binaryFile").option("pathGlobFilter", "*.gz").option("recursiveFileLookup", "true").load(folder)
    return files.select("content").mapInArrow(parse, RECORD)


HEADS = ("response", "revisit")


def assemble(found: DataFrame) -> DataFrame:
    """One nested row per capture: capture_id, request, response, metadata, copies (of the response's record id).

    A request or metadata record joins the record it is concurrent to; one that names another request or
    metadata record goes where that one goes. ``found`` is read several times: stage it.
    """
    head = F.col("concurrent_to").isNull() | F.col("type").isin(*HEADS)
    own = found.filter(head).withColumn("capture_id", F.col("record_id"))
    pointing = found.filter(~head).withColumn("capture_id", F.col("concurrent_to"))
    steps = pointing.groupBy(F.col("record_id").alias("via")).agg(F.max("concurrent_to").alias("to"))
    onward = steps.join(steps.select(F.col("to").alias("via")).distinct(), "via", "left_semi")  # records that others name
    if not onward.isEmpty():
        ends = _ends(staged(onward, "steps"))
        counts = pointing.groupBy(F.col("capture_id").alias("via")).agg(F.count("*").alias("weight"))
        pointing = attach(pointing, ends.join(counts, "via").withColumnRenamed("via", "capture_id"), "capture_id", "weight", F.col("record_id"), pointing.count())
        pointing = pointing.withColumn("capture_id", F.coalesce("to", "capture_id")).drop("to", "weight")
    keyed = own.unionByName(pointing)
    whole = lambda kinds: F.max(F.when(F.col("type").isin(*kinds), F.struct(*found.columns)))
    copies = F.count(F.when(F.col("type").isin(*HEADS), 1)).alias("copies")
    return keyed.groupBy("capture_id").agg(whole(["request"]).alias("request"), whole(HEADS).alias("response"), whole(["metadata"]).alias("metadata"), copies)


def _ends(steps: DataFrame) -> DataFrame:
    """(via, to) where each step's target is followed to the end of its chain; the length known doubles each round."""
    for _ in range(max(steps.count(), 1).bit_length() + 1):
        onward = steps.select(F.col("via").alias("to"), F.col("to").alias("far"))
        if steps.join(onward, "to", "left_semi").isEmpty():
            break
        steps = staged(steps.join(onward, "to", "left").select("via", F.coalesce("far", "to").alias("to")), "steps")
    return steps


def with_original(captures: DataFrame) -> DataFrame:
    """Adds original_page: the page id of the capture that a revisit refers to. ``captures`` is read several times."""
    refers = F.col("response.refers_to")
    counts = captures.filter(refers.isNotNull()).groupBy(refers.alias("refers")).agg(F.count("*").alias("weight"))
    table = captures.select(F.col("capture_id").alias("refers"), F.col("metadata.page_id").alias("original_page")).join(counts, "refers")
    return attach(captures.withColumn("refers", refers), table, "refers", "weight", F.col("capture_id"), captures.count()).drop("refers", "weight")


def round_trip(pages: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """Writes the captures, reads the archives back and assembles them, one row per row of ``pages``, without the payloads."""
    spark, folder = pages.sparkSession, new_folder(pages.sparkSession, "archives")
    write_archives(pages, folder, min_bytes)
    found = staged(read_records(spark, folder, payloads=False).drop("payload"), "records")
    drop_folder(spark, folder)
    captures = staged(assemble(found), "captures")
    discard(found)
    return with_original(captures).withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).drop("_copy")

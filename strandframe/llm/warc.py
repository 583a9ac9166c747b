"""WARC archives: written by Spark's text writer, read back by boundary-chain verification.

*Writing.* A record is one row of text whose line separator closes the record,
so archives are plain files on any store that Spark writes to. Of payloads that
are equal and have ``least`` bytes or more, the one of the largest id is written as
a response, the others as revisits that refer to it.

*Reading.* Files are split like any text input, at every ``WARC/1.`` wherever it
stands. A split owns a contiguous run of bytes, so the sizes of the runs, summed
over the earlier splits of a file, give every piece its offset in the file. A piece
with a parsable header is a candidate record start; its length field names
the offset of its successor. Pointer jumping from offset 0 (each round doubles
the distance of all pointers) marks the candidates that the chain reaches. A
separator inside a payload is not reached, whatever it looks like, and is
joined back into the record it lies in. Payloads are only shuffled when they are
asked for (``read``) or cut by a separator; their digests are taken on the spot.

Rounds are logarithmic in the number of records of a file, and each writes its
pointers to the shared folder. Pointers are joined by sorting, never broadcast.
``round_trip`` deletes the archive and all its tables but the one it returns;
after ``read`` and ``describe`` that is left to the caller (``_store.sweep``).

Record ids hold the page's id and a hash of the row, so those of repeated page ids
differ unless the rows are equal. Defined cases: a null payload is empty. Null ids
are written as empty ids and read back as null; they are never the response that
others refer to. Repeated ids are records of their own. An archive whose chain
breaks gives the records before the one that is not followed by another or by the
end of its file; ``round_trip`` raises then. Empty tables give an empty archive.
Other columns are ignored. Payloads are handled whole, however long.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strandframe.llm._names import col
from strandframe.llm._store import Scratch, delete

MAGIC = "WARC/1."
HEADS = "file string, block long, position long, size long, body long, length long, type string, record_id string, refers string, digest string, sha string"
#: Groups of equal payloads, of some 80 bytes each, up to which they are sent to all tasks.
SMALL = 100_000
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_FIELD = re.compile(rb"^([A-Za-z-]+):[ \t]*(.*)$")


def decide(pages: DataFrame, id_col: str, payload_col: str, url_col: str | None, least: int) -> DataFrame:
    """(id, url, payload, size, digest, tag, refers_to, refers_tag): refers_to is null for responses; tag tells rows of one id apart."""
    scratch = Scratch(pages.sparkSession, "digests")
    url = F.coalesce(col(url_col).cast("string"), F.lit("")) if url_col else F.lit("")
    rows = pages.select(col(id_col).cast("long").alias("id"), url.alias("url"), F.coalesce(col(payload_col).cast("string"), F.lit("")).alias("payload"))
    rows = rows.withColumn("size", F.octet_length("payload").cast("long")).withColumn("digest", F.sha1(F.col("payload").cast("binary")))
    rows = rows.withColumn("tag", F.lower(F.hex(F.xxhash64("id", "url", "digest"))))
    groups = rows.filter((F.col("size") >= least) & F.col("id").isNotNull()).groupBy(F.col("digest").alias("same"))
    groups = groups.agg(F.max(F.struct("id", "tag")).alias("last"), F.count("*").alias("c")).filter("c > 1").select("same", "last")
    groups = scratch.save(groups, "groups")
    if groups.count() <= SMALL:
        groups = F.broadcast(groups)  # else payloads are shuffled by digest
    revisits = (F.col("id") != F.col("last.id")) & (F.col("size") >= least)
    joined = rows.join(groups, F.col("digest") == F.col("same"), "left")
    refers = (F.when(revisits, F.col(f"last.{c}")).alias(f"refers_{n}") for c, n in (("id", "to"), ("tag", "tag")))
    return joined.select("id", "url", "payload", "size", "digest", "tag", *refers)


def write(pages: DataFrame, path: str, id_col: str = "page_id", payload_col: str = "html", url_col: str | None = "url", least: int = 1000, per_file: int = 4096) -> None:
    """Write one record per row below path."""
    rows = decide(pages, id_col, payload_col, url_col, least)
    is_revisit = F.col("refers_to").isNotNull()
    body = F.when(is_revisit, F.lit("")).otherwise(F.col("payload"))
    name = lambda i, tag: F.concat(F.lit("<urn:page:"), F.coalesce(F.col(i).cast("string"), F.lit("")), F.lit(":"), F.col(tag), F.lit(">"))
    refers = F.concat(F.lit(f"\r\nWARC-Profile: {PROFILE}\r\nWARC-Refers-To: "), name("refers_to", "refers_tag"))
    # A separator in a header would cut it; %57 is the same URI as W.
    uri = F.replace(F.regexp_replace("url", r"[\x00-\x20\x7F]", ""), F.lit(MAGIC), F.lit("%57" + MAGIC[1:]))
    header = F.concat(
        F.lit(MAGIC + "1\r\nWARC-Type: "), F.when(is_revisit, "revisit").otherwise("response"),
        F.lit("\r\nWARC-Record-ID: "), name("id", "tag"), F.lit("\r\nWARC-Target-URI: "), uri,
        F.lit("\r\nWARC-Date: 1970-01-01T00:00:00Z\r\nWARC-Payload-Digest: sha1:"), F.col("digest"),
        F.when(is_revisit, refers).otherwise(F.lit("")),
        F.lit("\r\nWARC-Identified-Payload-Type: text/html\r\nContent-Length: "), F.octet_length(body).cast("string"), F.lit("\r\n\r\n"),
    )
    records = rows.select(F.concat(header, body, F.lit("\r\n")).alias("value"))
    records.write.option("lineSep", "\r\n").option("maxRecordsPerFile", per_file).text(path)


def pieces(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, position, piece): the runs of bytes between separators, in order within a block."""
    lines = spark.read.option("lineSep", MAGIC).text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("value").cast("binary").alias("piece"),
    )

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, where = None, 0
        for batch in batches:
            files, blocks, offsets = batch.column(0).to_pylist(), batch.column(1).to_pylist(), []
            sizes = [len(p.as_buffer()) for p in batch.column(2)]
            for file, block, size in zip(files, blocks, sizes, strict=True):
                if (file, block) != at:
                    at, where = (file, block), 0
                offsets.append(where)
                where += size + len(MAGIC)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(offsets, pa.int64()), batch.column(2)], ["file", "block", "position", "piece"])

    return lines.mapInArrow(place, "file string, block long, position long, piece binary")


def _headers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Candidates: where the record would end, its fields, and the digest of a payload that the piece holds whole."""
    for batch in batches:
        out: list[list] = [[] for _ in range(8)]
        for value in batch.column(3):
            piece = bytes(value.as_buffer())
            end = piece.find(b"\r\n\r\n")
            fields, length = {}, None
            if end >= 0 and piece[:1].isdigit():
                for line in piece[:end].split(b"\r\n")[1:]:
                    if m := _FIELD.match(line):
                        fields.setdefault(m[1].lower(), m[2].decode("utf-8", "replace"))
                text = fields.get(b"content-length", "")
                length = int(text) if text.isascii() and text.isdigit() and len(text) < 16 else None
            body = end + 4
            held = length is not None and body + length <= len(piece)
            row = (
                len(piece), None if length is None else body, length, fields.get(b"warc-type"), fields.get(b"warc-record-id"), fields.get(b"warc-refers-to"),
                fields.get(b"warc-payload-digest"), hashlib.sha1(piece[body : body + length]).hexdigest() if held else None,
            )
            for column, v in zip(out, row, strict=True):
                column.append(v)
        types = (*[pa.int64()] * 3, *[pa.string()] * 5)
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], *(pa.array(v, t) for v, t in zip(out, types, strict=True))], [f.split()[0] for f in HEADS.split(", ")])


def reachable(candidates: DataFrame, scratch: Scratch, rounds: int = 60) -> DataFrame:
    """(file, start) of the candidates (file, start, next) on the chain from offset 0."""
    jump = scratch.save(candidates.filter("next is not null").select("file", "start", F.col("next").alias("to")), "pointers")
    found = scratch.save(candidates.filter("start = 0").select("file", "start").distinct(), "reached")
    known = scratch.save(candidates.select("file", "start").distinct(), "starts")
    for _ in range(rounds):
        if jump.isEmpty():
            break
        here, there = found.withColumnRenamed("start", "at"), jump.withColumnRenamed("start", "at")
        more = there.join(here.hint("merge"), ["file", "at"], "left_semi").select("file", F.col("to").alias("start")).join(known.hint("merge"), ["file", "start"], "left_semi")
        grown = scratch.save(found.unionByName(more).distinct(), "reached")
        second = jump.select("file", F.col("start").alias("mid"), F.col("to").alias("end"))
        first = jump.select("file", "start", F.col("to").alias("mid"))
        farther = scratch.save(first.join(second.hint("merge"), ["file", "mid"]).select("file", "start", F.col("end").alias("to")), "pointers")
        scratch.drop(found, jump)
        found, jump = grown, farther
    scratch.drop(jump, known)
    return found


class Archive:
    """The verified chains of the archives below a path.

    records: (file, start, body, length, type, record_id, refers, digest, sha);
    sha is null where a separator inside the payload cut it into pieces.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.scratch, self.raw = Scratch(spark, "warc"), pieces(spark, path)
        heads = self.scratch.save(self.raw.mapInArrow(_headers, HEADS), "heads")
        order = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
        base = heads.groupBy("file", "block").agg(F.sum(F.col("size") + len(MAGIC)).alias("bytes"))
        self.base = self.scratch.save(base.select("file", "block", F.coalesce(F.sum("bytes").over(order), F.lit(0)).alias("base")), "blocks")
        # The first piece of a file stands before its first separator and is empty in an archive.
        self.start = (F.col("base") + F.col("position") - len(MAGIC)).alias("start")
        self.placed = self.scratch.save(heads.join(self.base, ["file", "block"]).select("*", self.start).filter("start >= 0"), "placed")
        # A record ends where the next one starts, or with its file; the last piece has no separator behind it.
        whole = heads.groupBy("file").agg((F.sum(F.col("size") + len(MAGIC)) - len(MAGIC)).alias("end"))
        next_ = F.col("start") + len(MAGIC) + F.col("body") + F.col("length") + 4
        candidates = self.placed.filter("length is not null").select("file", "start", next_.alias("next"))
        ends = candidates.select("file", F.col("start").alias("next")).unionByName(whole.select("file", F.col("end").alias("next"))).distinct()
        candidates = self.scratch.save(candidates.join(ends.hint("merge"), ["file", "next"], "left_semi"), "candidates")
        found = reachable(candidates, self.scratch)
        kept = self.placed.filter("length is not null").join(found.hint("merge"), ["file", "start"], "left_semi")
        self.records = self.scratch.save(kept.select("file", "start", "body", "length", "type", "record_id", "refers", "digest", "sha", "size"), "records")
        self.scratch.drop(heads, candidates, found)

    def payloads(self, some: DataFrame) -> DataFrame:
        """(file, start, payload) of the records (file, start) in some, put together from all their pieces."""
        marks = self.placed.select("file", "start").join(self.records.select("file", "start", F.lit(True).alias("real")), ["file", "start"], "left")
        back = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, 0)
        # A piece lies in the last record that starts at or before it.
        owner = marks.select("file", F.col("start").alias("at"), F.last(F.when(F.col("real"), F.col("start")), True).over(back).alias("start"))
        owner = self.scratch.save(owner.filter("start is not null").join(some.select("file", "start"), ["file", "start"], "left_semi"), "owners")
        located = self.raw.join(self.base, ["file", "block"]).select("file", self.start.alias("at"), "piece").join(owner, ["file", "at"])
        parts = owner.groupBy("file", "start").agg(F.count("*").alias("parts"))
        located = located.join(parts, ["file", "start"])
        whole = located.filter("parts = 1").select("file", "start", "piece")
        several = located.filter("parts > 1").groupBy("file", "start").agg(F.array_sort(F.collect_list(F.struct("at", "piece"))).alias("list"))
        joined = F.array_join(F.transform("list", lambda x: x["piece"].cast("string")), MAGIC).cast("binary")
        pieces_of = whole.unionByName(several.select("file", "start", joined.alias("piece")))
        content = F.substring(F.col("piece"), (F.col("body") + 1).cast("int"), F.col("length").cast("int"))
        return self.records.select("file", "start", "body", "length").join(pieces_of, ["file", "start"]).select("file", "start", content.alias("payload"))


def read(spark: SparkSession, path: str) -> DataFrame:
    """(file, start, type, record_id, refers, digest, payload) of every record on a chain."""
    archive = Archive(spark, path)
    return archive.records.select("file", "start", "type", "record_id", "refers", "digest").join(archive.payloads(archive.records), ["file", "start"])


def describe(spark: SparkSession, path: str) -> DataFrame:
    """(type, record_id, refers, digest, bytes, sha) of every record on a chain.

    Payloads are digested where they are read; only those cut by a separator are shuffled.
    """
    return _describe(Archive(spark, path))


def _describe(archive: Archive) -> DataFrame:
    cols = ("type", "record_id", "refers", "digest")
    done = archive.records.filter("sha is not null").select(*cols, F.col("length").alias("bytes"), "sha")
    cut = archive.records.filter("sha is null")
    if cut.isEmpty():
        return done
    put = cut.join(archive.payloads(cut), ["file", "start"])
    return done.unionByName(put.select(*cols, F.octet_length("payload").cast("long").alias("bytes"), F.sha1("payload").alias("sha")))


def round_trip(pages: DataFrame, id_col: str = "page_id", payload_col: str = "html", url_col: str | None = "url", least: int = 1000) -> DataFrame:
    """Write pages, read them back, and describe every record.

    (id, payload_bytes, payload_digest, record_type, refers_to, intact); intact
    says whether a response's payload has the digest in its header.
    """
    spark = pages.sparkSession
    scratch = Scratch(spark, "archive")
    path = scratch.path("records")
    write(pages, path, id_col, payload_col, url_col, least)
    archive = Archive(spark, path)
    number = lambda c: F.regexp_extract(c, r"<urn:page:(-?\d+):", 1)
    as_id = lambda c: F.when(number(c) != "", number(c).cast("long"))
    got = _describe(archive).select(
        as_id("record_id").alias("id"), F.col("type").alias("record_type"), as_id("refers").alias("refers_to"), "bytes", "sha", F.expr("substring(digest, 6)").alias("stated")
    )
    got = scratch.save(got, "described")
    delete(spark, archive.scratch.root)
    delete(spark, path)
    written, back = pages.count(), got.count()
    if written != back:
        raise ValueError(f"{written} pages written, {back} records read back")
    sizes = got.filter("record_type = 'response' and id is not null").groupBy(F.col("id").alias("of"), F.col("sha").alias("sum")).agg(F.max("bytes").alias("full"))
    is_revisit = F.col("record_type") == "revisit"
    joined = got.join(sizes, (F.col("refers_to") == F.col("of")) & (F.col("stated") == F.col("sum")), "left")
    return joined.select(
        F.col("id").alias(id_col), F.when(is_revisit, F.col("full")).otherwise(F.col("bytes")).alias("payload_bytes"),
        F.when(is_revisit, F.col("sum")).otherwise(F.col("sha")).alias("payload_digest"), "record_type", "refers_to",
        F.when(is_revisit, F.col("full").isNotNull()).otherwise(F.col("sha") == F.col("stated")).alias("intact"),
    )


ORACLE = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, strlen(html)::BIGINT AS payload_bytes, sha1(html) AS payload_digest FROM p),
g AS (SELECT payload_digest, max(page_id) AS last FROM d WHERE payload_bytes >= 1000 GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id <> last THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id <> last THEN last END AS refers_to, TRUE AS intact
FROM d LEFT JOIN g USING (payload_digest)
"""

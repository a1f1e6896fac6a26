"""WARC archives: written and read by Spark's own readers, records verified by their boundary chain.

Writing.  Payloads get SHA-256 digests.  Of records with equal payloads of at least SMALLEST bytes that with the least id is a
`response`, the others are `revisit` records without a payload that refer to it; smaller ones are all responses.  A record is one
string whose end mark (two line ends) is the writer's line separator, so files are plain WARC in the shared folder, and the
commit protocol covers lost tasks.

Reading.  The text reader splits files at the version line, in parallel and at any size.  A part's place in its split and the
splits' sizes give its byte offset, so every task emits candidate records (offset, successor) where its headers parse.  Pointer
jumping from each file's start (jumps double each round) keeps only reachable candidates: a version line in a payload is
rejected, and the payload's parts are joined.

Edge cases: null html is empty; rows that repeat an id and a payload are all responses if the id is the least; a null id is kept
and never referred to unless it is the only one; urls are stripped of line ends; any text in a payload, whole WARC records too, is data.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .base import cut, lookup, scratch, sieve, text_or_empty, tune

MAGIC = "WARC/1.1\r\n"
SMALLEST = 100
STAMP = "2024-01-01T00:00:00Z"


def write_archive(pages: DataFrame, folder: str, key: str = "page_id", url: str = "url", html: str = "html") -> None:
    """A record per row under `folder`."""
    rows = pages.select(F.col(key).cast("long").alias("id"), F.regexp_replace(text_or_empty(url), r"[\r\n]+", " ").alias("url"), text_or_empty(html).alias("body"))
    rows = rows.withColumn("size", F.octet_length("body").cast("long")).withColumn("digest", F.sha2(F.col("body").cast("binary"), 256))
    firsts = rows.where(F.col("size") >= SMALLEST).groupBy(F.col("digest").alias("of")).agg(F.min("id").alias("first"), F.count("*").alias("n")).where("n > 1")
    firsts = cut(firsts)
    keep = sieve(firsts.select(F.col("of").alias("id")))  # payloads that surely occur once are not shuffled
    alone = keep(rows, "digest", among=False).select("*", F.lit(None).cast("long").alias("first"))
    known = alone.unionByName(lookup(keep(rows, "digest"), firsts.withColumnRenamed("of", "digest"), "digest", how="left"))  # bodies of a hot payload spread evenly
    again = F.coalesce((F.col("first") != F.col("id")) | (F.col("first").isNotNull() & F.col("id").isNull()), F.lit(False))
    field = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    head = F.concat(
        F.lit(MAGIC),
        field("WARC-Type", F.when(again, "revisit").otherwise("response")),
        field("WARC-Record-ID", F.concat(F.lit("<urn:page:"), F.coalesce(F.col("id").cast("string"), F.lit("none")), F.lit(">"))),
        field("WARC-Date", F.lit(STAMP)),
        field("WARC-Target-URI", F.col("url")),
        field("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        field("X-Payload-Length", F.col("size").cast("string")),
        F.when(again, F.concat(field("WARC-Refers-To", F.concat(F.lit("<urn:page:"), F.col("first").cast("string"), F.lit(">"))), field("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")))).otherwise(""),
        field("Content-Type", F.lit("text/html; charset=utf-8")),
        field("Content-Length", F.when(again, "0").otherwise(F.col("size").cast("string"))),
        F.lit("\r\n"),
    )
    known.select(F.concat(head, F.when(again, "").otherwise(F.col("body"))).alias("value")).write.option("lineSep", "\r\n\r\n").mode("overwrite").text(folder)


CANDIDATE = [("file", pa.string()), ("block", pa.int64()), ("at", pa.int64()), ("bytes", pa.int64()), ("head", pa.int64()), ("content", pa.int64()), ("headers", pa.map_(pa.string(), pa.string())), ("digest", pa.string()), ("raw", pa.binary())]
CANDIDATE_SCHEMA = "file string, block long, at long, bytes long, head long, content long, headers map<string,string>, digest string, raw binary"


def parse_head(part: bytes) -> tuple[int, dict[str, str]] | None:
    """(length of the headers with their blank line, headers) of what follows a version line."""
    end = part.find(b"\r\n\r\n")
    if end < 0:
        return None
    found = {}
    for line in part[:end].split(b"\r\n"):
        name, colon, value = line.partition(b":")
        if not colon:
            return None
        found[name.decode("utf-8", "replace").strip().lower()] = value.decode("utf-8", "replace").strip()
    return (end + 4, found) if found.get("content-length", "").isdigit() else None


def _candidates(keep: bool):
    """Rows come in file order within a block (file, start of the split); `at` is relative to the block's first part.  `keep`: the bytes of all parts."""

    def run(batches):
        mark, before, at = len(MAGIC), None, 0
        for batch in batches:
            rows = []
            for file, block, part in zip(batch.column("file").to_pylist(), batch.column("block").to_pylist(), batch.column("part").to_pylist(), strict=True):
                if (file, block) != before:
                    before, at = (file, block), 0
                head, content, headers, digest, raw = None, None, None, None, part
                if parsed := parse_head(part):
                    head, headers = parsed
                    content = int(headers["content-length"])
                    if head + content + 4 == len(part) and not keep:  # whole in one part, the usual case: the payload needs no other row
                        digest, raw = hashlib.sha256(part[head : head + content]).hexdigest(), None
                rows.append((file, block, at, len(part) + mark, head, content, list(headers.items()) if headers else None, digest, raw))
                at += len(part) + mark
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, (_, k) in zip(list(zip(*rows, strict=True)) or [[]] * len(CANDIDATE), CANDIDATE, strict=True)], names=[n for n, _ in CANDIDATE])

    return run


def reachable(candidates: DataFrame, rounds: int = 64) -> DataFrame:
    """Offsets (file, at) that the chain from each file's start reaches; `candidates` has file, at, next."""
    known = candidates.select("file", "at", "next")
    jump = cut(known.join(known.select("file", F.col("at").alias("next")), ["file", "next"], "left_semi"))  # jumps that land on a candidate
    reach = known.where("at = 0").select("file", "at")
    size = None
    for _ in range(rounds):
        landed = reach.join(jump, ["file", "at"]).select("file", F.col("next").alias("at"))
        reach = cut(reach.unionByName(landed).distinct())
        now = reach.count()
        if now == size:
            return reach
        size = now
        jump = cut(jump.alias("a").join(jump.alias("b"), (F.col("a.file") == F.col("b.file")) & (F.col("a.next") == F.col("b.at"))).select("a.file", "a.at", "b.next"))
    raise RuntimeError("the chain did not end")


def read_archive(spark, folder: str) -> DataFrame:
    """One row per record that the boundary chain reaches: file, at, headers, digest, content."""
    tune(spark)
    parts = spark.read.option("lineSep", MAGIC).text(folder).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("value").cast("binary").alias("part"))
    found = cut(parts.mapInArrow(_candidates(False), CANDIDATE_SCHEMA))
    blocks = found.groupBy("file", "block").agg(F.sum("bytes").alias("size"))
    base = blocks.select("file", "block", F.coalesce(F.sum("size").over(Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    # part k begins after k version lines, so a record begins a version line before its part; a file's first part is what stands before its first record
    placed = found.join(base, ["file", "block"]).withColumn("at", F.col("base") + F.col("at") - len(MAGIC))
    candidates = placed.where("head is not null and at >= 0").withColumn("next", F.col("at") + len(MAGIC) + F.col("head") + F.col("content") + 4)
    true = reachable(candidates)
    records = candidates.join(true, ["file", "at"])
    whole = records.where("digest is not null").select("file", "at", "headers", "content", "digest")
    broken = records.where("digest is null").select("file", "at", "next", "headers", "content", "head")
    held = placed.where("raw is not null and at >= 0").select("file", "block", "at", "raw")
    false = candidates.where("digest is not null").join(true, ["file", "at"], "left_anti")
    if false.limit(1).count():  # a whole record in a payload: the bytes of its part are read again
        again = parts.mapInArrow(_candidates(True), CANDIDATE_SCHEMA).join(base, ["file", "block"]).withColumn("at", F.col("base") + F.col("at") - len(MAGIC))
        held = cut(held.unionByName(again.select("file", "block", "at", "raw").join(false.select("file", "at"), ["file", "at"], "left_semi")))
    # a version line in a payload has split it: its parts are found again by the record they lie in, the last that starts before them.  That is looked
    # for within a split of the file, and beyond it in the splits' last starts, so no file is one task
    starts = held.select("file", "block", "at").join(broken.select("file", "at", F.col("at").alias("start")), ["file", "at"], "left")
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = starts.groupBy("file", "block").agg(F.max("start").alias("last")).select("file", "block", F.max("last").over(before).alias("carried"))
    owner = starts.select("file", "block", "at", F.max("start").over(Window.partitionBy("file", "block").orderBy("at")).alias("near"))
    owner = owner.join(carried, ["file", "block"]).select("file", "at", F.coalesce("near", "carried").alias("owner")).where("owner is not null")
    pieces = held.select("file", "at", "raw").join(owner, ["file", "at"]).groupBy("file", "owner").agg(F.sort_array(F.collect_list(F.struct("at", "raw"))).alias("raw"))
    text = F.concat_ws(MAGIC, F.transform("raw", lambda x: x["raw"].cast("string"))).cast("binary")  # bytes as they are, joined in one pass
    joined = broken.join(pieces.select("file", F.col("owner").alias("at"), text.alias("raw")), ["file", "at"])
    mended = joined.select("file", "at", "headers", "content", F.sha2(F.expr("substring(raw, cast(head + 1 as int), cast(content as int))"), 256).alias("digest"))
    return whole.unionByName(mended)


def archive_pages(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of each page, from the archive as read back."""
    spark = pages.sparkSession
    folder = folder or scratch(spark, "warc")
    write_archive(pages, folder)
    r = read_archive(spark, folder)
    h = F.col("headers")
    number = lambda c: F.regexp_extract(c, r"<urn:page:(-?\d+)>", 1)
    kind = h["warc-type"]
    return r.select(
        F.when(number(h["warc-record-id"]) != "", number(h["warc-record-id"])).cast("long").alias("page_id"),
        F.when(kind == "revisit", h["x-payload-length"].cast("long")).otherwise(F.col("content")).alias("payload_bytes"),
        F.when(kind == "revisit", F.regexp_replace(h["warc-payload-digest"], "^sha256:", "")).otherwise(F.col("digest")).alias("payload_digest"),
        kind.alias("record_type"),
        F.when(kind == "revisit", number(h["warc-refers-to"])).cast("long").alias("refers_to"),
    )

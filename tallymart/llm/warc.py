"""WARC archives: written with revisit records for equal payloads, read back by verified chains.

Records are written through Spark's text sink: the line separator is the blank line that
closes a record.  Reading splits large archives at the version line, wherever its bytes
occur, so a payload that holds them yields false candidates.  Each task therefore emits,
for every candidate, where a record that begins there would end ("successor"); only the
candidates that the chain of successors from the start of the file reaches are records.
Chains are followed in two steps: inside a split by the task that reads it, from split to
split by pointer jumping over the few candidates at which a split can be entered.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallymart.llm.tables import Bits, Scratch, batch_of

MAGIC = "WARC/1.0\r\n"
CLOSE = "\r\n\r\n"
#: Payloads under so many bytes are always written whole.
LEAST_SHARED = 1000
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
RECORD_ID = "urn:x-page:"
#: Width of the stretches of a file in which segments look for the record that holds them.
STRETCH = 1 << 20


def records_to_write(pages: DataFrame, scratch: Scratch) -> DataFrame:
    """page_id, url, payload, n_bytes, digest, refers_to (null for responses) for every row of ``pages``.

    Only pages whose digest occurs twice have to meet the others of their digest; the rest
    are told apart by a filter of bounded size and stay where they are.
    """
    spark = pages.sparkSession
    payload = F.coalesce("html", F.lit(""))
    held = pages.select("page_id", "url", payload.alias("payload"), F.octet_length(payload).cast("long").alias("n_bytes"), F.sha1(F.encode(payload, "UTF-8")).alias("digest"))
    shared = held.filter(F.col("n_bytes") >= LEAST_SHARED).groupBy("digest").agg(F.count("*").alias("n"), F.max("page_id").alias("winner"))
    shared = scratch.put("shared", shared.filter("n > 1").select(F.col("digest").alias("of"), "winner"))
    bits = Bits(spark, shared, "of", shared.count())
    words = bits.words
    marked = held.withColumn("at", bits.place("digest"))
    names = held.columns

    def look(keep: bool):
        def work(batches):
            for batch in batches:
                hit = Bits.hit(words.value, batch.column("at"))
                yield batch.filter(hit if keep else pc.invert(hit)).select(names)

        return work

    alone = marked.mapInArrow(look(False), held.schema).withColumn("refers_to", F.lit(None).cast("long"))
    meeting = marked.mapInArrow(look(True), held.schema)
    other = (F.col("n_bytes") >= LEAST_SHARED) & ~F.col("page_id").eqNullSafe(F.col("winner"))
    met = meeting.join(shared, meeting["digest"] == shared["of"], "left").select(*names, F.when(other, F.col("winner")).alias("refers_to"))
    return alone.unionByName(met)


def write_archives(pages: DataFrame, path: str, scratch: Scratch) -> None:
    """One record for every row of ``pages`` (page_id, url, html), in as many archives as there are tasks.

    Of rows with equal payloads of at least LEAST_SHARED bytes that with the largest id is a
    response (all rows that share this id are), the others revisit it.  A null html is an
    empty payload; control characters and blanks in a url are written as %20, a null url as
    nothing; a null id is written as an empty one, and never refers or is referred to
    unless no row of its payload has an id.
    """
    revisit = F.col("refers_to").isNotNull()
    name = lambda c: F.concat(F.lit(f"<{RECORD_ID}"), F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit(">"))
    line = lambda key, value: F.concat(F.lit(f"{key}: "), value, F.lit("\r\n"))
    header = F.concat(
        F.lit(MAGIC), line("WARC-Type", F.when(revisit, "revisit").otherwise("response")), line("WARC-Record-ID", name("page_id")),
        line("WARC-Date", F.lit(DATE)), line("WARC-Target-URI", F.coalesce(F.regexp_replace("url", r"[\x00-\x20\x7F]", "%20"), F.lit(""))),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "digest")),
        F.when(revisit, F.concat(line("WARC-Refers-To", name("refers_to")), line("WARC-Profile", F.lit(PROFILE)))).otherwise(""),
        line("Content-Type", F.lit("text/html; charset=utf-8")), line("Content-Length", F.when(revisit, 0).otherwise(F.col("n_bytes")).cast("string")), F.lit("\r\n"),
    )
    rows = records_to_write(pages, scratch)
    rows.select(F.concat(header, F.when(revisit, "").otherwise(F.col("payload"))).alias("value")).write.option("lineSep", CLOSE).text(path)


def segments(spark: SparkSession, path: str) -> DataFrame:
    """file, split, value: what lies between version lines, in the order of the file inside each split."""
    read = spark.read.option("lineSep", MAGIC).text(path)
    return read.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"), F.col("value").cast("binary").alias("value"))


def placed(batches) -> Iterator[tuple[str, int, int, bytes]]:
    """file, split, start inside the split's own segments, bytes; a split is read by one task from front to end."""
    now, at = None, 0
    for batch in batches:
        for file, split, value in zip(*(batch.column(c).to_pylist() for c in ("file", "split", "value"))):
            if (file, split) != now:
                now, at = (file, split), 0
            yield file, split, at, value
            at += len(value) + len(MAGIC)


def parsed(value: bytes) -> tuple[int, dict[str, str]] | None:
    """Where the payload begins in a segment, and the header; None if no record can begin here."""
    end = value.find(b"\r\n\r\n")
    if end < 0:
        return None
    header = {}
    for row in value[:end].split(b"\r\n"):
        key, colon, text = row.partition(b": ")
        if not colon:
            return None
        header[key.decode("utf-8", "replace").lower()] = text.decode("utf-8", "replace")
    return (end + 4, header) if re.fullmatch("[0-9]{1,18}", header.get("content-length", "")) and "warc-type" in header else None


def page_of(text: str | None) -> int | None:
    found = re.fullmatch(f"<{RECORD_ID}(-?[0-9]+)>", text or "")
    return int(found[1]) if found else None


FIELDS = [
    ("file", pa.string()), ("split", pa.int64()), ("start", pa.int64()), ("size", pa.int64()), ("span", pa.int64()), ("leaves", pa.int64()),
    ("type", pa.string()), ("page_id", pa.int64()), ("refers_to", pa.int64()), ("declared", pa.string()), ("body", pa.int64()), ("n_bytes", pa.int64()), ("digest", pa.string()),
]
SCHEMA = "file string, split long, start long, size long, span long, leaves long, type string, page_id long, refers_to long, declared string, body long, n_bytes long, digest string"


def candidates(spark: SparkSession, path: str) -> DataFrame:
    """One row per segment, places relative to its split: span from the segment's start to where the next
    segment would begin if it were a record, and where the chain through it leaves the split.

    The payload's digest is taken here if the payload lies in the segment, which it does unless it holds the version line.
    """
    schema = pa.schema(FIELDS)

    def ended(rows: list[list]) -> pa.RecordBatch:
        leave = {}
        last = rows[-1][2]
        for row in reversed(rows):
            after = None if row[4] is None else row[2] + row[4]
            # Beyond the split's last segment the chain goes on elsewhere; inside it must meet a candidate.
            row[5] = leave.get(after) if after is not None and after <= last else after
            leave[row[2]] = row[5]
        return batch_of(schema, *(list(c) for c in zip(*rows)))

    def work(batches):
        rows: list[list] = []
        for file, split, start, value in placed(batches):
            if rows and (file, split) != (rows[0][0], rows[0][1]):
                yield ended(rows)
                rows = []
            row = [file, split, start, len(value), *[None] * 9]
            found = parsed(value)
            if found:
                begin, header = found
                n = int(header["content-length"])
                row[4] = begin + n + len(CLOSE) + len(MAGIC)
                row[6:12] = [header["warc-type"], page_of(header.get("warc-record-id")), page_of(header.get("warc-refers-to")), header.get("warc-payload-digest", "").removeprefix("sha1:"), begin, n]
                if begin + n <= len(value):
                    row[12] = hashlib.sha1(value[begin : begin + n]).hexdigest()
            rows.append(row)
        if rows:
            yield ended(rows)

    return segments(spark, path).mapInArrow(work, SCHEMA)


def read_archives(spark: SparkSession, path: str, scratch: Scratch) -> DataFrame:
    """One row per record: file, start, type, page_id, refers_to, declared digest, n_bytes and digest of the payload as read.

    A file that does not begin with a record, or whose chain ends in something that is no
    record, keeps the records up to there.
    """
    found = scratch.put("candidates", candidates(spark, path))
    per_split = found.groupBy("file", "split").agg(F.sum(F.col("size") + len(MAGIC)).alias("length"))
    before = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    bases = scratch.put("bases", per_split.select("file", "split", F.coalesce(F.sum("length").over(before), F.lit(0)).alias("base")))
    whole = found.join(bases, ["file", "split"])
    whole = scratch.put("whole", whole.withColumns({"start": F.col("start") + F.col("base"), "leaves": F.col("leaves") + F.col("base")}))

    # The segment before the first version line is empty in an archive; the first record begins after that line.
    heads = whole.filter(F.col("start") == len(MAGIC)).select("file", "start")
    exits = whole.filter("leaves is not null").select("file", F.col("leaves").alias("start")).distinct()
    entries = whole.join(exits.unionByName(heads).distinct(), ["file", "start"]).select("file", "start", "leaves")
    jumps = scratch.put("jumps-0", entries)
    reached = scratch.put("reached-0", heads)
    known, step = reached.count(), 0
    while True:
        over = reached.join(jumps, ["file", "start"]).filter("leaves is not null").select("file", F.col("leaves").alias("start"))
        step += 1
        reached = scratch.put(f"reached-{step}", reached.unionByName(over).distinct())
        count = reached.count()
        if count == known:
            break
        known = count
        onward = jumps.select("file", F.col("start").alias("leaves"), F.col("leaves").alias("beyond"))
        jumps = scratch.put(f"jumps-{step}", jumps.join(onward, ["file", "leaves"]).select("file", "start", F.col("beyond").alias("leaves")))
    records = scratch.put("records", followed(whole, reached))
    return stitched(spark, path, whole, records, scratch)


def followed(whole: DataFrame, reached: DataFrame) -> DataFrame:
    """The records of each split: from where the chain enters it, every segment that begins where the last record ended."""
    entry = whole.join(reached, ["file", "start"]).groupBy("file", "split").agg(F.min("start").alias("entry"))
    rows = whole.join(entry, ["file", "split"]).filter("start >= entry and span is not null").repartition("file", "split").sortWithinPartitions("file", "split", "start")
    names = rows.columns

    def work(batches):
        now, due = None, 0
        for batch in batches:
            keep = []
            for file, split, start, span, entry in zip(*(batch.column(c).to_pylist() for c in ("file", "split", "start", "span", "entry"))):
                if (file, split) != now:
                    now, due = (file, split), entry
                keep.append(start == due)
                if start == due:
                    due = start + span
            yield batch.filter(pa.array(keep, pa.bool_())).select(names)

    return rows.mapInArrow(work, rows.schema).drop("entry")


def stitched(spark: SparkSession, path: str, whole: DataFrame, records: DataFrame, scratch: Scratch) -> DataFrame:
    """The records, with the digest also of payloads that hold the version line and so lie in several segments."""
    out = ["file", "start", "type", "page_id", "refers_to", "declared", "n_bytes", "digest"]
    torn = records.filter("digest is null").select("file", F.col("start").alias("head"), "body", "n_bytes", (F.col("start") + F.col("body") + F.col("n_bytes")).alias("until"))
    if torn.isEmpty():
        return records.select(out)
    stretch = lambda c: F.floor(F.col(c) / STRETCH)
    spread = torn.withColumn("stretch", F.explode(F.sequence(stretch("head"), stretch("until"))))
    owned = whole.withColumn("stretch", stretch("start")).join(spread.select("file", "stretch", "head", "until"), ["file", "stretch"]).filter("start >= head and start < until")
    within = F.col("start") - F.col("base")
    needed = scratch.put("needed", owned.select("file", "split", within.alias("within"), "start", "head", F.crc32(F.encode(F.concat_ws(":", "file", "split", within), "UTF-8")).alias("id")))
    bits = Bits(spark, needed, "id", needed.count(), hashed=True)
    words, last = bits.words, bits.bits - 1
    schema = pa.schema([("of_file", pa.string()), ("of_split", pa.int64()), ("of_within", pa.int64()), ("value", pa.binary())])

    def again(batches):
        held = words.value
        for row in placed(batches):
            at = zlib.crc32(f"{row[0]}:{row[1]}:{row[2]}".encode()) & last
            if held[at >> 6] >> (at & 63) & 1:
                yield batch_of(schema, *([x] for x in row))

    read = segments(spark, path).mapInArrow(again, "of_file string, of_split long, of_within long, value binary")
    met = needed.join(read, (F.col("file") == F.col("of_file")) & (F.col("split") == F.col("of_split")) & (F.col("within") == F.col("of_within")))
    pieces = met.groupBy("file", "head").agg(F.sort_array(F.collect_list(F.struct("start", F.hex("value").alias("value")))).alias("pieces"))
    # A version line closes every piece: the payload may end in one, or end where one begins.
    text = F.array_join(F.transform("pieces", lambda p: F.concat(p["value"], F.lit(MAGIC.encode().hex().upper()))), "")
    pieces = pieces.join(torn, ["file", "head"]).select("file", F.col("head").alias("start"), F.sha1(F.unhex(F.substr(text, 2 * F.col("body") + 1, 2 * F.col("n_bytes")))).alias("mended"))
    return records.join(scratch.put("mended", pieces), ["file", "start"], "left").withColumn("digest", F.coalesce("digest", "mended")).select(out)


def archived(pages: DataFrame) -> DataFrame:
    """Write ``pages``, read the archives back: page_id, payload_bytes, payload_digest, record_type, refers_to, sound.

    A revisit has the bytes and digest of the payload it refers to, as read.  ``sound`` says
    that the digest that the record declares is the one of the bytes.  Repeated rows give
    repeated records; further columns are ignored; no rows give none.
    """
    spark = pages.sparkSession
    scratch = Scratch(spark, "warc")
    write_archives(pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html"), scratch.path("archives"), scratch)
    records = scratch.put("read", read_archives(spark, scratch.path("archives"), scratch))
    first = records.filter("type = 'response'").groupBy("page_id").agg(F.min(F.struct("n_bytes", "digest")).alias("first"))
    first = scratch.put("first", first.select(F.col("page_id").alias("first_id"), "first.*").withColumnsRenamed({"n_bytes": "first_bytes", "digest": "first_digest"}))
    whole = records.filter("type = 'response'").select("page_id", F.col("n_bytes").alias("payload_bytes"), F.col("digest").alias("payload_digest"), "declared", "type", "refers_to")
    again = records.filter("type = 'revisit'").join(first, F.col("refers_to") == F.col("first_id"), "left").select(
        "page_id", F.col("first_bytes").alias("payload_bytes"), F.col("first_digest").alias("payload_digest"), "declared", "type", "refers_to")
    return whole.unionByName(again).select("page_id", "payload_bytes", "payload_digest", F.col("type").alias("record_type"), "refers_to", (F.col("declared") == F.col("payload_digest")).alias("sound"))


SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, octet_length(encode(h))::BIGINT AS payload_bytes, sha1(h) AS payload_digest FROM p),
m AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS winner FROM d)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN payload_bytes >= 1000 AND page_id <> winner THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 1000 AND page_id <> winner THEN winner END AS refers_to, true AS sound
FROM m
"""

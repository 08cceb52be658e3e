"""Mixture-controlled packing: deficit round-robin over source queues, worked out without a loop.

Each source's documents form a queue of items (a document, cut every ``window`` ids).  In
every round a source is credited its quantum, the window times its share of the mixture,
and sends items while its credit covers them; what is left over (the deficit) is carried
into the next round.  An item that ends at token C of its queue is therefore sent in round
ceil(C / quantum): a round number is a prefix sum and a division, so no state has to travel
from window to window or from partition to partition.  Items in the order (round, source,
place in queue) are laid end to end and cut at every ``window`` ids; only the very last
window has padding.  A source that runs dry drops out and the others go on.

Prefix sums have two levels: sums of blocks of about ``BLOCK_ITEMS`` items, then a running
sum inside each block, so a source that holds most rows is spread over many blocks.
"""

from __future__ import annotations

import base64
import re
from array import array

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallymart.llm.tables import Scratch, batch_of, blocks, strings_of

BLOCK_ITEMS = 2000
#: Blocks at most; beyond, blocks grow instead of their list.
MOST_BLOCKS = 100_000
#: Chunks of text whose ids a task remembers.
KEPT_CHUNKS = 200_000
RARE_BLANK = re.compile(r"[^\S \n]")


class Ids:
    """Token ids of whole texts as little-endian unsigned 16-bit numbers.

    ``name`` stands for a pair of vocabulary files: ``<name>.json`` for the tokenizers
    library defines the ids, ``<name>.tiktoken`` is the same vocabulary as ranks, which is
    faster.  The split pattern never joins a blank to what stands before it unless two
    blanks meet, so a text without such a pair is the concatenation of its chunks, each
    beginning with its space, and repeated chunks are looked up.  Texts that hold a special
    token's string go through the defining library.
    """

    def __init__(self, name: str):
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        self.exact = Tokenizer.from_file(public_tokenizers.path(f"{name}.json"))
        self.special = [t.content for t in self.exact.get_added_tokens_decoder().values()]
        if self.exact.get_vocab_size() > 1 << 16:
            raise ValueError("ids are stored in 16 bits")
        with open(public_tokenizers.path(f"{name}.tiktoken"), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.plain = tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.chunks = Chunks(self.plain)

    def of(self, text: str) -> bytes:
        if any(s in text for s in self.special):
            return array("H", self.exact.encode(text, add_special_tokens=False).ids).tobytes()
        if "  " in text or "\n " in text or " \n" in text or RARE_BLANK.search(text):
            return array("H", self.plain(text)).tobytes()
        first, *rest = text.split(" ")
        if len(self.chunks) > KEPT_CHUNKS:
            self.chunks.clear()
        return array("H", self.plain(first)).tobytes() + b"".join(map(self.chunks.__getitem__, rest))


class Chunks(dict):
    def __init__(self, encode):
        self.encode = encode

    def __missing__(self, chunk: str) -> bytes:
        found = self[chunk] = array("H", self.encode(" " + chunk)).tobytes()
        return found


def tokenized(docs: DataFrame, vocabulary: str, end_id: int) -> DataFrame:
    """doc_id, source, n (ids with the closing one), ids (compressed)."""
    schema = pa.schema([("doc_id", pa.int64()), ("source", pa.string()), ("n", pa.int64()), ("ids", pa.binary())])

    def work(batches):
        ids, end = None, array("H", [end_id]).tobytes()
        press = zstandard.ZstdCompressor(level=3)
        for block in blocks(batches, "text"):
            ids = ids or Ids(vocabulary)
            found = [ids.of(t) + end for t in strings_of(block.column("text"))]
            yield batch_of(schema, block.column("doc_id"), block.column("source"), [len(x) // 2 for x in found], [press.compress(x) for x in found])

    return docs.select("doc_id", "source", "text").mapInArrow(work, "doc_id long, source string, n long, ids binary")


def laid_out(items: DataFrame, scratch: Scratch, window: int, weights: dict[str, float] | None) -> DataFrame:
    """For items (row, start, length, source) the place ``at`` of each on the packed line."""
    items = scratch.put("items", items)
    sums = scratch.put("sums", items.groupBy("source").agg(F.count("*").alias("items"), F.sum("length").alias("tokens")))
    if weights is None:  # shares as they are: all queues end together
        sums = sums.withColumn("weight", F.col("tokens").cast("double"))
    else:
        given = items.sparkSession.createDataFrame(list(weights.items()), "source string, weight double")
        sums = sums.join(given, "source", "left")
        if not sums.filter("weight is null or not weight > 0").isEmpty():
            raise ValueError("every source of the documents needs a weight above zero")
    count, total = sums.agg(F.coalesce(F.sum("items"), F.lit(0)), F.coalesce(F.sum("weight"), F.lit(1.0))).first()
    quanta = scratch.put("quanta", sums.select("source", "tokens", (F.lit(window) * F.col("weight") / F.lit(total)).alias("quantum")))
    parts = max(1, min(count // BLOCK_ITEMS, MOST_BLOCKS))

    block = F.pmod(F.xxhash64("row"), F.lit(parts))
    inside = Window.partitionBy("source", "block").orderBy("row", "start").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy("source").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    queued = items.withColumn("block", block)
    bases = queued.groupBy("source", "block").agg(F.sum("length").alias("size"))
    bases = scratch.put("queue-blocks", bases.select("source", "block", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("base")))
    ends = scratch.put("queue-ends", queued.withColumn("end", F.sum("length").over(inside)))
    ends = ends.join(bases, ["source", "block"]).join(quanta.drop("tokens"), "source").withColumn("end", F.col("end") + F.col("base"))
    ends = ends.withColumn("round", F.greatest(F.ceil(F.col("end") / F.col("quantum")), F.lit(1)))

    rounds = quanta.agg(F.max(F.col("tokens") / F.col("quantum"))).first()[0] or 1
    per_block = max(1, int(rounds * max(BLOCK_ITEMS / max(count, 1), 1 / MOST_BLOCKS)))
    lined = scratch.put("rounds", ends.select("row", "start", "length", "source", "end", "round", F.expr(f"(round - 1) div {per_block}").alias("block")))
    inside = Window.partitionBy("block").orderBy("round", "source", "end").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    bases = lined.groupBy("block").agg(F.sum("length").alias("size"))
    bases = scratch.put("round-blocks", bases.select("block", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("base")))
    ends = scratch.put("round-ends", lined.select("row", "start", "length", "block", F.sum("length").over(inside).alias("end")))
    return ends.join(bases, "block").select("row", "start", "length", (F.col("base") + F.col("end") - F.col("length")).alias("at"))


def pack(docs: DataFrame, vocabulary: str = "byte_bpe_50k", end_id: int = 1, window: int = 2048, weights: dict[str, float] | None = None) -> DataFrame:
    """One row per piece: doc_id, source, start, length, doc_tokens, sequence_id, offset, ids (little-endian uint32).

    ``docs`` has doc_id, text, source; further columns are ignored.  Null text counts as
    empty and gives the closing id alone; a null source is a queue of its own (written as
    empty text); rows that repeat, or share or lack an id, are packed each for itself.  A
    text of any length is cut into items of at most a window.  No rows give no pieces.
    ``weights`` are the mixture's target token shares by source (default: the shares there
    are); every source needs one.
    """
    scratch = Scratch(docs.sparkSession, "packing")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.coalesce("source", F.lit("")).alias("source"))
    held = scratch.put("tokens", tokenized(docs, vocabulary, end_id).withColumn("row", F.monotonically_increasing_id()))
    items = held.select("row", "source", "n", F.explode(F.expr(f"sequence(0L, (n - 1) div {window})")).alias("part"))
    items = items.select("row", "source", (F.col("part") * window).alias("start"), F.least(F.lit(window).cast("long"), F.col("n") - F.col("part") * window).alias("length"))
    laid = laid_out(items, scratch, window, weights)
    first = F.least(F.col("length"), F.lit(window) - F.pmod("at", F.lit(window)))
    cuts = laid.select("row", F.explode(F.array(
        F.struct(F.col("start").alias("start"), first.alias("length"), F.col("at").alias("at")),
        F.struct((F.col("start") + first).alias("start"), (F.col("length") - first).alias("length"), (F.col("at") + first).alias("at")),
    )).alias("piece")).filter("piece.length > 0")
    pieces = scratch.put("pieces", cuts.groupBy("row").agg(F.sort_array(F.collect_list("piece")).alias("pieces")))
    scratch.drop("items", "sums", "quanta", "queue-blocks", "queue-ends", "rounds", "round-blocks", "round-ends")
    schema = "doc_id long, source string, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"
    fields = pa.schema([("doc_id", pa.int64()), ("source", pa.string()), *((c, pa.int64()) for c in ("start", "length", "doc_tokens", "sequence_id", "offset")), ("ids", pa.binary())])

    def cut(batches):
        for batch in (b.slice(i, 500) for b in batches for i in range(0, b.num_rows, 500)):
            rows = []
            press = zstandard.ZstdDecompressor()
            for doc, source, n, held, pieces in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "source", "n", "ids", "pieces"))):
                ids = np.frombuffer(press.decompress(held), "<u2").astype("<u4")
                rows += [(doc, source, p["start"], p["length"], n, *divmod(p["at"], window), ids[p["start"] : p["start"] + p["length"]].tobytes()) for p in pieces]
            yield batch_of(fields, *(list(c) for c in zip(*rows)))

    return held.join(pieces, "row").select("doc_id", "source", "n", "ids", "pieces").mapInArrow(cut, schema)


def sequences(pieces: DataFrame, window: int = 2048, pad_id: int = 0) -> DataFrame:
    """One row per packed sequence: sequence_id, n (ids before padding), ids (little-endian uint32, padded).

    A sequence whose length is a power of two keeps it; any other is padded to ``window``.
    """
    held = pieces.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("held"), F.sum("length").alias("n"))
    power = F.col("n").bitwiseAND(F.col("n") - 1) == 0
    short = F.when(power, F.lit(0)).otherwise(F.lit(window) - F.col("n")).cast("int")
    pad = F.repeat(F.lit(pad_id.to_bytes(4, "little").hex()), short)
    joined = F.concat(F.array_join(F.transform("held", lambda x: F.hex(x["ids"])), ""), pad)
    return held.select("sequence_id", "n", F.unhex(joined).alias("ids"))

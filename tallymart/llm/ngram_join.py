"""Exact Jaccard join on word n-grams by prefixes under several global token orders.

A document is the set of its distinct word n-grams.  Two sets with
``den * |A & B| >= num * |A | B|`` share at least ``ceil(num * |A| / den)`` tokens, so
under *any* order of all tokens they share one among the first ``|A| - ceil(..) + 1``
tokens of each.  Candidates must do so under every one of ``ORDERS`` orders; only then
are whole sets compared: first a few bits of every token, which rules out most pairs that
do not link at a quarter of the traffic, then the tokens themselves.

Pairs that share a passage meet under every order and are many more than the links, so
before the other orders the parities of two sets are compared: about a bit a token, each
the parity of the tokens that fall on it.  A token that only one set holds turns one bit,
so sets differ in at least as many tokens as their parities do in bits.

Each order ranks tokens by how common they are (a class), then by its own hash: common
passages come last, so they are in a prefix only where a document holds hardly anything
else.  Classes come from counts that every task makes over all its tokens and that are
summed by token; a wrong class costs time, never a link, since any order is a valid one.

Steps, each a written table:

1. ``sketch``  one row a document: set size, 128-bit key of the set, prefixes, parity.  Equal sets
   share a key; within a task only the first of them carries prefixes.
2. ``shared``  prefix tokens of the first order that two rows hold, with the smallest
   holder ("pivot").
3. Stars: every set against its tokens' pivots.  This is linear in the index whatever the
   size of a group of near copies, and joins such a group up.
4. Rest: in each token's bucket, holders outside the pivot's component against all holders
   of other components.  After it every pair that shares a token is either connected or
   was compared, so no link that matters to the components is missed.
5. Components by label propagation; the smallest id of each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymart.llm.components import components
from tallymart.llm.tables import Bits, Scratch, batch_of, blocks, fresh
from tallymart.llm.words import Texts, U, mix, windows

ORDERS = 3
#: A token is reported by a task from so many holders on, and is common from so many in all.
TASK_COUNT, COMMON_COUNT = 8, 32
#: At most so many common tokens (the most frequent ones) are sent to the tasks: 16 bytes each.
COMMON_TOKENS = 200_000
#: Comparisons with one pivot that one group of rows holds.
PIVOT_ROWS = 2000
#: Sets of more tokens are outlined with 32 bits a token, smaller ones with 16.
WIDE_FROM = 4096
#: Bits of a parity at most.
PARITY_MOST = 4096
SEEDS = np.array([0x243F6A8885A308D3, 0x13198A2E03707344, 0xA4093822299F31D0], dtype=np.uint64)


def token_sets(texts: Texts, k: int) -> Iterator[np.ndarray]:
    """The sorted distinct tokens of each text; under ``k`` words the whole sequence is one token."""
    words = texts.words()
    hashes = words.hashes(lower=True)
    tokens, at = windows(hashes, words.owner, k)
    owner = words.owner[at] if len(at) else at
    counts = words.counts()
    ends = np.cumsum(counts)
    limits = np.searchsorted(owner, np.arange(len(texts) + 1))
    for i in range(len(texts)):
        if counts[i] >= k:
            yield np.unique(tokens[limits[i] : limits[i + 1]])
        elif counts[i]:
            h = np.full(1, U(counts[i]), U)
            for w in hashes[ends[i] - counts[i] : ends[i]]:
                h = mix(h * U(0x9E3779B97F4A7C15) + w)
            yield h
        else:
            yield np.zeros(0, U)


def set_key(tokens: np.ndarray) -> bytes | None:
    """128 bits that stand for a set; None for the empty one."""
    if not len(tokens):
        return None
    return (int(np.add.reduce(mix(tokens))) << 64 | int(np.bitwise_xor.reduce(mix(tokens + SEEDS[0])))).to_bytes(16, "big")


def parity(tokens: np.ndarray) -> np.ndarray:
    """A power of two of bits, as many as tokens or more (up to PARITY_MOST), in words of 64: whether an odd number of tokens falls on each."""
    bits = 64
    while bits < min(len(tokens), PARITY_MOST):
        bits <<= 1
    at = (mix(tokens + SEEDS[1]) & U(bits - 1)).astype(np.int64)
    return np.packbits((np.bincount(at, minlength=bits) & 1).astype(np.uint8), bitorder="little").view(np.int64)


def needed(n, num: int, den: int):
    """Tokens that a set of ``n`` shares with any set it links to, at least."""
    return (num * n + den - 1) // den


class Common:
    """Common tokens and their class, 1 (common) to 63; 0 for every other token."""

    def __init__(self, tokens: np.ndarray, counts: np.ndarray):
        order = np.argsort(tokens)
        self.tokens = tokens[order]
        self.level = np.minimum(1 + np.log2(np.maximum(counts[order], 1)), 63).astype(U)

    def levels(self, tokens: np.ndarray) -> np.ndarray:
        if not len(self.tokens):
            return np.zeros(len(tokens), U)
        at = np.minimum(np.searchsorted(self.tokens, tokens), len(self.tokens) - 1)
        return np.where(self.tokens[at] == tokens, self.level[at], U(0))

    def prefix(self, tokens: np.ndarray, size: int, order: int) -> np.ndarray:
        """The ``size`` first tokens under one of the orders, in that order."""
        rank = (self.levels(tokens) << U(58)) | (mix(tokens ^ SEEDS[order]) >> U(6))
        near = np.argpartition(rank, size - 1)[:size] if size < len(tokens) else np.arange(len(tokens))
        return tokens[near[np.argsort(rank[near])]]


def common_tokens(docs: DataFrame, k: int) -> Common:
    """Tokens that many documents hold, from sums of what each task has counted over all its documents."""
    schema = pa.schema([("token", pa.int64()), ("n", pa.int64())])

    def count(batches):
        kept: list[np.ndarray] = []
        size = 0

        def flush():
            found, n = np.unique(np.concatenate(kept), return_counts=True)
            often = n >= TASK_COUNT
            return batch_of(schema, found[often].view(np.int64), n[often])

        for block in blocks(batches, "text"):
            seen = set()
            for tokens in token_sets(Texts.of(block.column("text")), k):
                if len(tokens) and (mark := tokens[:2].tobytes()) not in seen:
                    seen.add(mark)
                    kept.append(tokens)
                    size += len(tokens)
            if size > 2_000_000:
                yield flush()
                kept, size = [], 0
        if kept:
            yield flush()

    found = (
        docs.select("text").mapInArrow(count, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
        .filter(F.col("n") >= COMMON_COUNT).orderBy(F.desc("n"), "token").limit(COMMON_TOKENS).toArrow()
    )
    return Common(found["token"].to_numpy().view(U), found["n"].to_numpy().astype(np.int64))


def sketch(docs: DataFrame, common, k: int, num: int, den: int) -> DataFrame:
    """doc_id, digest, n (set size), key, first (prefix of order 0), others (32 bits of each token of the other prefixes), parity."""
    schema = pa.schema([
        ("doc_id", pa.int64()), ("digest", pa.int64()), ("n", pa.int64()), ("key", pa.binary()),
        ("first", pa.list_(pa.int64())), ("others", pa.list_(pa.list_(pa.int32()))), ("parity", pa.list_(pa.int64())),
    ])

    def work(batches):
        seen: set[bytes] = set()
        ranks = common.value
        for block in blocks(batches, "text"):
            sizes, keys, firsts, others, parities = [], [], [], [], []
            for tokens in token_sets(Texts.of(block.column("text")), k):
                n = len(tokens)
                key = set_key(tokens)
                sizes.append(n)
                keys.append(key)
                if key is None or key in seen:
                    firsts.append(None)
                    others.append(None)
                    parities.append(None)
                    continue
                if len(seen) < 1_000_000:
                    seen.add(key)
                size = n - needed(n, num, den) + 1
                firsts.append(ranks.prefix(tokens, size, 0).view(np.int64))
                others.append([ranks.prefix(tokens, size, i).astype(np.uint32).view(np.int32) for i in range(1, ORDERS)])
                parities.append(parity(tokens))
            lists = (pa.array(x, schema.field(c).type) for x, c in ((firsts, "first"), (others, "others"), (parities, "parity")))
            yield batch_of(schema, block.column("doc_id"), block.column("digest"), sizes, pa.array(keys, pa.binary()), *lists)

    return docs.select("doc_id", "digest", "text").mapInArrow(work, "doc_id long, digest long, n long, key binary, first array<long>, others array<array<int>>, parity array<long>")


def met(pairs: DataFrame, sketches: DataFrame, bits: Bits, *columns: str) -> DataFrame:
    """Pairs (a, b) with ``columns`` of the sketches of both, the names followed by ``_a`` and ``_b``; ``bits`` knows their rows."""
    words = bits.words

    def look(batches):
        for batch in batches:
            yield batch.filter(Bits.hit(words.value, batch.column("at"))).drop_columns(["at"])

    marked = sketches.filter("others is not null").select("row", *columns, bits.place("row").alias("at"))
    held = marked.mapInArrow(look, marked.drop("at").schema)
    for side in ("a", "b"):
        pairs = pairs.join(held.select(F.col("row").alias(side), *(F.col(c).alias(f"{c}_{side}") for c in columns)), side)
    return pairs


def rows_of(spark: SparkSession, pairs: DataFrame) -> Bits:
    """A filter that knows the rows of written pairs (a, b)."""
    return Bits(spark, pairs.select(F.col("a").alias("row")).union(pairs.select(F.col("b").alias("row"))).distinct(), "row", pairs.count())


def near_parities(pairs: DataFrame, sketches: DataFrame, bits: Bits, num: int, den: int) -> DataFrame:
    """Pairs (a, b) without those whose parities differ in more bits than the sets of a link in tokens.

    Parities are brought to one length by folding the longer in half; pairs of sets further apart in size stay.
    """
    both = met(pairs, sketches, bits, "n", "parity")
    a, b = F.col("parity_a"), F.col("parity_b")
    least = F.least(F.size(a), F.size(b))

    def xor(x: Column, y: Column) -> Column:
        return F.zip_with(x, y, lambda p, q: p.bitwiseXOR(q))

    def folded(x: Column) -> Column:
        return F.when(F.size(x) > least, xor(F.slice(x, 1, least), F.slice(x, least + 1, least))).otherwise(x)

    differ = F.aggregate(xor(folded(a), folded(b)), F.lit(0), lambda total, word: total + F.bit_count(word))
    far = (F.greatest(F.size(a), F.size(b)) <= 2 * least) & (differ * (num + den) > (F.col("n_a") + F.col("n_b")) * (den - num))
    return both.filter(~far).select("a", "b")


def cross_orders(pairs: DataFrame, sketches: DataFrame, bits: Bits) -> DataFrame:
    """Pairs (a, b) whose prefixes meet under each of the other orders too."""
    both = met(pairs, sketches, bits, "others")
    for i in range(ORDERS - 1):
        both = both.filter(F.arrays_overlap(F.col("others_a")[i], F.col("others_b")[i]))
    return both.select("a", "b")


def packed(tokens: np.ndarray) -> bytes:
    """16 bits (32 of large sets) of every token, after a byte that says which."""
    wide = len(tokens) > WIDE_FROM
    return bytes([wide]) + tokens.astype(np.uint32 if wide else np.uint16).tobytes()


def may_link(mine: bytes, other: bytes, num: int, den: int) -> bool:
    """False only if the sets cannot link: tokens are at most as many in common as their bits are."""
    a, b = (np.frombuffer(x, np.uint32 if x[0] else np.uint16, offset=1) for x in (mine, other))
    if a.dtype != b.dtype:
        a, b = a.astype(np.uint16), b.astype(np.uint16)
    both = int(min(np.isin(a, b).sum(), np.isin(b, a).sum()))
    return den * both >= num * (len(a) + len(b) - both)


def link(mine: bytes, other: bytes, num: int, den: int) -> bool:
    a, b = np.frombuffer(mine, U), np.frombuffer(other, U)
    both = len(np.intersect1d(a, b, assume_unique=True))
    return den * both >= num * (len(a) + len(b) - both)


def compare(pairs: DataFrame, leads: DataFrame, docs: DataFrame, k: int, encode, test, scratch: Scratch, name: str) -> DataFrame:
    """Pairs (a, b) for which ``test`` holds of their encoded sets, built again from the texts of the documents concerned.

    A set travels once to each of its pairs' ``b`` ("pivot"), whose comparisons are dealt
    over as many groups as they need.
    """
    spark = docs.sparkSession
    groups = scratch.put(f"{name}-groups", pairs.groupBy("b").agg(F.ceil(F.count("*") / PIVOT_ROWS).cast("int").alias("parts")))
    dealt = pairs.join(groups, "b").select(F.col("a").alias("row"), "b", F.pmod(F.xxhash64("a", "b"), F.col("parts")).cast("int").alias("part"), F.lit(1).alias("kind"))
    own = groups.select(F.col("b").alias("row"), "b", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(0).alias("kind"))
    routes = scratch.put(f"{name}-routes", dealt.unionByName(own).join(leads.select("row", "doc_id", "key"), "row"))
    wanted = routes.select("doc_id").distinct()
    bits = Bits(spark, wanted, "doc_id", wanted.count())
    words = bits.words
    schema = pa.schema([("doc_id", pa.int64()), ("key", pa.binary()), ("tokens", pa.binary())])

    def sets(batches):
        seen: set[tuple] = set()
        for block in blocks((b.filter(Bits.hit(words.value, b.column("at"))) for b in batches), "text"):
            rows = []
            for doc, tokens in zip(block.column("doc_id").to_pylist(), token_sets(Texts.of(block.column("text")), k)):
                row = (doc, set_key(tokens))
                if row[1] and row not in seen:  # a repeated row is sent once by each task
                    seen.add(row)
                    rows.append((*row, encode(tokens)))
            if rows:
                yield batch_of(schema, *(list(c) for c in zip(*rows)))

    found = docs.select("doc_id", "text", bits.place("doc_id").alias("at")).mapInArrow(sets, "doc_id long, key binary, tokens binary")
    brought = routes.join(found, routes["doc_id"].eqNullSafe(found["doc_id"]) & (routes["key"] == found["key"]))
    together = brought.select("b", "part", F.col("row").alias("a"), "kind", "tokens").repartition("b", "part").sortWithinPartitions("b", "part", "kind")
    out = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def check(batches):
        of, pivot = None, None
        for batch in batches:
            a, b = [], []
            for y, part, x, kind, tokens in zip(*(batch.column(c).to_pylist() for c in ("b", "part", "a", "kind", "tokens"))):
                if not kind:  # a group's pivot comes first
                    of, pivot = (y, part), tokens
                    continue
                assert of == (y, part), "a pair without its pivot"
                if test(tokens, pivot):
                    a.append(x)
                    b.append(y)
            yield batch_of(out, a, b)

    kept = scratch.put(f"{name}-kept", together.mapInArrow(check, "a long, b long").distinct())
    scratch.drop(f"{name}-groups", f"{name}-routes")
    return kept


def ngram_join(docs: DataFrame, k: int = 4, num: int = 85, den: int = 100) -> DataFrame:
    """(doc_id, n_shingles, component_id, n_same, digest, first) for every row of ``docs`` (doc_id, text).

    ``component_id`` is the smallest doc_id reachable by links, ``n_same`` the rows with the
    very same set, ``digest`` a hash of the text and ``first`` whether (doc_id, digest) is the
    smallest of its component.  A null text, or one without words, has an empty set and stays alone; rows with equal sets
    link; a repeated row comes back as often.  A null id takes part but never names a
    component unless it is all there is.  Extra columns are ignored; an empty table gives
    no row.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "ngram-join")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("digest"))
    common = spark.sparkContext.broadcast(common_tokens(docs, k))
    sketches = scratch.put("sketch", sketch(docs, common, k, num, den).withColumn("row", F.monotonically_increasing_id()))

    # One representative row for each set; leads are the rows that carry prefixes (one a task and set at most).
    sets = scratch.put("sets", sketches.filter("key is not null").groupBy("key").agg(
        F.min(F.when(F.col("first").isNotNull(), F.col("row"))).alias("set"), F.count("*").alias("n_same")))
    leads = scratch.put("leads", sketches.filter("first is not null").select("row", "doc_id", "n", "key").join(sets.select("key", "set"), "key"))
    tokens = sketches.filter("first is not null").select(F.posexplode("first").alias("at", "token"), "row")
    pivots = scratch.put("pivots", tokens.groupBy("token").agg(F.count("*").alias("holders"), F.min("row").alias("pivot")).filter("holders > 1"))
    index = tokens.join(pivots, "token").select("token", "row", "at", "pivot")
    index = scratch.put("index", index.join(leads.select("row", "set", "n"), "row").select("token", F.col("set").alias("row"), "at", "n", "pivot"))
    chief = leads.filter("row = set").select("row", "doc_id", "n", "key")

    def settled(pairs: DataFrame, name: str) -> DataFrame:
        """Links among pairs of sets: sizes, parities, then the other orders, then the sets themselves."""
        pairs = pairs.select(F.least("a", "b").alias("b"), F.greatest("a", "b").alias("a")).distinct()
        sized = pairs.join(chief.select(F.col("row").alias("a"), F.col("n").alias("n_a")), "a").join(chief.select(F.col("row").alias("b"), F.col("n").alias("n_b")), "b")
        sized = scratch.put(f"{name}-sized", sized.filter(F.least("n_a", "n_b") * den >= F.greatest("n_a", "n_b") * num).select("a", "b"))
        near = scratch.put(f"{name}-near", near_parities(sized, sketches, rows_of(spark, sized), num, den))
        left = scratch.put(f"{name}-left", cross_orders(near, sketches, rows_of(spark, near)))
        likely = compare(left, chief, docs, k, packed, lambda a, b: may_link(a, b, num, den), scratch, f"{name}-likely")
        found = compare(likely, chief, docs, k, lambda tokens: tokens.tobytes(), lambda a, b: link(a, b, num, den), scratch, f"{name}-links")
        scratch.drop(f"{name}-sized", f"{name}-near", f"{name}-left", f"{name}-likely-kept")
        return found

    scratch.drop("pivots")
    lead_set = leads.select(F.col("row").alias("pivot"), F.col("set").alias("hub"))
    stars = index.select("row", "pivot").distinct().join(lead_set, "pivot").filter("row <> hub").select(F.greatest("row", "hub").alias("a"), F.least("row", "hub").alias("b"))
    stars = scratch.put("stars", stars.distinct())
    links = settled(stars, "stars")
    labels = components(links, scratch, "after-stars")

    placed = index.join(lead_set, "pivot").join(labels.withColumnRenamed("node", "row"), "row", "left").select("token", "row", "at", "n", "hub", F.coalesce("label", "row").alias("group"))
    hub_labels = labels.select(F.col("node").alias("hub"), F.col("label").alias("hub_group"))
    placed = scratch.put("placed", placed.join(hub_labels, "hub", "left").select("token", "row", "at", "n", "group", F.coalesce("hub_group", "hub").alias("main")).distinct())
    scratch.drop("index")
    minor = scratch.put("minor", placed.filter("group <> main").select("token", F.col("row").alias("b"), F.col("group").alias("group_b"), F.col("at").alias("at_b"), F.col("n").alias("n_b")))
    # The first token that two sets share has all they share at or behind it, so it must leave room for
    # what a link takes: ceil(num * (n + n_b) / (num + den)) tokens.  Pairs that fail here meet no link
    # at this token; if they have one, they meet at an earlier token too.
    room = F.least(F.col("n") - F.col("at"), F.col("n_b") - F.col("at_b"))
    enough = (room * (num + den) >= (F.col("n") + F.col("n_b")) * num) & (F.least("n", "n_b") * den >= F.greatest("n", "n_b") * num)
    rest = minor.join(placed, "token").filter((F.col("group") != F.col("group_b")) & enough).select(F.greatest("row", "b").alias("a"), F.least("row", "b").alias("b")).distinct()
    rest = scratch.put("rest", rest.join(stars, ["a", "b"], "left_anti"))
    scratch.drop("placed", "minor")
    links = links.unionByName(settled(rest, "rest"))
    labels = scratch.put("all-labels", components(links, scratch, "all"))

    named = sets.join(labels.withColumnRenamed("node", "set"), "set", "left").select("key", "n_same", F.coalesce("label", "set").alias("part"))
    named = scratch.put("named", named)
    rows = scratch.put("rows", sketches.select("doc_id", "digest", "n", "key").filter("key is not null").join(named, "key").select("doc_id", "digest", "n", "part", "n_same"))
    smallest = F.min(F.struct(F.isnull("doc_id").alias("nameless"), "doc_id", "digest")).alias("smallest")
    least = scratch.put("least", rows.groupBy("part").agg(smallest).select("part", "smallest.*").withColumnsRenamed({"doc_id": "component_id", "digest": "chief"}))
    scratch.drop("leads", "stars", "rest")
    first = F.col("doc_id").eqNullSafe(F.col("component_id")) & (F.col("digest") == F.col("chief"))
    whole = rows.join(least, "part").select("doc_id", F.col("n").alias("n_shingles"), "component_id", "n_same", "digest", first.alias("first"))
    empty = sketches.filter("key is null").select(
        "doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"), F.lit(1).cast("long").alias("n_same"), "digest", F.lit(True).alias("first"))
    return whole.unionByName(empty)


def keep_first(docs: DataFrame, k: int = 4, num: int = 85, den: int = 100) -> DataFrame:
    """The rows of ``docs`` with all their columns, one for each component of the join.

    The row with the smallest id stays, and of rows that repeat under one id one; a row
    without words stays, since it links with nothing.
    """
    name, digest = fresh(docs, "of_id"), fresh(docs, "of_digest")
    found = ngram_join(docs, k, num, den).filter("first and n_shingles > 0").select(F.col("doc_id").alias(name), F.col("digest").alias(digest)).distinct()
    names = docs.columns
    marked = docs.withColumns({digest: F.xxhash64("text"), name: F.col("doc_id").cast("long")})
    kept = marked.join(found, marked[name].eqNullSafe(found[name]) & (marked[digest] == found[digest]), "left_semi")
    once = kept.dropDuplicates([name, digest]).select(names)
    blank = docs.filter(F.coalesce(~F.col("text").rlike("[^\\x20\\x09-\\x0D]"), F.lit(True)))
    return once.unionByName(blank)

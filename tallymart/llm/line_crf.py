"""Document quality from a linear-chain conditional random field over lines.

Every line is good or bad, judged by measures of itself and of the lines around it, with
weights for passing from one state to the next.  Labels are known for documents only: at
first a line has its document's label; then lines of poor documents that the field finds
good are relabelled and it is fitted once more.  Forward-backward marginals, weighted by
the lines' lengths, give a document's share of good text; two numbers fitted to the same
sample turn the share into a probability.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymart.llm.tables import batch_of, blocks, crc_of_id
from tallymart.llm.words import Runs, Texts

#: Labelled rows fitted to at most; longer documents are left out of the fit (not of the scores).
TRAIN_ROWS, TRAIN_LINES = 5000, 300
STEPS, RATE, DECAY, SEED = 120, 0.15, 1e-4, 3
GOOD, BAD = 0, 1
SYMBOLS, MARKS = b"#*$%&<>", b".,;:?"
#: Where a share counts as present, frequent or dominant.
LEVELS = (0.01, 0.05, 0.2)


def measures(lines: Runs) -> np.ndarray:
    """One row per line: shares of kinds of characters, repetition, length, each also at a few levels."""
    data = lines.texts.data
    size = np.maximum(lines.end - lines.begin, 1)

    def share(flags: np.ndarray) -> np.ndarray:
        return lines.sums(flags) / size

    words = lines.texts.words()
    line_of = np.searchsorted(lines.begin, words.begin, "right") - 1
    n = len(lines.begin)
    hashes = words.hashes(lower=True)
    counts = np.bincount(line_of, minlength=n)
    same = np.zeros(len(hashes), bool)
    same[1:] = (hashes[1:] == hashes[:-1]) & (line_of[1:] == line_of[:-1])
    order = np.lexsort((hashes, line_of))
    again = np.zeros(len(hashes), bool)
    again[1:] = (hashes[order][1:] == hashes[order][:-1]) & (line_of[order][1:] == line_of[order][:-1])
    repeats = np.bincount(line_of, same, n) / np.maximum(counts, 1)
    doubled = np.bincount(line_of[order], again, n) / np.maximum(counts, 1)
    text = lines.hashes()
    order = np.lexsort((np.arange(n), text, lines.owner))
    copy = np.zeros(n, bool)
    copy[order[1:]] = (text[order][1:] == text[order][:-1]) & (lines.owner[order][1:] == lines.owner[order][:-1])
    shares = np.column_stack([
        share((data >= 65) & (data <= 90)), share((data >= 48) & (data <= 57)), share(np.isin(data, np.frombuffer(SYMBOLS, np.uint8))),
        share(data == ord("|")), share(data == ord("!")), share(np.isin(data, np.frombuffer(MARKS, np.uint8))), repeats, doubled, copy,
    ])
    length = np.column_stack([np.log1p(size) / 10, np.minimum(size / np.maximum(counts, 1) / 20, 3), counts <= 2])
    return np.hstack([shares, *(shares > x for x in LEVELS), length]).astype(np.float64)


def with_neighbours(own: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """A line's measures, those of the line before and after (zeros at the ends of a text), and three flags."""
    n = len(own)
    before, after = np.zeros_like(own), np.zeros_like(own)
    if n > 1:
        joined = (owner[1:] == owner[:-1])[:, None]
        before[1:], after[:-1] = own[:-1] * joined, own[1:] * joined
    first = np.ones(n)
    last = np.ones(n)
    if n > 1:
        first[1:] = owner[1:] != owner[:-1]
        last[:-1] = owner[1:] != owner[:-1]
    return np.hstack([own, before, after, first[:, None], last[:, None], np.ones((n, 1))])


class Chains:
    """Texts as chains of lines; step t of all chains that are long enough is worked on at once."""

    def __init__(self, owner: np.ndarray):
        change = np.flatnonzero(np.diff(owner)) + 1 if len(owner) else np.zeros(0, int)
        self.start = np.concatenate([[0], change]).astype(int) if len(owner) else np.zeros(0, int)
        self.size = np.diff(np.concatenate([self.start, [len(owner)]]))
        order = np.argsort(-self.size, kind="stable")
        self.start, self.size = self.start[order], self.size[order]
        self.alive = np.searchsorted(-self.size, -np.arange(1, (self.size[0] if len(self.size) else 0) + 1), "right")

    def marginals(self, unary: np.ndarray, passing: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Probability of each state on each line, and the expected number of passages between states."""
        e = np.exp(unary - unary.max(axis=1, keepdims=True)) if len(unary) else unary
        a = np.exp(passing)
        ahead, back = np.zeros_like(e), np.ones_like(e)
        pairs = np.zeros((2, 2))
        for t, n in enumerate(self.alive):
            at = self.start[:n] + t
            x = e[at] if t == 0 else (ahead[at - 1] @ a) * e[at]
            ahead[at] = x / x.sum(axis=1, keepdims=True)
        for t in range(len(self.alive) - 2, -1, -1):
            at = self.start[: self.alive[t + 1]] + t
            onward = e[at + 1] * back[at + 1]
            x = onward @ a.T
            pair = ahead[at][:, :, None] * a[None] * onward[:, None, :]
            pairs += (pair / pair.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
            back[at] = x / x.sum(axis=1, keepdims=True)
        both = ahead * back
        return both / np.maximum(both.sum(axis=1, keepdims=True), 1e-300), pairs


@dataclass
class Field:
    weight: np.ndarray
    passing: np.ndarray
    scale: np.ndarray
    slope: float = 1.0
    shift: float = 0.0

    def states(self, rows: np.ndarray, chains: Chains) -> np.ndarray:
        return chains.marginals((rows / self.scale) @ self.weight, self.passing)[0]

    def scores(self, texts: Texts) -> np.ndarray:
        """Probability of the good label; 0 for a text without a character other than line ends."""
        lines = texts.lines()
        out = np.zeros(len(texts))
        if len(lines.begin):
            good = self.states(with_neighbours(measures(lines), lines.owner), Chains(lines.owner))[:, GOOD]
            share, seen = good_share(good, lines.end - lines.begin, lines.owner, len(texts))
            out[seen] = self.probability(share[seen])
        return out

    def probability(self, share: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.slope * share + self.shift)))


def good_share(good: np.ndarray, size: np.ndarray, owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    total = np.bincount(owner, size, n)
    return np.bincount(owner, good * size, n) / np.maximum(total, 1), total > 0


def ascend(rows: np.ndarray, truth: np.ndarray, owner: np.ndarray, field: Field) -> None:
    """Maximum likelihood by Adam over all chains."""
    chains = Chains(owner)
    x = rows / field.scale
    known = np.eye(2)[truth]
    inner = owner[1:] == owner[:-1]
    seen = np.zeros((2, 2))
    np.add.at(seen, (truth[:-1][inner], truth[1:][inner]), 1)
    moments = [np.zeros_like(p) for p in (field.weight, field.weight, field.passing, field.passing)]
    for step in range(1, STEPS + 1):
        state, pairs = chains.marginals(x @ field.weight, field.passing)
        grads = (x.T @ (known - state) / len(x) - DECAY * field.weight, (seen - pairs) / len(x) - DECAY * field.passing)
        for i, (p, g) in enumerate(zip((field.weight, field.passing), grads)):
            m, v = moments[2 * i], moments[2 * i + 1]
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p += RATE * (1 - step / (STEPS + 1)) * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-9)


def sample(docs: DataFrame, labels: DataFrame, learn: Column) -> pa.Table:
    """quality, lines (flat measures), sizes: of at most TRAIN_ROWS labelled documents, in the order of a hash of the id."""
    known = labels.filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull()).filter(learn).groupBy("doc_id").agg(F.min("quality").cast("int").alias("quality"))
    drawn = known.orderBy(F.xxhash64("doc_id", F.lit(SEED)), "doc_id").limit(TRAIN_ROWS)
    schema = pa.schema([("doc_id", pa.int64()), ("quality", pa.int32()), ("rows", pa.list_(pa.float64())), ("sizes", pa.list_(pa.int64()))])

    def work(batches):
        for block in blocks(batches, "text"):
            lines = Texts.of(block.column("text")).lines()
            rows, sizes = measures(lines), lines.end - lines.begin
            mine = [np.flatnonzero(lines.owner == i) for i in range(block.num_rows)]
            use = [i for i, m in enumerate(mine) if 0 < len(m) <= TRAIN_LINES]
            yield batch_of(
                schema, block.column("doc_id").take(pa.array(use, pa.int64())), block.column("quality").take(pa.array(use, pa.int64())),
                pa.array([rows[mine[i]].ravel() for i in use], schema.field("rows").type), pa.array([sizes[mine[i]] for i in use], schema.field("sizes").type),
            )

    # TRAIN_ROWS rows of two numbers are broadcast; repeated ids in docs are learned from once.
    joined = docs.select("doc_id", "text").join(F.broadcast(drawn), "doc_id").groupBy("doc_id", "quality").agg(F.min("text").alias("text"))
    return joined.mapInArrow(work, "doc_id long, quality int, rows array<double>, sizes array<long>").toArrow()


def fit(docs: DataFrame, labels: DataFrame, learn: Column) -> Field:
    """A field from labels (doc_id, quality) where ``learn`` holds; with labels of one kind or none it scores 1 or 0.5."""
    found = sample(docs, labels, learn).sort_by("doc_id").combine_chunks()
    quality = np.array(found["quality"].to_pylist(), int)
    sizes = [np.asarray(x.values) for x in found["sizes"]]
    width = 12 + 9 * len(LEVELS)
    own = np.concatenate([*(np.asarray(x.values) for x in found["rows"]), np.zeros(0)]).reshape(-1, width)
    owner = np.repeat(np.arange(len(sizes)), [len(s) for s in sizes])
    size = np.concatenate([*sizes, np.zeros(0, np.int64)])
    rows = with_neighbours(own, owner)
    field = Field(np.zeros((rows.shape[1], 2)), np.zeros((2, 2)), np.ones(rows.shape[1]))
    if not len(quality):
        field.slope = 0.0
        return field
    field.scale = np.maximum(rows.std(axis=0), 0.05)
    truth = np.where(quality[owner] == 1, GOOD, BAD)
    ascend(rows, truth, owner, field)
    good = field.states(rows, Chains(owner))[:, GOOD]
    ascend(rows, np.where((truth == BAD) & (good < 0.5), BAD, GOOD), owner, field)
    good = field.states(rows, Chains(owner))[:, GOOD]
    share = good_share(good, size, owner, len(quality))[0]
    field.slope, field.shift = logistic(share, quality)
    return field


def logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a one-variable logistic regression, by Newton steps with a small ridge; the slope is never negative."""
    b = np.zeros(2)
    z = np.column_stack([x, np.ones(len(x))])
    for _ in range(30):
        p = 1 / (1 + np.exp(-(z @ b)))
        ridge = np.diag([1e-2, 1e-3])
        b += np.linalg.solve(z.T @ (z * (p * (1 - p))[:, None]) + ridge, z.T @ (y - p) - ridge @ b)
    return max(float(b[0]), 0.0), float(b[1])


def score(docs: DataFrame, field: Field) -> DataFrame:
    """doc_id, score for every row of ``docs`` (doc_id, text; nothing else is read).

    A null or empty text scores 0; a text of any length is scored whole; rows with null or
    repeated ids are rows like any other; no rows give none.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])
    held = docs.sparkSession.sparkContext.broadcast(field)

    def work(batches):
        for block in blocks(batches, "text"):
            yield batch_of(schema, block.column("doc_id"), held.value.scores(Texts.of(block.column("text"))))

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(work, "doc_id long, score double")


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted; learns from rows whose crc32 of the id, mod 3, is not 1."""
    part = F.pmod(crc_of_id("doc_id"), F.lit(3))
    found = score(docs, fit(docs, labels, part != 1))
    return found.select("doc_id", (part == 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))

"""Soft-membership mixing: document rates whose expected domain token totals meet a target mixture.

1. A softmax over hashed words and a few style measures is fitted to a bounded sample of
   the labelled table; it gives every document a posterior over domains.
2. Rates r >= 0 (optionally at most ``max_rate``) are fitted by projected gradient on the
   least squares between the expected totals sum_d r_d * tokens_d * posterior_d and the
   targets.  A document's rate depends only on its own posterior and on the gradients so
   far, which are a few numbers: every round replays them per document, sums the totals
   over the cluster, and adds one gradient.  No state per document is kept or moved.
   The squares are weighted with the inverse second moment of the posteriors, so that small
   domains converge as fast as large ones and a step of one never overshoots.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from tallymart.llm.langid import softmax
from tallymart.llm.tables import Scratch, batch_of, blocks, fresh, list_array, relieve
from tallymart.llm.words import Texts, U

BUCKETS = 1 << 16
#: Labelled rows that the classifier is fitted to at most.
TRAIN_ROWS = 6000
EPOCHS, BATCH, RATE, SEED = 8, 32, 0.3, 5
#: Rounds at most, and the largest miss of a domain (as a share of all tokens) that ends them.
ROUNDS, CLOSE = 60, 1e-4
STYLES = 8


def features(texts: Texts) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Distinct word buckets of each text, its style measures, its number of words."""
    words = texts.words()
    counts = words.counts()
    bucket = (words.hashes(lower=True) % U(BUCKETS)).astype(np.int32)
    ends = np.cumsum(counts)
    held = [np.unique(bucket[e - n : e]) for e, n in zip(ends, counts)]
    data = texts.data

    def share(flags: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
        return np.diff(total[texts.start]) / np.maximum(np.diff(texts.start), 1)

    distinct = np.array([len(h) for h in held])
    style = np.column_stack([
        share((data >= 65) & (data <= 90)), share((data >= 48) & (data <= 57)), share(np.isin(data, np.frombuffer(b"#*$%&<>", np.uint8))),
        share(data == ord("|")), share(data == ord("!")), share(np.isin(data, np.frombuffer(b".,;:", np.uint8))),
        1 - distinct / np.maximum(counts, 1), np.minimum(np.log1p(counts) / 10, 2),
    ])
    return held, style, counts


@dataclass
class Classifier:
    domains: list[str]
    word_weight: np.ndarray
    style_weight: np.ndarray
    bias: np.ndarray

    def posteriors(self, held: list[np.ndarray], style: np.ndarray) -> np.ndarray:
        sizes = np.array([len(h) for h in held])
        flat = np.concatenate([*held, np.zeros(0, np.int32)]).astype(np.int64)
        place = np.repeat(np.arange(len(held)), sizes)
        logits = style @ self.style_weight + self.bias
        for k in range(len(self.domains)):
            logits[:, k] += np.bincount(place, self.word_weight[flat, k], len(held)) / np.sqrt(np.maximum(sizes, 1))
        return softmax(logits)


def fit(docs: DataFrame, labelled: DataFrame, domains: list[str]) -> Classifier:
    """A classifier from ``labelled`` (doc_id, domain); without usable labels every domain is as likely."""
    known = labelled.filter(F.col("doc_id").isNotNull() & F.col("domain").isin(domains)).groupBy("doc_id").agg(F.min("domain").alias("domain"))
    sample = known.orderBy(F.xxhash64("doc_id", F.lit(SEED)), "doc_id").limit(TRAIN_ROWS)
    schema = pa.schema([("domain", pa.string()), ("bucket", pa.list_(pa.int32())), ("style", pa.list_(pa.float64()))])

    def work(batches):
        for block in blocks(batches, "text"):
            held, style, _ = features(Texts.of(block.column("text")))
            yield batch_of(schema, block.column("domain"), list_array(np.concatenate(held), np.cumsum([len(h) for h in held])), pa.array(list(style)))

    # The sample has TRAIN_ROWS rows at most, two short columns each, so it is broadcast.
    joined = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").groupBy("doc_id", "domain").agg(F.min("text").alias("text"))
    found = joined.select("domain", "text").mapInArrow(work, "domain string, bucket array<int>, style array<double>").toArrow()
    truth = np.array([domains.index(x) for x in found["domain"].to_pylist()], int)
    found = found.combine_chunks()
    held = [np.asarray(x.values) for x in found["bucket"]]
    style = np.array([np.asarray(x.values) for x in found["style"]]).reshape(-1, STYLES)
    rng = np.random.default_rng(SEED)
    order0 = np.lexsort((truth, [h.sum() for h in held]))  # rows arrive in no fixed order
    model = Classifier(domains, np.zeros((BUCKETS, len(domains))), np.zeros((STYLES, len(domains))), np.zeros(len(domains)))
    seen_word, seen_style, seen_bias = (np.full(x.shape, 1e-3) for x in (model.word_weight, model.style_weight, model.bias))
    for _ in range(EPOCHS):
        order = order0[rng.permutation(len(truth))]
        for i in range(0, len(order), BATCH):
            rows = order[i : i + BATCH]
            mine = [held[j] for j in rows]
            error = model.posteriors(mine, style[rows])
            error[np.arange(len(rows)), truth[rows]] -= 1
            sizes = np.array([len(h) for h in mine])
            flat = np.concatenate(mine).astype(np.int64)
            scaled = (error / np.sqrt(np.maximum(sizes, 1))[:, None])[np.repeat(np.arange(len(rows)), sizes)]
            at, where = np.unique(flat, return_inverse=True)
            slope = np.column_stack([np.bincount(where, scaled[:, k], len(at)) for k in range(len(domains))])
            for weight, seen, grad, idx in ((model.word_weight, seen_word, slope, at), (model.style_weight, seen_style, style[rows].T @ error, slice(None)), (model.bias, seen_bias, error.sum(axis=0), slice(None))):
                seen[idx] += grad**2
                weight[idx] -= RATE * grad / np.sqrt(seen[idx])
    return model


def posteriors(docs: DataFrame, model: Classifier) -> DataFrame:
    """doc_id, tokens (words of the whole text), posterior (array in the order of the domains), draw (0 to 1)."""
    schema = pa.schema([("doc_id", pa.int64()), ("tokens", pa.int64()), ("posterior", pa.list_(pa.float64()))])
    held = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches):
        for block in blocks(batches, "text"):
            found, style, counts = features(Texts.of(block.column("text")))
            yield batch_of(schema, block.column("doc_id"), counts, pa.array(list(held.value.posteriors(found, style)), pa.list_(pa.float64())))

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(work, "doc_id long, tokens long, posterior array<double>")


def replay(posterior: np.ndarray, gradients: np.ndarray, max_rate: float | None) -> np.ndarray:
    rate = np.ones(len(posterior))
    for g in gradients:
        rate = np.clip(rate - posterior @ g, 0, max_rate)
    return rate


def matrix(column: pa.Array, width: int) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(-1, width)


def fit_rates(table: DataFrame, targets: np.ndarray, max_rate: float | None = None) -> np.ndarray:
    """The gradients (rounds by domains) that ``replay`` turns into rates; ``targets`` are token totals by domain."""
    k = len(targets)

    def totals(gradients: np.ndarray, moments: bool) -> np.ndarray:
        def work(batches):
            total = np.zeros(k * k if moments else k)
            for batch in batches:
                p, n = matrix(batch.column("posterior"), k), batch.column("tokens").to_numpy()
                total += (p.T @ (p * n[:, None])).ravel() if moments else replay(p, gradients, max_rate) @ (p * n[:, None])
            yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), pa.array(total)], names=["at", "total"])

        found = table.mapInArrow(work, "at int, total double").groupBy("at").agg(F.sum("total").alias("total")).collect()
        out = np.zeros(k * k if moments else k)
        for r in found:
            out[r["at"]] = r["total"]
        return out

    none = np.zeros((0, k))
    moment = totals(none, True).reshape(k, k)
    scale = max(float(targets.sum()), 1.0)
    inverse = np.linalg.inv(moment + np.eye(k) * 1e-9 * scale)
    gradients, last = none, None
    for _ in range(ROUNDS):
        now = totals(gradients, False)
        miss = now - targets
        if np.abs(miss).max() <= CLOSE * scale or (last is not None and np.abs(now - last).max() <= CLOSE * scale / 100):
            break
        gradients, last = np.vstack([gradients, inverse @ miss]), now
        relieve(table.sparkSession)
    return gradients


def with_rates(table: DataFrame, gradients: np.ndarray, max_rate: float | None) -> DataFrame:
    """``table`` with a column rate."""
    names = table.columns

    def work(batches):
        for batch in batches:
            rate = replay(matrix(batch.column("posterior"), gradients.shape[1]), gradients, max_rate)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(rate)], names=[*names, "rate"])

    return table.mapInArrow(work, StructType([*table.schema, StructField("rate", DoubleType())]))


def mix_rates(docs: DataFrame, labelled: DataFrame, weights: dict[str, float], total: float | None = None, max_rate: float | None = None) -> DataFrame:
    """doc_id, tokens, posterior, rate for every row of ``docs`` (doc_id, text; other columns are ignored).

    ``weights`` are the target token shares of the domains, ``total`` the tokens to reach
    (default: as many as there are).  A null or empty text has no tokens and still a
    posterior and a rate; a null or repeated id is a row like any other; no rows give none.
    Where targets cannot be met (a bound on rates, a domain without tokens), the rates come
    as near as least squares can.
    """
    domains = sorted(weights)
    scratch = Scratch(docs.sparkSession, "mixing")
    model = fit(docs, labelled, domains)
    table = scratch.put("posteriors", posteriors(docs, model))
    have = table.agg(F.coalesce(F.sum("tokens"), F.lit(0))).first()[0]
    shares = np.array([weights[d] for d in domains])
    gradients = fit_rates(table, shares / shares.sum() * float(have if total is None else total), max_rate)
    return with_rates(table, gradients, max_rate)


#: Domains that the labels table tells apart, and the production mixture.
TARGETS = {"plain": 0.94, "poor": 0.04, "toxic": 0.02}


def labelled_domains(labels: DataFrame) -> DataFrame:
    domain = F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 1, "plain").when(F.col("quality") == 0, "poor")
    return labels.select("doc_id", domain.alias("domain")).filter("domain is not null")


def draw_by_rate(docs: DataFrame, labelled: DataFrame, weights: dict[str, float], max_rate: float = 1.0) -> DataFrame:
    """Rows of ``docs``, each kept with the chance its rate gives it; all columns as they are.

    Rates are at most one, so no row repeats, and a document of a domain that has fewer
    tokens than its target is kept for sure.  The draw hangs on id and text alone: a rerun
    of a lost task draws alike, and repeated rows share their fate.  A row's rate is worked
    out again where the row is, so nothing is joined.
    """
    domains = sorted(weights)
    scratch = Scratch(docs.sparkSession, "mixing-draw")
    model = fit(docs, labelled, domains)
    table = scratch.put("posteriors", posteriors(docs, model))
    have = table.agg(F.coalesce(F.sum("tokens"), F.lit(0))).first()[0]
    shares = np.array([weights[d] for d in domains])
    gradients = fit_rates(table, shares / shares.sum() * float(have), max_rate)
    scratch.drop("posteriors")
    held = docs.sparkSession.sparkContext.broadcast(model)
    names = docs.columns

    def work(batches):
        for block in blocks(batches, "text"):
            found, style, _ = features(Texts.of(block.column("text")))
            rate = replay(held.value.posteriors(found, style), gradients, max_rate)
            draw = block.column(len(names)).to_numpy() / float(1 << 30)
            yield block.select(names).filter(pa.array(draw < rate))

    drawn = docs.withColumn(fresh(docs, "draw"), F.pmod(F.xxhash64("doc_id", "text", F.lit(SEED)), F.lit(1 << 30)))
    return drawn.mapInArrow(work, docs.schema)

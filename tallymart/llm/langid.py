"""Language identification: averaged hashed subword embeddings under a linear softmax.

A text is the average of the embeddings of its byte n-grams (inside words, word ends
marked by their blank), hashed into ``BUCKETS``; a linear softmax reads the language off
it.  Both layers are trained by stochastic gradient descent in numpy on a bounded sample
of labelled rows.  A second sample fits one temperature (so that the score is a
probability) and the score under which a prediction is rejected.  Prediction covers whole
texts: since averaging is linear, the two layers become one table of bucket by language.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallymart.llm.tables import batch_of, blocks, crc_of_id, list_array, relieve, strings_of
from tallymart.llm.words import BLANK, LOWER, Texts, U

SIZES = (2, 3, 4)
BUCKETS = 1 << 15
DIMENSIONS = 16
#: Labelled rows that are learned from, and further ones for temperature and rejection.
TRAIN_ROWS, CALIBRATION_ROWS = 3000, 1500
EPOCHS, BATCH, RATE, SEED = 6, 16, 0.5, 11
#: Steps of gradient descent at least: a small table is passed over more often, so that it is learned as well as a large one.
MIN_STEPS = 800
#: Bytes of whole calibration texts that reach the driver; rows past them count for the temperature (by their buckets) alone.
CALIBRATION_BYTES = 4 << 20
#: Bytes of text predicted at once inside a task.
PREDICT_BLOCK = 1 << 19
#: Characters of calibration texts measured at once on the driver.
CALIBRATION_BLOCK = 1 << 18
#: Rows whose means the driver works out at once.
MEANS_ROWS = 64
#: Of the calibration rows this share may fall under the limit of the score, and of familiarity.
RIGHT_REJECTED = 0.001
#: Bytes of the stretches whose scores are compared: a text in two learned languages is sure of each by itself.
STRETCH = 256
#: The familiarity of a text with few n-grams is drawn to that of learned texts as if it had so many more.
PRIOR = 24
UNKNOWN = "und"
OUTPUT = ("lang_pred", "score", "rejected")


#: Digits and signs tell nothing of a language.
WORDY = BLANK | (np.arange(256) >= 128) | np.isin(np.arange(256) | 32, np.arange(97, 123))


def wordy(texts: Texts, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets and texts of the n-grams without digits and signs."""
    found, valid = buckets(texts, size)
    plain = WORDY[texts.data]
    for j in range(size if len(found) else 0):
        valid = valid & plain[j : len(found) + j]
    at = np.flatnonzero(valid)
    return found[at], np.searchsorted(texts.start, at, "right") - 1


def buckets(texts: Texts, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of the n-gram that begins at each byte, and whether there is one (BUCKETS where not)."""
    n = len(texts.data) - size + 1
    if n <= 0:
        return np.zeros(0, np.int32), np.zeros(0, bool)
    blank = BLANK[texts.data]
    data = np.where(blank, np.uint8(32), LOWER[texts.data]).astype(np.uint32)
    h = np.full(n, size, np.uint32)
    valid = np.ones(n, bool)
    for j in range(size):
        h = (h ^ data[j : n + j]) * np.uint32(0x01000193)
        if 0 < j < size - 1:
            valid &= ~blank[j : n + j]
    valid &= ~(blank[:n] & blank[size - 1 :])
    for back in range(1, size):  # none across two texts
        at = texts.start[1:-1] - back
        valid[at[(at >= 0) & (at < n)]] = False
    h = (h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
    found = ((h ^ (h >> np.uint32(13))) & np.uint32(BUCKETS - 1)).astype(np.int32)
    found[~valid] = BUCKETS
    return found, valid


@dataclass
class Model:
    langs: list[str]
    table: np.ndarray
    bias: np.ndarray
    #: Log share of each bucket in the texts that were learned from, in all languages together.
    common: np.ndarray
    temperature: float = 1.0
    least: float = 0.0
    usual: float = 0.0
    familiar: float = -np.inf

    def measures(self, texts: Texts) -> tuple[np.ndarray, np.ndarray]:
        """For each text the score of its surest stretch, and how common its n-grams are (mean log share)."""
        size = np.diff(texts.start)
        pieces = np.maximum(1, size // STRETCH)
        owner = np.repeat(np.arange(len(texts)), pieces)
        place = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        start = np.append(texts.start[:-1][owner] + place * size[owner] // pieces[owner], texts.start[-1])
        sure = self.probabilities(self.logits(Texts(texts.data, start))).max(axis=1)
        best = np.zeros(len(texts))
        np.maximum.at(best, owner, sure)
        total, count = np.zeros(len(texts)), np.zeros(len(texts))
        for n in SIZES:
            found, of = wordy(texts, n)
            total += np.bincount(of, self.common[found], len(texts))
            count += np.bincount(of, minlength=len(texts))
        return best, (total + PRIOR * self.usual) / (count + PRIOR)

    def logits(self, texts: Texts) -> np.ndarray:
        total = np.zeros((len(texts), len(self.langs)))
        count = np.zeros(len(texts))
        full = np.diff(texts.start) > 0
        for size in SIZES:
            found, valid = buckets(texts, size)
            begin = texts.start[:-1][full]
            inside = begin < len(found)
            rows = np.flatnonzero(full)[inside]
            if len(rows):
                for lang in range(len(self.langs)):  # a column at a time: 8 bytes a text byte, not 8 per language
                    total[rows, lang] += np.add.reduceat(self.table[found, lang], begin[inside])
                count[rows] += np.add.reduceat(valid.astype(np.int64), begin[inside])
        return total / np.maximum(count, 1)[:, None] + self.bias

    def probabilities(self, logits: np.ndarray) -> np.ndarray:
        return softmax(logits / self.temperature)


def softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(axis=1, keepdims=True))
    return x / x.sum(axis=1, keepdims=True)


def shrunk(bucket: np.ndarray, times: np.ndarray) -> bytes:
    """Distinct buckets (16 bits each) and then their counts (32 bits), compressed: a driver receives samples whole, so they come small."""
    return zlib.compress(bucket.astype(np.uint16).tobytes() + times.astype(np.int32).tobytes(), 1)


def widened(table: pa.Table) -> pa.Table:
    """The table with the list columns bucket and times in place of what ``shrunk`` made of them."""
    raw = [zlib.decompress(x.as_py()) for x in table["counted"]]
    sizes = np.array([len(x) // 6 for x in raw], int)
    ends = np.cumsum(sizes)
    bucket, times = np.zeros(sizes.sum(), np.uint16), np.zeros(sizes.sum(), np.int32)
    for i, (end, n) in enumerate(zip(ends, sizes)):
        bucket[end - n : end] = np.frombuffer(raw[i], np.uint16, n)
        times[end - n : end] = np.frombuffer(raw[i], np.int32, n, 2 * n)
        raw[i] = b""
    lists = [list_array(x, ends) for x in (bucket, times)]
    return pa.table([table["lang"], table["text"], *lists], names=["lang", "text", "bucket", "times"])


def examples(docs: DataFrame, use: Column, rows: int, whole: bool = False) -> pa.Table:
    """lang, text (only if ``whole``), and distinct buckets with counts of the whole text, of ``rows`` labelled rows in the order of a hash."""
    schema = pa.schema([("lang", pa.string()), ("text", pa.string()), ("counted", pa.binary())])

    sent = [0]

    def work(batches):
        for block in blocks(batches, "text"):
            texts = Texts.of(block.column("text"))
            found = [buckets(texts, s)[0] for s in SIZES]
            counted = []
            for a, b in zip(texts.start, texts.start[1:]):
                u, n = np.unique(np.concatenate([f[a:b] for f in found]), return_counts=True)
                counted.append(shrunk(u[u < BUCKETS], n[u < BUCKETS]))
            kept = pa.nulls(block.num_rows, pa.string())
            if whole:  # whole texts up to CALIBRATION_BYTES in all; the sample is one task after its limit
                size = np.cumsum([len(t.encode()) for t in strings_of(block.column("text"))]) + sent[0]
                kept = pa.array([t if n <= CALIBRATION_BYTES else None for t, n in zip(block.column("text").to_pylist(), size)], pa.string())
                sent[0] = int(size[-1]) if len(size) else sent[0]
            yield batch_of(schema, block.column("lang"), kept, counted)

    labelled = docs.filter(use & F.col("lang").isNotNull()).withColumn("draw", F.xxhash64("doc_id", F.lit(SEED)))
    # Only about twice as many rows as are wanted reach the sort, whatever the number of tasks.
    share = min(1.0, (2 * rows + 200) / max(1, labelled.select("draw").count()))
    near = labelled.filter((F.pmod("draw", F.lit(1 << 30)) < int(share * (1 << 30))) & F.col("text").isNotNull())
    sample = near.withColumn("tie", F.crc32(F.encode("text", "UTF-8"))).orderBy(F.pmod("draw", F.lit(1 << 30)), "draw", "tie", "lang").limit(rows)
    return widened(sample.select("lang", "text").mapInArrow(work, "lang string, text string, counted binary").toArrow())


class Examples:
    """Collected rows as views of the table they came in: buckets and counts lie in memory once, weights are made a batch at a time."""

    def __init__(self, table: pa.Table, langs: list[str]):
        self.label = np.array([langs.index(x) if x in langs else -1 for x in table["lang"].to_pylist()])
        self.text = table["text"].to_pylist()
        self.bucket = [np.asarray(x.values) for x in table["bucket"]]
        self.times = [np.asarray(x.values) for x in table["times"]]
        self.total = np.array([max(1, x.sum()) for x in self.times])

    def batch(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Buckets, weights and place in the batch, of all rows of a batch."""
        place = np.repeat(np.arange(len(rows)), [len(self.bucket[i]) for i in rows])
        return np.concatenate([self.bucket[i] for i in rows]), np.concatenate([self.times[i] for i in rows]) / self.total[rows][place], place

    def means(self, table: np.ndarray, rows: np.ndarray) -> np.ndarray:
        out = np.zeros((len(rows), table.shape[1]))
        for start in range(0, len(rows), MEANS_ROWS):
            some = rows[start : start + MEANS_ROWS]
            bucket, weight, place = self.batch(some)
            for d in range(table.shape[1]):
                out[start : start + len(some), d] = np.bincount(place, weight * table[bucket, d], len(some))
        return out


def _one_stretch(words) -> str:
    """Words joined by blanks, as many as fit in STRETCH bytes."""
    out, size = [], 0
    for w in words:
        size += len(w.encode()) + 1
        if size > STRETCH and out:
            break
        out.append(w)
    return " ".join(out)


def _parts(texts: list[str], most: int = CALIBRATION_BLOCK) -> list[list[str]]:
    """The texts in runs of about ``most`` bytes (a longer text is a run of its own)."""
    runs, run, size = [], [], 0
    for t in texts:
        if run and size + len(t) > most:
            runs.append(run)
            run, size = [], 0
        run.append(t)
        size += len(t)
    return runs + [run] if run else runs


def _measured(model: Model, texts: list[str], rng: np.random.Generator | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Surest stretch, familiarity and count of wordy n-grams of each text, a run of texts at a time.

    With ``rng`` the letters of the texts are first replaced by random ones.
    """
    out = [], [], []
    for part in _parts(texts):
        real = Texts.of(pa.array(part, pa.string()))
        if rng is not None:
            real = Texts(np.where(BLANK[real.data], real.data, rng.integers(97, 123, len(real.data)).astype(np.uint8)), real.start)
        best, known = model.measures(real)
        counts = sum((np.bincount(wordy(real, n)[1], minlength=len(real)) for n in SIZES), np.zeros(len(real), int))
        for into, x in zip(out, (best, known, counts)):
            into.append(x)
    return tuple(np.concatenate(x) if x else np.zeros(0) for x in out)


def calibrate(model: Model, texts: list[str], right: np.ndarray) -> None:
    """Limits of score and familiarity from held-out texts, and from the same texts with random letters in their place.

    A limit lets all but RIGHT_REJECTED of the texts that are predicted rightly pass.  That of
    the score also lets pass pairs of them that alternate word by word; that of familiarity lies halfway to those of random letters, which are no language, if they lie lower.
    Texts are measured in runs of CALIBRATION_BLOCK bytes, so the driver's memory is bounded by that, not by the sample.
    """
    model.usual = 0.0
    _, plain, counts = _measured(model, texts)
    long = counts >= 4 * PRIOR
    raw = plain * (counts + PRIOR)
    model.usual = float(raw[right].sum() / max(1, counts[right].sum()))
    best, known, _ = _measured(model, texts)
    if not right.any():
        return
    # A clean text that changes its language with every word, within one stretch, is the least sure one.
    turns = [_one_stretch(w for pair in zip(a.split(), b.split()) for w in pair) for a, b in zip(texts, texts[1:] + texts[:1])]
    turned = _measured(model, [t for t in turns if t])[0]
    model.least = min(float(np.quantile(x, RIGHT_REJECTED)) for x in (best[right], turned) if len(x))
    model.familiar = float(np.quantile(known[right], RIGHT_REJECTED))
    noise = _measured(model, texts, np.random.default_rng(SEED))[1]
    if long.any():
        model.familiar = min(model.familiar, (model.familiar + float(np.quantile(noise[long], 1 - RIGHT_REJECTED))) / 2)


def train(docs: DataFrame, learn: Column, check: Column) -> Model | None:
    """A model from rows (doc_id, text, lang) where ``learn`` holds, calibrated on those where ``check`` holds.

    Without a labelled row there is no model.  The driver holds one of the two samples at a time.
    """
    found = examples(docs, learn, TRAIN_ROWS)
    langs = sorted(set(found["lang"].to_pylist()))
    if not langs:
        return None
    data = Examples(found, langs)
    rng = np.random.default_rng(SEED)
    embed = rng.normal(0, 0.1, (BUCKETS, DIMENSIONS))
    weight = np.zeros((DIMENSIONS, len(langs)))
    weight[:] = rng.normal(0, 0.1, weight.shape)
    bias = np.zeros(len(langs))
    per_pass = len(data.label) // BATCH + 1
    passes = max(EPOCHS, -(-MIN_STEPS // per_pass))
    steps, step = passes * per_pass, 0
    for _ in range(passes):
        order = rng.permutation(len(data.label))
        for i in range(0, len(order), BATCH):
            rows = order[i : i + BATCH]
            rate = RATE * (1 - step / (steps + 1))
            step += 1
            mean = data.means(embed, rows)
            error = softmax(mean @ weight + bias)
            error[np.arange(len(rows)), data.label[rows]] -= 1
            error /= len(rows)
            bucket, share, place = data.batch(rows)
            back = error @ weight.T
            weight -= rate * (mean.T @ error)
            bias -= rate * error.sum(axis=0)
            # A bucket's gradient is its share of a text; scaling it up to the text's length keeps steps even.
            np.subtract.at(embed, bucket, (rate * 50 * share)[:, None] * back[place])
    table = np.vstack([embed @ weight, np.zeros(len(langs))])
    seen = np.full(BUCKETS, 0.5)
    for bucket, times in zip(data.bucket, data.times):
        seen[bucket] += times
    model = Model(langs, table, bias, np.append(np.log(seen / seen.sum()), 0.0))
    del found, data, bucket, times, embed
    pa.default_memory_pool().release_unused()
    relieve(docs.sparkSession)
    held = Examples(examples(docs, check, CALIBRATION_ROWS, whole=True), langs)
    known = np.flatnonzero(held.label >= 0)
    if len(known):
        logits = held.means(table, known) + bias
        truth = held.label[known]
        losses = {t: -np.log(softmax(logits / t)[np.arange(len(known)), truth] + 1e-12).mean() for t in np.geomspace(0.02, 10, 120)}
        model.temperature = float(min(losses, key=losses.get))
        whole = np.array([held.text[i] is not None for i in known], bool)
        right = model.probabilities(logits).argmax(axis=1) == truth
        texts = [held.text[i] for i in known[whole]]
        del held
        pa.default_memory_pool().release_unused()
        calibrate(model, texts, right[whole])
    return model


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """``docs`` with lang_pred, score (0 to 1) and rejected; input columns of these names are replaced.

    A null text and one without a letter get ``und``, score 0 and are rejected, as does
    everything if there is no model.  Only the text is read.
    """
    docs = docs.drop(*OUTPUT)
    held = docs.sparkSession.sparkContext.broadcast(model)
    kept = docs.columns
    marked = docs.withColumn("lang_pred", F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).cast("string"))

    def work(batches):
        m = held.value
        for block in blocks(batches, "text", PREDICT_BLOCK):
            letters = np.array(block.column("lang_pred").to_pylist()) == "true"
            best = np.zeros(block.num_rows, int)
            score = np.zeros(block.num_rows)
            surest, known_as = score, score
            if m is not None:
                surest, known_as = m.measures(Texts.of(block.column("text")))
                sure = m.probabilities(m.logits(Texts.of(block.column("text"))))
                best, score = sure.argmax(axis=1), sure.max(axis=1)
            known = letters & (m is not None)
            score = np.where(known, score, 0.0)
            rejected = ~known | (surest < (m.least if m else 0)) | (known_as < (m.familiar if m else 0))
            names = [m.langs[b] if k else UNKNOWN for b, k in zip(best, known)]
            columns = [block.column(c) for c in kept]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(names, pa.string()), pa.array(score), pa.array(rejected)], names=[*kept, *OUTPUT])

    new = StructType().add("lang_pred", "string").add("score", "double").add("rejected", "boolean")
    return marked.mapInArrow(work, StructType([*docs.schema, *new]))


def held_out(modulus: int = 5) -> Column:
    return F.pmod(crc_of_id("doc_id"), F.lit(modulus)) == 0


def identify(docs: DataFrame) -> DataFrame:
    """Train on the rows of ``docs`` that are not held out, then predict every row."""
    part = F.pmod(crc_of_id("doc_id"), F.lit(5))
    sample = docs.select("doc_id", "text", "lang")
    model = train(sample, part.isin(2, 3, 4), part == 1)
    return predict(docs, model)

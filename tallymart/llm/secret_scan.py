"""Secrets in texts: a pattern proposes, a random forest trained on labelled findings removes false positives.

The forest (Spark ML) sees a candidate's length, its character transitions, how much of it
dictionary words cover, the path it stands under and the words around it.  The dictionary
is the most frequent words of the whole corpus; transitions are rated by how common they
are in those words.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymart.llm.tables import Scratch, batch_of, blocks, strings_of
from tallymart.llm.words import Texts

#: A run of so many characters that keys are written in.
CANDIDATE = re.compile(r"[A-Za-z0-9+/=_-]{16,}+")
DICTIONARY_WORDS = 5000
#: Distinct words that a task holds before it reports their counts so far.
PORTION_WORDS = 200_000
#: Labelled findings that the forest is fitted to at most.
TRAIN_ROWS = 6000
TREES, DEPTH, SEED = 20, 6, 17
KEPT_FROM = 0.5
AROUND = 32
#: Words before an assignment that name a secret.
NAMES = ("token", "secret", "password", "passwd", "key", "api", "apikey", "auth", "credential", "access", "private", "bearer")
NAME = re.compile("|".join(NAMES), re.IGNORECASE)
#: From a name of NAMES on: the rest of its identifier, an assignment, and a value, quoted or up to the next blank.
VALUE = re.compile(
    r"""[\w.\-]{0,64}+["'`\])]{0,3}+[ \t]{0,16}+(?:=>|:=|={1,3}|:)[ \t]{0,16}+(?:(?:bearer|basic)[ \t]{1,16}+)?"""
    r"""(?:"((?:[^"\\\r\n]|\\.){6,}+)"|'((?:[^'\\\r\n]|\\.){6,}+)'|`([^`\r\n]{6,}+)`|([^\s"'`]\S{5,}+))""",
    re.IGNORECASE,
)
#: The same inside an address.
PAIR = re.compile(r"[\w.\-]{0,64}+=([^&#\s]*+)")
#: What ends an unquoted value and does not belong to it.
TAIL = ",;"
#: Beginnings of well-known key formats.
PREFIXES = ("AKIA", "ASIA", "ghp_", "gho_", "github_pat_", "xoxb-", "xoxp-", "sk_live_", "sk-", "eyJ", "AIza", "glpat-")
#: Parts of a path under which keys are seldom real.
MOCK_PATHS = ("test", "example", "sample", "fixture", "doc", "mock")
FEATURES = (
    "length", "distinct", "entropy", "switches", "digits", "upper", "rarity", "covered", "mock_path", "path_length", "named", "assigned", "quoted", "prose",
)


def dictionary(docs: DataFrame) -> list[tuple[str, int]]:
    """The most frequent words of three letters and more over all texts, with counts (at most DICTIONARY_WORDS).

    Every task counts all its words and reports them in portions of PORTION_WORDS; the sums are those of the whole table.
    """
    schema = pa.schema([("word", pa.string()), ("n", pa.int64())])

    def work(batches):
        total: Counter = Counter()
        for block in blocks(batches, "text"):
            texts = Texts.of(block.column("text"))
            words = texts.words()
            hashes = words.hashes(lower=True)
            _, first, n = np.unique(hashes, return_index=True, return_counts=True)
            data = texts.data.tobytes()
            for i, c in zip(first.tolist(), n.tolist()):
                word = data[words.begin[i] : words.end[i]].decode().lower().strip(".,;:!?\"'()")
                if 3 <= len(word) <= 20 and word.isalpha():
                    total[word] += c
            if len(total) >= PORTION_WORDS:
                yield batch_of(schema, list(total), list(total.values()))
                total.clear()
        if total:
            yield batch_of(schema, list(total), list(total.values()))

    found = docs.select("text").mapInArrow(work, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return [(r["word"], r["n"]) for r in found.orderBy(F.desc("n"), "word").limit(DICTIONARY_WORDS).collect()]


class Lexicon:
    def __init__(self, words: list[tuple[str, int]]):
        self.words = {w for w, _ in words}
        #: The lengths of the words that begin with three letters, the longest first.
        self.sizes: dict[str, list[int]] = {}
        for w in self.words:
            self.sizes.setdefault(w[:3], []).append(len(w))
        for head, found in self.sizes.items():
            self.sizes[head] = sorted(set(found), reverse=True)
        pairs: Counter = Counter()
        for w, n in words:
            for a, b in zip(w, w[1:]):
                pairs[a + b] += n
        total = sum(pairs.values()) + 40 * 40
        self.rate = {p: math.log((n + 1) / total) for p, n in pairs.items()}
        self.floor = math.log(1 / total)

    def rarity(self, text: str) -> float:
        """Mean surprise of two characters following each other, by the dictionary's words."""
        low = text.lower()
        return -sum(self.rate.get(low[i : i + 2], self.floor) for i in range(len(low) - 1)) / max(1, len(low) - 1)

    def covered(self, text: str) -> float:
        """Share of characters in dictionary words, the longest first from left to right."""
        low, at, inside = text.lower(), 0, 0
        while at < len(low):
            size = next((k for k in self.sizes.get(low[at : at + 3], ()) if low[at : at + k] in self.words), 0)
            inside += size
            at += size or 1
        return inside / max(1, len(low))


def kind(c: str) -> str:
    return "0" if c.isdigit() else "A" if c.isupper() else "a" if c.islower() else "-"


def assigned_values(text: str) -> list[tuple[int, int]]:
    """Where the values lie that are assigned to a name of NAMES; a value ends where the text is read on.

    An address may hold assignments of its own (?token=..&key=..), which are read too.
    """
    out, at = [], 0
    while named := NAME.search(text, at):
        found = VALUE.match(text, named.end())
        if not found:
            at = named.end()
            continue
        start, end = found.span(found.lastindex)
        if found.lastindex == 4:
            end = start + len(text[start:end].rstrip(TAIL))
        if end - start >= 6:
            out.append((start, end))
        value, inner = text[start:end], 0
        while "://" in value and (named := NAME.search(value, inner)):
            pair = PAIR.match(value, named.end())
            inner = pair.end() if pair else named.end()
            if pair and len(pair[1]) >= 6:
                out.append((start + pair.start(1), start + pair.end(1)))
        at = max(end, start)
    return out


def spans(text: str) -> list[tuple[int, int, bool]]:
    """Start and end of every candidate in order, and whether it is the value of a name of NAMES."""
    values = set(assigned_values(text))
    return sorted({(*m.span(), m.span() in values) for m in CANDIDATE.finditer(text)} | {(a, b, True) for a, b in values})


def described(text: str, start: int, end: int, path: str, lexicon: Lexicon, value: bool = False) -> list[float]:
    """The numbers of FEATURES for one candidate; ``value``: it is known to be the value of a name of NAMES."""
    held = text[start:end]
    count = Counter(held)
    entropy = -sum(n / len(held) * math.log2(n / len(held)) for n in count.values())
    kinds = [kind(c) for c in held]
    before, after = text[max(0, start - AROUND) : start], text[end : end + AROUND]
    near = re.findall(r"[a-z]+", before.lower().replace("_", " "))
    around = re.findall(r"[^\W\d_]+", (before + " " + after).lower())
    return [
        float(len(held)), len(count) / len(held), entropy, sum(a != b for a, b in zip(kinds, kinds[1:])) / len(held),
        kinds.count("0") / len(held), kinds.count("A") / len(held), lexicon.rarity(held), lexicon.covered(held),
        float(any(m in path.lower() for m in MOCK_PATHS)), float(len(path)), float(value or any(w in NAMES for w in near[-3:])),
        float(value or bool(re.search(r"[=:]\s*[\"']?$", before))), float(before[-1:] in ("'", '"') and after[:1] in ("'", '"')),
        sum(w in lexicon.words for w in around) / max(1, len(around)),
    ]


def rule_label(whole: str, features: list[float]) -> int | None:
    """1 or 0 where a finding is beyond doubt by its form, else None: the stand-in for findings labelled by people."""
    f = dict(zip(FEATURES, features))
    if whole.startswith(PREFIXES) or (f["named"] and f["assigned"] and f["digits"] < 1 and f["entropy"] > 2.5 and f["covered"] <= 0.6):
        return 1
    if f["named"] and f["assigned"] and f["quoted"] and f["digits"] < 1 and f["entropy"] > 2.5:
        return None  # words in quotes after such a name: a passphrase or a remark
    if f["digits"] == 1 or f["covered"] > 0.6 or f["distinct"] < 0.15 or (not f["assigned"] and not f["named"] and f["entropy"] < 3):
        return 0
    return None


def candidates(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """doc_id, start, end (code points), candidate, FEATURES, rule (label by form, or null)."""
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("end", pa.int64()), ("candidate", pa.string()), *((f, pa.float64()) for f in FEATURES), ("rule", pa.int32())])
    held = docs.sparkSession.sparkContext.broadcast(lexicon)

    def work(batches):
        for block in blocks(batches, "text"):
            rows = []
            for doc, text, path in zip(block.column("doc_id").to_pylist(), strings_of(block.column("text")), strings_of(block.column("path"))):
                for start, end, value in spans(text):
                    f = described(text, start, end, path, held.value, value)
                    rows.append((doc, start, end, text[start:end], *f, rule_label(text[start:end], f)))
            if rows:
                yield batch_of(schema, *(list(c) for c in zip(*rows)))

    columns = ", ".join(f"{f} double" for f in FEATURES)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.col("source").alias("path")).mapInArrow(
        work, f"doc_id long, start long, end long, candidate string, {columns}, rule int")


def scan(docs: DataFrame, findings: DataFrame | None = None) -> DataFrame:
    """doc_id, start, end, candidate, score, kept: every candidate of ``docs`` (doc_id, text, source as its path).

    ``findings`` (doc_id, start, is_secret) are labelled findings to learn from; without
    them the findings whose form leaves no doubt are.  Where labels of one kind or none
    exist, nothing can be learned: the score is that label's share, or 0.5.  Null or empty
    texts have no candidate, a null path is an empty one; rows with null or repeated ids are
    rows like any other (labels are matched by id and start); other columns are ignored; no rows
    give none.
    """
    scratch = Scratch(docs.sparkSession, "secret-scan")
    found = scratch.put("candidates", candidates(docs, Lexicon(dictionary(docs))))
    if findings is None:
        known = found.filter("rule is not null").withColumn("label", F.col("rule").cast("double"))
    else:
        labels = findings.groupBy(F.col("doc_id").alias("of_doc"), F.col("start").alias("of_start")).agg(F.max(F.col("is_secret").cast("double")).alias("label"))
        known = found.join(labels, (F.col("doc_id") == F.col("of_doc")) & (F.col("start") == F.col("of_start"))).drop("of_doc", "of_start")
    draw = F.xxhash64("doc_id", "start", F.lit(SEED))
    known = scratch.put("known", known.orderBy(draw, "doc_id", "start", "candidate").limit(TRAIN_ROWS))
    kinds = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    out = ("doc_id", "start", "end", "candidate")
    if len(kinds) < 2:
        return found.select(*out, F.lit(next(iter(kinds), 0.5)).alias("score")).withColumn("kept", F.col("score") >= KEPT_FROM)
    assembled = VectorAssembler(inputCols=list(FEATURES), outputCol="features")
    weight = F.when(F.col("label") == 1, kinds[0.0] / sum(kinds.values())).otherwise(kinds[1.0] / sum(kinds.values()))
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED, weightCol="weight", featuresCol="features", labelCol="label")
    model = forest.fit(assembled.transform(known.withColumn("weight", weight)).select("features", "label", "weight"))
    rated = model.transform(assembled.transform(found))
    return rated.select(*out, vector_to_array("probability")[1].alias("score")).withColumn("kept", F.col("score") >= KEPT_FROM)

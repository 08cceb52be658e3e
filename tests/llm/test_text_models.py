"""Language ID, line field, mixing: held-out accuracy, gradients, targets, edges."""

import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallymart.llm import langid, line_crf, mixing
from tallymart.llm.queries import QUERIES
from tallymart.llm.tables import documents
from tallymart.llm.words import Texts

SF = "/root/testdata/sf0.01"


def test_buckets_stay_inside_words_and_texts():
    texts = Texts.of(pa.array(["ab cd", None, "", "ab", "cd x"]))
    for size in langid.SIZES:
        found, valid = langid.buckets(texts, size)
        alone = [langid.buckets(Texts.of(pa.array([t])), size) for t in ("ab cd", "ab", "cd x")]
        assert sorted(found[valid]) == sorted(np.concatenate([f[v] for f, v in alone]))


def test_language_on_held_out_rows(ready):
    found = QUERIES["op3_language_id"](ready, SF).join(documents(ready, SF).select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in found if r["held_out"]]
    assert len(found) == 1000 and len(held) > 100
    assert np.mean([r["lang"] == r["lang_pred"] for r in held]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in found)
    assert sum(r["rejected"] for r in found) < 10


def test_language_edges(edge_docs):
    got = langid.identify(edge_docs)
    assert got.columns == [c for c in edge_docs.columns if c not in langid.OUTPUT] + list(langid.OUTPUT)
    rows = got.select("text", *langid.OUTPUT).collect()
    assert len(rows) == edge_docs.count()
    for r in rows:
        letterless = not any(c.isalpha() for c in r["text"] or "")
        assert (r["lang_pred"] == "und") == letterless
        assert not letterless or (r["score"] == 0 and r["rejected"])
        assert letterless or r["lang_pred"] in ("en", "fr")


def test_language_without_labels_or_rows(edge_docs, no_docs):
    assert {r["lang_pred"] for r in langid.identify(edge_docs.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
    assert langid.identify(no_docs).count() == 0


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(0)
    owner = np.array([0, 0, 0, 1, 2, 2])
    unary, passing = rng.normal(size=(6, 2)), rng.normal(size=(2, 2))
    got, pairs = line_crf.Chains(owner).marginals(unary, passing)
    want, want_pairs = np.zeros((6, 2)), np.zeros((2, 2))
    for lines in ([0, 1, 2], [3], [4, 5]):
        total = 0.0
        state, step = np.zeros((6, 2)), np.zeros((2, 2))
        for code in range(2 ** len(lines)):
            s = [code >> i & 1 for i in range(len(lines))]
            weight = np.exp(sum(unary[i, x] for i, x in zip(lines, s)) + sum(passing[a, b] for a, b in zip(s, s[1:])))
            total += weight
            for i, x in zip(lines, s):
                state[i, x] += weight
            for a, b in zip(s, s[1:]):
                step[a, b] += weight
        want += state / total
        want_pairs += step / total
    assert np.allclose(got, want) and np.allclose(pairs, want_pairs)


def test_quality_on_held_out_rows(ready):
    labels = ready.read.parquet(f"{SF}/labels.parquet")
    found = QUERIES["op10_quality_crf"](ready, SF).join(labels, "doc_id").filter("held_out").collect()
    right = [r["predicted"] == r["quality"] for r in found]
    assert len(found) > 80 and np.mean(right) > 0.95
    assert np.mean([r["predicted"] == 0 for r in found if r["quality"] == 0]) > 0.8


def test_quality_edges(edge_docs, no_docs, ready):
    labels = ready.createDataFrame([(1, 1), (2, 0), (6, 1), (7, 0), (None, 1), (8, None), (3, 1)], "doc_id long, quality int")
    got = line_crf.quality(edge_docs, labels).collect()
    assert len(got) == edge_docs.count() and all(0 <= r["score"] <= 1 for r in got)
    assert {r["score"] for r in got if r["doc_id"] in (4, 5)} == {0.0}
    assert line_crf.quality(no_docs, labels).count() == 0
    assert len(line_crf.quality(edge_docs, labels.filter("false")).collect()) == len(got)


@pytest.fixture(scope="module")
def domains(ready):
    return mixing.labelled_domains(ready.read.parquet(f"{SF}/labels.parquet"))


def test_rates_meet_the_targets(ready, domains):
    table = mixing.mix_rates(documents(ready, SF), domains, mixing.TARGETS)
    k = sorted(mixing.TARGETS)
    row = table.agg(F.sum("tokens").alias("all"), F.min("rate").alias("least"), *(F.sum(F.col("rate") * F.col("tokens") * F.col("posterior")[i]).alias(d) for i, d in enumerate(k))).first()
    assert row["least"] >= 0
    assert all(abs(row[d] / row["all"] - mixing.TARGETS[d]) < 1e-3 for d in k)
    known = table.join(domains, "doc_id").select("domain", "posterior").collect()
    assert np.mean([k[int(np.argmax(r["posterior"]))] == r["domain"] for r in known]) > 0.95


def test_bounded_rates_meet_targets_that_can_be_met(ready):
    rng = np.random.default_rng(1)
    p = rng.dirichlet([0.3, 0.3, 0.3], 60)
    n = rng.integers(1, 90, 60)
    table = ready.createDataFrame([(int(a), [float(x) for x in b]) for a, b in zip(n, p)], "tokens long, posterior array<double>")
    target = np.minimum(rng.exponential(0.5, 60), 1) @ (p * n[:, None])  # met by some rates within the bounds
    gradients = mixing.fit_rates(table, target, 1.0)
    rate = mixing.replay(p, gradients, 1.0)
    assert rate.min() >= 0 and rate.max() <= 1
    assert np.abs(rate @ (p * n[:, None]) - target).max() < 2e-3 * n.sum()


def test_mixing_edges(edge_docs, no_docs, ready):
    labels = ready.createDataFrame([(1, "plain"), (6, "poor"), (11, "toxic"), (None, "plain"), (3, None)], "doc_id long, domain string")
    assert mixing.mix_rates(edge_docs, labels, mixing.TARGETS).count() == edge_docs.count()
    drawn = mixing.draw_by_rate(edge_docs, labels, mixing.TARGETS)
    assert drawn.columns == edge_docs.columns
    held = Counter((r["doc_id"], r["text"]) for r in edge_docs.collect())
    assert all(n in (0, held[x]) for x, n in Counter((r["doc_id"], r["text"]) for r in drawn.collect()).items())
    assert mixing.draw_by_rate(no_docs, labels, mixing.TARGETS).count() == 0
    assert mixing.mix_rates(edge_docs, labels.filter("false"), mixing.TARGETS).count() == edge_docs.count()


def test_other_scripts_and_gibberish_are_rejected_and_mixed_texts_stay(ready):
    rng = np.random.default_rng(2)
    docs = documents(ready, SF).select("doc_id", "text", "lang")
    part = F.pmod(langid.crc_of_id("doc_id"), F.lit(5))
    model = langid.train(docs, part.isin(2, 3, 4), part == 1)
    odd = ["".join(rng.choice(list(x), n)) for x in ("абвгдежзиклмнопрст ", "これは日本語の文章 ", "qzxvkjwbpy ") for n in (60, 400, 3000)]
    long = {x: [r["text"] for r in docs.filter(f"lang = '{x}' and length(text) > 300 and doc_id % 5 != 1").orderBy("doc_id").limit(19).collect()] for x in ("en", "de")}
    mixed = [a[:150] + " " + b[:150] for a, b in zip(long["en"], long["de"])] + [b + " " + a for a, b in zip(long["en"], long["de"])]
    rows = [(i, t) for i, t in enumerate(odd + mixed)]
    found = {r["doc_id"]: r["rejected"] for r in langid.predict(ready.createDataFrame(rows, "doc_id long, text string"), model).collect()}
    assert len(mixed) == 38 and all(found[i] == (i < len(odd)) for i in found)


def test_a_small_table_is_learned(ready):
    """200 documents: every held-out labelled text is named rightly and none with letters is rejected."""
    docs = documents(ready, "/root/testdata/sf0.001").select("doc_id", "text", "lang")
    found = langid.identify(docs).filter(langid.held_out() & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")).toPandas()
    assert len(found) > 20
    assert (found["lang_pred"] == found["lang"]).mean() > 0.95
    assert not found["rejected"].any()


def test_samples_reach_the_driver_small_and_whole(ready, monkeypatch):
    came, widened = [], langid.widened
    monkeypatch.setattr(langid, "widened", lambda table: came.append(table.nbytes) or widened(table))
    docs = documents(ready, SF)
    table = langid.examples(docs, F.col("lang").isNotNull(), 150)
    assert 2 * came[0] < 8 * len(table["bucket"].combine_chunks().values)  # 8 bytes a bucket as integers
    rows = docs.filter("lang is not null and text is not null").select("lang", "text").collect()
    want = set()
    for lang, text in rows:
        found = np.concatenate([langid.buckets(Texts.of(pa.array([text])), s)[0] for s in langid.SIZES])
        want.add((lang, tuple(sorted(Counter(found[found < langid.BUCKETS].tolist()).items()))))
    got = [(r["lang"], tuple(zip(r["bucket"], r["times"]))) for r in table.to_pylist()]
    assert len(got) == 150 and set(got) <= want
    often = langid.shrunk(np.array([0, langid.BUCKETS - 1]), np.array([1, 1 << 20]))
    edge = langid.widened(pa.table({"lang": ["a", "b"], "text": [None, "x"], "counted": [often, langid.shrunk(np.zeros(0), np.zeros(0))]}))
    assert edge["bucket"].to_pylist() == [[0, langid.BUCKETS - 1], []] and edge["times"].to_pylist() == [[1, 1 << 20], []]


def test_collected_examples_lie_in_memory_once():
    rng = np.random.default_rng(2)
    counts = [rng.integers(1, 9, n).astype(np.int32) for n in rng.integers(500, 2500, 1200)]
    held = [rng.choice(langid.BUCKETS, len(c), replace=False).astype(np.int32) for c in counts]
    schema = pa.schema([("lang", pa.string()), ("text", pa.string()), ("bucket", pa.list_(pa.int32())), ("times", pa.list_(pa.int32()))])
    parts = [pa.table([["en", "fr"] * 300, pa.nulls(600, pa.string()), held[i : i + 600], counts[i : i + 600]], schema=schema) for i in (0, 600)]
    table = pa.concat_tables(parts)
    arrow = pa.total_allocated_bytes()
    tracemalloc.start()
    data = langid.Examples(table, ["en", "fr"])
    means = data.means(np.ones((langid.BUCKETS + 1, 2)), np.arange(1200))
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert pa.total_allocated_bytes() - arrow + most < table.nbytes
    assert np.allclose(means, 1)
    bucket, weight, place = data.batch(np.array([7, 200]))
    assert (bucket == np.concatenate([held[7], held[200]])).all() and (place == np.repeat([0, 1], [len(held[7]), len(held[200])])).all()
    assert (weight == np.concatenate([counts[i] / counts[i].sum() for i in (7, 200)])).all()

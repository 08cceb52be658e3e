import random
import re
from collections import Counter

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from tallymart.llm import mixing, pii, tables
from tallymart.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def test_every_query_is_registered_once():
    names = set(entry.queries())
    for n in range(1, 11):
        assert sum(x.startswith(f"op{n}_") for x in names) == 1
    assert "pipeline" in names and set(QUERIES) < names


def test_stages_on_edges_and_whole_run(ready, edge_docs):
    docs = edge_docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(ready, docs, SF)
        assert after.columns == edge_docs.columns, name
        rows = after.select("doc_id", "text").collect()
        held = Counter((r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect())
        if name != "personal_data":
            assert not Counter((r["doc_id"], r["text"]) for r in rows) - held, name
        else:
            assert sum(held.values()) == len(rows)
        docs = ready.createDataFrame(after.collect(), after.schema)
    assert {r["doc_id"] for r in corpus_pipeline.STAGES[-1][1](ready, docs, SF).collect()} == {r["doc_id"] for r in docs.collect()}


def test_clean_documents_pass_and_personal_data_is_masked(ready):
    pieces = corpus_pipeline.run(ready, SF)
    labels = ready.read.parquet(f"{SF}/labels.parquet")
    out = {r["doc_id"] for r in pieces.select("doc_id").distinct().collect()}
    joined = QUERIES["op5_ngram_jaccard_join"](ready, SF).join(labels, "doc_id").filter("doc_id = component_id and quality = 1 and toxic = 0").collect()
    assert len(joined) > 20
    assert {r["doc_id"] for r in joined} <= out


@pytest.mark.parametrize("stage", corpus_pipeline.STAGES[:-1], ids=lambda s: s[0])
def test_stages_take_no_rows(ready, no_docs, stage):
    assert stage[1](ready, no_docs, SF).count() == 0


def test_steps_give_back_a_grown_heap(ready, monkeypatch):
    """Inside the stages of many jobs too, not only between the stages; a small heap is left alone."""
    calls = []
    monkeypatch.setattr(tables, "release", lambda spark: calls.append(spark))
    scratch = tables.Scratch(ready, "test-heap")
    table = ready.createDataFrame([(10, [0.9, 0.1]), (30, [0.2, 0.8])], "tokens long, posterior array<double>")
    for share, least, most in ((0.0, 2, 1000), (2.0, 0, 0)):
        monkeypatch.setattr(tables, "HEAP_SHARE", share)
        calls.clear()
        scratch.put(f"some-{share}", ready.range(3))
        assert len(calls) == (share == 0)
        rounds = len(mixing.fit_rates(table, mixing.np.array([20.0, 20.0]), 1.0))
        assert rounds > 0 and least <= len(calls) <= most and len(calls) == (rounds + 1) * (share == 0)


def test_masked_text_has_no_span_left():
    text = "write x@y.zz or 4532015112830366, call +1 (555) 010-9999"
    assert pii.find(pii.masked(text, pii.find(text))) == []


def five_words(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text.lower())
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def test_near_duplicates_are_those_of_five_words_and_four_fifths(ready):
    rng = random.Random(4)
    rows = []
    for g in range(12):
        base = [f"g{g}w{rng.randrange(300)}" for _ in range(rng.randrange(60, 160))]
        rows.append((len(rows), " ".join(base)))
        for _ in range(4):
            words = list(base)
            for _ in range(rng.randrange(1, 5)):
                words[rng.randrange(len(words))] = f"x{rng.randrange(900)}"
            rows.append((len(rows), " ".join(words)))
    sets = [five_words(t) for _, t in rows]
    part = list(range(len(rows)))
    between = 0
    for a in range(len(rows)):
        for b in range(a):
            shared = len(sets[a] & sets[b])
            alike = shared / (len(sets[a]) + len(sets[b]) - shared)
            between += 0.8 <= alike < 0.85
            if alike >= 0.8:
                old, new = part[a], part[b]
                part = [new if p == old else p for p in part]
    least = {}
    for i, p in enumerate(part):
        least.setdefault(p, i)
    docs = ready.createDataFrame(rows, "doc_id long, text string").repartition(3)
    kept = dict(corpus_pipeline.STAGES)["near_duplicates"](ready, docs, SF)
    assert between and sorted(r["doc_id"] for r in kept.collect()) == sorted(least.values())

from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from tallymart.llm import packing

public_tokenizers = pytest.importorskip("public_tokenizers")
VOCABULARY = "byte_bpe_50k"


@pytest.fixture(scope="module")
def exact():
    return Tokenizer.from_file(public_tokenizers.path(f"{VOCABULARY}.json"))


def test_ids_equal_the_defining_library(exact):
    ids = packing.Ids(VOCABULARY)
    texts = ["", " ", "a b", " a", "a ", "a  b", "a \n b", "x\n\n y", "it's we'll", "tab\t x", "\t \nfoo", "é ñ 12 ²x", "<|endoftext|> a", "a  b", "\x1c x", "end.\nNew 'quoted' (x)", "1234 5 6,7"]
    for t in texts * 2:  # the second time from remembered chunks
        assert list(np.frombuffer(ids.of(t), "<u2")) == exact.encode(t, add_special_tokens=False).ids, repr(t)


def test_edges_round_trip(edge_docs, edge_rows, exact):
    pieces = packing.pack(edge_docs, VOCABULARY).collect()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p["doc_id"]].append(p)
        by_sequence[p["sequence_id"]].append((p["offset"], p["length"]))
    want = defaultdict(list)
    for doc, text, *_ in edge_rows:
        want[doc].append(exact.encode(text or "", add_special_tokens=False).ids + [1])
    for doc, texts in want.items():
        held = sorted(i for t in texts for i in t)
        assert sorted(np.concatenate([np.frombuffer(p["ids"], "<u4") for p in by_doc[doc]])) == held
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    for s, cuts in by_sequence.items():
        at = 0
        for offset, length in sorted(cuts):
            assert offset == at
            at += length
        assert at == 2048 or s == max(by_sequence)
    one = sorted((p["start"], p["ids"]) for p in by_doc[6])
    assert list(np.frombuffer(b"".join(x for _, x in one), "<u4")) == want[6][0]


def test_no_rows(no_docs):
    assert packing.pack(no_docs, VOCABULARY).count() == 0


def round_robin(queues, quanta):
    """Deficit round-robin, one round after another: the order in which items are sent."""
    deficit = dict.fromkeys(queues, 0.0)
    at = dict.fromkeys(queues, 0)
    sent = []
    while any(at[s] < len(q) for s, q in queues.items()):
        for s in sorted(queues):
            if at[s] < len(queues[s]):
                deficit[s] += quanta[s]
                while at[s] < len(queues[s]) and queues[s][at[s]][1] <= deficit[s] + 1e-9:
                    deficit[s] -= queues[s][at[s]][1]
                    sent.append(queues[s][at[s]][0])
                    at[s] += 1
    return sent


def test_order_is_that_of_round_robin(ready, monkeypatch):
    monkeypatch.setattr(packing, "BLOCK_ITEMS", 40)
    rng = np.random.default_rng(2)
    rows = [(i, int(rng.integers(1, 17)), "abc"[int(rng.choice(3, p=[0.7, 0.2, 0.1]))]) for i in range(500)]
    items = ready.createDataFrame(rows, "row long, length long, source string").selectExpr("row", "source", "0L AS start", "length")
    from tallymart.llm.tables import Scratch

    weights = {"a": 2.0, "b": 1.0, "c": 1.0}
    laid = sorted((r["at"], r["row"]) for r in packing.laid_out(items, Scratch(ready, "test"), 16, weights).collect())
    order = [row for _, row in laid]
    length = {i: n for i, n, _ in rows}
    assert [at for at, _ in laid] == [sum(length[r] for r in order[:i]) for i in range(len(order))]
    source = {i: s for i, _, s in rows}
    queues = {s: [(r, length[r]) for r in order if source[r] == s] for s in weights}
    assert order == round_robin(queues, {"a": 8.0, "b": 4.0, "c": 4.0})


def test_weights_have_to_cover_the_sources(edge_docs):
    with pytest.raises(ValueError):
        packing.pack(edge_docs, VOCABULARY, weights={"a": 1.0}).count()


def test_sequences_are_padded_except_at_a_power_of_two(ready):
    rows = [(0, 0, 3, b"\x01\0\0\0\x02\0\0\0\x03\0\0\0"), (1, 0, 2, b"\x07\0\0\0\x08\0\0\0")]
    pieces = ready.createDataFrame(rows, "sequence_id long, offset long, length long, ids binary")
    got = {r["sequence_id"]: (r["n"], len(r["ids"]) // 4) for r in packing.sequences(pieces, window=8).collect()}
    assert got == {0: (3, 8), 1: (2, 2)}

"""Personal data, secrets, quality rules, WARC, top-k."""

import hashlib
import random
import re
from collections import Counter
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

from tallymart.llm import pii, quality_rules, secret_scan, topk_search, warc
from tallymart.llm.queries import QUERIES, SQL
from tools.check_oracle import rows_of

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for f in Path(SF).glob("*.parquet"):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    return con


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(ready, db, name):
    df = QUERIES[name](ready, SF)
    cursor = db.execute(SQL[name])
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of([d[0] for d in cursor.description], cursor.fetchall())


PATTERNS = (
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]",
)


def brute_spans(text):
    out = []
    for kind, pattern in enumerate(PATTERNS):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            double = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
            fits = (True, kind == 1 and all(int(x) <= 255 for x in m[0].split(".")), 14 <= len(digits) <= 19 and sum(x - 9 * (x > 9) for x in double) % 10 == 0, 10 <= len(digits) <= 15)
            if fits[kind]:
                out.append((m.start(), kind, f"{pii.KINDS[kind]}:{m.start()}:{m.end()}"))
    return ",".join(x for _, _, x in sorted(out))


def test_base_spans_equal_plain_patterns():
    rng = random.Random(7)
    whole = ["1.2.3.4", "4532015112830366", "+1 (555) 010-9999", "x@y.zz", "255.256.1.1", "00012.1.1.1"]
    for _ in range(8000):
        text = "".join(rng.choice("a1@. -+()9é0%\n25") if rng.random() < 0.7 else rng.choice(whole) for _ in range(rng.randint(0, 25)))
        base = [s for s in pii.find(text) if s.kind in pii.BASE_KINDS]
        assert pii.listed(base) == brute_spans(text), repr(text)


def test_checksums_and_context():
    assert pii.mod97("GB82 WEST 1234 5698 7654 32") and not pii.mod97("GB82 WEST 1234 5698 7654 33")
    assert pii.luhn("4532015112830366") and not pii.luhn("4532015112830367")
    assert [s.kind for s in pii.find("iban GB82 WEST 1234 5698 7654 32")] == ["iban"]
    assert [s.kind for s in pii.find("call 555-123-4567")] == ["national_phone"]
    assert pii.find("part 555-123-4567") == []
    assert pii.masked("a x@y.zz b 10.0.0.1", pii.find("a x@y.zz b 10.0.0.1")) == "a [EMAIL] b [IP]"


def test_patterns_are_linear():
    for text in ("a" * 400_000 + "@", "1" * 400_000, "1." * 200_000, "+" * 400_000, "@" * 400_000):
        pii.find(text)


def test_pii_edges(edge_docs, no_docs):
    rows = pii.find_pii(edge_docs).collect()
    assert len(rows) == edge_docs.count()
    empty = hashlib.sha256(b"").hexdigest()
    assert all(r["spans"] == "" and r["base_sha256"] == empty for r in rows if r["doc_id"] in (4, 5))
    masked = pii.redact(edge_docs)
    assert masked.columns == edge_docs.columns
    assert Counter(r["text"] for r in masked.collect()) == Counter(r["text"] for r in edge_docs.collect())
    assert pii.find_pii(no_docs).count() == 0 and pii.redact(no_docs).count() == 0


def test_rules_edges(edge_docs, no_docs):
    rows = quality_rules.judge(edge_docs).collect()
    assert len(rows) == edge_docs.count()
    assert all(r["base_failed"] and not r["kept"] for r in rows if r["n_words"] < 50)
    assert quality_rules.judge(no_docs).count() == 0


def test_bins_keep_a_value_to_a_32nd(ready):
    rows = ready.range(0, 200_000, 37).select("id", quality_rules.bin_of(F.col("id")).alias("bin")).collect()
    assert all(r["bin"] <= r["id"] < r["bin"] + max(1, r["id"] / 32 + 1) for r in rows)


def test_secrets(ready):
    rng = random.Random(3)
    secret = lambda: "".join(rng.choice("0123456789abcdef") for _ in range(40))
    rows = [(i, f"lorem ipsum dolor sit {i} " + (f'token = "{secret()}" amet' if i % 3 == 0 else f"order {rng.randrange(10**15, 10**16)} amet"), "src") for i in range(120)]
    found = secret_scan.scan(ready.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    assert len(found) == 120 and all(r["kept"] == (r["doc_id"] % 3 == 0) for r in found)
    # Labels of one's own decide, whatever the form says.
    labels = ready.createDataFrame([(i, rows[i][1].index("order ") + 6, True) for i in range(120) if i % 3] + [(i, rows[i][1].index('"') + 1, False) for i in range(0, 120, 3)], "doc_id long, start long, is_secret boolean")
    turned = secret_scan.scan(ready.createDataFrame(rows, "doc_id long, text string, source string"), labels).collect()
    assert all(r["kept"] == (r["doc_id"] % 3 != 0) for r in turned)


def test_secret_edges(edge_docs, no_docs):
    assert secret_scan.scan(edge_docs).count() == 0
    assert secret_scan.scan(no_docs).count() == 0


def test_archives_with_version_lines_in_payloads(ready):
    rng = random.Random(3)
    fake = "WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:x-page:7777>\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
    rows = []
    for i in range(150):
        html = "".join(rng.choice(["<p>é", "WARC/1.0\r\n", "WARC/1.0", fake, "x" * rng.randint(0, 900), "\r\n\r\n"]) for _ in range(rng.randint(0, 9)))
        rows.append((i, f"http://a/{i} b" if i % 7 else None, html if i % 11 else None))
    rows += [(1000 + i, "u", "same" * 300) for i in range(60)] + [(1000, "u", "same" * 300)] * 2
    before = ready.conf.get("spark.sql.files.maxPartitionBytes")
    ready.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        pages = ready.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'x' AS type", "'y' AS digest").repartition(2)
        got = Counter(tuple(r) for r in warc.archived(pages).collect())
    finally:
        ready.conf.set("spark.sql.files.maxPartitionBytes", before)
    largest = {}
    for i, _, h in rows:
        largest[h or ""] = max(largest.get(h or "", -1), i)
    want = Counter()
    for i, _, h in rows:
        data = (h or "").encode()
        again = len(data) >= 1000 and largest[h or ""] != i
        want[i, len(data), hashlib.sha1(data).hexdigest(), "revisit" if again else "response", largest[h or ""] if again else None, True] += 1
    assert got == want


def test_no_pages(ready):
    assert warc.archived(ready.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_top_k_equals_brute_force(ready, monkeypatch):
    for name, value in (("QUERY_GROUP", 3), ("CANDIDATE_GROUP", 40), ("BINS", 8), ("SCORES", 50)):
        monkeypatch.setattr(topk_search, name, value)
    rng = random.Random(5)
    rows = [(i, [rng.choice([-0.5, 0.0, 0.25, 0.3, 1.0]) for _ in range(3)]) for i in range(400)]
    rows += [(400 + i, [1.0, 1.0, 1.0]) for i in range(90)] + [(700, [1.0, 1.0, 1.0])] * 3
    rows += [(800, None), (801, []), (850, [1.0, None, 0.0]), (851, [float("nan"), 1.0, 1.0]), (852, [float("inf"), 1.0, 1.0]), (None, [1.0, 1.0, 1.0]), (900, [1.0, 2.0])]
    vectors = ready.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 AS score", "2 AS group").repartition(3)
    got = sorted(tuple(r) for r in topk_search.top_k(vectors, F.col("vec_id") % 50 == 0, 5).select("query_id", "rank", "vec_id", "score").collect())
    held = [(i, [int(256 * x // 1) for x in v]) for i, v in rows if i is not None and v and all(x is not None and abs(x) < 1e9 for x in v)]
    want = []
    for q, x in {i: v for i, v in held if i % 50 == 0}.items():
        best = sorted((-sum(a * b for a, b in zip(x, v)), i) for i, v in held if i != q and len(v) == len(x))[:5]
        want += [(q, r + 1, i, -s) for r, (s, i) in enumerate(best)]
    assert got == sorted(want)


def test_top_k_of_few_and_none(ready):
    few = ready.createDataFrame([(0, [1.0]), (1, [0.5]), (2, [-3.0])], "vec_id long, embedding array<double>")
    assert sorted(tuple(r) for r in topk_search.top_k(few, F.col("vec_id") == 0).collect()) == [(0, 1, 1, 256 * 128), (0, 2, 2, 256 * -768)]
    assert topk_search.top_k(few.filter("false"), F.col("vec_id") == 0).count() == 0


def test_dictionary_counts_every_word(ready):
    rng = random.Random(8)
    texts = [" ".join("".join(rng.choice("abcdeé") for _ in range(rng.randrange(2, 6))) + rng.choice(["", ",", "."]) for _ in range(300)) for _ in range(40)]
    texts = [t + f" seldom{chr(97 + i % 3)}" for i, t in enumerate(texts)] + ["Once", None, ""]
    want = Counter(w for t in texts if t for x in t.split() if len(w := x.lower().strip(".,")) >= 3)
    docs = ready.createDataFrame([(t,) for t in texts], "text string")
    got = [secret_scan.dictionary(docs.repartition(n)) for n in (1, 7)]
    assert got[0] == got[1] == sorted(want.items(), key=lambda x: (-x[1], x[0]))[: secret_scan.DICTIONARY_WORDS]


def test_long_candidates_are_described_whole():
    lexicon = secret_scan.Lexicon([("needle", 3), ("need", 2)])
    ends, middle = "0123456789abcdef" * 16, "NeedleNeed" * 400
    f = dict(zip(secret_scan.FEATURES, secret_scan.described(ends + middle + ends, 0, 4512, "", lexicon)))
    count = Counter(ends + middle + ends)
    assert f["length"] == 4512 and f["distinct"] == len(count) / 4512
    assert f["covered"] == 4000 / 4512 and f["upper"] == 800 / 4512 and f["digits"] == 320 / 4512


def test_values_of_names_and_runs_without_digits_are_proposed():
    cases = {
        'password = "Tr0ub4dor&3"': ["Tr0ub4dor&3"], "DB_PASSWD=p@ss!w$rd, next": ["p@ss!w$rd"], '{"apiKey": "a.b:c d?e"}': ["a.b:c d?e"],
        "secret := 'it\\'s me'": ["it\\'s me"], "Authorization: Bearer ab.cd.ef.gh": ["ab.cd.ef.gh"], "see abcdefghijklmnopqrstuv there": ["abcdefghijklmnopqrstuv"],
        "token=https://a.b/?key=s3cr.t!&x=1": ["https://a.b/?key=s3cr.t!&x=1", "s3cr.t!"], "password: short": [], "colour = 'Tr0ub4dor&3'": [], "the key to it": [],
        "key=" * 5 + "0123456789abcdef": ["key=" * 4 + "0123456789abcdef", "key=" * 5 + "0123456789abcdef"],
    }
    for text, want in cases.items():
        assert sorted(text[a:b] for a, b, _ in secret_scan.spans(text)) == sorted(want), text
    for text in ("key=" * 100_000, "key" * 100_000, 'key="' * 80_000, "key=http://" * 40_000, "key: '\\" * 50_000):
        secret_scan.spans(text)


def test_short_and_digitless_secrets_are_kept(ready):
    rng = random.Random(5)
    mark = lambda: "".join(rng.choice("abcXYZ!@$.:&") for _ in range(11))
    rows = [(i, f"lorem ipsum dolor sit {i} " + (f'password = "{mark()}" amet' if i % 3 == 0 else f"order {rng.randrange(10**15, 10**16)} amet"), "src") for i in range(120)]
    found = secret_scan.scan(ready.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    assert {r["doc_id"] for r in found if r["kept"]} == {i for i in range(0, 120, 3)}

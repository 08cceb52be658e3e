"""Personal data in texts: patterns propose, checksums confirm, nearby words adjust the score.

Every pattern is written so that one pass over a text is linear in its length, also over
megabytes of digits or of one letter.
"""

from __future__ import annotations

import hashlib
import re
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame

from tallymart.llm.tables import batch_of, blocks, strings_of

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
DIGIT = re.compile("[0-9]")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?:\x20[A-Z0-9]{4}){2,7}(?:\x20[A-Z0-9]{1,3})?)(?![A-Za-z0-9])")
NATIONAL = re.compile(r"(?<![0-9+(])(?:\([0-9]{3}\)\x20?|[0-9]{3}[\x20.-])[0-9]{3}[\x20.-][0-9]{4}(?![0-9])")

#: In the order in which spans that begin together are listed; the last two are the method's own.
KINDS = ("email", "ip", "card", "phone", "iban", "national_phone")
BASE_KINDS = KINDS[:4]
#: Score of a proposal that its validator has confirmed (or that has none).
CONFIRMED = {"email": 0.9, "ip": 0.7, "card": 0.9, "phone": 0.8, "iban": 0.9, "national_phone": 0.4}
#: Words (lower case) that move a kind's score if they stand in the text just before the span.
CONTEXT = {
    "email": (("mail", "contact", "write", "kontakt", "correo", "courriel"), ()),
    "ip": (("ip", "host", "server", "address", "login"), ("version", "release", "section", "chapter")),
    "card": (("card", "visa", "credit", "payment", "karte", "carte", "tarjeta"), ("order", "isbn", "tracking", "serial")),
    "phone": (("phone", "tel", "call", "mobile", "fax", "telefon", "téléphone", "teléfono"), ()),
    "iban": (("iban", "account", "bank", "konto", "compte", "cuenta"), ()),
    "national_phone": (("phone", "tel", "call", "mobile", "fax", "telefon", "téléphone", "teléfono"), ("order", "isbn", "serial", "part")),
}
CONTEXT_CHARS, CONTEXT_STEP = 40, 0.3
#: Spans of the method's own kinds count from this score on; those of the base kinds always do.
ACCEPTED = 0.6


class Span(NamedTuple):
    start: int
    end: int
    kind: str
    score: float


def luhn(digits: str) -> bool:
    odd = sum(map(int, digits[-1::-2]))
    even = sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return (odd + even) % 10 == 0


def mod97(iban: str) -> bool:
    code = iban.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in code[4:] + code[:4])) % 97 == 1


def emails(text: str):
    """Leftmost non-overlapping addresses, found from their @: nothing else can follow a local part."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in LOCAL:
            start -= 1
        found = DOMAIN.match(text, at + 1) if start < at else None
        if found:
            free = found.end()
            yield start, free
        at = text.find("@", max(at + 1, free))


def only_digits(piece: str) -> str:
    return "".join(c for c in piece if "0" <= c <= "9")


def base_spans(text: str):
    """(kind, start, end) of confirmed matches of the four base kinds; a failing match is dropped."""
    for start, end in emails(text):
        yield "email", start, end
    if not DIGIT.search(text):
        return
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p[-3:]) <= 255 for p in m[0].split(".")):
            yield "ip", *m.span()
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 14 and 14 <= len(digits := only_digits(m[0])) <= 19 and luhn(digits):
            yield "card", *m.span()
    if "+" in text:
        for m in PHONE.finditer(text):
            if 10 <= len(only_digits(m[0])) <= 15:
                yield "phone", *m.span()


def own_spans(text: str):
    for m in IBAN.finditer(text):
        if mod97(m[0]):
            yield "iban", *m.span()
    for m in NATIONAL.finditer(text):
        yield "national_phone", *m.span()


def score(text: str, kind: str, start: int) -> float:
    near = re.findall(r"\w+", text[max(0, start - CONTEXT_CHARS) : start].lower())
    for_it, against = CONTEXT[kind]
    step = CONTEXT_STEP * (any(w in for_it for w in near) - any(w in against for w in near))
    return round(min(1.0, max(0.0, CONFIRMED[kind] + step)), 3)


def find(text: str) -> list[Span]:
    """All accepted spans by start, then kind; the method's own never overlap another."""
    spans = [Span(s, e, k, score(text, k, s)) for k, s, e in base_spans(text)]
    if DIGIT.search(text):
        taken = [(x.start, x.end) for x in spans]
        for kind, start, end in own_spans(text):
            rated = score(text, kind, start)
            if rated >= ACCEPTED and not any(start < e and s < end for s, e in taken):
                spans.append(Span(start, end, kind, rated))
                taken.append((start, end))
    return sorted(spans, key=lambda x: (x.start, KINDS.index(x.kind)))


def listed(spans: list[Span]) -> str:
    return ",".join(f"{x.kind}:{x.start}:{x.end}" for x in spans)


def masked(text: str, spans: list[Span]) -> str:
    """Each span becomes its kind in brackets; of overlapping ones the first names the whole stretch."""
    out, at, i = [], 0, 0
    while i < len(spans):
        start, end, kind = spans[i][:3]
        while i + 1 < len(spans) and spans[i + 1].start < end:
            i += 1
            end = max(end, spans[i].end)
        out += [text[at:start], f"[{kind.upper()}]"]
        at, i = end, i + 1
    return "".join([*out, text[at:]])


def find_pii(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, found (array of kind, start, end, score), counts, digests.

    Offsets are code points, the end exclusive.  A null or empty text has no span; a row
    with a null id, or a repeated one, is treated like any other; further columns are
    ignored, whatever their names; no rows give none.  ``base_sha256`` covers the base
    kinds, ``spans`` all accepted spans.
    """
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])
    schema = pa.schema([("doc_id", pa.int64()), ("found", pa.list_(span)), *((f"n_{k}", pa.int64()) for k in BASE_KINDS), ("base_sha256", pa.string()), ("spans", pa.string())])

    def work(batches):
        for block in blocks(batches, "text"):
            every = [find(t) for t in strings_of(block.column("text"))]
            base = [[x for x in spans if x.kind in BASE_KINDS] for spans in every]
            yield batch_of(
                schema, block.column("doc_id"),
                pa.array([[{"kind": x.kind, "start": x.start, "end": x.end, "score": x.score} for x in spans] for spans in every], pa.list_(span)),
                *([sum(x.kind == k for x in spans) for spans in base] for k in BASE_KINDS),
                [hashlib.sha256(listed(spans).encode()).hexdigest() for spans in base], [listed(spans) for spans in every],
            )

    columns = ", ".join(f"n_{k} long" for k in BASE_KINDS)
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), "text").mapInArrow(
        work, f"doc_id long, found array<struct<kind: string, start: bigint, end: bigint, score: double>>, {columns}, base_sha256 string, spans string")


def redact(docs: DataFrame) -> DataFrame:
    """The same rows and columns, with every accepted span of ``text`` masked and ``n_chars``, if there, counted again.

    A null text stays null.
    """
    names = docs.columns

    def work(batches):
        for block in blocks(batches, "text"):
            texts = [t if t is None else masked(t, find(t)) for t in block.column("text").to_pylist()]
            columns = dict(zip(names, block.columns))
            if "n_chars" in columns:
                counted = [old if t is None else len(t) for t, old in zip(texts, columns["n_chars"].to_pylist())]
                columns["n_chars"] = pa.array(counted, columns["n_chars"].type)
            columns["text"] = pa.array(texts, columns["text"].type)
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=names)

    return docs.mapInArrow(work, docs.schema)

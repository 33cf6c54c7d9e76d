"""Personal data: patterns propose spans, checksums confirm them, words nearby adjust their score."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tabwright.llm.batches import slices, texts_of

# Kinds in their order, patterns, and words that speak for a kind when they stand close by.
KINDS = ("email", "ip", "card", "phone", "iban")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
LOCAL_SIGNS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
CONTEXT = {
    "email": ("mail", "contact", "write", "address"),
    "ip": ("ip", "host", "server", "address"),
    "card": ("card", "visa", "credit", "payment"),
    "phone": ("phone", "call", "tel", "mobile"),
    "iban": ("iban", "bank", "account", "transfer"),
}
PRIOR = {"email": 0.9, "ip": 0.6, "card": 0.7, "phone": 0.6, "iban": 0.9}
AWAY = ("version", "example", "serial", "sample", "release")
LIFT, WIDTH = 0.2, 40


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def mod97(account: str) -> bool:
    moved = account[4:] + account[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of ``[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+``, in time linear in the text."""
    last, at = 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > last and text[begin - 1] in LOCAL_SIGNS:
            begin -= 1
        if begin < at and (domain := DOMAIN.match(text, at + 1)):
            yield begin, domain.end()
            last = domain.end()
        else:
            last = at + 1
        at = text.find("@", last)


def ibans(text: str) -> Iterator[tuple[int, int]]:
    """Confirmed account numbers. A match may run on into the words behind the number, so the checksum is tried at its
    end, then at each space inside it from the right; the search goes on behind the confirmed span, or else behind the first letter of the match."""
    at = 0
    while m := IBAN.search(text, at):
        begin, end, at = m.start(), m.end(), m.start() + 1
        while end > begin:
            account = text[begin:end].replace(" ", "")
            if len(account) < 15:
                break
            if len(account) <= 34 and mod97(account):
                yield begin, end
                at = end
                break
            end = text.rfind(" ", begin, end)


def propose(text: str) -> Iterator[tuple[str, int, int, str]]:
    """Confirmed spans, kind by kind: kind, start, end, checksum result ('none' where the kind has no checksum)."""
    for begin, end in emails(text):
        yield "email", begin, end, "none"
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split(".")):
            yield "ip", m.start(), m.end(), "none"
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = m[0].replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                yield "card", m.start(), m.end(), "luhn"
    if "+" in text:
        for m in PHONE.finditer(text):
            if 10 <= sum(c.isdigit() for c in m[0]) <= 15:
                yield "phone", m.start(), m.end(), "none"
    for begin, end in ibans(text):
        yield "iban", begin, end, "mod97"


def score(text: str, kind: str, start: int, end: int) -> float:
    """The kind's prior, raised by its context words within ``WIDTH`` characters and lowered by words that speak against."""
    near = f"{text[max(0, start - WIDTH):start]} {text[end:end + WIDTH]}".lower()
    words = set(re.findall(r"[a-z]+", near))
    value = PRIOR[kind] + LIFT * any(w in words for w in CONTEXT[kind]) - LIFT * any(w in words for w in AWAY)
    return round(min(1.0, max(0.0, value)), 2)


def spans_of(text: str) -> list[tuple[int, int, int, str, str, float]]:
    """(start, kind rank, end, kind, checksum, score) in order of start, then kind."""
    found = [(s, KINDS.index(k), e, k, c, score(text, k, s, e)) for k, s, e, c in propose(text)]
    return sorted(found)


SPAN = "struct<kind:string,start:long,end:long,checksum:string,score:double>"


def find_personal_data(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id and ``spans``, an array of (kind, start, end, checksum, score) by start and kind.

    Positions are code points, the end exclusive. Kinds: email, ip, card (Luhn), phone and iban (mod 97). A failing
    match is dropped with its text; only an iban is tried again, at the words inside its match. The score says how sure a span is; no span is
    dropped for it. Null and empty texts have an empty array; repeated rows and null ids stay as they are; an empty
    table gives no rows; other columns are not read. Only the spans leave Python, and nothing is shuffled.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()),
                                   ("checksum", pa.string()), ("score", pa.float64())]))
        for batch in (s for b in batches for s in slices(b, 1)):
            rows = [[{"kind": k, "start": s, "end": e, "checksum": c, "score": p} for s, _, e, k, c, p in spans_of(t)]
                    for t in texts_of(batch.column(1)).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, kind)], names=["doc_id", "spans"])

    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(
        work, f"doc_id long, spans array<{SPAN}>")


def masked(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", least: float = 0.5) -> DataFrame:
    """doc_id and the text with every span of at least that score replaced by its kind in brackets.

    Overlapping spans become one, named by the first. Null texts stay null.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (s for b in batches for s in slices(b, 1)):
            rows = []
            for text in batch.column(1).to_pylist():
                parts, last = [], 0
                for start, _, end, kind, _, sure in spans_of(text or ""):
                    if sure >= least and start >= last:
                        parts += [text[last:start], f"[{kind}]"]
                        last = end
                    elif sure >= least:
                        last = max(last, end)
                rows.append(None if text is None else "".join(parts) + text[last:])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.string())], names=["doc_id", "text"])

    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(work, "doc_id long, text string")

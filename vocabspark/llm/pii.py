"""Personal data: regular expressions propose, checksums confirm, context words adjust a score.

Kinds and their rules (all digits and letters ASCII; matches of a kind run from left to right and do
not overlap; a match that fails its check is dropped and not tried again in part):

- ``email``, ``ip`` (four numbers up to 255), ``card`` (12 to 19 digits that pass Luhn),
  ``phone`` (a plus sign, 9 to 15 digits): the base kinds;
- ``iban``: two letters, two check digits, up to 30 more characters in groups, with remainder 1 modulo 97.

A span's score starts from how telling its kind's check is, and rises when a context word of its
kind stands within ``CONTEXT`` characters of it on either side.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vocabspark.llm.tables import by_chunk

# In the order in which spans that begin at the same place are listed.
KINDS = ["email", "ip", "card", "phone", "iban"]

CONTEXT = 40
RISE = 0.3
PRIOR = {"email": 0.7, "ip": 0.6, "card": 0.6, "phone": 0.6, "iban": 0.7}
WORDS = {
    "email": ["e-mail", "email", "mail", "contact", "kontakt", "courriel", "correo"],
    "ip": ["ip", "address", "host", "server", "client", "adresse"],
    "card": ["card", "visa", "mastercard", "amex", "credit", "karte", "carte", "tarjeta"],
    "phone": ["phone", "tel", "call", "mobile", "fax", "telefon", "téléphone", "teléfono"],
    "iban": ["iban", "account", "bank", "konto", "compte", "cuenta"],
}

SPANS = "array<struct<kind:string,start:int,end:int,score:double>>"

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A run of digits is tried from its first digit only: from a later one it would end at the same place.
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:[\x20]?[A-Z0-9]{4}){2,7}(?:[\x20]?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
_DIGIT = re.compile(r"[0-9]")
_NEAR = {kind: re.compile(r"(?<!\w)(?:" + "|".join(map(re.escape, words)) + r")(?!\w)", re.I) for kind, words in WORDS.items()}


def luhn(digits: str) -> bool:
    """Whether the last digit is the Luhn check digit of the others."""
    total = sum(map(int, digits[-1::-2])) + sum((2 * int(d) - 9 * (d > "4")) for d in digits[-2::-2])
    return total % 10 == 0


def mod97(code: str) -> bool:
    """Whether an account number's check digits hold: rearranged and read as digits, 1 modulo 97."""
    return int("".join(str(int(c, 36)) for c in code[4:] + code[:4])) % 97 == 1


def octet(part: str) -> bool:
    """Whether a run of digits of any length is at most 255; ``int`` refuses very long ones."""
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Places of addresses: around each at sign, so that a long run of letters costs nothing."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            done = domain.end()
        at = text.find("@", max(at + 1, done))


def find(text: str) -> list[tuple[str, int, int, float]]:
    """All spans of a text as ``(kind, start, end, score)`` in order of place, then kind."""
    found = [("email", s, e) for s, e in emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(octet(part) for part in m[0].split(".")):
                found.append(("ip", *m.span()))
        for m in _CARD.finditer(text):
            if 12 <= len(digits := _digits(m[0])) <= 19 and luhn(digits):
                found.append(("card", *m.span()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 9 <= len(_digits(m[0])) <= 15:
                    found.append(("phone", *m.span()))
        for m in _IBAN.finditer(text):
            if 15 <= len(code := m[0].replace(" ", "")) <= 34 and mod97(code):
                found.append(("iban", *m.span()))
    found.sort(key=lambda x: (x[1], KINDS.index(x[0]), x[2]))
    return [(kind, s, e, score(text, kind, s, e)) for kind, s, e in found]


def score(text: str, kind: str, start: int, end: int) -> float:
    """The kind's prior, and more if its context words are near."""
    around = text[max(0, start - CONTEXT) : start] + " " + text[end : end + CONTEXT]
    return min(1.0, PRIOR[kind] + (RISE if _NEAR[kind].search(around) else 0.0))


def spans(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(id, spans)`` for every row: kind, start, end (code points, end exclusive) and score.

    A null or empty text has no spans. Rows with a null or repeated id are searched like any
    other; other columns are not read; an empty table gives an empty table.
    """

    def one(part: pa.RecordBatch) -> pa.RecordBatch:
        found = [
            [{"kind": k, "start": s, "end": e, "score": p} for k, s, e, p in find(t)] if t else []
            for t in part.column("text").to_pylist()
        ]
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))
        return pa.record_batch({"id": part.column("id"), "spans": pa.array(found, kind)})

    rows = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
    kind = docs.schema[id].dataType.simpleString()
    return rows.mapInArrow(by_chunk(one, "text"), f"id {kind}, spans {SPANS}").withColumnRenamed("id", id)


def redacted(docs: DataFrame, text: str = "text", least: float = 0.5) -> DataFrame:
    """The same rows and columns with every span of at least that score replaced by ``[KIND]``.

    Spans that overlap are replaced together, under the kind of the first. A null text stays null;
    all columns but ``text`` pass through unchanged, whatever their names; an empty table stays empty.
    """
    names = docs.columns

    def one(part: pa.RecordBatch) -> pa.RecordBatch:
        at = names.index(text)
        clean = pa.array([t and redact(t, least) for t in part.column(at).to_pylist()], pa.string())
        return pa.RecordBatch.from_arrays([*part.columns[:at], clean, *part.columns[at + 1 :]], names=names)

    return docs.mapInArrow(by_chunk(one, text), docs.schema)


def redact(text: str, least: float) -> str:
    out, done = [], 0
    for kind, start, end, p in find(text):
        if p < least:
            continue
        if start >= done:
            out += [text[done:start], f"[{kind.upper()}]"]
        done = max(done, end)
    return "".join(out) + text[done:] if out else text


def listed(spans: Column, kinds: list[str]) -> Column:
    """``kind:start:end`` of the spans of some kinds, comma-joined."""
    kept = F.filter(spans, lambda s: s["kind"].isin(kinds))
    return F.array_join(F.transform(kept, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

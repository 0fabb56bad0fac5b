"""Personal data by anchor expansion.

An Aho-Corasick automaton reads each text once and reports anchors: at-signs, plus signs, digits, schemes of
addresses and words that announce an identifier. A small deterministic parser then expands each anchor to the
boundaries of an email, address, card, phone or account number and validates it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from matchbook.llm.store import slices

#: Kinds in the order that settles equal starts. The first four follow fixed patterns, the others are found by cue.
KINDS = ("email", "ip", "card", "phone", "url", "account", "secret")
SCHEMES = ("http://", "https://", "ftp://")
ACCOUNT_CUES = ("iban", "account", "acct", "ssn", "passport")
SECRET_CUES = ("token", "password", "secret", "api_key", "apikey", "access_key")

# The patterns of the four base kinds, cut at their anchors.
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
SPACED = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

HOST = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+(?::[0-9]{1,5})?(?:[/?#][^\x00-\x20\"'<>]*)?")
VALUE = re.compile(r"(?:[ \t]*(?:no\.?|number|id))?[ \t]*[:=#]?[ \t]*[\"']?([A-Za-z0-9](?:[ -]?[A-Za-z0-9])*)", re.I)
SECRET = re.compile(r"[ \t]*[:=][ \t]*[\"']?([A-Za-z0-9_./+-]{8,})")
IBAN = re.compile(r"[A-Za-z]{2}[0-9]{2}(?:[ -]?[A-Za-z0-9])*")


def automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for sign, kind in [("@", "at"), ("+", "plus"), *((d, "digit") for d in "0123456789")]:
        found.add_word(sign, (kind, 1))
    for words, kind in ((SCHEMES, "url"), (ACCOUNT_CUES, "account"), (SECRET_CUES, "secret")):
        for word in words:
            for form in {word, word.upper(), word.capitalize()}:
                found.add_word(form, (kind, len(form)))
    found.make_automaton()
    return found


def luhn(digits: str) -> bool:
    doubled = [int(d) * 2 for d in digits[-2::-2]]
    return (sum(map(int, digits[-1::-2])) + sum(d - 9 if d > 9 else d for d in doubled)) % 10 == 0


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def _iban(value: str) -> bool:
    value = re.sub(r"[ -]", "", value).upper()
    return 15 <= len(value) <= 34 and int("".join(str(int(c, 36)) for c in value[4:] + value[:4])) % 97 == 1


def _account(text: str, at: int) -> tuple[int, int] | None:
    """The number after a cue: an international account number with right check digits, or 6 to 20 digits."""
    found = VALUE.match(text, at, at + 80)
    if not found:
        return None
    begin = found.start(1)
    if (own := IBAN.match(text, begin, begin + 50)) and own.end() > begin + 4:
        # A word may follow after a space: take the longest part of whole groups that passes the check.
        ends = [own.end(), *(begin + m.start() for m in re.finditer(r"[ -]", own.group()))]
        return next(((begin, e) for e in sorted(ends, reverse=True) if _iban(text[begin:e])), None)
    number = SPACED.match(text, begin)
    if number and 6 <= sum(c.isdigit() for c in number.group()) <= 20:
        return begin, number.end()
    return None


def find(text: str, anchors: ahocorasick.Automaton) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, by start and then kind; spans of one kind never overlap."""
    spans: list[tuple[str, int, int]] = []
    end = dict.fromkeys(("email", "dotted", "spaced", "phone", "url", "account", "secret"), 0)
    for last, (kind, length) in anchors.iter(text):
        at = last - length + 1
        if kind == "digit":
            if at >= end["dotted"]:
                chain = DOTTED.match(text, at)
                end["dotted"] = chain.end()
                parts = chain.group().split(".")
                for i in range(0, len(parts) - 3, 4):
                    if all(map(_small, parts[i : i + 4])):
                        begin = at + sum(map(len, parts[:i])) + i
                        spans.append(("ip", begin, begin + len(".".join(parts[i : i + 4]))))
            if at >= end["spaced"]:
                chain = SPACED.match(text, at)
                end["spaced"] = chain.end() if chain else at + 1
                digits = re.sub("[ -]", "", chain.group()) if chain else ""
                if 12 <= len(digits) <= 19 and luhn(digits):
                    spans.append(("card", at, chain.end()))
        elif kind == "at":
            begin = at
            while begin > end["email"] and text[begin - 1] in LOCAL:
                begin -= 1
            domain = DOMAIN.match(text, at + 1) if begin < at else None
            if domain:
                end["email"] = domain.end()
                spans.append(("email", begin, domain.end()))
        elif kind == "plus":
            number = PHONE.match(text, at)
            if number and at >= end["phone"]:
                end["phone"] = number.end()
                if 9 <= sum(c in "0123456789" for c in number.group()) <= 15:
                    spans.append(("phone", at, number.end()))
        elif at >= end[kind]:
            if kind == "url":
                host = HOST.match(text, last + 1)
                span = (at, host.end() - (text[host.end() - 1] in ".,;:!?)")) if host else None
            elif kind == "account":
                span = None if text[at - 1 : at].isalnum() else _account(text, last + 1)
            else:
                value = SECRET.match(text, last + 1)
                span = value.span(1) if value and any(c.isdigit() for c in value.group(1)) else None
            if span:
                end[kind] = span[1]
                spans.append((kind, *span))
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def redact(text: str, spans: list[tuple[str, int, int]]) -> str:
    """Replace every span by its kind in brackets; spans that overlap give one replacement, named after the first."""
    out, done = [], 0
    for kind, start, end in spans:
        if start >= done:
            out += [text[done:start], f"[{kind.upper()}]"]
        done = max(done, end)
    return "".join([*out, text[done:]])


def cleaned(text: str, anchors: ahocorasick.Automaton) -> str:
    """Redact until nothing is found: a number that ran on into another one can stand alone after it is gone."""
    while spans := find(text, anchors):
        text = redact(text, spans)
    return text


SPANS = "array<struct<kind:string,start:long,end:long>>"


def find_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, spans): all personal data of each whole text, sorted by start and kind.

    Null and empty texts have no spans. Rows that repeat each give a row, null ids stay null, an empty table
    gives no rows, and further columns of ``docs`` are ignored.
    """
    kinds = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = automaton()
        for batch in batches:
            found = [
                [{"kind": k, "start": a, "end": b} for k, a, b in find(t.as_py() or "", anchors)] for t in batch.column(1)
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, kinds)], names=["doc_id", "spans"])

    ids = docs.selectExpr(f"cast(`{id_col}` as long) doc_id", f"`{text_col}` text")
    return ids.mapInArrow(run, f"doc_id long, spans {SPANS}")


def without_pii(docs: DataFrame) -> DataFrame:
    """The documents with personal data replaced by its kind, n_chars counted anew; a null text stays null."""
    schema = T.StructType(list(docs.schema.fields))
    counts = [f.name for f in schema if f.name == "n_chars"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = automaton()
        for batch in batches:
            for part in slices(batch, "text"):
                texts = [None if t is None else cleaned(t, anchors) for t in part.column("text").to_pylist()]
                columns = {n: part.column(n) for n in part.schema.names} | {"text": pa.array(texts, pa.string())}
                for name in counts:
                    sizes = pa.array([None if t is None else len(t) for t in texts], pa.int64())
                    columns[name] = sizes.cast(part.column(name).type)
                yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return docs.mapInArrow(run, schema)

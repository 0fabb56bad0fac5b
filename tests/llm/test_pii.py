import hashlib
import random
import re

import pytest

from matchbook.llm import pii, queries

PATTERNS = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}
ANCHORS = pii.automaton()


def valid(kind, found):
    digits = re.sub("[^0-9]", "", found)
    if kind == "ip":
        return all(int(p) <= 255 for p in found.split("."))
    if kind == "card":
        total = sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(digits)))
        return 12 <= len(digits) <= 19 and total % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def base(text):
    found = [(k, m.start(), m.end()) for k, p in PATTERNS.items() for m in p.finditer(text) if valid(k, m.group())]
    return sorted(found, key=lambda s: (s[1], list(PATTERNS).index(s[0])))


def own(text):
    return [s for s in pii.find(text, ANCHORS) if s[0] in PATTERNS]


def listed(spans):
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def test_random_texts_against_the_patterns():
    rng = random.Random(3)
    for _ in range(20_000):
        signs = rng.choice(["a@.b-_ ", "0123.4 -5", "+1 (2).-3", "a@b.1 2-3+4.é", "0 12-", "1.25.6"])
        text = "".join(rng.choice(signs) for _ in range(rng.randint(0, 40)))
        assert own(text) == base(text), text


def test_query_against_the_patterns(spark, folder):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = queries.op4_pii(spark, folder).collect()
    assert len(rows) == len(texts)
    for r in rows:
        wanted = base(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(listed(wanted).encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == s[0] for s in wanted) for k in PATTERNS]
        assert r.spans == listed(pii.find(texts[r.doc_id], ANCHORS))
    assert sum(r.n_email + r.n_ip + r.n_card + r.n_phone for r in rows)


@pytest.mark.parametrize(
    "text, wanted",
    [
        ("see https://www.example.com/a?b=1#c, ok", [("url", "https://www.example.com/a?b=1#c")]),
        ("IBAN: DE89 3704 0044 0532 0130 00 thanks", [("account", "DE89 3704 0044 0532 0130 00")]),
        ("IBAN: DE88 3704 0044 0532 0130 00 thanks", []),
        ("account no. 123-456-789 is", [("account", "123-456-789")]),
        ("accountable for 1 thing", []),
        ('token = "0b96a8c8d79c"', [("secret", "0b96a8c8d79c")]),
        ("the token passed", []),
        ("http://nohost", []),
    ],
)
def test_cues(text, wanted):
    assert [(k, text[a:b]) for k, a, b in pii.find(text, ANCHORS) if k not in PATTERNS] == wanted


def test_long_runs_stay_fast():
    for text in ("a" * 200_000 + "@" * 1000, "1" * 200_000, "1." * 100_000, "+1" + "(" * 200_000, "token " * 30_000):
        pii.find(text, ANCHORS)


def test_odd_rows(odd, nothing):
    rows = pii.find_spans(odd).collect()
    assert len(rows) == odd.count() and all(r.spans == [] for r in rows if r.doc_id in (0, 1, 2))
    clean = pii.without_pii(odd)
    assert clean.columns == odd.columns and clean.count() == odd.count()
    for r in clean.collect():
        assert r.n_chars == (None if r.text is None else len(r.text))
        assert not base(r.text or "")
    assert "mail [EMAIL] now" in clean.where("doc_id = 7").first().text
    assert pii.find_spans(nothing).count() == pii.without_pii(nothing).count() == 0

import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from matchbook.llm import queries, spelling


def plain_counts(rows, modulus, least=6):
    counts = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'null' if doc is None else doc}:{run}".encode())
            if modulus and h % modulus == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= least and n >= 5}


def one_edit(a, b):
    """Exactly one code point put in, left out or replaced."""
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_near(words):
    """Pairs that share a word with one letter left out are looked at one by one."""
    buckets = defaultdict(set)
    for w in words:
        for i in range(len(w)):
            buckets[w[:i] + w[i + 1 :]].add(w)
        buckets[w].add(w)
    near = defaultdict(set)
    for group in buckets.values():
        for a in group:
            near[a] |= {b for b in group if one_edit(a, b)}
    return near


def plain(counts, ratio=5):
    near, form, out = plain_near(counts), {}, []
    for w in counts:
        best = min(near[w], key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best is not None and counts[best] >= ratio * counts[w] else None
    for w, n in counts.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, n, len(near[w]), form[w], form[w] and counts[form[w]], root))
    return sorted(out)


def found(frame):
    return sorted((r.word, r.n, r.n_near, r.form, r.form_n, r.root) for r in frame.collect())


def test_query_against_brute_force(spark, folder):
    for path in (folder, "/root/testdata/sf0.01"):
        rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{path}/documents.parquet").collect()]
        wanted = plain(plain_counts(rows, 199))
        got = queries.op11_spelling_variants(spark, path)
        assert {"word", "form", "root", "n", "n_near", "form_n"} <= set(got.columns)
        assert found(got) == wanted and any(w[3] for w in wanted)


@pytest.mark.parametrize("seed", range(40))
def test_composition_against_every_pair(seed):
    rng = random.Random(seed)
    words = sorted({"".join(rng.choice("abc") for _ in range(rng.randrange(0, 7))) for _ in range(60)})
    left, right = words[::2], words[1::2]
    same = spelling.Acceptor(words)
    got = list(spelling.composed(same, same))
    assert sorted(got) == sorted((a, b) for a in words for b in words if one_edit(a, b))
    got = list(spelling.composed(spelling.Acceptor(left), spelling.Acceptor(right)))
    assert sorted(got) == sorted((a, b) for a in left for b in right if one_edit(a, b))


def test_the_acceptor_is_minimal():
    """As many states as there are different sets of word ends."""
    rng = random.Random(1)
    words = sorted({"".join(rng.choice("ab") for _ in range(rng.randrange(0, 8))) for _ in range(80)})
    machine = spelling.Acceptor(words)
    starts = {w[:i] for w in words for i in range(len(w) + 1)}
    ends = {frozenset(w[len(s) :] for w in words if w.startswith(s)) for s in starts}
    used, todo = {0}, [0]
    while todo:
        for state in machine.next[todo.pop()].values():
            if state not in used:
                used.add(state)
                todo.append(state)
    assert len(used) == len(ends)


@pytest.mark.parametrize("block", [4, 20_000])
def test_groups_against_brute_force(spark, block):
    """Dense words, repeated letters, ties, accents, a very long pair; small blocks meet in pairs."""
    rng = random.Random(3)
    counts = {"".join(rng.choice("abé") for _ in range(rng.choice([6, 7, 8]))): rng.choice([5, 25, 125, 625]) for _ in range(500)}
    counts |= {"aaaaaa": 5, "aaaaaaa": 25, "aaaaaaaa": 125, "x" * 5000: 7, "x" * 4999 + "y": 50, "aprefixes": 9, "bprefixes": 9, "prefixes": 45}
    words = spark.createDataFrame([(w, n, "clash") for w, n in counts.items()], "word string, n long, form string").repartition(3)
    assert found(spelling.variants(words, block=block)) == plain(counts)


def test_long_chains(spark):
    """Each word's form is the next: the root is reached whatever the length of the chain."""
    counts = {"a" * (6 + k): 5 * 5**k for k in range(20)}
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    got = spelling.variants(words).collect()
    assert {r.root for r in got} == {"a" * 25} and found(spelling.variants(words)) == plain(counts)


def test_odd_rows(spark, odd, nothing):
    rows = [(r.doc_id, r.text) for r in odd.collect()] * 5
    frame = spark.createDataFrame([(*r, "clash", 1) for r in rows], "doc_id long, text string, word string, n int").repartition(4)
    for modulus in (None, 3):
        wanted = plain(plain_counts(rows, modulus, 4))
        assert wanted and found(spelling.grouped(frame, least_chars=4, modulus=modulus)) == wanted
    assert spelling.grouped(nothing).count() == 0


def test_counts_are_passed_on_in_parts(spark, monkeypatch):
    monkeypatch.setattr(spelling, "COUNTS", 3)
    rows = [(i, f"Wordone wordtwo WORDÉone own{'abcdefghij'[i % 10]}words") for i in range(60)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.word: r.n for r in spelling.word_counts(frame).collect()} == plain_counts(rows, None)

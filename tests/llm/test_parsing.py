import hashlib
import random

import numpy as np
import pytest

from matchbook.llm import parsing, queries


def plain(rows):
    """The contract on (id, text) pairs with ids in falling order."""
    texts = [t or "" for _, t in rows]
    out = []
    for i, (doc, _) in enumerate(rows):
        own, after = texts[i], texts[(i + 1) % len(rows)]
        half = len(own) // 2
        new = own[: len(own) - half] + after[:half]
        prints = parsing.fingerprints([own, new, after])
        hexes = parsing.to_hex(prints)
        near = parsing.likeness(prints[[0, 0]], prints[[1, 2]])
        out.append((doc, len(own), hashlib.sha256(new.encode()).hexdigest(), hexes[0], hexes[1], near[0], near[1]))
    return out


def test_query_against_brute_force(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    wanted = plain(sorted(((r.doc_id, r.text) for r in docs.collect()), reverse=True))
    got = sorted((tuple(r) for r in queries.op2_phrase_fingerprints(spark, folder).collect()), reverse=True)
    assert got == wanted
    assert np.mean([r[5] for r in got]) > np.mean([r[6] for r in got]) + 0.15


@pytest.mark.parametrize("per_range", [1, 3, 1000])
def test_ranges_do_not_matter(spark, per_range):
    rows = [(i * 7 % 101, f"text {i} " * (i % 9)) for i in range(60)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = sorted((tuple(r) for r in parsing.against_next(frame, per_range=per_range).collect()), reverse=True)
    assert got == plain(sorted(rows, reverse=True))


def test_odd_rows(odd, nothing):
    for per_range in (2, 1000):
        rows = parsing.against_next(odd, per_range=per_range).collect()
        assert len(rows) == odd.count() and all(0 <= x <= 1 for r in rows for x in (r.near_edited, r.near_next))
    assert parsing.against_next(nothing).count() == 0
    one = parsing.against_next(odd.where("doc_id = 7")).first()
    assert one.near_next == 1.0


def test_equal_substrings_share_inner_phrases():
    rng = random.Random(1)
    shared = "".join(rng.choice("abcdefghij ") for _ in range(4000))
    a, b, c = parsing.fingerprints(["q" * 7 + "xy" + shared, shared + " another end", shared[::-1]])
    near = parsing.likeness(np.array([a, a]), np.array([b, c]))
    assert near[0] > 0.8 and near[1] < 0.2


def test_length_does_not_change_what_is_compared():
    """Near copies are alike on both sides of, and across, any length."""
    rng = random.Random(3)
    near = {}
    for size in (200, 257, 300, 1000):
        texts = ["".join(rng.choice("abcdefghijklmnop ") for _ in range(size)) for _ in range(100)]
        whole, cut = parsing.fingerprints(texts), parsing.fingerprints([t[:-2] for t in texts])
        near[size] = parsing.likeness(whole, cut)
    assert min(x.mean() for x in near.values()) > 0.8 and min(x.min() for x in near.values()) > 0.6
    texts = ["".join(rng.choice("abcdefghijklmnop ") for _ in range(400)) for _ in range(100)]
    halves = parsing.fingerprints([parsing.edited(t, "") for t in texts])
    assert parsing.likeness(parsing.fingerprints(texts), halves).mean() > 0.35


def test_texts_do_not_influence_each_other():
    texts = ["", "a", "aaaaaaa", "abab" * 50, "hello world", "x" * 5000, "the same", "the same"]
    together = parsing.fingerprints(texts)
    assert all((parsing.fingerprints([t]) == row).all() for t, row in zip(texts, together, strict=True))
    assert not together[0].any() and all(row.any() for row in together[1:])

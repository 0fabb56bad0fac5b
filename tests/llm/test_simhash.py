import random

import numpy as np
import pytest
import xxhash

from matchbook.llm import queries, simhash
from matchbook.llm.components import connected


def plain_fingerprint(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        text = text.replace(c, " ")
    words = [w for w in text.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(pairs, most=3):
    """pairs: (id, fingerprint); the smallest id that each can reach."""
    distinct = sorted({f for _, f in pairs})
    root = {f: f for f in distinct}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f

    prints = np.array(distinct, np.uint64)
    for i, f in enumerate(distinct):
        for j in np.flatnonzero(np.bitwise_count(prints[i + 1 :] ^ prints[i]) <= most):
            root[find(f)] = find(distinct[i + 1 + j])
    least = {}
    for doc, f in pairs:
        if doc is not None:
            r = find(f)
            least[r] = min(least.get(r, doc), doc)
    return [least.get(find(f)) for _, f in pairs]


def check(rows):
    prints = [(r.doc_id, int(r.fingerprint, 16)) for r in rows]
    assert plain_components(prints) == [r.component_id for r in rows]


def test_query_against_brute_force(spark, folder):
    rows = queries.op1_simhash_near_dedup(spark, folder).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    assert len(rows) == len(texts)
    assert all(int(r.fingerprint, 16) == plain_fingerprint(texts[r.doc_id]) for r in rows)
    check(rows)


def test_odd_rows(odd, nothing):
    rows = simhash.near_duplicates(odd).collect()
    assert len(rows) == odd.count()
    check(rows)
    assert {r.fingerprint for r in rows if r.doc_id in (0, 1, 2)} == {"0" * 16}
    assert simhash.near_duplicates(nothing).count() == 0


@pytest.mark.parametrize("block", [3, 4096])
def test_chains_and_dense_groups(spark, block, monkeypatch):
    """A dense group, a chain of single flips and noise; small blocks cut the full anchors."""
    rng = random.Random(2)
    centre = rng.getrandbits(64)
    prints = [centre ^ (1 << a) ^ (1 << b) for a in range(0, 64, 3) for b in range(0, 64, 7)]
    chain = rng.getrandbits(64)
    for _ in range(40):
        prints.append(chain)
        for bit in rng.sample(range(64), 3):
            chain ^= 1 << bit
    prints += [rng.getrandbits(64) for _ in range(100)]
    signed = [(f - (1 << 64) if f >> 63 else f, i) for i, f in enumerate(dict.fromkeys(prints))]
    links = simhash.links(spark.createDataFrame(signed, "fp long, rep long"), block=block)
    found = {r.node: r.component for r in connected(links).collect()}
    wanted = plain_components([(i, f % (1 << 64)) for f, i in signed])
    assert [found.get(i, i) for _, i in signed] == wanted


def test_anchors_cover(spark):
    """Any two fingerprints up to three bits apart meet at a home anchor of one of them."""
    rng = random.Random(4)
    pairs = []
    for i in range(200):
        f = rng.getrandbits(64)
        g = f
        for bit in rng.sample(range(64), 3):
            g ^= 1 << bit
        pairs += [(f, 2 * i), (g, 2 * i + 1)]
    signed = [(f - (1 << 64) if f >> 63 else f, i) for f, i in pairs]
    at = {}
    for r in simhash.spread_to_anchors(spark.createDataFrame(signed, "fp long, rep long")).collect():
        at.setdefault(r.rep, {})[r.key] = r.home
    for i in range(200):
        a, b = at[2 * i], at[2 * i + 1]
        assert any(a[k] or b[k] for k in a.keys() & b.keys())


def test_one_of_each(odd):
    kept = simhash.one_of_each(odd)
    assert kept.columns == odd.columns
    rows = odd.collect()
    prints = [(i, plain_fingerprint(r.text)) for i, r in enumerate(rows)]
    wanted = sorted({(rows[i].doc_id is None, rows[i].doc_id) for i in first_of_each(rows, prints)}, key=str)
    got = kept.collect()
    assert sorted({(r.doc_id is None, r.doc_id) for r in got}, key=str) == wanted
    assert len(got) == len(set(plain_components(prints)))


def first_of_each(rows, prints):
    """Of each component the row with the smallest id, null last."""
    components = plain_components(prints)
    return {min((i for i, c in enumerate(components) if c == k), key=lambda i: (rows[i].doc_id is None, rows[i].doc_id or 0)) for k in set(components)}


def test_unlike_texts_of_one_id_and_copies_without_id(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(40)) for x in "abc")
    rows = [(3, a, "en"), (5, a, "en"), (5, b, "en"), (None, c, "en"), (None, c, "en"), (None, c, "de"), (None, b, "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    got = simhash.one_of_each(docs).collect()
    assert {(r.doc_id, r.text) for r in got} == {(3, a), (5, b), (None, c)} and len(got) == 3
    found = {(r.doc_id, r.fingerprint): r.component_id for r in simhash.near_duplicates(docs).collect()}
    prints = {t: f"{plain_fingerprint(t):016x}" for t in (a, b, c)}
    assert found == {(3, prints[a]): 3, (5, prints[a]): 3, (5, prints[b]): 5, (None, prints[b]): 5, (None, prints[c]): None}


def test_components_of_no_edges_loops_and_a_hub(spark):
    edges = lambda rows: spark.createDataFrame(rows, "src long, dst long")
    assert connected(edges([])).count() == 0
    rows = [(7, 7), (1, 2), (2, 1), *((100, k) for k in range(50, 90)), (89, 5), (30, 31)]
    found = {r.node: r.component for r in connected(edges(rows)).collect()}
    assert found == {1: 1, 2: 1, 30: 30, 31: 30, 5: 5, 100: 5, **{k: 5 for k in range(50, 90)}}
    low, high = -(2**63), 2**63 - 1  # sums of nodes leave 64 bits
    rows = [(high - k, high - k - 1) for k in range(6)] + [(low + k, low + k + 1) for k in range(6)]
    found = {r.node: r.component for r in connected(edges(rows)).collect()}
    assert found == {**{high - k: high - 6 for k in range(7)}, **{low + k: low for k in range(7)}}

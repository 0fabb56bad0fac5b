import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from matchbook.llm import ngrams, queries


def plain(rows, held):
    tokens = [(i, [w.decode() for w in (t or "").encode().lower().split()] + [""]) for i, t in rows]
    words, pairs = Counter(), Counter()
    for (_, own), out in zip(tokens, held, strict=True):
        if not out:
            words.update(own)
            pairs.update(zip([" ", *own[:-1]], own, strict=True))
    total, known = sum(words.values()), len(words)
    seen = {**words, " ": words[""]}
    for i, own in tokens:
        base = score = 0.0
        for a, b in zip([" ", *own[:-1]], own, strict=True):
            one, n = (words[b] + 0.5) / (total + 0.5 * (known + 1)), seen.get(a, 0)
            spare = n**ngrams.HEAPS
            base += math.log10(one)
            score += math.log10((pairs[a, b] + spare * one) / (n + spare) if n else one)
        yield i, len(own), sum(words[w] > 0 for w in own), total, base, score


def same(rows, wanted):
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[4])
    got = sorted(((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in rows), key=key)
    wanted = sorted(wanted, key=key)
    assert [g[:4] for g in got] == [w[:4] for w in wanted]
    for g, w in zip(got, wanted, strict=True):
        assert g[4] == pytest.approx(w[4], rel=1e-9)
        assert abs(g[5] - w[5]) <= 0.03 * w[1]  # probabilities are kept in 8 bits


def test_query_against_brute_force(spark, folder):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    held = [zlib.crc32(str(i).encode()) % 5 == 1 for i, _ in docs]
    rows = queries.op7_ngram_scores(spark, folder).collect()
    assert {r.doc_id for r in rows if r.held_out} == {i for (i, _), out in zip(docs, held, strict=True) if out}
    same(rows, plain(docs, held))
    out = [r for r in rows if r.held_out]
    assert sum(r.score for r in out) > sum(r.base_score for r in out)


@pytest.mark.parametrize("block, bucket", [(50, 40), (1000, 300), (1 << 20, 1 << 19)])
def test_block_and_bucket_sizes_do_not_matter(spark, block, bucket):
    rows = [(i, " ".join(f"w{(i * j) % (3 + i % 13)}" for j in range(i % 40))) for i in range(120)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = ngrams.score(frame, F.col("doc_id") % 5 == 1, block=block, bucket=bucket).collect()
    same(found, plain(rows, [i % 5 == 1 for i, _ in rows]))


def test_a_word_with_a_third_of_the_tokens_is_dealt_to_many_buckets():
    """No bucket gets more than twice its size, and a common word goes to as many as its count needs."""
    rng, tokens, bucket = np.random.default_rng(3), 600_000, 4_000
    context = np.where(np.arange(tokens) % 3 == 0, 7, rng.integers(100, 50_000, tokens)).astype(np.uint64)
    context = np.where(np.arange(tokens) % 30 == 1, 8, context).astype(np.uint64)
    context = context * np.uint64(0x9E3779B97F4A7C15)
    successor = rng.integers(0, 1 << 63, tokens, dtype=np.uint64)
    words, counts = np.unique(context, return_counts=True)
    often = {int(w): int(n) for w, n in zip(words, counts, strict=True) if n > bucket // ngrams.PIECE}
    hot = ngrams.Hot.of(often, bucket // ngrams.PIECE)
    assert sorted(hot.counts.tolist()) == [20_000, 200_000] and sorted(hot.pieces.tolist()) == [40, 400]
    buckets = tokens // bucket
    dealt = np.bincount(ngrams._bucket_of(context, successor, hot, buckets), minlength=buckets)
    assert dealt.max() < 2 * bucket and dealt.min() > bucket // 3
    none = ngrams.Hot.of({}, 1)
    assert len(np.unique(ngrams._bucket_of(context[::3], successor[::3], none, buckets))) == 1


def test_sizes_follow_the_corpus():
    """Rows between blocks and buckets stay in proportion to the corpus; sizes that are given are the least."""
    for tokens in (0, 10**6, 10**9, 10**12, 10**15):
        block, bucket = ngrams.sizes_for(tokens)
        assert block >= ngrams.BLOCK and bucket >= ngrams.BUCKET
        assert (tokens / block) * (tokens / bucket) <= tokens / ngrams.PRODUCT * 1.01 + 1
    assert ngrams.sizes_for(10**12, 10**8, 10**9) == (10**8, 10**9)


def test_common_words_in_small_buckets(spark):
    """A word with a third of all tokens before many others, over buckets that hold a few tokens each."""
    rows = [(i, " ".join(f"the w{(i * 37 + j * j) % 211} v{j % 5}" for j in range(60))) for i in range(60)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = ngrams.score(frame, F.col("doc_id") % 5 == 1, block=500, bucket=200).collect()
    same(found, plain(rows, [i % 5 == 1 for i, _ in rows]))


def test_odd_rows(odd, nothing):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    found = ngrams.score(odd, F.col("doc_id") == 7).collect()
    assert len(found) == len(rows)
    same(found, plain(rows, [i == 7 for i, _ in rows]))
    assert ngrams.score(nothing, F.lit(False)).count() == 0
    alone = ngrams.score(odd, F.lit(True)).collect()
    assert len(alone) == len(rows) and all(r.n_known == 0 and r.train_tokens == 0 for r in alone)


def test_elias_fano():
    rng = np.random.default_rng(1)
    for top in (1, 7, 1000, 2**40, 2**63):
        values = np.sort(rng.integers(0, top, 500, dtype=np.uint64, endpoint=True))
        own = ngrams.EliasFano.of(values)
        assert (own.at(np.arange(500)) == values).all()
        asked = np.append(rng.integers(0, top, 2000, dtype=np.uint64, endpoint=True), values)
        place, hit = own.successor(asked)
        assert (place == np.searchsorted(values, asked)).all() and (hit == np.isin(asked, values)).all()
        assert (own.successor(np.array([values[-1] + np.uint64(1), 2**64 - 1], np.uint64))[0] == 500).all()
    compact = ngrams.EliasFano.of(np.sort(rng.integers(0, 2**32, 100_000, dtype=np.uint64)))
    assert 8 * (compact.low.nbytes + compact.high.nbytes) < 100_000 * (np.log2(2**32 / 100_000) + 3)


def test_codes_are_close():
    p = 10 ** np.random.default_rng(2).uniform(-7, 0, 1000)
    assert np.abs(ngrams.CODE_LOGS[ngrams.quantised(p)] - np.log10(p)).max() < 0.015
    assert ngrams.quantised(np.array([0.0]))[0] == 0


def test_a_very_common_context():
    """Codes reach down to a bigram seen once after a word seen half a billion times, and add up to its share."""
    total, rare = 500_000_000, 1_000_000
    counts = np.append(np.ones(rare, np.int64), total - rare)
    trie = ngrams.Trie(np.array([9], np.uint64), np.array([total]), np.array([0]), np.arange(rare + 1, dtype=np.uint32), counts)
    asked = np.arange(rare + 1, dtype=np.uint64)
    codes, weights = trie.look_up(np.full(rare + 1, 9, np.uint64), asked)
    book = ngrams.code_logs(trie.depth)
    true = np.log10(counts / (total + total**ngrams.HEAPS))
    assert np.abs(book[codes] - true).max() < 0.03
    assert (10 ** book[codes]).sum() + 10 ** book[weights[0]] == pytest.approx(1, abs=0.05)
    one = ngrams.depth_for(total)
    assert abs(ngrams.code_logs(one)[ngrams.quantised(np.array([1 / (total + total**ngrams.HEAPS)]), one)][0] - true[0]) < 1e-6

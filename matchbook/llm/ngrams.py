"""Scores of texts under a word bigram model, held in Elias-Fano tries.

The corpus is cut into blocks of whole documents; a block keeps its distinct words once and its tokens as
numbers of them. Word counts go by word hash and bigrams by the hash of their first word into buckets, so a
bucket has all counts it needs: its task builds a trie of two levels (contexts, and successors under each
context), writes it to a memory-mapped file, and looks up the distinct bigrams of every block in it. The
answers go back to the blocks, which add up their documents. Nothing depends on the corpus fitting anywhere.

A level is a monotone sequence in Elias-Fano form. Successors are stored relative to their context (its rank in
front of theirs), so a lookup is a successor search within the range that the context's pointers give.
Smoothing is Witten-Bell with the number of different successors taken from Heaps' law, t = c ** 0.9: a context
seen c times leaves t / (c + t) of its probability to the word's own. Both parts are stored in 8 bits, whose range
reaches down to a bigram seen once after the commonest context.
"""

from __future__ import annotations

import math
import mmap
import tempfile
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchbook.llm.store import stored

HEAPS = 0.9
#: Least tokens of a block, and of a bucket.
BLOCK, BUCKET = 1 << 20, 1 << 19
#: Bytes of a token, and what both sizes' product is at least times the tokens of the corpus, so that a block has some
#: dozens of bigrams for each bucket: as one row goes from each block to each bucket, rows grow with the corpus only.
TOKEN, PRODUCT = 6, 160
#: A context with more tokens than this part of a bucket is cut by successor into pieces of about so many.
PIECE = 8
END, START = (xxhash.xxh64_intdigest(x) for x in (b"", b" "))  # no word is empty or a space

#: The codes reach down to 10 ** -DEPTH, and further where a context is seen so often that its rarest successor is below.
DEPTH = 7.0


def depth_for(most: int) -> float:
    """How far codes must reach down, in log10, for a bigram seen once after a context seen ``most`` times."""
    return max(DEPTH, float(np.log10(most + most**HEAPS)) if most > 0 else 0.0)


def code_logs(depth: float) -> np.ndarray:
    """log10 of the probability of each 8-bit code k: 10 ** (-depth * (255 - k) / 254) from 1; 0: none."""
    return np.append(-np.inf, -depth * (255 - np.arange(1, 256)) / 254)


CODE_LOGS = code_logs(DEPTH)


def quantised(p: np.ndarray, depth: float = DEPTH) -> np.ndarray:
    """The nearest 8-bit code of a probability; 0 for 0."""
    code = np.rint(255 + np.log10(np.maximum(p, 1e-300)) * 254 / depth)
    return np.where(p > 0, np.clip(code, 1, 255), 0).astype(np.uint8)


class EliasFano:
    """A non-decreasing sequence of 64-bit numbers: low bits packed, high bits in unary."""

    def __init__(self, low: np.ndarray, high: np.ndarray, ones: np.ndarray, n: int, width: int) -> None:
        self.low, self.high, self.ones, self.n, self.width = low, high, ones, n, width

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        values = values.astype(np.uint64)
        n = len(values)
        top = int(values[-1]) if n else 0
        width = max(0, ((top + 1) // max(n, 1)).bit_length() - 1)
        low = np.zeros(n * width // 64 + 2, np.uint64)
        if width:
            part = values & np.uint64((1 << width) - 1)
            place = np.arange(n, dtype=np.uint64) * np.uint64(width)
            word, shift = (place >> np.uint64(6)).astype(np.int64), place & np.uint64(63)
            np.add.at(low, word, part << shift)  # the bits do not overlap
            over = shift + np.uint64(width) > np.uint64(64)
            np.add.at(low, word[over] + 1, part[over] >> (np.uint64(64) - shift[over]))
        places = (values >> np.uint64(width)).astype(np.int64) + np.arange(n)
        bits = np.zeros((int(places[-1]) // 64 + 2 if n else 2) * 64, np.uint8)
        bits[places] = 1
        high = np.packbits(bits, bitorder="little").view(np.uint64)
        ones = np.append(0, np.cumsum(np.bitwise_count(high), dtype=np.int64))
        return cls(low, high, ones, n, width)

    def _select0(self, k: np.ndarray) -> np.ndarray:
        """The place of the zero bit number k, from 0."""
        zeros = np.arange(len(self.ones)) * 64 - self.ones
        word = np.minimum(np.searchsorted(zeros, k, side="right") - 1, len(self.high) - 1)
        left = k - zeros[word]
        bits = ~self.high[word]
        at = np.zeros(len(k), np.int64)
        for step in (32, 16, 8, 4, 2, 1):
            here = np.bitwise_count(bits & np.uint64((1 << step) - 1)).astype(np.int64)
            skip = left >= here
            left, at = left - np.where(skip, here, 0), at + np.where(skip, step, 0)
            bits = np.where(skip, bits >> np.uint64(step), bits)
        return word * 64 + at

    def _low(self, i: np.ndarray) -> np.ndarray:
        if not self.width:
            return np.zeros(len(i), np.uint64)
        place = i.astype(np.uint64) * np.uint64(self.width)
        word, shift = (place >> np.uint64(6)).astype(np.int64), place & np.uint64(63)
        first = self.low[word] >> shift
        rest = np.where(shift > 0, self.low[word + 1] << ((np.uint64(64) - shift) & np.uint64(63)), np.uint64(0))
        return (first | rest) & np.uint64((1 << self.width) - 1)

    def at(self, i: np.ndarray) -> np.ndarray:
        """The numbers at these indexes."""
        word = np.searchsorted(self.ones, i, side="right") - 1
        left = i - self.ones[word]
        bits, place = self.high[word], np.zeros(len(i), np.int64)
        for step in (32, 16, 8, 4, 2, 1):
            here = np.bitwise_count(bits & np.uint64((1 << step) - 1)).astype(np.int64)
            skip = left >= here
            left, place = left - np.where(skip, here, 0), place + np.where(skip, step, 0)
            bits = np.where(skip, bits >> np.uint64(step), bits)
        return ((word * 64 + place - i).astype(np.uint64) << np.uint64(self.width)) | self._low(i)

    def successor(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each x the index of the first number not below it, and whether it is x."""
        x = x.astype(np.uint64)
        high = x >> np.uint64(self.width)
        inside = high < np.uint64(len(self.high) * 64 - int(self.ones[-1]) - 1)  # no number has a higher part beyond
        h = np.where(inside, high, 0).astype(np.int64)
        begin = np.where(h > 0, self._select0(np.maximum(h - 1, 0)) + 1 - h, 0)
        end = self._select0(h) - h
        begin, end = np.where(inside, begin, self.n), np.where(inside, end, self.n)
        low = x & np.uint64((1 << self.width) - 1) if self.width else np.zeros(len(x), np.uint64)
        lo, hi = begin.copy(), end.copy()
        while (lo < hi).any():
            mid = (lo + hi) // 2
            smaller = (lo < hi) & (self._low(np.minimum(mid, max(self.n - 1, 0))) < low)
            lo, hi = np.where(smaller, mid + 1, lo), np.where(smaller | (lo >= hi), hi, mid)
        hit = (lo < end) & (self._low(np.minimum(lo, max(self.n - 1, 0))) == low) if self.n else np.zeros(len(x), bool)
        return lo, hit


class Trie:
    """Two levels: contexts with a weight for the word's own probability, successors with theirs."""

    def __init__(
        self,
        contexts: np.ndarray,
        totals: np.ndarray,
        starts: np.ndarray,
        successors: np.ndarray,
        counts: np.ndarray,
        depth: float | None = None,
    ) -> None:
        """Sorted 64-bit contexts; for each, how often it was seen and where its sorted 32-bit successors start.

        Codes reach down by ``depth``; without one, as far as the largest of these contexts needs.
        """
        self.depth = depth_for(int(totals.max(initial=0))) if depth is None else depth
        seen = totals.astype(float)
        spare = seen**HEAPS
        sizes = np.diff(np.append(starts, len(successors)))
        rank = np.repeat(np.arange(len(contexts), dtype=np.uint64), sizes)
        levels = [
            EliasFano.of(contexts),
            EliasFano.of(np.append(starts, len(successors))),
            EliasFano.of((rank << np.uint64(32)) | successors.astype(np.uint64)),
        ]
        shares = spare / np.maximum(seen + spare, 1), counts / np.repeat(seen + spare, sizes)
        codes = [quantised(p, self.depth) for p in shares]
        arrays = [a for level in levels for a in (level.low, level.high, level.ones)] + codes
        self._file = tempfile.TemporaryFile()
        for a in arrays:
            self._file.write(a.tobytes() + b"\0" * (-a.nbytes % 8))
        self._file.flush()
        self._map = mmap.mmap(self._file.fileno(), 0, access=mmap.ACCESS_READ) if any(a.nbytes for a in arrays) else b""
        at, mapped = 0, []
        for a in arrays:
            mapped.append(np.frombuffer(self._map, a.dtype, len(a), at))
            at += a.nbytes + -a.nbytes % 8
        self.contexts, self.pointers, self.successors = (
            EliasFano(*mapped[3 * k : 3 * k + 3], level.n, level.width) for k, level in enumerate(levels)
        )
        self.weights, self.codes = mapped[9:]

    def look_up(self, context: np.ndarray, successor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The code of each bigram (0: never seen), and that of its context's weight (0: context never seen)."""
        if not self.contexts.n:
            return np.zeros(len(context), np.uint8), np.zeros(len(context), np.uint8)
        distinct, back = np.unique(context, return_inverse=True)
        index, known = self.contexts.successor(distinct)
        index = np.minimum(index, self.contexts.n - 1)
        weight = np.where(known, self.weights[index], 0).astype(np.uint8)
        begin = self.pointers.at(index).astype(np.int64)[back]
        end = self.pointers.at(index + 1).astype(np.int64)[back]
        place, hit = self.successors.successor((index[back].astype(np.uint64) << np.uint64(32)) | successor.astype(np.uint64))
        hit &= known[back] & (place >= begin) & (place < end)
        code = np.where(hit, self.codes[np.minimum(place, len(self.codes) - 1)], 0).astype(np.uint8)
        return code, weight[back]


def pack(a: np.ndarray) -> bytes:
    """Bytes of equal weight together, compressed."""
    planes = np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.itemsize).T if len(a) else np.zeros((0, 0), np.uint8)
    return zstandard.ZstdCompressor(level=3).compress(np.ascontiguousarray(planes).tobytes())


def unpack(b: bytes, dtype: type) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(b), np.uint8).reshape(size, -1)
    return np.ascontiguousarray(planes.T).view(dtype).ravel()


def _blocks(most: int):
    """Whole documents to blocks: their tokens as numbers of the block's words, commonest first; the end is a token."""

    def block(number: int, docs: list[tuple[int | None, bool]], words: list[list[bytes]]) -> pa.RecordBatch:
        flat = [w for one in words for w in (*one, b"")]
        codes, distinct = pd.factorize(np.array(flat, dtype=object))
        sizes = np.array([len(one) + 1 for one in words], np.int64)
        train = np.repeat(np.array([not out for _, out in docs]), sizes)
        order = np.argsort(-np.bincount(codes, minlength=len(distinct)), kind="stable")
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        codes = rank[codes]
        hashes = np.array([xxhash.xxh64_intdigest(distinct[i]) for i in order], np.uint64)
        counts = np.bincount(codes[train], minlength=len(order))
        return pa.RecordBatch.from_arrays(
            [
                pa.array([number], pa.int64()),
                pa.array([[i for i, _ in docs]], pa.list_(pa.int64())),
                pa.array([pack(np.array([out for _, out in docs], np.uint8))]),
                pa.array([pack(sizes.astype(np.uint32))]),
                pa.array([pack(codes.astype(np.uint32))]),
                pa.array([pack(hashes)]),
                pa.array([pack(counts.astype(np.uint32))]),
                pa.array([int(train.sum())], pa.int64()),
                pa.array([len(codes)], pa.int64()),
            ],
            names=["block", "ids", "held", "sizes", "tokens", "hashes", "counts", "trained", "n"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        docs: list[tuple[int | None, bool]] = []
        words: list[list[bytes]] = []
        held = 0
        for batch in batches:
            for doc_id, out, text in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                docs.append((doc_id, bool(out)))
                words.append((text or "").encode("utf-8", "surrogatepass").lower().split())
                held += len(words[-1]) + 1
                if held >= most:
                    yield block(number, docs, words)
                    docs, words, held, number = [], [], 0, number + 1
        if docs:
            yield block(number, docs, words)

    return run


BLOCK_SCHEMA = (
    "block long, ids array<long>, held binary, sizes binary, tokens binary, hashes binary, counts binary, trained long, n long"
)


def _word_shards(shards: int):
    """Each block's words with their training counts, dealt by hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                hashes, counts = unpack(row["hashes"], np.uint64), unpack(row["counts"], np.uint32)
                shard = (hashes % np.uint64(shards)).astype(np.int64)
                order = np.argsort(shard, kind="stable")
                cuts = np.searchsorted(shard[order], np.arange(shards + 1))
                there = np.flatnonzero(np.diff(cuts))
                parts = [order[cuts[s] : cuts[s + 1]] for s in there]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(there, pa.int32()),
                        pa.array([row["block"]] * len(there), pa.int64()),
                        pa.array([pack(hashes[p]) for p in parts], pa.binary()),
                        pa.array([pack(counts[p]) for p in parts], pa.binary()),
                    ],
                    names=["shard", "block", "hashes", "counts"],
                )

    return run


def _groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[list[dict]]:
    """Consecutive rows with the same key."""
    rows: list[dict] = []
    for batch in batches:
        for row in batch.to_pylist():
            if rows and row[key] != rows[0][key]:
                yield rows
                rows = []
            rows.append(row)
    if rows:
        yield rows


def _count_words(most: int, total: int):
    """For each shard: every block's words with their counts in the whole training corpus, and those above ``most``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _groups(batches, "shard"):
            hashes = [unpack(r["hashes"], np.uint64) for r in rows]
            distinct, back = np.unique(np.concatenate(hashes), return_inverse=True)
            counts = np.bincount(back, np.concatenate([unpack(r["counts"], np.uint32) for r in rows]), len(distinct))
            counts = counts.astype(np.int64)
            often = np.flatnonzero(counts > most)
            answers = np.split(counts[back].astype(np.uint32 if total < 1 << 32 else np.uint64), np.cumsum([len(h) for h in hashes])[:-1])
            n = len(rows)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([r["shard"] for r in rows], pa.int32()),
                    pa.array([r["block"] for r in rows], pa.int64()),
                    pa.array([pack(a.astype(np.int64)) for a in answers], pa.binary()),
                    pa.array([int((counts > 0).sum())] + [0] * (n - 1), pa.int64()),
                    pa.array([distinct[often].view(np.int64).tolist()] + [[]] * (n - 1), pa.list_(pa.int64())),
                    pa.array([counts[often].tolist()] + [[]] * (n - 1), pa.list_(pa.int64())),
                ],
                names=["shard", "block", "counts", "known", "hot", "hot_counts"],
            )

    return run


def _bigrams(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of a block: distinct bigrams as context and successor numbers, each token's bigram, and the words' hashes.

    Context number 0 is the start of a document; that of a word is one more than its number.
    """
    tokens, sizes = unpack(row["tokens"], np.uint32).astype(np.int64), unpack(row["sizes"], np.uint32).astype(np.int64)
    context = np.append(0, tokens[:-1] + 1)
    context[np.cumsum(sizes) - sizes] = 0
    hashes = unpack(row["hashes"], np.uint64)
    keys, back = np.unique(context * len(hashes) + tokens, return_inverse=True)
    return keys // len(hashes), keys % len(hashes), back, np.append(np.uint64(START), hashes), hashes


def sizes_for(tokens: int, block: int = BLOCK, bucket: int = BUCKET) -> tuple[int, int]:
    """Tokens of a block and of a bucket: at least those given, and both at least the root of PRODUCT times the tokens."""
    wide = math.isqrt(PRODUCT * tokens)
    return max(block, wide), max(bucket, wide)


class Hot(NamedTuple):
    """Contexts that are cut by successor: hashes in order, how often each is seen, and into how many pieces it is cut."""

    words: np.ndarray
    counts: np.ndarray
    pieces: np.ndarray

    @classmethod
    def of(cls, counts: dict[int, int], piece: int) -> Hot:
        words = np.array(sorted(counts), np.uint64)
        seen = np.array([counts[w] for w in sorted(counts)], np.int64)
        return cls(words, seen, np.maximum(-(-seen // piece), 1).astype(np.uint64))


def _bucket_of(context: np.ndarray, successor: np.ndarray, hot: Hot, buckets: int) -> np.ndarray:
    """By context; the contexts of the ``hot`` list by successor too."""
    piece = np.zeros(len(context), np.uint64)
    if len(hot.words):
        at = np.minimum(np.searchsorted(hot.words, context), len(hot.words) - 1)
        piece = np.where(hot.words[at] == context, successor % hot.pieces[at] + np.uint64(1), piece)
    salted = context + piece * np.uint64(0x9E3779B97F4A7C15)
    return ((salted ^ (salted >> np.uint64(29))) % np.uint64(buckets)).astype(np.int64)


def _deal(context: np.ndarray, successor: np.ndarray, buckets: int, hot: Hot) -> tuple[np.ndarray, np.ndarray]:
    """The order of bigrams by bucket, context and successor, and where each bucket starts."""
    bucket = _bucket_of(context, successor, hot, buckets)
    order = np.lexsort((successor, context, bucket))
    return order, np.searchsorted(bucket[order], np.arange(buckets + 1))


def _bigram_buckets(buckets: int, hot: Hot):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                context, successor, back, of_context, hashes = _bigrams(row)
                sizes, out = unpack(row["sizes"], np.uint32).astype(np.int64), unpack(row["held"], np.uint8)
                counts = np.bincount(back, np.repeat(1 - out.astype(np.int64), sizes), len(context)).astype(np.uint32)
                first, second = of_context[context], hashes[successor]
                order, cuts = _deal(first, second, buckets, hot)
                there = np.flatnonzero(np.diff(cuts))
                columns: list[list[bytes]] = [[], [], [], []]
                for b in there:
                    part = order[cuts[b] : cuts[b + 1]]
                    own, starts = np.unique(first[part], return_index=True)
                    columns[0].append(pack(own))
                    columns[1].append(pack(np.diff(np.append(starts, len(part))).astype(np.uint32)))
                    columns[2].append(pack((second[part] >> np.uint64(32)).astype(np.uint32)))
                    columns[3].append(pack(counts[part]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(there, pa.int32()), pa.array([row["block"]] * len(there), pa.int64()), *[pa.array(c, pa.binary()) for c in columns]],
                    names=["bucket", "block", "contexts", "lengths", "successors", "counts"],
                )

    return run


def _look_up(often: Hot, depth: float):
    """Build the trie of each bucket from all its bigrams, and look up those of every block."""
    hot, hot_counts = often.words, often.counts
    spare = hot_counts.astype(float) ** HEAPS
    hot_weights = quantised(spare / np.maximum(hot_counts + spare, 1), depth)

    def known_weights(context: np.ndarray, weight: np.ndarray) -> np.ndarray:
        if not len(hot):
            return weight
        at = np.minimum(np.searchsorted(hot, context), len(hot) - 1)
        return np.where(hot[at] == context, hot_weights[at], weight)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _groups(batches, "bucket"):
            context = [np.repeat(unpack(r["contexts"], np.uint64), unpack(r["lengths"], np.uint32)) for r in rows]
            successor = [unpack(r["successors"], np.uint32) for r in rows]
            counts = np.concatenate([unpack(r["counts"], np.uint32) for r in rows]).astype(np.int64)
            trained = counts > 0
            first, second, counts = np.concatenate(context)[trained], np.concatenate(successor)[trained], counts[trained]
            order = np.lexsort((second, first))
            first, second = first[order], second[order]
            new = np.flatnonzero(np.append(True, (first[1:] != first[:-1]) | (second[1:] != second[:-1]))[: len(first)])
            counts = np.add.reduceat(counts[order], new) if len(new) else counts
            first, second = first[new], second[new]
            starts = np.flatnonzero(np.append(True, first[1:] != first[:-1])[: len(first)])
            totals = np.add.reduceat(counts, starts) if len(starts) else counts
            names = first[starts]
            if len(hot) and len(names):  # a context that was cut has its total from the word counts
                at = np.minimum(np.searchsorted(hot, names), len(hot) - 1)
                totals = np.where(hot[at] == names, hot_counts[at], totals)
            trie = Trie(names, totals, starts, second, counts, depth)
            answers = [trie.look_up(c, s) for c, s in zip(context, successor, strict=True)]
            # A part of a cut context may hold none of its bigrams and so not its weight.
            answers = [(code, known_weights(c, weight)) for (code, weight), c in zip(answers, context, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([r["block"] for r in rows], pa.int64()),
                    pa.array([r["bucket"] for r in rows], pa.int32()),
                    pa.array([pack(code) for code, _ in answers], pa.binary()),
                    pa.array([pack(weight) for _, weight in answers], pa.binary()),
                ],
                names=["block", "bucket", "codes", "weights"],
            )

    return run


RESULT = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def _add_up(shards: int, buckets: int, hot: Hot, total: int, known: int, depth: float):
    """Rows of a block: its answers, words' counts (kind 0) and bigrams' codes (kind 1), then the block itself (kind 2)."""
    book = code_logs(depth)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _groups(batches, "block"):
            block = rows[-1]
            context, successor, back, of_context, hashes = _bigrams(block)
            counts = np.zeros(len(hashes), np.int64)
            by_shard = np.argsort(hashes % np.uint64(shards), kind="stable")
            counts[by_shard] = np.concatenate([unpack(r["first"], np.int64) for r in rows if r["kind"] == 0])
            order, _ = _deal(of_context[context], hashes[successor], buckets, hot)
            codes, weights = np.zeros(len(context), np.uint8), np.zeros(len(context), np.uint8)
            codes[order] = np.concatenate([unpack(r["first"], np.uint8) for r in rows if r["kind"] == 1])
            weights[order] = np.concatenate([unpack(r["second"], np.uint8) for r in rows if r["kind"] == 1])
            own = (counts + 0.5) / (total + 0.5 * (known + 1))
            spare = np.where(weights > 0, 10 ** book[np.maximum(weights, 1)], 1.0)
            logs = np.log10(np.where(codes > 0, 10 ** book[np.maximum(codes, 1)], 0.0) + spare * own[successor])
            sizes = unpack(block["sizes"], np.uint32).astype(np.int64)
            begins = np.cumsum(sizes) - sizes
            token = successor[back]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(block["ids"], pa.int64()),
                    pa.array(unpack(block["held"], np.uint8).astype(bool)),
                    pa.array(sizes),
                    pa.array(np.add.reduceat((counts[token] > 0).astype(np.int64), begins)),
                    pa.array(np.full(len(sizes), total, np.int64)),
                    pa.array(np.add.reduceat(np.log10(own)[token], begins)),
                    pa.array(np.add.reduceat(logs[back], begins)),
                ],
                names=[c.split()[0] for c in RESULT.split(", ")],
            )

    return run


def score(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK, bucket: int = BUCKET) -> DataFrame:
    """Train on the documents for which ``held_out`` is not true, and score all.

    Returns doc_id, held_out, n_tokens (words and one end), n_known (tokens seen in training), train_tokens,
    base_score (word counts plus one half) and score (log10 probability under the bigram model). Null and empty texts
    have the end only. Rows that repeat each count and each give a row; a null id is not held out if the condition is
    null for it. ``block`` and ``bucket`` are the least tokens of each; the scores do not depend on them. Without training documents every token has the same probability. An empty table gives no rows.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(held_out, F.lit(False)).alias("out"), F.col(text_col).alias("text"))
    length = texts.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)), F.count(F.lit(1))).first()
    block, bucket = sizes_for(length[0] // TOKEN + length[1], block, bucket)
    most = max(1, bucket // PIECE)
    blocks = stored(texts.mapInArrow(_blocks(block), BLOCK_SCHEMA), "blocks")
    sums = blocks.agg(F.coalesce(F.sum("trained"), F.lit(0)), F.coalesce(F.sum("n"), F.lit(0))).first()
    total, tokens = int(sums[0]), int(sums[1])
    buckets = shards = max(1, -(-tokens // bucket))
    dealt = blocks.select("block", "hashes", "counts").mapInArrow(_word_shards(shards), "shard int, block long, hashes binary, counts binary")
    dealt = dealt.repartition(shards, "shard").sortWithinPartitions("shard", "block")
    words = stored(
        dealt.mapInArrow(
            _count_words(most, max(total, 1)), "shard int, block long, counts binary, known long, hot array<long>, hot_counts array<long>"
        ),
        "word_counts",
    )
    known = int(words.agg(F.coalesce(F.sum("known"), F.lit(0))).first()[0])
    often = words.where(F.size("hot") > 0).select(F.explode(F.arrays_zip("hot", "hot_counts")).alias("h")).select("h.*").collect()
    starts = blocks.select(F.size("ids").alias("n"), "held")
    pairs = {int(r.hot) & (1 << 64) - 1: int(r.hot_counts) for r in often}
    pairs[START] = pairs.get(END, 0) or _documents(starts)
    hot = Hot.of(pairs, most)  # at most PIECE contexts for each bucket

    depth = depth_for(max(int(hot.counts.max()), most))  # no context is seen more often

    rows = blocks.select("block", "held", "sizes", "tokens", "hashes").mapInArrow(
        _bigram_buckets(buckets, hot), "bucket int, block long, contexts binary, lengths binary, successors binary, counts binary"
    )
    rows = rows.repartition(buckets, "bucket").sortWithinPartitions("bucket", "block")
    found = stored(rows.mapInArrow(_look_up(hot, depth), "block long, bucket int, codes binary, weights binary"), "answers")

    none = lambda *names: [F.lit(None).cast(t).alias(n) for n, t in names]
    own = ("ids", "array<long>"), ("held", "binary"), ("sizes", "binary"), ("tokens", "binary"), ("hashes", "binary")
    parts = (
        words.select("block", F.lit(0).alias("kind"), F.col("shard").alias("part"), F.col("counts").alias("first"), *none(("second", "binary"), *own))
        .unionByName(found.select("block", F.lit(1).alias("kind"), F.col("bucket").alias("part"), F.col("codes").alias("first"), F.col("weights").alias("second"), *none(*own)))
        .unionByName(blocks.select("block", F.lit(2).alias("kind"), F.lit(0).alias("part"), *none(("first", "binary"), ("second", "binary")), *[n for n, _ in own]))
    )
    parts = parts.repartition(buckets, "block").sortWithinPartitions("block", "kind", "part")
    return parts.mapInArrow(_add_up(shards, buckets, hot, total, known, depth), RESULT)


def _documents(blocks: DataFrame) -> int:
    """Training documents, counted where the end of a document is too rare a token to be in the list of common ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = [int((unpack(h, np.uint8) == 0).sum()) for h in batch.column("held").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(kept, pa.int64())], names=["n"])

    return int(blocks.mapInArrow(run, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0])

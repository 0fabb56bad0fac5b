"""SimHash near-duplicates by anchor-point covering.

A fingerprint has 64 bits, one majority vote per bit over the hashes of the text's word shingles.
Fingerprints at most three bits apart agree, but for one bit, in one of their two halves. The
anchors of a half are the words of a covering code: the Hamming code on its low 31 bits, any value
of the top bit. Its covering radius is 1, so every half has a home anchor at distance 0 or 1, and a
half that differs from it in one more bit lies within 1 + 1 of that home. Each fingerprint is sent
to all anchors within 2 of either half (33 on average), and compared there.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchbook.llm.components import connected
from matchbook.llm.store import stored

SEED = 42
RADIUS = 1
#: Fingerprints at one anchor that one task compares; a fuller anchor is cut into blocks of this many.
BLOCK = 4096


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """The unsigned 64-bit fingerprint; 0 for a text without words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        hashes = [xxhash.xxh64_intdigest(joined, SEED)]
    else:
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(lengths + 1) - 1
        starts = ends - lengths
        digest = xxhash.xxh64_intdigest
        hashes = [
            digest(joined[a:b], SEED) for a, b in zip(starts.tolist(), ends[shingle - 1 :].tolist(), strict=False)
        ]
    votes = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 1 << 15):
        raw = np.array(hashes[i : i + (1 << 15)], np.uint64).view(np.uint8).reshape(-1, 8)
        votes += np.unpackbits(raw, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(votes * 2 > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(rows: DataFrame, text_col: str = "text", shingle: int = 3) -> DataFrame:
    """The other columns of ``rows``, and fp: the signed fingerprint of each whole text; a null text counts as empty."""
    others = [c for c in rows.columns if c != text_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            prints = np.array([fingerprint(t.as_py(), shingle) for t in texts], np.uint64).view(np.int64)
            kept = [batch.column(i) for i in range(len(others))]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(prints)], names=[*others, "fp"])

    kinds = dict(rows.dtypes)
    schema = ", ".join([*[f"`{c}` {kinds[c]}" for c in others], "fp long"])
    return rows.select(*others, text_col).mapInArrow(run, schema)


def _syndrome(half: Column) -> Column:
    """The position, 1 to 31, of the low bit to flip to reach the nearest Hamming word; 0: it is one."""
    bits = []
    for k in range(5):
        mask = sum(1 << (p - 1) for p in range(1, 32) if p >> k & 1)
        bits.append(F.shiftleft(F.bit_count(half.bitwiseAND(F.lit(mask))) % 2, k).cast("long"))
    return bits[0] + bits[1] + bits[2] + bits[3] + bits[4]


def _offsets() -> list[list[int]]:
    """For each syndrome, what to flip in the half to get its anchors: the home anchor first, then those within 2."""
    bit = lambda p: 1 << (p - 1) if p else 0
    top = 1 << 31
    pairs = [[bit(i) | bit(i ^ flaw) for i in range(1, 32) if i != flaw and i < i ^ flaw] if flaw else [] for flaw in range(32)]
    return [[bit(flaw), bit(flaw) | top, *pairs[flaw]] for flaw in range(32)]


def spread_to_anchors(prints: DataFrame) -> DataFrame:
    """(key, home, fp, rep): every fingerprint once for each anchor within 2 of either of its halves."""
    mask = F.lit(0xFFFFFFFF)
    sides = F.array(
        F.struct(F.lit(0).cast("long").alias("side"), F.col("fp").bitwiseAND(mask).alias("half")),
        F.struct(F.lit(1 << 32).alias("side"), F.shiftrightunsigned("fp", 32).bitwiseAND(mask).alias("half")),
    )
    halves = prints.select("fp", "rep", F.explode(sides).alias("s")).select("fp", "rep", "s.side", "s.half")
    table = F.array(*[F.array(*[F.lit(x).cast("long") for x in row]) for row in _offsets()])
    near = halves.select("fp", "rep", "side", "half", F.posexplode(F.get(table, _syndrome(F.col("half")).cast("int"))))
    key = F.col("side").bitwiseOR(F.col("half").bitwiseXOR(F.col("col")))
    return near.select(key.alias("key"), (F.col("pos") == 0).alias("home"), "fp", "rep")


def _forest(prints: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Edges that connect what links of at most ``most`` bits connect: a tree per component, not all pairs."""
    left = np.arange(len(prints))
    while len(left) > 1:
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            at = queue.pop()
            linked = np.bitwise_count(prints[left] ^ prints[at]) <= most
            if linked.any():
                for child in left[linked].tolist():
                    yield int(at), child
                    queue.append(child)
                left = left[~linked]


def _compare(most: int):
    """Compare the fingerprints of each (key, part); rows arrive sorted by both."""

    def edges(group: dict[str, np.ndarray]) -> tuple[list[int], list[int]]:
        src: list[int] = []
        dst: list[int] = []
        cut = np.flatnonzero((np.diff(group["key"]) != 0) | (np.diff(group["part"]) != 0)) + 1
        starts, ends = np.append(0, cut), np.append(cut, len(group["key"]))
        homes = np.add.reduceat(group["home"].astype(np.int64), starts)
        for a, b in zip(starts[(ends - starts > 1) & (homes > 0)], ends[(ends - starts > 1) & (homes > 0)], strict=True):
            for i, j in _forest(group["fp"][a:b].view(np.uint64), most):
                src.append(int(group["rep"][a + i]))
                dst.append(int(group["rep"][a + j]))
        return src, dst

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] | None = None
        for batch in batches:
            now = {n: batch.column(n).to_numpy(zero_copy_only=False) for n in batch.schema.names}
            held = now if held is None else {n: np.concatenate([held[n], now[n]]) for n in now}
            same = (held["key"] == held["key"][-1]) & (held["part"] == held["part"][-1])
            first = int(np.argmax(same))  # the last group may go on in the next batch
            if first:
                done, held = {n: v[:first] for n, v in held.items()}, {n: v[first:] for n, v in held.items()}
                src, dst = edges(done)
                yield pa.RecordBatch.from_arrays([pa.array(src, pa.int64()), pa.array(dst, pa.int64())], names=["src", "dst"])
        if held is not None:
            src, dst = edges(held)
            yield pa.RecordBatch.from_arrays([pa.array(src, pa.int64()), pa.array(dst, pa.int64())], names=["src", "dst"])

    return run


def links(prints: DataFrame, most: int = 3, block: int = BLOCK) -> DataFrame:
    """(src, dst) ids whose links connect all distinct fingerprints (fp, rep) within ``most`` bits."""
    if not 0 <= most <= 2 * RADIUS + 1:
        raise ValueError("two halves with anchors of radius 1 cover at most three differing bits")
    spread = spread_to_anchors(prints)
    # An anchor with more rows than a block goes out as pairs of blocks, so no task gets it whole. Only homes can make
    # an anchor worth a comparison; the list of full anchors has at most rows / block entries.
    full = (
        spread.groupBy("key")
        .agg(F.count("*").alias("n"))
        .where(F.col("n") > block)
        .select("key", F.ceil(F.col("n") / block).cast("int").alias("blocks"))
    )
    full = stored(full, "full_anchors")
    own = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    pairs = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda other: F.least(own, other) * F.col("blocks") + F.greatest(own, other),
    )
    dealt = (
        spread.join(full, "key", "left")
        .withColumn("part", F.explode(F.when(F.col("blocks").isNull(), F.array(F.lit(0))).otherwise(pairs)))
        .select("key", "part", "home", "fp", "rep")
    )
    sorted_ = dealt.repartition("key", "part").sortWithinPartitions("key", "part")
    return sorted_.mapInArrow(_compare(most), "src long, dst long")


def groups(prints: DataFrame, most: int = 3, block: int = BLOCK) -> DataFrame:
    """(fp, node): for each distinct fingerprint the smallest one that it reaches by links.

    The nodes are the fingerprints themselves, so rows that share an id but not a text are never taken for one.
    """
    distinct = stored(prints.select("fp").distinct(), "distinct")
    labels = connected(stored(links(distinct.withColumn("rep", F.col("fp")), most, block), "links"))
    return distinct.join(labels.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", F.coalesce("component", "fp").alias("node")
    )


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, most: int = 3, block: int = BLOCK
) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id (smallest reachable doc_id).

    Null and empty texts have fingerprint zero and link like any other. Rows that repeat, or share an id,
    each give a row; unlike texts of one id stay apart. A document without an id gets the component of those it
    links to, and null if none of them has an id. An empty table gives no rows; further columns of ``docs`` are ignored.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    prints = stored(fingerprints(rows, "text", shingle), "fingerprints")
    known = stored(groups(prints, most, block), "components")
    least = prints.groupBy("fp").agg(F.min("doc_id").alias("id")).join(known, "fp").groupBy("node").agg(F.min("id").alias("id"))
    named = stored(known.join(least, "node").select("fp", "id"), "named")
    return prints.join(named, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), F.col("id").alias("component_id")
    )


def one_of_each(docs: DataFrame, shingle: int = 3, most: int = 3) -> DataFrame:
    """One row of every group of documents that link: that of the smallest doc_id, null last.

    Of rows that share this id, or have none, one is chosen by a hash of all their columns; of equal rows, any.
    So a group of copies without ids leaves one row too, and unlike texts of one id each stay. All columns of
    ``docs`` are returned as they are; columns of map type do not count for the choice.
    """
    hashed = F.xxhash64(*[F.col(f"`{c}`") for c, kind in docs.dtypes if "map<" not in kind])
    keys = {"_none": F.col("doc_id").isNull(), "_id": F.coalesce("doc_id", F.lit(0)).cast("long"), "_row": hashed}
    rows = docs.select(*[c.alias(n) for n, c in keys.items()], "text")
    prints = stored(fingerprints(rows, "text", shingle), "fingerprints")
    first = F.min(F.struct(*keys)).alias("first")
    best = prints.groupBy("fp").agg(first).join(groups(prints, most), "fp")
    keep = best.groupBy("node").agg(F.min("first").alias("first")).select("first.*")
    # Equal rows go before the shuffle already, and the texts move once.
    one = docs.withColumns(keys).dropDuplicates(list(keys))
    return one.join(stored(keep, "keep"), list(keys), "left_semi").select(*[f"`{c}`" for c in docs.columns])

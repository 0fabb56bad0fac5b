"""Document fingerprints by locally consistent parsing.

A text is parsed bottom up. On each level runs of one symbol become one symbol; then every symbol is labelled
by the lowest bit in which it differs from its left neighbour, and labels are tossed again until few are left.
Symbols with a label above both neighbours' start a phrase, and a phrase is named by a hash of its symbols.
Where a phrase starts depends on a few symbols around it only, so equal substrings get equal phrases inside,
wherever they stand. A fingerprint keeps, for 64 bins of phrase names of all levels, the smallest hash in the bin; the
likeness of two is the share of filled bins on which they agree, which estimates the share of common phrases.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BINS = 64
TOSSES = 4  # 64-bit names to labels below 6
#: Characters parsed at once.
AT_ONCE = 1 << 19
#: Documents per range of ids, and the most ranges.
PER_RANGE, RANGES = 2000, 10_000

_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _B
    x = (x ^ (x >> np.uint64(27))) * _C
    return x ^ (x >> np.uint64(31))


def _starts(owner: np.ndarray) -> np.ndarray:
    return np.append(True, owner[1:] != owner[:-1])


def _merge_runs(names: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    head = _starts(owner)
    head[1:] |= names[1:] != names[:-1]
    at = np.flatnonzero(head)
    length = np.diff(np.append(at, len(names))).astype(np.uint64)
    names, owner = names[at], owner[at]
    return np.where(length > 1, _mix(names + length * _A), names), owner


def _toss(label: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Twice the place of the lowest bit in which a label differs from its neighbour, plus that bit."""
    one = label.dtype.type(1)
    apart = label ^ left
    low = np.bitwise_count((apart & (~apart + one)) - one).astype(label.dtype)
    return (low * 2 + ((label >> low) & one)).astype(np.uint8)


#: The toss of two labels below 128, by 128 * label + neighbour; equal ones do not meet.
_TOSSED = _toss(*(x.ravel().astype(np.uint16) for x in np.meshgrid(range(128), range(128), indexing="ij"))).ravel()


def _labels(names: np.ndarray, first: np.ndarray) -> np.ndarray:
    lead = np.flatnonzero(first)
    for k in range(TOSSES):
        left = np.append(names[:1], names[:-1])
        label = _TOSSED[(names.astype(np.uint16) << 7) | left] if k else _toss(names, left)
        label[lead] = names[lead].astype(np.uint8) & 1  # as if the neighbour differed in the first bit
        names = label
    return names.astype(np.int8)


def parse(names: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One level up: the names of the phrases, and the text each is in."""
    names, owner = _merge_runs(names, owner)
    first = _starts(owner)
    label = _labels(names, first)
    left = np.where(first, np.int8(-1), np.append(label[:1], label[:-1]))
    right = np.where(np.append(first[1:], True), np.int8(-1), np.append(label[1:], label[-1:]))
    head = first | ((label > left) & (label > right))
    at = np.flatnonzero(head)
    place = (np.arange(len(names)) - np.repeat(at, np.diff(np.append(at, len(names))))).astype(np.uint64)
    phrase = _mix(np.add.reduceat(_mix(names + (place + np.uint64(1)) * _A), at))
    return phrase, owner[at]


def fingerprints(texts: list[str]) -> np.ndarray:
    """A row of 64 numbers below 65536 for each text; 0 marks an empty bin."""
    best = np.full(len(texts) * BINS, 1 << 16, np.int64)
    sizes = np.array([len(t) for t in texts])
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    owner, names = np.repeat(np.arange(len(texts)), sizes), _mix(points.astype(np.uint64) + _A)
    level = 0
    while len(names):
        names, owner = parse(names, owner)
        level += 1
        value = _mix(names + np.uint64(level * int(_C) % 2**64))
        slot = owner * BINS + (value % np.uint64(BINS)).astype(np.int64)
        np.minimum.at(best, slot, 1 + ((value >> np.uint64(16)) % np.uint64(65535)).astype(np.int64))
        alone = np.bincount(owner, minlength=len(texts)) == 1
        more = ~alone[owner]
        names, owner = names[more], owner[more]
    return np.where(best == 1 << 16, 0, best).reshape(-1, BINS).astype(np.uint16)


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row: the share of bins filled in either that agree; 1 for two empty texts."""
    filled = ((a > 0) | (b > 0)).sum(axis=1)
    same = ((a == b) & (a > 0)).sum(axis=1)
    return np.where(filled == 0, 1.0, same / np.maximum(filled, 1))


def to_hex(prints: np.ndarray) -> list[str]:
    return [row.astype(">u2").tobytes().hex() for row in prints]


def fingerprint_column(docs: DataFrame, text_col: str = "text", column: str = "fingerprint") -> DataFrame:
    """Add the fingerprint (256 hex digits) of each whole text; a null text counts as empty, which gives zeros."""
    docs = docs.select(*[f"`{c}`" for c in docs.columns if c != column])
    schema = docs.withColumn(column, F.lit("")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from matchbook.llm.store import slices

        for batch in batches:
            for part in slices(batch, text_col, AT_ONCE):
                made = to_hex(fingerprints([t or "" for t in part.column(text_col).to_pylist()]))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(made, pa.string())], names=schema.names)

    return docs.mapInArrow(run, schema)


def edited(text: str, follower: str) -> str:
    """The last half of the code points replaced by as many first ones of the next text, or all it has."""
    half = len(text) // 2
    return text[: len(text) - half] + follower[:half]


RESULT = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def _rows(texts: list[tuple[int | None, str]], follower: str) -> pa.RecordBatch:
    """The result for consecutive documents; ``follower`` is the text after the last of them."""
    own = [t for _, t in texts]
    changed = [edited(a, b) for a, b in zip(own, [*own[1:], follower], strict=True)]
    prints, new = fingerprints([*own, follower]), fingerprints(changed)
    return pa.RecordBatch.from_arrays(
        [
            pa.array([i for i, _ in texts], pa.int64()),
            pa.array([len(t) for t in own], pa.int64()),
            pa.array([hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in changed]),
            pa.array(to_hex(prints[:-1])),
            pa.array(to_hex(new)),
            pa.array(likeness(prints[:-1], new)),
            pa.array(likeness(prints[:-1], prints[1:])),
        ],
        names=[c.split()[0] for c in RESULT.split(", ")],
    )


def _follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come by range and place in it; each range ends with copies of the row after it."""
    unpack = zstandard.ZstdDecompressor()
    held: list[tuple[int | None, str]] = []
    held_chars, now, closed = 0, None, True
    for batch in batches:
        columns = [batch.column(n).to_pylist() for n in ("bucket", "after", "doc_id", "z")]
        for bucket, after, doc_id, z in zip(*columns, strict=True):
            if bucket != now:
                now, closed = bucket, False
            if closed:
                continue
            text = unpack.decompress(z).decode("utf-8", "surrogatepass")
            if after or (held and held_chars + len(text) > AT_ONCE):
                if held:
                    yield _rows(held, text)
                held, held_chars, closed = [], 0, after
            if not after:
                held.append((doc_id, text))
                held_chars += len(text)


def against_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", per_range: int = PER_RANGE) -> DataFrame:
    """Fingerprint every text, its edited text, and compare both, and it with the next document by descending id.

    Rows without an id come last; rows of one id are ordered by text. After the last row comes the first, so a
    single row follows itself. Null texts count as empty. An empty table gives no rows; further columns are ignored.

    Ids are cut into ranges; each goes through one task in order, a few hundred kilobytes at a time. The first
    row of every range is also sent to the range before it. Texts are packed for the one shuffle.
    """
    ids = docs.select(F.col(id_col).cast("long").alias("doc_id"))
    ranges = max(1, min(RANGES, docs.count() // per_range))
    shares = [k / ranges for k in range(1, ranges)]
    cuts = ids.select(F.percentile_approx("doc_id", shares or [0.5], max(10_000, 10 * ranges))).first()[0] or []
    cuts = np.unique(np.array(cuts if shares else [], np.int64))
    none = -(1 << 63)  # no id: after the smallest one

    def bucket_of(column: pa.Array) -> np.ndarray:
        """Range 0 holds the largest ids."""
        return len(cuts) - np.searchsorted(cuts, column.fill_null(none).to_numpy(zero_copy_only=False), side="left")

    def first_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.table({"bucket": bucket_of(batch.column(0)), "top": batch.column(0).fill_null(none)})
            found = found.group_by("bucket").aggregate([("top", "max")]).select(["bucket", "top_max"])
            yield from found.rename_columns(["bucket", "top"]).to_batches()

    # One row per range.
    tops = ids.mapInArrow(first_ids, "bucket long, top long").groupBy("bucket").agg(F.max("top").alias("top")).collect()
    tops = dict(sorted((r.bucket, r.top) for r in tops))
    order = list(tops)
    before = {tops[b]: order[k - 1] for k, b in enumerate(order)}  # the first id of a range, and the range it follows

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            z = [packer.compress((t.as_py() or "").encode("utf-8", "surrogatepass")) for t in batch.column(1)]
            buckets, keys = bucket_of(batch.column(0)), batch.column(0).fill_null(none).to_pylist()
            again = [i for i, key in enumerate(keys) if key in before]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([*buckets.tolist(), *(before[keys[i]] for i in again)], pa.int64()),
                    pa.array([False] * len(keys) + [True] * len(again)),
                    pa.concat_arrays([batch.column(0), batch.column(0).take(pa.array(again, pa.int64()))]),
                    pa.array([*z, *(z[i] for i in again)], pa.binary()),
                ],
                names=["bucket", "after", "doc_id", "z"],
            )

    packed = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        pack, "bucket long, after boolean, doc_id long, z binary"
    )
    dealt = packed.repartition(max(1, len(order)), "bucket").sortWithinPartitions(
        "bucket", "after", F.col("doc_id").desc_nulls_last(), F.xxhash64("z"), "z"
    )
    return dealt.mapInArrow(_follow, RESULT)

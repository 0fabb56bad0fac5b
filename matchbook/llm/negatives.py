"""Hard-negative mining with scores from a residue number system.

Integer vectors are reduced modulo several small primes. In single precision, products of residues add up exactly, so
each prime costs one fast float32 matrix product; the residues of a score determine it by Chinese remaindering, for as
many primes as its largest possible size needs. Scores are thus exact integers, whatever the order of addition.

Anchors travel in blocks, candidates in packs, and every block meets every pack: once to find the anchors' positives,
and once more to find, for every positive, the best rows of other labels inside its margin. A task keeps only the best
few of each, and a window over what the tasks found makes the final choice.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matchbook.llm.store import stored

#: Vectors of a pack, anchors of a block, and packs that one task holds against one block of anchors.
PACK, ANCHORS, LANE = 1024, 1024, 16
#: Stands for no candidate.
LOW = -(2**63)


def _primes(most: int) -> list[int]:
    sieve = np.ones(most, bool)
    sieve[:2] = False
    for i in range(2, int(most**0.5) + 1):
        sieve[i * i :: i] &= not sieve[i]
    return np.flatnonzero(sieve)[::-1].tolist()


#: Largest first. Residues are centred, so a product is at most 125 * 125.
PRIMES = _primes(256)
#: So many products of centred residues add up to less than 2**24 and are exact in single precision.
EXACT_TERMS = 2**24 // (PRIMES[0] // 2) ** 2


def residues(values: np.ndarray, prime: int) -> np.ndarray:
    """Centred residues, from -(prime // 2) to prime // 2."""
    r = np.mod(values, prime)
    return np.where(r > prime // 2, r - prime, r).astype(np.float32)


def _product(a: np.ndarray, b: np.ndarray, prime: int) -> np.ndarray:
    """The inner products modulo the prime: float32 all the way, reduced between slices of the terms."""
    x, y = residues(a, prime), residues(b, prime).T
    total = np.zeros((len(a), len(b)), np.int32)
    for i in range(0, a.shape[1], EXACT_TERMS):
        total = (total + (x[:, i : i + EXACT_TERMS] @ y[i : i + EXACT_TERMS]).astype(np.int32)) % prime
    return total


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of integer rows, exact where they fit 64 bits (beyond, the low 64 bits).

    A score lies between -bound and bound. Its residues, moved up by the bound, are turned into digits (Garner's form
    of the Chinese remainder theorem): score + bound = d0 + d1 p0 + d2 p0 p1 + ...
    """
    high = lambda v: max(abs(int(v.max())), abs(int(v.min()))) if v.size else 0
    bound = high(a) * high(b) * a.shape[1]
    total = np.full((len(a), len(b)), np.int64(_wrapped(-bound)))
    digits: list[np.ndarray] = []
    weight = 1  # the product of the primes so far
    for p in PRIMES:
        digit = _product(a, b, p) + bound % p
        part = 1
        for d, q in zip(digits, PRIMES, strict=False):
            digit = (digit - d * part) % p
            part = part * q % p
        digit = digit % p * pow(part, -1, p) % p
        total += digit.astype(np.int64) * np.int64(_wrapped(weight))
        digits.append(digit)
        weight *= p
        if weight > 2 * bound:
            return total
    raise ValueError("the vectors are too long for the primes")


def _wrapped(value: int) -> int:
    """The low 64 bits as a signed number."""
    return (value + 2**63) % 2**64 - 2**63


def scaled(column: str, scale: int) -> Column:
    """floor(scale * x) of every component; null for a vector that holds a null, infinite or undefined one."""
    finite = lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) != float("inf")), F.lit(False))
    values = F.col(column).cast("array<double>")
    return F.when(F.forall(values, finite), F.transform(values, lambda x: F.floor(x * scale)))


def _narrow(values: np.ndarray) -> tuple[str, bytes]:
    for kind in ("i1", "i2", "i4"):
        if not values.size or (values.min() >= np.iinfo(kind).min and values.max() <= np.iinfo(kind).max):
            return kind, values.astype(kind).tobytes()
    return "i8", values.tobytes()


PACKED = pa.schema(
    [("part", pa.int32()), ("dims", pa.int32()), ("ids", pa.binary()), ("labels", pa.binary()), ("kind", pa.string()),
     ("vals", pa.binary()), ("extra", pa.binary())]
)


def _packed(rows: DataFrame, most: int = PACK) -> DataFrame:
    """Rows (part, id, label, v, extra) in packs: up to ``most`` neighbours of one part and one length of vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = np.stack([batch.column("part").to_numpy(), pa.compute.list_value_length(batch.column("v")).to_numpy()], axis=1)
            for part, dims in np.unique(keys, axis=0).tolist():
                own = np.flatnonzero((keys == (part, dims)).all(axis=1))
                for i in range(0, len(own), most):
                    some = batch.take(pa.array(own[i : i + most]))
                    flat = {c: some.column(c).flatten().to_numpy(zero_copy_only=False).astype(np.int64) for c in ("v", "extra")}
                    ids, labels = (some.column(c).to_numpy().astype(np.int64).tobytes() for c in ("id", "label"))
                    kind, vals = _narrow(flat["v"])
                    row = (part, dims, ids, labels, kind, vals, flat["extra"].tobytes())
                    yield pa.RecordBatch.from_pylist([dict(zip(PACKED.names, row, strict=True))], schema=PACKED)

    columns = [F.col("part").cast("int").alias("part"), "id", "label", "v", "extra"]
    return rows.select(*columns).mapInArrow(run, "part int, dims int, ids binary, labels binary, kind string, vals binary, extra binary")


class Best:
    """The first ``k`` candidates of each key so far: highest score first, equal scores by smaller id."""

    def __init__(self, keys: int, k: int) -> None:
        self.k = k
        self.key, self.score, self.id = (np.zeros(0, np.int64) for _ in range(3))
        self.least = np.full(keys, LOW, np.int64)

    def add(self, keys: np.ndarray, found: np.ndarray, ids: np.ndarray) -> None:
        """A row of candidates for each key; LOW marks none. Only those that can be among the first k are sorted."""
        if found.shape[1] > self.k:
            reach = np.partition(found, -self.k, axis=1)[:, -self.k]
        else:
            reach = np.full(len(found), LOW, np.int64)
        rows, columns = np.nonzero((found >= np.maximum(reach, self.least[keys])[:, None]) & (found != LOW))
        key = np.concatenate([self.key, keys[rows]])
        score = np.concatenate([self.score, found[rows, columns]])
        ident = np.concatenate([self.id, ids[columns]])
        order = np.lexsort((ident, -score, key))
        key, score, ident = key[order], score[order], ident[order]
        place = np.arange(len(key)) - np.searchsorted(key, key)
        kept = place < self.k
        self.key, self.score, self.id = key[kept], score[kept], ident[kept]
        full = place[kept] == self.k - 1
        self.least[self.key[full]] = self.score[full]


def _unpacked(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ids, labels = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["labels"], np.int64)
    return ids, labels, np.frombuffer(row["vals"], row["kind"]).reshape(len(ids), row["dims"]).astype(np.int64)


class Block:
    """The anchors of one part and length; with ``positives``, ``wanted`` holds the scores of each one's positives."""

    def __init__(self, rows: list[dict], positives: int, k: int) -> None:
        self.ids, self.labels, self.values = (np.concatenate(x) for x in zip(*map(_unpacked, rows), strict=True))
        wanted = np.concatenate([np.frombuffer(r["extra"], np.int64) for r in rows])
        self.wanted = wanted.reshape(len(self.ids), positives)
        self.width = max(1, positives)
        self.best = Best(len(self.ids) * self.width, k)

    def meet(self, pack: dict, floor: int) -> None:
        ids, labels, values = _unpacked(pack)
        made = scores(self.values, values)
        same = labels[None, :] == self.labels[:, None]
        keys = np.arange(len(self.ids)) * self.width
        if not self.wanted.shape[1]:
            self.best.add(keys, np.where(same & (ids[None, :] != self.ids[:, None]), made, LOW), ids)
        for slot, top in enumerate(self.wanted.T[:, :, None]):
            # floor * top <= 100 * score without overflow: the score is at least floor * top / 100, rounded up.
            least = top // 100 * floor - (-(top % 100) * floor // 100)
            inside = ~same & (made <= top) & (made >= least) & (top != LOW)
            if inside.any():
                self.best.add(keys + slot, np.where(inside, made, LOW), ids)

    def result(self) -> pa.RecordBatch:
        key = self.best.key
        return pa.RecordBatch.from_arrays(
            [pa.array(self.ids[key // self.width]), pa.array((key % self.width + 1).astype(np.int32)), pa.array(self.best.id), pa.array(self.best.score)],
            names=["anchor_id", "slot", "id", "score"],
        )


def _search(positives: int, k: int, floor: int):
    """For rows sorted by (part, lane, role): the anchors of a part, and then the packs that they meet.

    Without ``positives``, the best k other rows of each anchor's label; with them, for each positive's score the
    best k rows of other labels from ``floor`` percent of it up to it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, asked, blocks = None, {}, {}
        for batch in batches:
            for i in range(batch.num_rows):
                row = {n: batch.column(n)[i].as_py() for n in batch.schema.names}
                if (row["part"], row["lane"]) != now:
                    yield from (block.result() for block in blocks.values())
                    now, asked, blocks = (row["part"], row["lane"]), {}, {}
                if not row["role"]:
                    asked.setdefault(row["dims"], []).append(row)
                elif row["dims"] in asked:
                    if row["dims"] not in blocks:
                        blocks[row["dims"]] = Block(asked[row["dims"]], positives, k)
                    blocks[row["dims"]].meet(row, floor)
        yield from (block.result() for block in blocks.values())

    return run


def _met(anchors: DataFrame, packs: DataFrame, sizes: tuple[int, int], positives: int, k: int, floor: int) -> DataFrame:
    """Every block of anchors against every pack; a block is sent once to each lane of packs, and comes before them."""
    blocks, lanes = sizes
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    asked = anchors.withColumn("part", F.pmod(F.xxhash64("id"), F.lit(blocks)))
    asked = _packed(asked.repartition("part").sortWithinPartitions("part")).withColumn("role", F.lit(0)).withColumn("lane", every(lanes))
    against = packs.withColumn("role", F.lit(1)).withColumn("part", every(blocks))
    dealt = asked.unionByName(against).repartition("part", "lane").sortWithinPartitions("part", "lane", "role")
    return dealt.mapInArrow(_search(positives, k, floor), "anchor_id long, slot int, id long, score long")


def mine(
    vectors: DataFrame,
    anchors: Column,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    positives: int = 5,
    negatives: int = 5,
    floor: int = 80,
    scale: int = 256,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score): hard negatives of the rows that
    ``anchors`` marks, for each of their first ``positives`` other rows of the same label.

    A negative has another label and a score from ``floor`` percent of the positive's up to it; the first ``negatives``
    come back, highest score first, equal scores by smaller id, fewer if there are fewer. A positive without any, such
    as one with a negative score, gives no row. Scores are integer inner products of floor(scale * x). Rows without an
    id or label, without a vector, or with a null or non-finite component take no part; vectors of different lengths
    are not compared. Rows that repeat an id are candidates each, but never of that id's own anchor; an anchor id with
    several rows is asked with the smallest label and vector. Empty tables give no rows; further columns are ignored.
    """
    usable = vectors.select(
        F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"),
        scaled(vector_col, scale).alias("v"), anchors.alias("asked"),
    ).where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull())
    rows = stored(usable, "vectors")
    n, asked = rows.agg(F.count("*"), F.count_if("asked")).first()
    blank = F.array().cast("array<long>")
    lanes = max(1, -(-n // (PACK * LANE)))
    packs = stored(_packed(rows.select(F.lit(0).alias("part"), "id", "label", "v", blank.alias("extra"))), "packs")
    packs = packs.withColumn("lane", F.pmod(F.xxhash64("ids"), F.lit(lanes)).cast("int"))
    sizes = (max(1, -(-asked // ANCHORS)), lanes)
    one = rows.where("asked").groupBy("id").agg(F.min(F.struct("label", "v")).alias("s"))
    one = stored(one.select("id", "s.label", "s.v", blank.alias("extra")), "anchors")

    found = _met(one, packs, sizes, 0, positives, floor)
    order = Window.partitionBy("anchor_id").orderBy(F.desc("score"), "id")
    best = found.withColumn("slot", F.row_number().over(order)).where(F.col("slot") <= positives)
    best = stored(best.select("anchor_id", "slot", F.col("id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")

    listed = best.groupBy("anchor_id").agg(F.map_from_entries(F.collect_list(F.struct("slot", "positive_score"))).alias("tops"))
    tops = F.transform(F.sequence(F.lit(1), F.lit(positives)), lambda s: F.coalesce(F.try_element_at("tops", s), F.lit(LOW + 1) - 1))
    wanted = one.join(listed.withColumnRenamed("anchor_id", "id"), "id").withColumn("extra", tops)
    found = _met(wanted, packs, sizes, positives, negatives, floor)
    order = Window.partitionBy("anchor_id", "slot").orderBy(F.desc("score"), "id")
    found = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
    return found.join(best, ["anchor_id", "slot"]).select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )

"""Exact top-k search by inner product with block-at-a-time pruning.

The components are the terms. Candidates are cut into ranges, and within a range into blocks of vectors that lie
close together; a block keeps its vectors (the forward index) and the largest and smallest value of every term.
For a query the sum over its terms of the larger product bounds every score in a block. A task takes the blocks
of its ranges by falling bound and scores them until the bound of the next one is below the k-th score found.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from matchbook.llm.store import stored

SCALE = 1024
BLOCK = 64
#: Vectors in a pack (the rows of one range that travel together) and queries in one block of the query set.
PACK, QUERIES = 4096, 1024
#: Tasks among which the packs are dealt for one block of queries.
LANES = 24
#: The score of no candidate; its negative still is a 64-bit number.
LOW = -(2**63) + 1


def scaled(column: str) -> F.Column:
    """floor(1024 * x) of every component; null for a vector that holds a null, infinite or undefined one."""
    one = lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) != float("inf")), F.lit(False))
    values = F.col(column).cast("array<double>")
    return F.when(F.forall(values, one), F.transform(values, lambda x: F.floor(x * SCALE)))


def _packed(rows: DataFrame, most: int) -> DataFrame:
    """(ids, values, dims): up to ``most`` vectors of one partition in each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = pa.compute.list_value_length(batch.column("v")).to_numpy(zero_copy_only=False)
            for dims in np.unique(sizes).tolist():
                own = np.flatnonzero(sizes == dims)
                for i in range(0, len(own), most):
                    part = batch.take(pa.array(own[i : i + most]))
                    ids = part.column("id").to_numpy().astype(np.int64)
                    values = part.column("v").flatten().to_numpy().astype(np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([ids.tobytes()]), pa.array([values.tobytes()]), pa.array([dims], pa.int32())],
                        names=["ids", "vals", "dims"],
                    )

    return rows.mapInArrow(run, "ids binary, vals binary, dims int")


def _blocks(values: np.ndarray) -> list[np.ndarray]:
    """Cut the rows in halves at the middle of the widest spread term, down to blocks."""
    todo, done = [np.arange(len(values))], []
    while todo:
        rows = todo.pop()
        if len(rows) <= BLOCK:
            done.append(rows)
            continue
        term = int(np.argmax(np.ptp(values[rows], axis=0))) if values.shape[1] else 0
        order = np.argsort(values[rows, term], kind="stable") if values.shape[1] else np.arange(len(rows))
        todo += [rows[order[: len(rows) // 2]], rows[order[len(rows) // 2 :]]]
    return done


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer products; in doubles where every sum stays below 2**53 and so is exact."""
    if a.size and b.size and float(np.abs(a).max()) * float(np.abs(b).max()) * a.shape[1] < 2.0**53:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    return a @ b.T


class Best:
    """The k best (score, id) of each query so far; equal scores go to the smaller id."""

    def __init__(self, ids: np.ndarray, values: np.ndarray, k: int) -> None:
        self.ids, self.values, self.k = ids, values, k
        self.scores = np.zeros((len(ids), 0), np.int64)
        self.found = np.zeros((len(ids), 0), np.int64)
        self.there = np.zeros((len(ids), 0), bool)

    def kth(self) -> np.ndarray:
        """The score a candidate must reach; the lowest number while there are fewer than k."""
        if self.scores.shape[1] < self.k:
            return np.full(len(self.ids), LOW)
        return np.where(self.there[:, -1], self.scores[:, -1], LOW)

    def add(self, rows: np.ndarray, scores: np.ndarray, ids: np.ndarray, there: np.ndarray) -> None:
        """Candidates of the queries in ``rows``; where ``there`` is false, there is none."""
        width = max(self.scores.shape[1], min(self.k, self.scores.shape[1] + scores.shape[1]))
        if width > self.scores.shape[1]:
            more = ((0, 0), (0, width - self.scores.shape[1]))
            self.scores = np.pad(self.scores, more, constant_values=LOW)
            self.found = np.pad(self.found, more)
            self.there = np.pad(self.there, more)
        there = np.hstack([self.there[rows], there])
        scores = np.where(there, np.hstack([self.scores[rows], scores]), LOW)
        ids = np.hstack([self.found[rows], ids])
        order = np.lexsort((ids, -scores, ~there), axis=1)[:, :width]
        self.scores[rows] = np.take_along_axis(scores, order, 1)
        self.found[rows] = np.take_along_axis(ids, order, 1)
        self.there[rows] = np.take_along_axis(there, order, 1)

    def search(self, ids: np.ndarray, values: np.ndarray) -> int:
        """Take in a pack; returns how many (query, vector) products were made."""
        blocks = _blocks(values)
        high = np.array([values[b].max(axis=0) for b in blocks])
        low = np.array([values[b].min(axis=0) for b in blocks])
        bounds = product(np.maximum(self.values, 0), high) + product(np.minimum(self.values, 0), low)
        order = np.argsort(-bounds, axis=1, kind="stable")
        made = 0
        for step in range(len(blocks)):
            chosen = order[:, step]
            open_ = bounds[np.arange(len(chosen)), chosen] >= self.kth()
            if not open_.any():
                break
            for block in np.unique(chosen[open_]).tolist():
                rows = np.flatnonzero(open_ & (chosen == block))
                own = ids[blocks[block]]
                scores = product(self.values[rows], values[blocks[block]])
                others = own[None, :] != self.ids[rows][:, None]
                made += scores.size
                self.add(rows, scores, np.broadcast_to(own, scores.shape), others)
        return made


def _search(k: int):
    def result(best: Best) -> pa.RecordBatch:
        rows = np.nonzero(best.there)[0]
        return pa.RecordBatch.from_arrays(
            [pa.array(best.ids[rows]), pa.array(best.found[best.there]), pa.array(best.scores[best.there])],
            names=["query_id", "vec_id", "score"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Packs come sorted by lane and block of queries; the k-th scores carry over from pack to pack."""
        now, best = None, None
        for batch in batches:
            for row in batch.to_pylist():
                if (row["part"], row["lane"]) != now:
                    if best is not None:
                        yield result(best)
                    now = (row["part"], row["lane"])
                    ids = np.frombuffer(row["q_ids"], np.int64)
                    best = Best(ids, np.frombuffer(row["q_vals"], np.int64).reshape(len(ids), row["dims"]), k)
                ids = np.frombuffer(row["ids"], np.int64)
                best.search(ids, np.frombuffer(row["vals"], np.int64).reshape(len(ids), row["dims"]))
        if best is not None:
            yield result(best)

    return run


def top_k(
    vectors: DataFrame, queries: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 10
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best other rows of each query by integer inner product.

    Equal scores go to the smaller id; a query gets fewer rows if there are fewer candidates. Ids may be negative.
    Vectors without an id, null, or with null or non-finite components take no part, nor are vectors of different
    lengths compared. Rows that repeat an id are candidates each, but never of that id's own query; a query id with
    several vectors is asked with the smallest of them. Empty tables give no rows; further columns are ignored.
    """
    flat = lambda rows: rows.select(F.col(id_col).cast("long").alias("id"), scaled(vector_col).alias("v")).where(
        F.col("v").isNotNull() & F.col("id").isNotNull()
    )
    # Candidates in ranges of ids; a pack is a bounded part of one range.
    ranges = max(1, vectors.count() // PACK)
    packs = _packed(flat(vectors).repartitionByRange(ranges, "id"), PACK)
    asked = flat(queries).groupBy("id").agg(F.min("v").alias("v"))
    asked = _packed(asked.repartition(max(1, queries.count() // QUERIES), "id"), QUERIES)
    asked = stored(asked.withColumn("part", F.monotonically_increasing_id()), "queries")
    # Every block of the query set meets every pack: once for each part number, in lanes.
    parts = [r.part for r in asked.select("part").collect()]
    met = packs.withColumn("lane", F.pmod(F.xxhash64("ids"), F.lit(LANES)))
    met = met.withColumn("part", F.explode(F.array(*[F.lit(p) for p in parts]).cast("array<long>")))
    asked = asked.select("part", "dims", F.col("ids").alias("q_ids"), F.col("vals").alias("q_vals"))
    met = met.join(asked, ["part", "dims"]).repartition("part", "lane").sortWithinPartitions("part", "lane")
    found = met.mapInArrow(_search(k), "query_id long, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
    )

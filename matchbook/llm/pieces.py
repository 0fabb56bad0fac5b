"""SentencePiece encoding and decoding with a table of distinct chunks.

SentencePiece writes a space as a marker and puts one marker before the text. If no piece of the vocabulary
has a marker after another character, no merge crosses the place before a run of markers, so the ids of a text
are the ids of its chunks (a run of markers and the word after it) one after the other. Each task keeps a table
of the distinct chunks it has met, segments each of them once, and joins their ids back by position. The table
stays with its task: a shuffle of all positions would cost more than segmenting a word once per task.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from matchbook.llm.store import slices

MARK = "▁"
CHUNK = re.compile(r" *[^ ]+| +")
#: Distinct chunks that a task keeps; a fuller table is emptied and filled anew, with the same results.
TABLE = 250_000
#: Bytes of text that are cut into chunks at once: a chunk takes some twenty times its length while it is looked up.
SLICE = 512 << 10


class ChunkTable:
    """Encode and decode whole texts; distinct chunks are segmented once."""

    def __init__(self, model: bytes, most: int = TABLE) -> None:
        self.model = sentencepiece.SentencePieceProcessor(model_proto=model)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        probe = f"a{MARK}  b"
        plain = self.model.decode(self.model.encode(probe)) == "a   b"  # nothing trimmed, folded or kept apart
        self.splits = plain and not any(MARK in p.lstrip(MARK) for p in pieces)
        self.most = most
        self._clear()

    def _clear(self) -> None:
        self.index: dict[str, int] = {}
        self.ids = np.zeros(0, np.int32)  # of all chunks, one after the other
        self.ends = np.zeros(1, np.int64)
        self.surface: list[str] = []

    def _learn(self, chunks: set[str]) -> None:
        new = [c for c in chunks if c not in self.index]
        if len(self.index) + len(new) > self.most:
            self._clear()
            new = list(chunks)
        if not new:
            return
        # The library adds one marker of its own, so it gets each chunk without its first space.
        alone = [self.model.piece_to_id(MARK)]
        ids = [x or alone for x in self.model.encode([c[1:] for c in new], num_threads=1)]
        self.index.update(zip(new, range(len(self.index), len(self.index) + len(new)), strict=True))
        # Most chunks decode to themselves and are not held twice.
        surface = [" " + text for text in self.model.decode(ids, num_threads=1)]
        self.surface += [c if c == text else text for c, text in zip(new, surface, strict=True)]
        self.ends = np.append(self.ends, self.ends[-1] + np.cumsum(list(map(len, ids))))
        self.ids = np.append(self.ids, np.fromiter(itertools.chain.from_iterable(ids), np.int32))

    def run(self, texts: list[str]) -> tuple[pa.ListArray, list[str]]:
        """The ids of each text, and the text that decoding them gives."""
        if not self.splits:
            ids = self.model.encode(texts, num_threads=1)
            return pa.array(ids, pa.list_(pa.int32())), self.model.decode(ids, num_threads=1)
        cut = [CHUNK.findall(" " + t.replace(MARK, " ")) if t else [] for t in texts]
        self._learn(set(itertools.chain.from_iterable(cut)))
        index, surface = self.index, self.surface
        chunk = np.fromiter((index[c] for chunks in cut for c in chunks), np.int64)
        texts_at = np.cumsum([0, *map(len, cut)])
        del cut
        size = self.ends[chunk + 1] - self.ends[chunk]
        before = np.append(0, np.cumsum(size))
        # Place k of the output is place k - before + start of the table, for the chunk it belongs to.
        places = np.arange(before[-1]) + np.repeat(self.ends[chunk] - before[:-1], size)
        offsets = before[texts_at].astype(np.int32)
        ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(self.ids[places]))
        ends = itertools.pairwise(texts_at.tolist())
        return ids, ["".join([surface[i] for i in chunk[start:end].tolist()])[1:] for start, end in ends]


def coded(table: ChunkTable, batches: Iterable[pa.RecordBatch], text_col: str, names: list[str]) -> Iterator[pa.RecordBatch]:
    """The rows of the batches with their ids and decoded texts, a slice at a time."""
    for batch in batches:
        for part in slices(batch, text_col, SLICE):
            ids, decoded = table.run([t or "" for t in part.column(text_col).to_pylist()])
            yield pa.RecordBatch.from_arrays([*part.columns, ids, pa.array(decoded, pa.string())], names=names)


def encode(docs: DataFrame, model_path: str, text_col: str = "text", ids_col: str = "ids", decoded_col: str = "decoded") -> DataFrame:
    """Add the ids of each whole text and their decoding, exactly as the library gives them.

    No begin or end ids, no sampling. Null and empty texts have no ids and decode to the empty text. Rows that
    repeat each give a row; an empty table gives none. Columns of ``docs`` with the new names are replaced.
    The model file is read by the driver and sent along, as its size does not depend on the data.
    """
    with open(model_path, "rb") as file:
        model = docs.sparkSession.sparkContext.broadcast(file.read())
    kept = [f for f in docs.schema.fields if f.name not in (ids_col, decoded_col)]
    docs = docs.select(*[f"`{f.name}`" for f in kept])
    schema = T.StructType(
        [*kept, T.StructField(ids_col, T.ArrayType(T.IntegerType())), T.StructField(decoded_col, T.StringType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return coded(ChunkTable(model.value), batches, text_col, schema.names)

    return docs.mapInArrow(run, schema)

import hashlib
import random
import tracemalloc

import public_tokenizers
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import sentencepiece

from matchbook.llm import pieces, queries

PATH = public_tokenizers.path("piece_bpe_32k.model")
MODEL = sentencepiece.SentencePieceProcessor(model_file=PATH)


def table(most=pieces.TABLE):
    with open(PATH, "rb") as file:
        return pieces.ChunkTable(file.read(), most)


def test_same_as_the_library():
    rng = random.Random(1)
    parts = [" ", "▁", "a", "the", "\n", "é", "😀", "<s>", "中", "́", "　", "\x00", "ing"]
    texts = ["", " ", "  ", "   a  b ", "▁▁", "﻿x", "x" * 5000, " " * 100, "<unk></s>"]
    texts += ["".join(rng.choice(parts) for _ in range(rng.randint(0, 25))) for _ in range(3000)]
    own = table()
    assert own.splits
    ids, decoded = own.run(texts)
    assert ids.to_pylist() == MODEL.encode(texts) and decoded == MODEL.decode(MODEL.encode(texts))


def test_a_small_table_gives_the_same():
    texts = [f"word{i} and word{i % 7} " * 3 for i in range(200)]
    own = table(most=10)
    for i in range(0, 200, 8):
        ids, _ = own.run(texts[i : i + 8])
        assert ids.to_pylist() == MODEL.encode(texts[i : i + 8])


def test_memory_is_that_of_a_slice():
    texts = [f"{i % 100} and of the w{i % 500} " * 20 for i in range(10_000)]  # 4 MB of text in one batch
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])
    own = table()
    tracemalloc.start()
    rows = sum(part.num_rows for part in pieces.coded(own, [batch], "text", ["text", "ids", "decoded"]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows == len(texts) and peak < 40e6


def test_query(spark, folder):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = queries.op6_sentencepiece(spark, folder).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = MODEL.encode(texts[r.doc_id])
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(MODEL.decode(ids).encode()).hexdigest()


def test_odd_rows(odd, nothing):
    coded = pieces.encode(odd, PATH)
    assert sorted(coded.columns) == sorted([*odd.columns, "decoded"])
    rows = coded.collect()
    assert len(rows) == odd.count()
    for r in rows:
        assert r.ids == MODEL.encode(r.text or "") and r.decoded == MODEL.decode(r.ids)
    assert pieces.encode(nothing, PATH).count() == 0

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from matchbook.llm import queries, toxicity

CLEAN = [a + b + c for a in ("ra", "mi", "to", "ne", "sul") for b in ("dor", "en", "lish", "ka") for c in ("", "ta", "wen")]
BAD = ["grubwit", "snarlpig", "mudbrain"]


def corpus(seed, n):
    rng = random.Random(seed)
    for i in range(n):
        words = [rng.choice(CLEAN) for _ in range(rng.randint(20, 120))]
        toxic = int(rng.random() < 0.2)
        if toxic:
            for _ in range(max(2, len(words) // 30)):
                words.insert(rng.randrange(len(words)), rng.choice(BAD))
        yield i, " ".join(words) + ".", toxic


@pytest.fixture(scope="module")
def machine():
    rows = list(corpus(1, 600))
    return toxicity.fit([r[1] for r in rows], [r[2] for r in rows])


def test_held_out_accuracy(machine):
    rows = list(corpus(2, 400))
    found = machine.scores([r[1] for r in rows]) >= toxicity.CUT
    assert np.mean(found == np.array([r[2] == 1 for r in rows])) > 0.98


def test_gaps_and_inserted_characters(machine):
    plain, clean = machine.scores(["radorta miliska grubwit grubwit nekawen", "radorta miliska nekawen sulenta"])
    assert plain > 0.9 > 0.1 > clean
    marks = lambda w: machine.word_scores([w])[0].max()
    for changed in ("grub-wit", "grrubwit", "gr.ubwit", "GRUBW1T", "g r u b w i t"):
        assert marks(changed) > marks("nekawen") + 0.5, changed


def test_the_table_is_the_kernel(machine):
    """Looking up weights gives the sum over subsequences of the word."""
    for word in ("grubwit", "mu-dbrain", "nekawen", "ab", "x"):
        direct = sum(v * machine.tables[n][code] for (n, code), v in toxicity.word_features(word).items()) + machine.bias
        assert machine.word_scores([f"other {word} words"])[0][1] == pytest.approx(direct, abs=1e-4)


def test_texts_do_not_influence_each_other(machine):
    texts = [r[1] for r in corpus(3, 30)] + ["", "  ", "1 2 3 !", "y", "grubwit"]
    assert np.allclose(machine.scores(texts), np.concatenate([machine.scores([t]) for t in texts]))


def test_longer_gaps_and_pieces(machine):
    marks = lambda w: machine.word_scores([w])[0].max()
    clean = marks("radorta miliska nekawen ra mi to ne")
    for k in (2, 3):
        assert marks(("*" * k).join("grubwit")) > clean + 0.5, k
    for changed in ("g . r . u . b . w . i . t", "grub wit", "gr ubw it", "mud bra in", "ra mi snar lpig to"):
        assert marks(changed) > clean + 0.5, changed


def test_pieces_are_one_row(machine):
    """A row of pieces has the distance of the kernel over its letters."""
    score = machine.word_scores(["other grub wit words"])[0][1]
    direct = sum(v * machine.tables[n][code] for (n, code), v in toxicity.word_features("grub wit").items()) + machine.bias
    assert score == pytest.approx(direct, abs=1e-4)


def test_rare_insults_are_learned():
    """Each of four insults is in 15 of 600 toxic documents and in no clean one."""
    rare = ["vexhoof", "quagjaw", "zobfink", "plimcrud"]

    def rows(seed, n, each):
        rng = random.Random(seed)
        for i in range(n):
            words = [rng.choice(CLEAN) + rng.choice(CLEAN)[:3] for _ in range(rng.randint(20, 120))]
            own = [rare[i // 2 % 4]] if i // 2 < 4 * each else BAD
            for _ in range(2 * (i % 2)):
                words.insert(rng.randrange(len(words)), rng.choice(own))
            yield " ".join(words) + ".", i % 2

    train, held = list(rows(1, 1200, 15)), list(rows(2, 400, 50))
    found = toxicity.fit(*map(list, zip(*train, strict=True))).scores([t for t, _ in held]) >= toxicity.CUT
    assert np.mean(found == [y == 1 for _, y in held]) > 0.97


def test_long_labelled_texts_are_used(spark):
    docs = spark.createDataFrame([(1, "a" * 7000), (2, "b"), (3, "c" * 9000), (4, "d" * 8000)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 0), (4, 0)], "doc_id long, toxic int")
    chosen = lambda most: sorted(r.doc_id for r in toxicity.training_sample(docs, labels, F.lit(True), most).collect())
    assert chosen(10) == [1, 2, 3, 4] and chosen(2) == [1, 2, 4]


def test_query(spark, folder):
    rows = queries.op3_toxicity(spark, folder).collect()
    assert len(rows) == spark.read.parquet(f"{folder}/documents.parquet").count()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    assert 0 < sum(r.held_out for r in rows) < len(rows)


def test_held_out_rows_and_other_columns_do_not_matter(spark):
    rows = list(corpus(4, 200))
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    flipped = labels.selectExpr("doc_id", "case when pmod(crc32(cast(doc_id as string)), 4) = 2 then 1 - toxic else toxic end toxic")
    usable = ~toxicity.held_out()
    texts = [t for _, t, _ in rows[:50]]
    one, two = (toxicity.train(docs, y, usable).scores(texts) for y in (labels, flipped))
    assert (one == two).all()


def test_odd_rows(spark, odd, nothing, machine):
    scored = toxicity.score(odd, machine)
    assert sorted(scored.columns) == sorted(odd.columns) and scored.count() == odd.count()
    assert scored.where("score is null or score < 0 or score > 1").count() == 0
    assert toxicity.score(nothing, machine).count() == 0
    labels = spark.createDataFrame([(3, 1, None), (None, 1, 0), (4, None, 1), (5, 0, 1), (77, 1, 1)], "doc_id long, toxic int, quality int")
    assert toxicity.clean_documents(odd, labels).columns == odd.columns
    assert toxicity.clean_documents(odd, labels.limit(0)).count() == odd.count()
    assert toxicity.clean_documents(nothing, labels).count() == 0

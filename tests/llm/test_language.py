import random

import numpy as np
import pytest

from matchbook.llm import language, queries

WORDS = {
    "en": "the house and river over with thing where people would there night".split(),
    "de": "der haus und fluss über mit ding wo leute würden dort nacht schön".split(),
    "fr": "le maison et rivière sur avec chose où gens seraient là nuit".split(),
}


def text(rng, lang, n):
    return " ".join(rng.choice(WORDS[lang]) for _ in range(n))


@pytest.fixture(scope="module")
def model(spark):
    rng = random.Random(1)
    rows = [(i, text(rng, lang, 50), lang) for i, lang in enumerate(list(WORDS) * 30)]
    rows += [(None, "x", "en"), (1000, None, "en"), (1001, "", "de"), (1002, "abc", None)]
    return language.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def test_long_texts_and_ties_teach(spark, monkeypatch):
    """A language that has only texts beyond FIT_CHARS is learned; of equally common languages the first names stay."""
    rng = random.Random(8)
    rows = [(i, text(rng, "en", 40), "en") for i in range(20)] + [(100 + i, text(rng, "de", 2000), "de") for i in range(20)]
    rows += [(None, text(rng, "fr", 40), "fr") for _ in range(20)] + [(7, rows[0][1], "en")] * 3
    docs = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, lang string, h string")
    model = language.train(docs.repartition(3))
    assert model.names == ["de", "en", "fr"]
    truth = list(WORDS) * 20
    assert [model.names[i] for i in model.evidence([text(rng, x, 12) for x in truth]).argmax(axis=1)] == truth
    monkeypatch.setattr(language, "LANGUAGES", 2)
    assert language.train(docs.where("lang <> 'en' OR doc_id > 0")).names == ["de", "en"]


def test_text_alone(model):
    rng = random.Random(2)
    truth = [rng.choice(list(WORDS)) for _ in range(300)]
    found = model.evidence([text(rng, lang, 12) for lang in truth]).argmax(axis=1)
    assert np.mean([model.names[i] == t for i, t in zip(found, truth, strict=True)]) > 0.98


def test_host_and_markup_decide_where_text_does_not(spark, model):
    rng = random.Random(3)
    rows = []
    for i in range(300):
        lang = ("de", "fr", "en")[i % 3]
        rows.append((i, f"https://{lang}.example.{lang}/p{i}", f'<html lang="{lang}"><p>{text(rng, lang, 20)}</p>'))
    rows += [(900, "https://de.example.de/x", "<html><p>123 456</p>"), (901, "http://fr.example.fr/", None)]
    rows += [(902, "https://new.example.de/", ""), (903, None, '<HTML LANG=fr-CA class="x"> '), (904, None, None)]
    got = {r.page_id: r for r in language.identify(pages(spark, rows).repartition(3), model).collect()}
    assert len(got) == len(rows) and all(0 < r.probability <= 1 for r in got.values())
    assert all(got[i].lang == ("de", "fr", "en")[i % 3] for i in range(300))
    assert (got[900].lang, got[901].lang, got[902].lang, got[903].lang) == ("de", "fr", "de", "fr")
    assert got[902].probability < got[900].probability
    # A declaration against clear text does not win.
    wrong = [*rows, (950, "https://de.example.de/y", f'<html lang="en"><p>{text(rng, "de", 60)}</p>')]
    assert {r.page_id: r.lang for r in language.identify(pages(spark, wrong), model).collect()}[950] == "de"


def test_visible_text():
    assert language.visible("<p>a &amp; b<script>var x='</p>';</script><!-- no <b> --> c</p>").split() == ["a", "&", "b", "c"]


def test_query(spark, folder):
    truth = {r.page_id: r.url.split("/")[3] for r in spark.read.parquet(f"{folder}/pages.parquet").collect()}
    rows = queries.op8_language(spark, folder).collect()
    assert len(rows) == len(truth)
    assert np.mean([r.lang == truth[r.page_id] for r in rows]) > 0.97
    assert np.mean([r.text_lang == truth[r.page_id] for r in rows]) > 0.9


def test_repeats_clashing_columns_and_empty_tables(spark, model):
    rows = [(1, "http://a.example.com/", "<p>the house</p>", "clash", "clash")] * 3
    frame = spark.createDataFrame(rows, "page_id long, url string, html string, host string, lang string")
    assert language.identify(frame, model).count() == 3
    assert language.identify(frame.limit(0), model).count() == 0
    none = language.train(spark.createDataFrame([], "doc_id long, text string, lang string"))
    assert [r.lang for r in language.identify(frame, none).collect()] == [None] * 3

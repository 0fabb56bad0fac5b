import hashlib

import public_tokenizers
import sentencepiece

import __spark_entry__ as entry
import corpus_pipeline
from matchbook.llm import mixing, pii, simhash, toxicity
from matchbook.llm.store import stored


def test_all_operators_are_registered():
    names = entry.queries()
    assert "pipeline" in names
    assert all(sum(n.startswith(f"op{k}_") for n in names) == 1 for k in range(1, 14))


def test_stages_against_their_parts(spark, folder):
    """Each stage does what its operator says, on what the stage before it kept."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, anchors = docs.columns, pii.automaton()
    at = {"start": docs}
    for name, stage in corpus_pipeline.STAGES:
        docs = at[name] = stored(stage(spark, docs, folder), name)
        if name != "sentencepiece":
            assert docs.columns == columns
    rows = {k: f.collect() for k, f in at.items()}

    labels = spark.read.parquet(f"{folder}/labels.parquet")
    machine = toxicity.train(at["start"], labels)
    scores = machine.scores([r.text or "" for r in rows["start"]])
    assert {r.doc_id for r in rows["toxicity"]} == {r.doc_id for r, s in zip(rows["start"], scores, strict=True) if s < toxicity.CUT}

    prints = {}
    for r in sorted(rows["toxicity"], key=lambda r: r.doc_id):
        prints[r.doc_id] = simhash.fingerprint(r.text)
    groups = []
    for i, f in prints.items():
        near = [g for g in groups if any((f ^ prints[j]).bit_count() <= 3 for j in g)]
        groups = [g for g in groups if g not in near] + [sum(near, [i])]
    assert sorted(r.doc_id for r in rows["simhash_near_dedup"]) == sorted(min(g) for g in groups)

    kept = {r.doc_id: r for r in rows["simhash_near_dedup"]}
    clean = {i: pii.cleaned(r.text, anchors) for i, r in kept.items()}
    assert {r.doc_id: r.text for r in rows["pii"]} == clean
    assert any(clean[i] != kept[i].text for i in kept)

    taken = {r.doc_id: r.taken for r in mixing.mix(at["pii"]).collect()}
    words = dict.fromkeys(taken, 0)
    for r in rows["mixing"]:
        words[r.doc_id] += len(r.text.split())
    assert words == taken

    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    ids = [model.encode(r.text) for r in rows["mixing"]]
    wanted = [(r.doc_id, len(i), hashlib.sha256(",".join(map(str, i)).encode()).hexdigest()) for r, i in zip(rows["mixing"], ids, strict=True)]
    assert sorted(map(tuple, (r[:3] for r in rows["sentencepiece"]))) == sorted(wanted)


def test_stages_on_odd_and_empty_documents(spark, odd, nothing, folder):
    for docs in (odd, nothing):
        for name, stage in corpus_pipeline.STAGES:
            columns = docs.columns
            docs = stored(stage(spark, docs, folder), name)
            assert name == "sentencepiece" or docs.columns == columns

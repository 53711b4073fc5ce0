"""The pipeline's stages, one behind the other, against their plain versions."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import brute
import corpus_pipeline
from vacancia.llm import common, ledger, pieces

ITEMS = [(1, brute.sentences(99, 80)), (2, brute.sentences(1, 30))]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("tables"))
    brute.frame(spark, brute.documents()).write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame(ITEMS, "item_id bigint, text string").write.parquet(f"{root}/benchmark.parquet")
    return root


@pytest.fixture(scope="module")
def steps(spark, folder):
    docs = [spark.read.parquet(f"{folder}/documents.parquet")]
    for name, stage in corpus_pipeline.STAGES:
        docs.append(common.saved(stage(spark, docs[-1], folder), "step"))
    return docs


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_stages_keep_the_columns_of_documents(steps):
    assert all(df.columns == steps[0].columns for df in steps[1:-1])
    assert [f.dataType for f in steps[-2].schema] == [f.dataType for f in steps[0].schema]


def test_texts_without_a_language_go(steps):
    before, after = texts(steps[0]), texts(steps[1])
    gone = {d for d, t in before.items() if not any(map(str.isalpha, t or ""))}
    assert gone and not gone & set(after)
    assert set(range(60)) <= set(after)  # prose stays
    assert steps[1].where(F.col("lang").isNull()).count() == 0


def test_mixtures_stay_and_unknown_languages_go(spark):
    german = "über straße schön mädchen zwölf größe hälfte früh jäger wörter gänse".split()
    french = "être où déjà forêt naïf çà élève très après voilà garçon hôtel".split()
    own = [brute.sentences(1, 900), brute.sentences(2, 900, french), brute.sentences(3, 900, german)]
    mixed = " ".join(" ".join(t.split()[k : k + 40]) for t in own for k in (0, 300))
    rng = np.random.default_rng(1)
    junk = " ".join("".join(rng.choice(list("bcdfghjkqvwxyz"), 7)) for _ in range(120))
    greek = brute.sentences(4, 120, "λόγος άνθρωπος θάλασσα ουρανός ημέρα νύχτα δρόμος".split())
    rows = [(i, t, lang, None, len(t)) for i, (t, lang) in enumerate(zip([*own, mixed, junk, greek], ["en", "fr", "de", None, None, None]))]
    kept = corpus_pipeline.identify_language(spark, brute.frame(spark, rows), "")
    assert set(texts(kept)) == {0, 1, 2, 3}


def test_one_of_each_class_stays(steps):
    classes = brute.links(list(texts(steps[1]).items()))
    assert set(texts(steps[2])) == {d for d, (least, _) in classes.items() if d == least}


def test_benchmark_passages_go(steps):
    hits = brute.benchmark_hits(list(texts(steps[2]).items()), ITEMS)
    assert texts(steps[3]) == {d: t for d, t in texts(steps[2]).items() if not hits[d][4]}
    assert any(x[4] for x in hits.values())


def test_secrets_are_masked(steps):
    before, after = texts(steps[3]), texts(steps[4])
    assert set(before) == set(after)
    for d, t in before.items():
        assert not brute.secrets(after[d])
        assert after[d] == t or ledger.MASK in after[d]
    assert any(ledger.MASK in t for t in after.values())


def test_ids_are_the_texts(steps):
    known = pieces.model(pieces.default_path())
    rows = {r.doc_id: r.ids for r in steps[5].collect()}
    for d, t in texts(steps[4]).items():
        assert known.decode(np.array(rows[d])) == t.replace("▁", " ")


def test_run_is_all_stages(spark, folder, steps):
    run = corpus_pipeline.run(spark, folder)
    assert sorted(map(str, run.collect())) == sorted(map(str, steps[5].collect()))

"""The pipeline's stages against plain versions, and on awkward tables."""

import re

import pytest

import __spark_entry__
import corpus_pipeline as pipeline
from tests.llm.test_decontam import least_edits
from tests.llm.test_partenum import plain_sets
from tracklab.llm import decontam, pii, toxicity
from tracklab.llm.common import table


@pytest.fixture(scope="module")
def stages(spark, sf, tmp_path_factory):
    base, docs, out = tmp_path_factory.mktemp("stages"), table(spark, sf, "documents"), {}
    out["documents"] = docs.collect()
    for name, stage in pipeline.STAGES:
        stage(spark, docs, sf).write.parquet(f"{base}/{name}")
        docs = spark.read.parquet(f"{base}/{name}")
        out[name] = docs.collect()
    return out


def ids(rows):
    return {r.doc_id for r in rows}


def test_toxic_documents_go(spark, sf, stages):
    docs = table(spark, sf, "documents")
    chain = toxicity.train(docs, toxicity.label_categories(table(spark, sf, "labels")), toxicity.CATEGORIES)
    want = {r.doc_id for r in stages["documents"] if toxicity.predict(chain, r.text or "")[-1] < toxicity.THRESHOLD}
    assert ids(stages["toxicity"]) == want and stages["toxicity"][0].__fields__ == stages["documents"][0].__fields__


def test_one_of_each_group_stays(stages):
    rows = sorted((r.doc_id, r.text) for r in stages["toxicity"])
    sets, group = plain_sets(rows, 5), list(range(len(rows)))
    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 80 * len(a | sets[j]):
                group = [group[j] if g == group[i] else g for g in group]
    want = {min(rows[k][0] for k in range(len(rows)) if group[k] == g) for g in set(group)}
    assert ids(stages["near_copies"]) == want


def test_contaminated_documents_go(spark, sf, stages):
    items = [decontam.normal(r.text) for r in table(spark, sf, "benchmark").collect()]
    gone = ids(stages["near_copies"]) - ids(stages["decontamination"])
    for r in stages["near_copies"]:
        body = decontam.normal(r.text)
        if any(i in body for i in items):
            assert r.doc_id in gone
        elif r.doc_id in gone:
            assert any(least_edits(i, body) <= decontam.ERROR_RATE * len(i) for i in items)


def test_private_values_are_replaced(spark, stages):
    before = {r.doc_id: r.text for r in stages["decontamination"]}
    after = {r.doc_id: r for r in stages["private_values"]}
    assert before.keys() == after.keys()
    for k, text in before.items():
        for value in re.findall(r"[\w.]+@mail\d+\.example\.com|\+1 \(\d{3}\) 555-\d{4}|\b[0-9a-f]{40}\b", text):
            assert value not in after[k].text
        if not re.search(r"[0-9@]", text):
            assert after[k].text == text
        assert after[k].n_chars == len(after[k].text)


def test_mix_follows_targets(stages):
    words = {}
    sizes = {r.doc_id: len(re.findall(r"[^\x20\x09-\x0D]+", r.text)) for r in stages["private_values"]}
    per_doc = {}
    for r in stages["mixing"]:
        assert len(re.findall(r"[^\x20\x09-\x0D]+", r.text)) == r.words > 0
        words.setdefault(r.source, [0, r.target])[0] += r.words
        per_doc[r.doc_id] = per_doc.get(r.doc_id, 0) + r.words
    assert all(got == int(target) for got, target in words.values())
    assert all(n <= 2 * sizes[k] for k, n in per_doc.items())


def test_registered_and_lazy_pieces(spark, sf, stages):
    assert __spark_entry__.queries()["pipeline"] is pipeline.run
    assert "pipeline" not in __spark_entry__.oracle_sql()
    got = sorted((r.doc_id, r.repetition, r.words) for r in pipeline.run(spark, sf).collect())
    assert got == sorted((r.doc_id, r.repetition, r.words) for r in stages["mixing"])


def test_awkward_documents(spark, sf, frame, tmp_path):
    rows = [(None, None, None, None, None, "a"), (1, "", "en", "s", 0, "b"), (2, "some words here", None, None, 15, "c"), (2, "some words here", None, None, 15, "c"),
            (3, "x " * 50_000, "en", "s", 100_000, "d"), (4, "1.2.3.4 and more", "en", "t", 16, "e")]
    docs = frame(rows, "doc_id long, text string, lang string, source string, n_chars long, n_private string")
    for name, stage in pipeline.STAGES:
        columns = docs.columns
        stage(spark, docs, sf).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        if name != "mixing":
            assert docs.columns == columns
        if name == "near_copies":
            assert sorted(r.doc_id or -1 for r in docs.collect()) == [-1, 1, 2, 3, 4]
    assert {r.doc_id for r in docs.collect()} <= {2, 3, 4}
    assert pii.KEY


def test_empty_documents(spark, sf, frame, tmp_path):
    docs = frame([], "doc_id long, text string, lang string, source string, n_chars long", 1)
    for name, stage in pipeline.STAGES:
        stage(spark, docs, sf).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        assert docs.count() == 0

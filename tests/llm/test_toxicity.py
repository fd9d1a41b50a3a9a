"""The chain on held-out labels, its use of earlier categories, and rows without information."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tracklab.llm import toxicity
from tracklab.llm.common import table
from tracklab.llm.toxicity import CATEGORIES


def test_held_out_documents(spark):
    directory = "/root/testdata/sf0.01"
    docs = table(spark, directory, "documents").select("doc_id", "text")
    labels = toxicity.label_categories(table(spark, directory, "labels"))
    test = F.pmod(F.xxhash64(F.lit(5), "doc_id"), F.lit(4)) == 0
    chain = toxicity.train(docs, labels.filter(~test), CATEGORIES)
    rows = toxicity.score(docs.join(labels.filter(test), "doc_id"), chain).collect()
    wrong = sum(r.is_toxic for r in rows if not r.toxic)
    english = [r for r in rows if r.toxic and any(w in r.text.lower() for w in ("idiot", "moron", "scum", "worthless", "pathetic", "trash"))]
    assert wrong <= 0.02 * len(rows) and sum(r.is_toxic for r in english) >= 0.6 * len(english)
    junk = [(r.p_low_quality >= 0.5) == bool(r.low_quality) for r in rows]
    assert sum(junk) >= 0.95 * len(junk)


def synthetic(n, seed):
    rng = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        rude, loud = rng.random() < 0.3, rng.random() < 0.3
        words = [f"w{rng.randrange(400)}".replace("0", "o") + rng.choice("abcdefgh") * 2 for _ in range(30)]
        if rude:
            words[rng.randrange(30)] = rng.choice(["nasty", "vile", "rotten"])
        if loud:
            words[rng.randrange(30)] = "shouting"
        docs.append((i, " ".join(words)))
        labels.append((i, int(loud), int(rude), int(rude and loud)))
    return docs, labels


def test_chain_feeds_earlier_categories(frame):
    docs, labels = synthetic(900, 3)
    chain = toxicity.train(frame(docs, "doc_id long, text string"), frame(labels, "doc_id long, loud int, rude int, both int"), ("loud", "rude", "both"))
    width = len(chain.words) + toxicity.N_RATIOS
    assert [len(w) for w, _ in chain.models] == [width, width + 1, width + 2]
    assert (chain.models[2][0][width:] > 0).all()  # the conjunction leans on both
    held, truth = synthetic(300, 4)
    got = {r.doc_id: r for r in toxicity.score(frame(held, "doc_id long, text string"), chain).collect()}
    for i, loud, rude, both in truth:
        p = toxicity.predict(chain, held[i][1])
        assert [got[i].p_loud, got[i].p_rude, got[i].p_both] == pytest.approx(p)
    right = [got[i].is_both == bool(b) for i, *_, b in truth]
    assert sum(right) >= 0.95 * len(right)


def test_near_copies_count_once():
    a = toxicity.word_list("a long text with many different words in it and then some more of them to read")
    b = a[:-1] + ["changed"]
    assert sum(toxicity.near_copy_key(a) == toxicity.near_copy_key(a[:k] + ["other"] + a[k + 1:]) for k in range(len(a))) > len(a) / 2
    assert toxicity.near_copy_key([]) == toxicity.near_copy_key([]) and isinstance(toxicity.near_copy_key(b), int)


def test_without_information(frame):
    docs = frame([(1, None, "x"), (1, None, "x"), (2, "", "y"), (None, "some text", "z"), (3, "word " * 100_000, "q")], "doc_id long, text string, is_toxic string")
    schema = "doc_id long, low_quality int, toxic int"
    for labels in ([], [(1, 0, 0)], [(3, 0, 0), (3, 0, 0), (7, 1, 1)], [(3, None, 1), (2, 0, 1)]):
        chain = toxicity.train(docs, frame(labels, schema, 1), CATEGORIES)
        rows = toxicity.score(docs, chain).collect()
        assert len(rows) == 5 and rows[0].__fields__.count("is_toxic") == 1
        want = labels == [(3, None, 1), (2, 0, 1)]  # all sampled labels toxic: so is everything
        assert {r.is_toxic for r in rows} == {want}
        assert toxicity.without(docs, chain).columns == docs.columns
    empty = frame([], "doc_id long, text string", 1)
    assert toxicity.score(empty, toxicity.train(empty, frame([], schema, 1), CATEGORIES)).count() == 0


def test_sigmoid_is_stable():
    assert toxicity.sigmoid(-1000) == 0 and toxicity.sigmoid(1000) == 1 and np.isclose(toxicity.sigmoid(0.3) + toxicity.sigmoid(-0.3), 1)

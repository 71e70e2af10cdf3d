"""Operators do the whole job: nothing is left out as the input grows."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from gridjobs.llm import ctw, quality_mil, toxicity_knn
from gridjobs.llm.common import held_out

from dense_tree import Tree


def words(seed, n):
    r = np.random.default_rng(seed)
    return " ".join("".join(r.choice(list("abcdefghij"), 4)) for _ in range(n))


@pytest.mark.parametrize("least", [1, 2])
def test_every_context_has_its_place(spark, monkeypatch, least):
    monkeypatch.setattr(ctw, "CHARS", 700)
    monkeypatch.setattr(ctw, "TOGETHER", 1)
    texts = [words(i % 9, 40 + i) + " é"[: i % 3] for i in range(24)] + ["", "zebra Zebra! \x07", "Once"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.score for r in ctw.score_documents(docs, F.col("doc_id") >= 20, least=least).collect()}
    own = [t.encode().lower() for t in texts[:20]]
    keys, n = ctw.Bytes(ctw.joined(own, ctw.DEPTH), np.array(list(map(len, own))), ctw.DEPTH).counted()
    cells = []
    for d in range(ctw.DEPTH + 1):
        part = pd.DataFrame({"ctx": (keys >> np.uint64(8 * (ctw.DEPTH + 1 - d))).astype(np.int64), "sym": (keys & np.uint64(255)).astype(int), "n": n}).groupby(["ctx", "sym"], as_index=False).sum()
        visits = part.groupby("ctx")["n"].transform("sum")
        cells.append(part[visits >= least].assign(d=d))
    tree = Tree(pd.concat(cells), ctw.DEPTH)
    want = tree.score([t.encode().lower() for t in texts])
    assert [got[i] for i in range(len(texts))] == pytest.approx(want, abs=1e-3, rel=1e-4)


def test_toxicity_searches_every_text_over_all_terms(spark):
    texts = [(i, words(i % 30, 30) + (" slurx" if i % 6 == 0 else "")) for i in range(120)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 6 == 0)) for i, _ in texts], "doc_id long, toxic int")
    model = toxicity_knn.learn(docs, labels)
    learned = {r.doc_id for r in docs.filter(~held_out(F.col("doc_id"), 5, 0)).collect()}
    assert set(model.index.value.ids.tolist()) == learned
    got = {r.doc_id: r.nearest for r in toxicity_knn.score_toxicity(docs, model).collect()}
    assert all(n in learned and dict(texts)[n].split()[:30] == dict(texts)[i].split()[:30] for i, n in got.items() if any((i - j) % 30 == 0 for j in learned))
    assert None not in got.values()


def test_quality_learns_from_every_passage(spark, monkeypatch):
    docs = spark.createDataFrame([(i, "a b c " * (80 * 100 if i == 1 else 10)) for i in range(12)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(12)], "doc_id long, quality int")
    sizes = []
    monkeypatch.setattr(quality_mil.AttentionBags, "fit", lambda self, x, n, y, weight: sizes.extend(n.tolist()) or self)
    quality_mil.learn(docs, labels)
    assert max(sizes) == 100

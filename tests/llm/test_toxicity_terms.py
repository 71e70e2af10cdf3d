"""Texts are taken apart once: their terms are kept as frequencies are counted, and scored from there."""

from gridjobs.llm import toxicity_knn

WORDS = [f"w{i}" for i in range(40)]


def test_scores_from_kept_terms_are_those_of_the_texts(spark):
    texts = [" ".join(WORDS[(i * k) % 40] for k in range(1, 9)) + (" awful awful" if i % 3 == 0 else " fine") for i in range(90)]
    rows = [(f"d{i}", t) for i, t in enumerate(texts)] + [("e", ""), ("n", None), (None, "awful w1"), ("d0", texts[0]), ("x", "unknown, words?"), ("p", "W1.w2 (AWFUL)\tw3")]
    docs = spark.createDataFrame(rows, "doc_id string, text string").repartition(3)
    labels = spark.createDataFrame([(f"d{i}", int(i % 3 == 0)) for i in range(90)], "doc_id string, toxic int")
    model, terms = toxicity_knn.learn_with(docs, labels)
    assert set(terms.columns) == {"doc_id", "terms", "counts"}
    plain = toxicity_knn.learn(docs, labels)
    assert (model.index.value.weight == plain.index.value.weight).all()
    show = lambda df: sorted(((r.doc_id or "", round(r.score, 9), r.nearest or "", round(r.cosine, 9), r.toxic_near) for r in df.collect()))
    got = toxicity_knn.score_terms(terms, model)
    assert show(got) == show(toxicity_knn.score_toxicity(docs, plain))
    assert got.count() == len(rows)
    # nothing is read but the kept terms
    assert got.inputFiles()
    assert all("toxicity-terms" in f for f in got.inputFiles())


def test_no_documents_and_no_labels(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    model, terms = toxicity_knn.learn_with(docs, labels)
    assert toxicity_knn.score_terms(terms, model).count() == 2
    model, terms = toxicity_knn.learn_with(docs.limit(0), labels)
    assert toxicity_knn.score_terms(terms, model).count() == 0

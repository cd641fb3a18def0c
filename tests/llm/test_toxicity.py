import random

import numpy as np
import pytest

from quotalens.llm import toxicity
from tests.llm.conftest import prose


@pytest.fixture(scope="module")
def marked(spark):
    """Documents with rude words labelled toxic, a quarter of the labels held out."""
    rnd, docs, labels = random.Random(1), [], []
    for i in range(400):
        words = prose(i, rnd.randint(20, 120)).split()
        bad = i % 4 == 0
        if bad:
            for w in rnd.choices(["blockhead", "nitwit", "dunce"], k=5):
                words.insert(rnd.randrange(len(words)), w)
        docs.append((i, " ".join(words)))
        labels.append((i, 1, int(bad)))
    return (spark.createDataFrame(docs, "doc_id long, text string").cache(),
            spark.createDataFrame(labels, "doc_id long, quality int, toxic int").cache())


def test_held_out_rows(marked):
    docs, labels = marked
    rows = toxicity.op4(docs, labels).collect()
    held = [r for r in rows if r.held_out]
    assert len(rows) == 400 and 60 < len(held) < 140
    right = sum(r.predicted == (r.doc_id % 4 == 0) for r in held)
    assert right / len(held) > 0.95 and all(0 <= r.score <= 1 for r in rows)


def test_held_out_labels_are_not_read(marked):
    from pyspark.sql import functions as F
    from quotalens.llm.common import fold
    docs, labels = marked
    flipped = labels.withColumn("toxic", F.when(fold(F.col("doc_id"), 4) == 2, 1 - F.col("toxic"))
                                .otherwise(F.col("toxic")))
    a, b = (sorted(tuple(r) for r in toxicity.op4(docs, x).collect()) for x in (labels, flipped))
    assert a == b


def test_a_bound_below_the_table_keeps_the_scale_of_the_scores(marked):
    docs, labels = marked
    whole = toxicity.fit(toxicity.labelled_rows(docs, labels))
    cut = toxicity.fit(toxicity.labelled_rows(docs, labels, max_toxic=40, max_ordinary=160))
    means, kept = [], []
    for model in (whole, cut):
        rows = toxicity.score(docs, model).collect()
        means.append(sum(r.toxicity for r in rows) / len(rows))
        clean = [r for r in rows if r.doc_id % 4]
        kept.append(sum(r.toxicity < toxicity.CUT for r in clean) / len(clean))
    assert abs(means[0] - means[1]) < 0.06 and min(kept) > 0.93
    rows = toxicity.labelled_rows(docs, labels, max_toxic=40, max_ordinary=160).groupBy("toxic").agg(
        {"*": "count", "weight": "max"}).collect()
    for r in rows:  # the weights stand for all labelled rows of the class
        assert abs(r["count(1)"] * r["max(weight)"] - (75 if r.toxic else 225)) < 30


def test_words_without_counts_say_nothing():
    model = toxicity.Model(*(np.zeros((2, n), np.float32) for n in (toxicity.PAIRS, toxicity.WORDS, toxicity.WORDS)),
                           np.full((2, toxicity.WORDS), 1e-5, np.float32), np.zeros(toxicity.FEATURES + 1))
    f = model.features(["never seen words", ""], toxicity.Words())
    assert np.allclose(f[0, :-1], 0, atol=1e-6) and (f[1] == 0).all()


def test_edge_rows(spark, edge, empty, marked):
    _, labels = marked
    none = spark.createDataFrame([(None, None, None)], "doc_id long, quality int, toxic int")
    assert toxicity.op4(edge, none).count() == edge.count()
    assert toxicity.op4(empty, labels).count() == 0
    kept = toxicity.keep_civil(edge, labels)
    assert kept.columns == edge.columns and kept.count() > 0

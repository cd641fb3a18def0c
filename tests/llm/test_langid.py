import random

import numpy as np

from quotalens.llm import langid

SOUNDS = {"aa": ["ba", "na", "ra", "la"], "bb": ["sch", "ung", "ein", "ver"], "cc": ["éau", "oui", "que", "ment"]}


def texts(seed, n):
    rnd = random.Random(seed)
    for i in range(n):
        lang = rnd.choice(sorted(SOUNDS))
        yield lang, " ".join("".join(rnd.choices(SOUNDS[lang], k=rnd.randint(1, 4))) for _ in range(rnd.randint(3, 60)))


def test_held_out_accuracy(spark):
    rows = [(i, t, l) for i, (l, t) in enumerate(texts(1, 400))]
    rows += [(1000, "12 34 !!", "aa"), (1001, None, "bb"), (1002, "sch ung ein", None)]
    got = {r.doc_id: r for r in langid.op5(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    held = [i for i in range(400) if got[i].held_out]
    assert sum(got[i].lang_pred == rows[i][2] for i in held) / len(held) > 0.95
    assert got[1000].lang_pred == got[1001].lang_pred == "und"
    assert all(0 <= r.score <= 1 for r in got.values())


def test_windows_hold_every_byte():
    raw = np.arange(1, 251, dtype=np.uint8)
    windows, doc, nth = langid.cut_windows(raw, np.array([0, 3, 3, 250]), 16)
    for d, (a, b) in enumerate(((0, 3), (3, 3), (3, 250))):
        own = windows[doc == d][np.argsort(nth[doc == d])].ravel()
        assert (own[:b - a] == raw[a:b]).all() and (own[b - a:] == 0).all()


def test_gradient_lowers_the_loss():
    rng = np.random.default_rng(0)
    x = rng.integers(97, 101, (300, 32)).astype(np.uint8)
    y = (x[:, 5] == 97).astype(int)
    x[y == 1, 10:13] = 120
    net = langid.train(x, y, ["n", "y"], epochs=60)
    assert (net.log_probs(x).argmax(1) == y).mean() > 0.95


def test_edge_rows(edge, empty):
    assert langid.op5(edge).count() == edge.count()
    assert langid.op5(empty).count() == 0

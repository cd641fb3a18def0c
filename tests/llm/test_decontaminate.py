import random

import numpy as np
import pytest

from quotalens.llm import decontaminate as dc
from tests.llm.conftest import prose


@pytest.fixture(scope="module")
def planted(spark):
    """Items inside documents: exact, with words changed, and only half of them."""
    rnd = random.Random(6)
    items = [(k, prose(500 + k, rnd.randint(18, 50)) + ". " + prose(700 + k, 6) + ".") for k in range(12)]
    docs, want = [], set()
    for i in range(80):
        words = prose(i, rnd.randint(30, 300)).split(" ")
        k = i % 20
        if k < 12:
            own = items[k][1].split(" ")
            if i % 3 == 1:
                for _ in range(len(own) // 10):
                    own[rnd.randrange(len(own))] = "changed"
            if i % 3 == 2:
                own = own[:len(own) // 3]
            else:
                want.add((i, k))
            at = rnd.randrange(len(words))
            words[at:at] = own
        docs.append((i, " ".join(words)))
    return (spark.createDataFrame(docs, "doc_id long, text string").cache(),
            spark.createDataFrame([*items, (99, None), (98, "")], "item_id long, text string").cache(), want)


def test_planted_items_are_found(planted):
    docs, items, want = planted
    got = {(r.doc_id, r.item_id) for r in dc.op10(docs, items).collect()}
    assert got <= want and len(got) >= 0.9 * len(want)
    kept = {r.doc_id for r in dc.keep_clean(docs, items).collect()}
    assert kept == set(range(80)) - {d for d, _ in got}


def test_items_in_blocks_give_the_same(planted, monkeypatch):
    docs, items, _ = planted
    space = dc.fit(dc.id_text(docs))
    rows = lambda: sorted((r.doc_id, r.item_id, round(r.cosine, 4), r.share)
                          for r in dc.leaks(docs, items, space).collect())
    whole = rows()
    monkeypatch.setattr(dc, "BLOCK", 5)
    assert rows() == whole


def test_subsequence_against_plain_table():
    rnd = random.Random(2)
    for _ in range(50):
        a, b = ([rnd.randint(0, 5) for _ in range(rnd.randint(1, 30))] for _ in range(2))
        row = [0] * (len(b) + 1)
        for x in a:
            new = [0]
            for j, y in enumerate(b):
                new.append(max(row[j] + 1 if x == y else 0, row[j + 1], new[j]))
            row = new
        assert dc.common(a, b) == row[-1]


def test_singular_vectors_span_the_leading_space():
    rng = np.random.default_rng(1)
    base = rng.normal(size=(300, 5)) @ rng.normal(size=(5, dc.FEATURES)) + 0.01 * rng.normal(size=(300, dc.FEATURES))
    fold = dc._nystroem(base.T @ (base @ dc._omega()))
    top = np.linalg.svd(base, full_matrices=False)[2][:5]
    q = np.linalg.qr(fold[:, :5].astype(float))[0]
    assert np.linalg.norm(top - top @ q @ q.T) < 0.05


def test_edge_rows(edge, empty, planted):
    _, items, _ = planted
    none = items.where("item_id < 0")
    assert dc.op10(edge, none).count() == 0 and dc.op10(empty, items).count() == 0
    kept = dc.keep_clean(edge, items)
    assert kept.columns == edge.columns and kept.count() == edge.count()


def test_a_paraphrase_that_keeps_the_common_words_is_found(spark):
    """40 words of 40 kinds; 15 of the 20 rarer ones are replaced, 25 words stay in order."""
    rnd = random.Random(8)
    common = [f"common{k}" for k in range(20)]
    rare = [f"rare{k}" for k in range(20)]
    item = [w for pair in zip(common, rare) for w in pair]
    lost = set(rnd.sample(rare, 15))
    leak = [f"other{w}" if w in lost else w for w in item]
    docs = [(0, " ".join(leak)), (1, " ".join(item))]
    for i in range(2, 200):  # every common word in most documents, in other orders
        docs.append((i, " ".join(rnd.sample(common, 12) + [f"own{rnd.randrange(3000)}" for _ in range(20)])))
    got = {r.doc_id: r.share for r in dc.op10(spark.createDataFrame(docs, "doc_id long, text string"),
                                              spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")).collect()}
    assert got.keys() == {0, 1} and got[0] == 25 / 40


def test_shared_words_bound_the_subsequence():
    rnd = random.Random(3)
    for _ in range(50):
        a, b = ([rnd.randint(0, 9) for _ in range(rnd.randint(1, 30))] for _ in range(2))
        known = np.unique(np.array(a, np.uint64))
        kinds = np.unique(np.searchsorted(known, np.array(a, np.uint64)), return_counts=True)
        items = dc.Items([0], [a], [a], [], known, [kinds])
        low = np.array([rnd.randrange(len(b)) for _ in range(6)] + [0])
        high = np.array([rnd.randint(x, len(b)) for x in low[:-1]] + [len(b)])
        got = dc.Places(items, np.array(b, np.uint64)).overlap(kinds, low, high)
        for x, lo, hi in zip(got, low, high):
            part = b[lo:hi]
            assert dc.common(a, part) <= x == sum(min(a.count(v), part.count(v)) for v in set(a))


@pytest.mark.parametrize("length", [5, 6, 8, 9, 10, 15, 24, 60])
def test_verbatim_items_of_every_length_are_found(spark, length):
    rnd = random.Random(length)
    items = [(k, prose(9000 + 100 * length + k, length)) for k in range(30)]
    docs = []
    for k, text in items:
        words = prose(k, 200).split(" ")
        where = rnd.randrange(len(words))
        docs.append((k, " ".join(words[:where] + text.split(" ") + words[where:])))
    docs += [(100 + i, prose(1000 + i, 200)) for i in range(60)]
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    got = {(r.doc_id, r.item_id) for r in dc.op10(docs, spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert sum((k, k) in got for k, _ in items) >= 27


def test_shared_words_by_range_and_by_place_are_those_of_brute_force():
    rng = np.random.default_rng(5)
    h = rng.integers(0, 12, 400).astype(np.uint64)
    known = np.array([1, 2, 3, 5, 7, 40], np.uint64)
    places = dc.Places(dc.Items([], [], [], [], known, []), h)
    low = rng.integers(0, 380, 60)
    high = low + rng.integers(0, 20, 60)
    which, c = np.array([0, 2, 3, 5]), np.array([1, 3, 2, 2])
    wanted = [sum(min(int(n), int((h[a:b] == known[w]).sum())) for w, n in zip(which, c)) for a, b in zip(low, high)]
    assert places._by_range(which, c, low, high).tolist() == wanted
    assert places._by_place(which, c, places.count[which], low, high).tolist() == wanted
    assert places.overlap((which, c), low[:1], high[:1]).tolist() == wanted[:1]

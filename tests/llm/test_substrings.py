import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest

from quotalens.llm import bwt, substrings


def brute(rows):
    """Rows (id, text): id sorts, null first; texts of one id by start alone (equal texts only)."""
    places = defaultdict(list)
    enc = [(i, (t or "").encode()) for i, t in rows]
    rank = lambda i: (i is not None, i or 0)
    for i, b in enc:
        for j in range(len(b) - 99):
            places[b[j:j + 100]].append((rank(i), j))
    first = {w: min(p) for w, p in places.items()}
    out = []
    for i, b in enc:
        gone = np.zeros(len(b), bool)
        for j in range(len(b) - 99):
            if first[b[j:j + 100]] < (rank(i), j):
                gone[j:j + 100] = True
        kept = bytes(np.frombuffer(b, np.uint8)[~gone])
        spans = int((np.diff(np.append(0, gone.astype(int))) == 1).sum())
        out.append((i, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def table(df):
    return sorted((tuple(r) for r in substrings.op6(df).collect()), key=str)


@pytest.mark.parametrize("hot", [2000, 1])
def test_against_brute_force(small, monkeypatch, hot):
    monkeypatch.setattr(substrings, "HOT", hot)
    assert table(small) == brute([(r.doc_id, r.text) for r in small.collect()])


def test_edge_rows(edge, empty):
    rows = [r for r in edge.collect() if r.doc_id != 7 and r.doc_id is not None]
    df = edge.where("doc_id is not null and doc_id != 7")
    assert table(df) == brute([(r.doc_id, r.text) for r in rows])
    assert substrings.op6(edge).count() == edge.count()  # null ids and texts that share an id
    assert substrings.op6(empty).count() == 0


def test_long_text_is_cut_with_overlap(spark, monkeypatch):
    rnd = random.Random(3)
    part = "".join(rnd.choice("abcdefgh") for _ in range(700))
    long = "".join(rnd.choice("abcdefgh") for _ in range(4_500_000))
    long = long[:3_000_000] + part + long[3_000_000:]
    rows = {r.doc_id: r for r in substrings.op6(spark.createDataFrame(
        [(1, long), (2, part)], "doc_id long, text string")).collect()}
    assert (rows[1].n_removed, rows[2].n_removed, rows[2].n_spans) == (0, 700, 1)


def test_merged_transforms_give_the_repeats():
    rnd = random.Random(2)
    for _ in range(60):
        base = bytes(rnd.choice(b"ab") for _ in range(60))
        strings = [base[a:a + rnd.randint(1, 40)] for a in (rnd.randint(0, 50) for _ in range(8))]
        depth = rnd.choice([1, 2, 5, 8])
        want = defaultdict(list)
        for i, s in enumerate(strings):
            for o in range(len(s) - depth + 1):
                want[s[o:o + depth]].append((i, o))
        got = defaultdict(list)
        for g, s, o in zip(*bwt.repeats(strings, depth, rnd.choice([10, 50, 1000]))):
            got[g].append((int(s), int(o)))
        assert sorted(sorted(v) for v in got.values()) == sorted(sorted(v) for v in want.values() if len(v) > 1)


def test_common_prefixes_of_the_merge():
    strings = [b"banana", b"bandana", b"nab"]
    parts = [np.frombuffer(s + b"\xff", np.uint8) + np.uint8(1) for s in strings]
    orders = [bwt.suffix_order(p, np.array([len(p) - 1])) for p in parts]
    row, _, prefix = bwt.merge([bwt.transform(p, o) for p, o in zip(parts, orders)], [1, 1, 1], 10)
    base = np.cumsum([0, *(len(p) for p in parts)])
    texts = []
    for r in row:
        s = int(np.searchsorted(base, r, "right")) - 1
        texts.append(strings[s][orders[s][r - base[s]]:])
    assert texts == sorted(texts)
    for k in range(1, len(texts)):
        a, b = texts[k - 1], texts[k]
        n = 0
        while n < min(len(a), len(b)) and a[n] == b[n]:
            n += 1
        assert prefix[k] == n

import hashlib

from quotalens.llm import fingerprints as fp


def expected(rows):
    out = []
    for k, (i, t) in enumerate(rows):
        n = rows[(k + 1) % len(rows)][1]
        out.append((i, len(t), hashlib.sha256(fp.edited(t, n).encode()).hexdigest()))
    return out


def test_edited_texts_and_order(spark, small):
    rows = sorted((r.doc_id, r.text) for r in small.collect())
    got = {r.doc_id: r for r in fp.op2(small).collect()}
    for i, n, sha in expected(rows):
        assert (got[i].n_chars, got[i].edited_sha256) == (n, sha)
    by_text = {}
    for i, t in rows:
        assert by_text.setdefault(t, got[i].fingerprint) == got[i].fingerprint


def test_shared_interior_means_shared_names():
    import numpy as np
    from tests.llm.conftest import prose
    body = prose(5, 400).encode()
    a, b = b"some head " + body, b"quite another, longer head here " + body + b" tail"
    raw, offs = np.frombuffer(a + b, np.uint8), np.array([0, len(a), len(a) + len(b)])
    v, o = fp.sketches(raw, offs)
    alike = fp.likeness(v[:o[1]], np.array([0, o[1]]), v[o[1]:], np.array([0, o[2] - o[1]]))
    assert alike[0] > 0.7


def test_edge_rows(edge, empty):
    rows = fp.op2(edge).collect()
    assert len(rows) == edge.count()
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in rows)
    assert all(r.fingerprint == "" for r in rows if r.n_chars == 0)
    assert fp.op2(empty).count() == 0


def test_single_row_follows_itself(spark):
    df = spark.createDataFrame([(1, "abcdef")], "doc_id long, text string")
    r = fp.op2(df).first()
    assert r.edited_sha256 == hashlib.sha256(b"abcabc").hexdigest() and r.near_next == 1.0

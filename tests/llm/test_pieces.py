import os
import random

import numpy as np
import pytest

from quotalens.llm import pieces


def ids(x):
    return np.frombuffer(x, np.int32).tolist()


@pytest.mark.skipif(not os.path.exists(pieces.MODEL_FILE), reason="no model file")
def test_ids_of_the_library():
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL_FILE)
    rnd = random.Random(3)
    texts = ["", " ", "  a", "hello world\n\nfoo\tbar", "漢字 é 🎉 x", "    def f(x):\n  return x", " " * 137 + "x",
             "İ ſ ﬁ", "x ▁ y", "a" * 300, " " * 40]
    texts += ["".join(rnd.choice("etaoin shrdlu  \n.=-A1漢é") for _ in range(rnd.randint(0, 60))) for _ in range(800)]
    coder = pieces.Encoder(pieces.load(pieces.MODEL_FILE))
    got = coder.encode(texts)
    assert [ids(x) for x in got] == sp.encode(texts)
    assert all(a == b for a, b in zip(coder.decode(got), texts) if "▁" not in b)


def test_unigram_scores_against_plain_dynamic_programming():
    rnd = random.Random(8)
    names = sorted({"".join(rnd.choices("abc▁", k=rnd.randint(2, 4))) for _ in range(60)})
    rows = [("<unk>", 0, 2)] + [(n, -rnd.random() * 9 - 1, 1) for n in [*"abc▁", *names]]
    v = pieces.build(rows, merges=False)
    score = {t: s for t, s, k in rows if k == 1}
    for size in (1, 3, 7, 12):
        words = ["".join(rnd.choices("abc▁", k=size)) for _ in range(30)]
        points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(-1, size)
        for w, got in zip(words, pieces.encode_equal(v, points)):
            best = [0.0] + [-1e9] * size
            for e in range(1, size + 1):
                best[e] = max(best[b] + score[w[b:e]] for b in range(e) if w[b:e] in score and best[b] > -1e8)
            assert "".join(rows[i][0] for i in got) == w
            assert sum(rows[i][1] for i in got) == pytest.approx(best[size])


@pytest.mark.skipif(not os.path.exists(pieces.MODEL_FILE), reason="no model file")
def test_edge_rows_and_round_trip(edge, empty):
    rows = pieces.op7(edge).collect()
    assert len(rows) == edge.count() and pieces.op7(empty).count() == 0
    assert all(r.round_trip for r in rows if r.doc_id != 9) and all(r.n_tokens == len(r.ids) for r in rows)
    back = pieces.decode(pieces.op7(edge).select("doc_id", "ids"), pieces.MODEL_FILE)
    texts = sorted((str(r.doc_id), (r.text or "").replace("▁", " ")) for r in edge.collect())
    assert sorted((str(r.doc_id), r.text) for r in back.collect()) == texts


@pytest.mark.skipif(not os.path.exists(pieces.MODEL_FILE), reason="no model file")
def test_words_of_a_batch_are_traced_back_together(monkeypatch):
    coder = pieces.Encoder(pieces.load(pieces.MODEL_FILE))
    words = ["".join(random.Random(k).choices("etaoinshrdlu", k=k % 15 + 1)) for k in range(500)]
    one_by_one = [coder.encode([w])[0] for w in words]
    fresh, made = pieces.Encoder(coder.v), []
    monkeypatch.setattr(pieces, "_ids", lambda ids: made.append(ids) or np.array(ids, np.int32).tobytes())
    assert fresh.encode(words) == one_by_one
    assert not made  # no array of its own for any word


def test_lookup_finds_keys_that_share_their_top_bits():
    keys = np.array([3, 5, (7 << 44) + 1, (7 << 44) + 2, (7 << 44) + 9, (9 << 44), (1 << 64) - 1], np.uint64)
    wanted = np.array([(7 << 44) + 9, 4, 5, (1 << 64) - 1, (7 << 44) + 3, (8 << 44), 3, 5, (9 << 44) + 1], np.uint64)
    which, at = pieces.Lookup(keys).find(wanted)
    assert which.tolist() == [0, 2, 3, 6, 7]
    assert keys[at].tolist() == wanted[which].tolist()
    assert not len(pieces.Lookup(keys[:0]).find(wanted)[0])

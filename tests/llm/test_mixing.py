import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from quotalens.llm import mixing


def tokens(t):
    t = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
    return re.findall(r"[^\x20\x09-\x0D]+", t) + [None]


def base(rows):
    held = [i is not None and zlib.crc32(str(i).encode()) % 5 == 1 for i, _ in rows]
    counts = Counter()
    for (_, t), h in zip(rows, held):
        if not h:
            counts.update(tokens(t))
    n, v = sum(counts.values()), len(counts)
    for (i, t), h in zip(rows, held):
        w = tokens(t)
        yield (i, None if i is None else h, len(w), sum(counts[x] > 0 for x in w), n,
               round(sum(math.log10((counts[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w), 6))


@pytest.mark.parametrize("name", ["edge", "small"])
def test_baseline_against_brute_force(name, request):
    df = request.getfixturevalue(name)
    got = [(*tuple(r)[:5], round(r.base_score, 6)) for r in mixing.op9(df).collect()]
    assert sorted(map(str, got)) == sorted(map(str, base([(r.doc_id, r.text) for r in df.collect()])))


def test_empty_table(empty):
    assert mixing.op9(empty).count() == 0


def mixer():
    rng = np.random.default_rng(0)
    pairs = rng.integers(0, 50, (256, 256)).astype(float)
    return mixing.Mixer(mixing.build_code(pairs), rng.integers(-40, 40, int(mixing._BASES[-1])).astype(np.int8))


def slow(m, text):
    """One text, bit by bit, segment by segment."""
    symbols = [mixing.END] * mixing.PAD + list(text) + [mixing.END]
    total, share = 0.0, None
    for k, i in enumerate(range(mixing.PAD, len(symbols))):
        if k % mixing.SEGMENT == 0:
            share = np.full(len(mixing.ORDERS), 1 / mixing.SCALE)
        key = m.code.classes[symbols[i - 1]] * 256 + symbols[i]
        ctx = mixing.contexts(np.array(symbols, np.uint8), np.array([i]))
        for e in range(m.code.start[key], m.code.start[key] + m.code.length[key]):
            node, bit = m.code.node[e:e + 1], m.code.bit[e]
            v = np.array([m.table[mixing.places(j, c, node)[0]] for j, c in enumerate(ctx)], float)
            p = 1 / (1 + math.exp(-(share * v).sum()))
            total += math.log10(p if bit else 1 - p)
            share = share + mixing.RATE / mixing.SCALE ** 2 * (bit - p) * v
    return total


def test_lanes_give_the_sequential_result():
    m, texts = mixer(), [b"", b"abc", bytes(range(200)) * 4, "é漢字".encode() * 30]
    raw = np.frombuffer(b"".join(texts), np.uint8)
    got = m.log10_probs(raw, np.append(0, np.cumsum([len(t) for t in texts])))
    assert got == pytest.approx([slow(m, t) for t in texts], rel=1e-4)


def test_probabilities_of_the_next_byte_add_up():
    m = mixer()
    before = b"the context"
    whole = sum(10 ** (slow(m, before + bytes([x])) - slow(m, before + bytes([x])[:0])
                       + _end(m, before) - _end(m, before + bytes([x]))) for x in range(255))
    assert whole + 10 ** _end(m, before) == pytest.approx(1, rel=1e-6)


def _end(m, text):
    """log10 probability of the closing symbol alone, after ``text`` in the same segment."""
    return slow(m, text) - slow_open(m, text)


def slow_open(m, text):
    """log10 probability of the text's bytes without the closing symbol."""
    symbols = [mixing.END] * mixing.PAD + list(text) + [mixing.END]
    total, share = 0.0, np.full(len(mixing.ORDERS), 1 / mixing.SCALE)
    for i in range(mixing.PAD, len(symbols) - 1):
        key = m.code.classes[symbols[i - 1]] * 256 + symbols[i]
        ctx = mixing.contexts(np.array(symbols, np.uint8), np.array([i]))
        for e in range(m.code.start[key], m.code.start[key] + m.code.length[key]):
            bit = m.code.bit[e]
            v = np.array([m.table[mixing.places(j, c, m.code.node[e:e + 1])[0]] for j, c in enumerate(ctx)], float)
            p = 1 / (1 + math.exp(-(share * v).sum()))
            total += math.log10(p if bit else 1 - p)
            share = share + mixing.RATE / mixing.SCALE ** 2 * (bit - p) * v
    return total


def counted(df):
    """Code, cells and brute-force (place -> [zero, one]) of all of ``df``'s bits."""
    from quotalens.llm.common import id_text
    docs = id_text(df).withColumnRenamed("doc_id", "row")
    code, cells = mixing.build_code(mixing.count_pairs(docs)), mixing.cell_counts(docs)
    want, bits = {}, 0
    for r in docs.collect():
        raw = np.frombuffer(r.text.encode(), np.uint8)
        symbols, at, _, _ = mixing.stream(raw, np.array([0, len(raw)]))
        node, bit, _, _, n = mixing.events(code, symbols, at)
        bits += len(bit)
        for k, c in enumerate(mixing.contexts(symbols, at)):
            for p, v in zip(mixing.places(k, np.repeat(c, n), node).tolist(), bit.tolist()):
                want.setdefault(p, [0, 0])[v] += 1
    return code, cells, want, bits


def test_tables_hold_every_training_bit(small):
    code, cells, want, _ = counted(small)
    got = {r.place: [int(r.zero), int(r.one)] for r in mixing.bit_counts(cells, code).collect()}
    assert got == want


def test_weights_are_fitted_on_every_training_bit(edge):
    """Long texts and all rows: no window, no share of them."""
    code, cells, want, bits = counted(edge)
    one, zero = (np.zeros(int(mixing._BASES[-1]), np.float32) for _ in range(2))
    for p, (z, o) in want.items():
        zero[p], one[p] = z, o
    key, n = mixing.gate_counts(cells, code, one, zero)
    assert n.sum() == bits
    again = mixing._gates(key[::-1], n[::-1])
    assert np.array_equal(mixing._gates(key, n), again) and not np.allclose(again, 1 / len(mixing.ORDERS))
